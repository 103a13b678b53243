"""Session settings the pipeline relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps at rest are zone-free UTC wall times; the session must agree.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets the REBALANCE hint in front of partitioned writes split a hot partition.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
