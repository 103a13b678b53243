"""Incoming records -> raw -> bronze (-> silver) as streams.

Every job takes a trigger: `availableNow` (the default) drains what is there and
stops, so a scheduler can start it; `{"processingTime": "10 minutes"}` keeps it running.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import bronze as bronze_ops
from tidemark.operators.ingest import ingestion_log, stamp
from tidemark.operators.validate import extract_fields, quarantined, valid_events, validate
from tidemark.sources.state import RunState
from tidemark.sources.tables import write_load

DRAIN = {"availableNow": True}

STAMPED = ["ingested_at", "request_id"]


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream that a checkpoint belongs to, made when it is first used.

    Batches count from 0 in every stream, so only name and batch together tell loads apart.
    The name lives inside the checkpoint folder: a reset checkpoint is another stream.
    """
    state = RunState(spark, f"{checkpoint}/name")
    if state.get("stream") is None:
        state.put("stream", uuid.uuid4().hex)
    return state.get("stream")


def land_events(
    incoming: DataFrame,
    raw_path: str,
    log_path: str,
    rejected_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Validate and stamp incoming records, append them to raw and log them.

    Each micro-batch of a stream owns its folders and overwrites them when it is retried. The
    log is derived from the landed files, so both carry the same request ids. If a
    reader already took the files of a failed try, it sees their events twice; silver
    keeps one per event_id.
    """

    stream = stream_id(incoming.sparkSession, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"batch={stream}-{batch_id}"
        folder = f"{raw_path}/{own}"
        judged = validate(batch)
        accepted = stamp(valid_events(judged).select("payload"))
        # The record as sent, with the two ingestion fields set.
        sent = F.col("payload").cast("map<string,variant>")
        kept = F.map_filter(sent, lambda name, _: ~name.isin(STAMPED))
        added = F.create_map(*[part for c in STAMPED for part in (F.lit(c), F.col(c).cast("variant"))])
        accepted.select(F.to_json(F.map_concat(kept, added)).alias("value")).write.mode(
            "overwrite"
        ).text(folder)
        landed = spark.read.schema("payload variant").option("singleVariantColumn", "payload").json(folder)
        ingestion_log(extract_fields(landed)).write.mode("overwrite").partitionBy("log_date").json(
            f"{log_path}/{own}"
        )
        quarantined(judged).withColumn("payload", F.to_json("payload")).write.mode("overwrite").json(
            f"{rejected_path}/{own}"
        )

    return (
        incoming.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )


def load_bronze(
    raw: DataFrame,
    bronze_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    after: Callable[[], object] | None = None,
) -> StreamingQuery:
    """Add new raw records to bronze exactly once; `after()` runs once a micro-batch is in.

    With `after` promoting to silver the whole way is one stream. Late copies must replace
    earlier ones, also across dates, so silver is rebuilt from bronze for the lookback
    window; deduplicating inside the stream would keep the first copy.

    A micro-batch covers the same files when it is retried and replaces its own `load`
    partitions, so no record is added twice. It is a batch write, so that adaptive
    execution sizes the files and splits a partition that gets most of the rows.
    """

    stream = stream_id(raw.sparkSession, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        write_load(bronze_ops.bronze(batch), bronze_path, f"{stream}-{batch_id}")
        if after is not None:
            after()

    return (
        raw.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DRAIN))
        .start()
    )
