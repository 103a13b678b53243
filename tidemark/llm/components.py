"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) for every node of the links (a, b).

    Each round a node takes the smallest label among its neighbours' and then the label of
    that label, which shortens long chains by half; the table is written between rounds, and
    minima combine before their shuffle, so a node may have any number of links. Ends when
    a round changes nothing.
    """
    both = store(
        links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links"
    )
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("new")
        )
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("further"))
        moved = store(
            lower.join(jump, F.col("new") == F.col("to"), "left").select(
                "node", F.least("new", F.coalesce("further", "new")).alias("component"), "old"
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.filter("component <> old").isEmpty():
            return labels
