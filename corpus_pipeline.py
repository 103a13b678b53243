"""From raw documents to shards: quality rules, near duplicates, benchmark leaks, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, prefix_tree, quality, shards
from tidemark.llm.common import broadcast_if_small, same, store, table, unused

#: No SQL: a language model, and splitters found by rounds. Tested against brute force.
ORACLE_SQL = None


def _only(docs: DataFrame, chosen: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of `docs` whose (doc_id, text hash) is among (id, hash) of `chosen`, or isn't."""
    of_id, of_hash = unused(docs, "id", "hash")
    on = same(F.col("doc_id"), F.col(of_id)) & same(F.xxhash64("text"), F.col(of_hash))
    return docs.join(broadcast_if_small(chosen.toDF(of_id, of_hash)), on, how)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or lie outside their language's perplexity band, go."""
    judged = store(quality.judge(docs).select("doc_id", "text_hash", "kept"), "judged")
    # A null text is judged as an empty one and fails.
    bad = judged.filter(~F.col("kept")).select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")
    ).distinct()
    return _only(docs, bad, "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one stays, the one with the smallest id: null ids last,
    texts under one id by hash, of rows with the same id and text any. Texts without words are
    no duplicates of each other, and rows that share only an id aren't either."""
    groups = store(prefix_tree.jaccard_join(docs).filter("part is not null"), "groups")
    key = [F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")]
    least = same(F.col("doc_id"), F.col("component_id"))
    kept = _only(docs, groups.filter(~least).select(*key).distinct(), "left_anti")
    # Where the smallest id stands on several rows of a group:
    several = store(
        groups.filter(least).groupBy(F.col("part").alias("of"))
        .agg(F.min("doc_id").alias("id"), F.min("text_hash").alias("hash"), F.count("*").alias("rows"))
        .filter("rows > 1"),
        "several",
    )
    if several.isEmpty():
        return kept
    theirs = groups.filter(least).join(several.select("of", F.col("hash").alias("first")), F.col("part") == F.col("of"))
    kept = _only(kept, theirs.filter("text_hash <> first").select(*key).distinct(), "left_anti")
    first = several.select("id", "hash")
    (own_hash,) = unused(kept, "own_hash")
    once = _only(kept, first).withColumn(own_hash, F.xxhash64("text"))
    return _only(kept, first, "left_anti").unionByName(once.dropDuplicates(["doc_id", own_hash]).drop(own_hash))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes. Texts stay whole: a document taken in part goes once more if at
    least half of its words are taken, so a source is off its target by half a document. `n_chars` follows the text.

    Rows of one source with the same id and text share their copies evenly. Where these don't come out even, which
    happens to one text a source at most, rows are numbered and the first ones get one more.
    """
    mixed = mixing.mix(docs, mixing.label_quality(table(spark, sf_dir, "labels")))
    copies = F.floor(F.col("taken") / F.col("size") + 0.5)
    taken = store(
        mixed.filter("taken > 0").groupBy(
            F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("source").alias("of")
        ).agg(F.sum(copies).cast("int").alias("all_copies"), F.count("*").cast("int").alias("rows"))
        .filter("all_copies > 0"),
        "taken",
    )
    # Apart from the columns of `docs`, whatever these are called.
    of_id, of_hash, of_source, all_copies, n_rows, number = names = unused(docs, *taken.columns, "number")
    on = same(F.col("doc_id"), F.col(of_id)) & same(F.xxhash64("text"), F.col(of_hash))
    rows = docs.join(taken.toDF(*names[:-1]), on & same(F.col("source"), F.col(of_source)))
    even = F.col(all_copies) % F.col(n_rows) == 0
    numbered = W.partitionBy(of_id, of_hash, of_source).orderBy(of_id)
    dealt = rows.filter(even).withColumn(number, F.lit(0)).unionByName(
        rows.filter(~even).withColumn(number, F.row_number().over(numbered) - 1)
    )
    own = F.floor((F.col(all_copies) + F.col(n_rows) - 1 - F.col(number)) / F.col(n_rows)).cast("int")
    copies = dealt.withColumn(number, F.explode(F.array_repeat(F.lit(1), own)))
    if "n_chars" in docs.columns:
        copies = copies.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return copies.select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with size, shard and slot."""
    return shards.histogram_sort(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mix),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
