"""Mix sources to target weights by weighted sampling with exponential keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, same, store

#: Documents of one source whose keys one task sorts.
ROWS_PER_BUCKET = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(totals: DataFrame, weights: tuple[int, ...], share: float, epochs: float) -> DataFrame:
    """Words wanted from each source: source, source_size, rows, target.

    Sources by code point, null last, take `weights` in turn and share `share` times all
    words. None gets more than `epochs` times its own words; what is above goes to the
    others by weight. With the sources by (limit / weight), the common rate after filling
    the first k rises while limits bind and falls after, so its maximum is the rate.

    One row per source, so one task sorts the sources (never their documents).
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = totals.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("double")
    ).withColumn("limit", F.col("source_size") * F.lit(float(epochs)))
    filled = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    after = filled.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rated = weighted.withColumn(
        "rate",
        (F.sum("source_size").over(everything) * F.lit(float(share))
         - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    rate = F.max("rate").over(everything)
    return rated.select(
        "source", "source_size", "n_rows", F.least("limit", rate * F.col("weight")).alias("target")
    )


def mix(
    docs: DataFrame,
    quality: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """Words to take from every document: doc_id, source, text_hash, size, source_size, target, taken.

    `docs` has doc_id, source, text; `quality` a positive weight per doc_id. As many whole
    epochs of a source as its target holds come first. The rest is sampled: each document
    draws the key -ln(u) / quality (Efraimidis and Spirakis), with u from a hash of seed,
    id and text, so that reruns agree; by rising key whole documents are taken until the
    words left are used up, the last one with its first words only. So a source gives its
    target to the word, and no document more than the epochs allow. Texts are read once and never
    shuffled.

    A source may hold any part of the rows: keys are cut into buckets of about
    `ROWS_PER_BUCKET`, bucket sums are added up first, and only a bucket is sorted whole.

    A null text has no words and gives none; a null source is a source; repeated rows are
    documents of their own; a null, non-positive or missing weight counts as 1, and of several
    the largest holds; an empty table gives no rows; other columns are not read.
    """
    draw = F.md5(
        F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                    F.coalesce(F.md5("text"), F.lit("")))
    )
    u = (F.conv(F.substring(draw, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    sized = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).alias("size"),
        (-F.log(u)).alias("plain"), draw.alias("tie"),
    )
    rated = quality.groupBy(F.col("doc_id").alias("rated")).agg(F.max("weight").cast("double").alias("given"))
    weight = F.when(F.col("given") > 0, F.col("given")).otherwise(1.0)
    sized = store(
        store(sized, "drawn").join(rated, F.col("doc_id") == F.col("rated"), "left")
        .withColumn("draw", F.col("plain") / weight).drop("plain", "rated", "given"),
        "sized",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    wanted = store(targets(totals, weights, share, epochs), "targets")  # its size is known from here on
    wanted = wanted.withColumnRenamed("source", "of")
    buckets = F.ceil(F.col("n_rows") / ROWS_PER_BUCKET)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rows = (
        sized.join(wanted, same(F.col("source"), F.col("of")))
        .withColumn("bucket", F.floor((1 - F.exp(-F.col("draw"))) * buckets))
        .withColumn("whole", whole)
        .withColumn("left", F.floor(F.col("target") + 0.5) - F.col("whole") * F.col("source_size"))
    )
    key = ["source", "bucket"]
    sums = rows.groupBy(*key).agg(F.sum("size").alias("in_bucket"))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"),
        F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("before"),
    )
    rows = rows.join(sums, same(F.col("source"), F.col("s")) & (F.col("bucket") == F.col("b")))
    within = W.partitionBy(*key).orderBy("draw", "tie").rowsBetween(W.unboundedPreceding, -1)
    before = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - before))
    return rows.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        (F.col("whole") * F.col("size") + part).cast("bigint").alias("taken"),
    )


def label_quality(labels: DataFrame) -> DataFrame:
    """doc_id and weight: 2 for documents labelled good, 0.5 for bad ones."""
    return labels.select("doc_id", F.when(F.col("quality") > 0, 2.0).when(F.col("quality") <= 0, 0.5).alias("weight"))
