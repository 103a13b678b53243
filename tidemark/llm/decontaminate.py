"""Benchmark decontamination: short test items inside long documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, broadcast_if_small, same, store, unused

SHINGLE = 5


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingles(n: Column, of) -> Column:
    """`of(i)` for every first word i of a shingle; one for all words of a text too short."""
    last = F.greatest(n - SHINGLE, F.lit(0))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), of)).otherwise(F.array())


def shingle_hashes(tokens: str) -> Column:
    """64-bit hashes of the 5-word shingles of an array column.

    Explode these with explode_outer: for explode, Spark infers a filter on the array's size
    and pushes it below, where it splits the text again for every word.
    """
    return _shingles(
        F.size(tokens), lambda i: F.xxhash64(*[F.get(F.col(tokens), i + k) for k in range(SHINGLE)])
    ).cast("array<bigint>")


def _runs(tokens: str, size: int, of) -> Column:
    """`of(i)` for the first word i of every run of `size` words."""
    last = F.size(tokens) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), of)).otherwise(F.array())


def run_hashes(tokens: str, size: int) -> Column:
    """Hashes of all runs of fewer words than a shingle has; equal to a short item's, as hashing passes over nulls."""
    return _runs(tokens, size, lambda i: F.xxhash64(*[F.get(F.col(tokens), i + k) for k in range(size)])).cast("array<bigint>")


def run_texts(tokens: str, size: int) -> Column:
    return _runs(tokens, size, lambda i: F.array_join(F.slice(F.col(tokens), i + 1, size), " ")).cast("array<string>")


def shingle_texts(tokens: str) -> Column:
    return _shingles(F.size(tokens), lambda i: F.array_join(F.slice(F.col(tokens), i + 1, SHINGLE), " ")).cast(
        "array<string>"
    )


def signatures(items: DataFrame, threshold: float) -> DataFrame:
    """Min-hashes of every item: item, size_class, least, hash.

    Items are partitioned by size: class c holds those of 2^c to 2^(c+1) - 1 distinct
    shingles. An item of n shingles of which at least a `threshold` stands in a document
    misses at most floor((1 - threshold) n) of them, so of its 1 + floor((1 - threshold) n)
    smallest hashes the document has one at least: the number of min-hashes grows with the
    class and no containment is lost, however long the document.
    """
    sets = items.select("item", F.array_sort(F.array_distinct(shingle_hashes("tokens"))).alias("hashes"))
    n = F.size("hashes")
    k = n - F.ceil(F.lit(threshold) * n - 1e-9).cast("int") + 1
    return sets.filter(n > 0).select(
        "item", F.floor(F.log2(n)).alias("size_class"),
        F.explode_outer(F.slice("hashes", F.lit(1), k)).alias("hash"),
    )


def contained(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Items of which a `threshold` or more of the distinct 5-word shingles stand in a document.

    `docs` has doc_id and text, `items` item_id and text. Returns a row per pair: doc_id,
    text_hash, item_id, n_found, n_item, containment.

    Candidates come from min-hashes of the items (see `signatures`) looked up among the
    shingle hashes of all documents; the documents' side of a MinHash comparison is its
    whole set, because a signature of equal length on both sides finds a 30-word item in a
    document of 20,000 words only with thousands of hash functions. Documents with fewer
    shingles than the smallest item of a size class needs are not looked up in that class.
    Candidates are then counted exactly, on the shingles' text.

    Item hashes are broadcast if a count proves them few; beyond that the join shuffles.
    A document's shingles never leave their task unless they match a min-hash.

    An item of fewer than 5 words is one shingle of so many words. It is looked up among all runs of its
    length in every document; only lengths that occur among the items cost anything.

    Letters compare in lower case. Items without words match nothing, and so do null texts.
    Each text of an item_id, null too, is an item of its own; of several found in a document
    the one of the highest containment is reported, of these the largest. Repeated items are
    one item; repeated rows give one row; empty tables give none.
    """
    items = items.select(
        F.struct("item_id", F.xxhash64("text").alias("item_hash")).alias("item"), words(F.col("text")).alias("tokens")
    )
    signed = store(signatures(items, threshold), "signatures")
    # An item needs ceil(threshold * n) shingles; in its class at least that of the smallest size.
    signed = signed.dropDuplicates(["item", "hash"]).withColumn(
        "least", F.ceil(F.lit(threshold) * F.pow(F.lit(2.0), F.col("size_class")) - 1e-9)
    )
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("tokens"))
    n_words = F.size("tokens")
    lengths = items.filter((n_words > 0) & (n_words < SHINGLE)).select(n_words.alias("n")).distinct()
    short = sorted(row["n"] for row in lengths.collect())  # of 1 to 4
    hashed = texts.select(
        "doc_id", "text_hash", shingle_hashes("tokens").alias("hashes"),
        *[run_hashes("tokens", n).alias(f"runs_{n}") for n in short],
    )
    every = F.concat("hashes", *[f"runs_{n}" for n in short]) if short else F.col("hashes")
    looked_up = hashed.select(
        "doc_id", "text_hash", F.size("hashes").alias("n_doc"), F.explode_outer(every).alias("shingle")
    )
    hits = looked_up.join(
        broadcast_if_small(signed), (F.col("shingle") == F.col("hash")) & (F.col("n_doc") >= F.col("least"))
    )
    pairs = store(hits.groupBy("doc_id", "text_hash", "item").agg(F.lit(1).alias("one")).drop("one"), "candidates")

    wanted = pairs.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(F.lit(1).alias("one"))
    only = same(F.col("doc_id"), F.col("d")) & same(F.col("text_hash"), F.col("h"))
    suspects = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(
        broadcast_if_small(wanted.drop("one")), only, "left_semi"
    )
    suspects = suspects.select("doc_id", "text_hash", words(F.col("text")).alias("tokens")).select(
        "doc_id", "text_hash", F.array_distinct(F.concat(shingle_texts("tokens"), *[run_texts("tokens", n) for n in short])).alias("doc_set"),
    )
    parts = items.select("item", F.explode_outer(shingle_texts("tokens")).alias("s")).dropDuplicates(["item", "s"])
    item_sets = parts.groupBy(F.col("item").alias("i")).agg(F.collect_set("s").alias("item_set"))
    sized = pairs.join(item_sets, same(F.col("item"), F.col("i"))).select(
        F.col("doc_id").alias("pd"), F.col("text_hash").alias("ph"), "item", "item_set"
    )
    both = suspects.join(sized, same(F.col("doc_id"), F.col("pd")) & same(F.col("text_hash"), F.col("ph")))
    n_found = F.size(F.array_intersect("doc_set", "item_set"))
    return (
        both.select("doc_id", "text_hash", F.col("item.item_id").alias("item_id"), n_found.cast("bigint").alias("n_found"),
                    F.size("item_set").cast("bigint").alias("n_item"))
        .filter(F.col("n_found") >= F.col("n_item") * threshold - 1e-9)
        .withColumn("containment", F.col("n_found") / F.col("n_item"))
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max(F.struct("containment", "n_item", "n_found")).alias("best"))
        .select("doc_id", "text_hash", "item_id", "best.n_found", "best.n_item", "best.containment")
    )


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of `docs` that hold no item."""
    found = store(contained(docs, items, threshold), "contaminated")
    gone_id, gone_hash = unused(docs, "gone_id", "gone_hash")
    gone = found.groupBy("doc_id", "text_hash").agg(F.lit(1).alias("one")).drop("one").toDF(gone_id, gone_hash)
    return docs.join(
        broadcast_if_small(gone),
        same(F.col("doc_id"), F.col(gone_id)) & same(F.xxhash64("text"), F.col(gone_hash)), "left_anti",
    )
