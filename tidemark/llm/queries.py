"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    decontaminate,
    language,
    mixing,
    packing,
    prefix_tree,
    quality,
    secrets,
    shards,
    spelling,
    url_filter,
    warc,
    whitening,
)
from tidemark.llm.common import table
from tidemark.llm.oracle import ORACLE_SQL

LANGUAGES = ["de", "en", "es", "fr"]
N_SHARDS = 24
#: host, path, verdict
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_secret_ownership(spark: SparkSession, sf: str) -> DataFrame:
    """Owner is the document's source, a repository a language of a source."""
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", F.col("source").alias("owner"), F.concat_ws("/", "source", "lang").alias("repo")
    )
    return secrets.scan(docs)


def op2_language_fusion(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with all evidence, and documents with their text and their source as host."""
    docs = table(spark, sf, "documents")
    model = language.train(docs, LANGUAGES)
    nothing = F.lit(None).cast("bigint")
    pages = language.page_rows(table(spark, sf, "pages")).withColumn("doc_id", nothing)
    own = docs.select(
        nothing.alias("page_id"), "text", F.lit("").alias("markup"), F.col("source").alias("host"), "doc_id"
    )
    return language.identify(pages.unionByName(own), LANGUAGES, model)


def op3_containment_search(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(
        "doc_id", "item_id", "n_found", "n_item"
    )


def op4_histogram_sort(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return shards.histogram_sort(rows, N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_prefix_tree_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = prefix_tree.jaccard_join(table(spark, sf, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op6_weighted_sampling(spark: SparkSession, sf: str) -> DataFrame:
    quality_of = mixing.label_quality(table(spark, sf, "labels"))
    return mixing.mix(table(spark, sf, "documents"), quality_of).select("doc_id", "size", "source_size", "target", "taken")


def op7_warc_derivatives(spark: SparkSession, sf: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf, "pages"), "2024-01-01T00:00:00Z"))


def op8_snapshot_collapse(spark: SparkSession, sf: str) -> DataFrame:
    return chat.collapse(table(spark, sf, "conversations"))


def op9_url_expressions(spark: SparkSession, sf: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filter.judge(table(spark, sf, "pages"), rules).drop("url")


def op10_perplexity_bands(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("log_perplexity", 9).alias("log_perplexity"), F.round("word_perplexity", 9).alias("word_perplexity"),
    )


def op11_configuration_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers  # the files of public tokenizers, which every executor has

    docs = table(spark, sf, "documents")
    pieces = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return packing.place(pieces)


def op12_contour_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.components(table(spark, sf, "embeddings"))


def op13_variable_gram_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_ownership, op2_language_fusion, op3_containment_search, op4_histogram_sort, op5_prefix_tree_join,
        op6_weighted_sampling, op7_warc_derivatives, op8_snapshot_collapse, op9_url_expressions, op10_perplexity_bands,
        op11_configuration_packing, op12_contour_whitening, op13_variable_gram_variants,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
