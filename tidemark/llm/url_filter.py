"""URL filter by host-suffix and path-prefix expressions looked up by hash prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, same

#: Hex digits of the digest that the equi-join compares (32 bits).
SHORT_DIGITS = 8


def short_hash(expression: Column, digits: int = SHORT_DIGITS) -> Column:
    """The first hex digits of an expression's digest, as a number."""
    return F.conv(F.substring(F.sha2(expression, 256), 1, digits), 16, 10).cast("bigint")


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host, up to ? # or end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def _prepared(rules: DataFrame, short_digits: int) -> DataFrame:
    """One row per expression: of repeated rules with different verdicts, block holds."""
    expression = F.concat(ascii_lower(F.col("host")), F.col("path"))
    return (
        rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull())
        .groupBy(expression.alias("rule"), ascii_lower(F.col("host")).alias("rule_host"))
        .agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("digest", F.sha2("rule", 256))
        .withColumn("short", short_hash(F.col("rule"), short_digits))
    )


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Host suffixes of up to `labels` labels, each with every path prefix that ends in one
    of the first `slashes` slashes, with no path, and with the whole path."""
    parts = F.split(host, r"\.")
    steps = F.split(path, "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."),
    )
    n = F.least(F.size(steps) - 1, F.lit(slashes))
    prefixes = F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(1), n), lambda k: F.concat(F.array_join(F.slice(steps, 1, k), "/"), F.lit("/"))
        ),
    ).otherwise(F.array().cast("array<string>"))
    paths = F.array_distinct(F.concat(F.array(F.lit(""), path), prefixes))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(paths, lambda p: F.concat(s, p))))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    key: str = "page_id",
    default: str = "allow",
    short_digits: int = SHORT_DIGITS,
) -> DataFrame:
    """A verdict for every row of `pages`: key, url, host, path, rule, verdict.

    `rules` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains where the path starts with the rule's, which ends in a slash, is empty, or
    is the whole path. The longest rule wins; of two as long, the one with the longer
    host, then the later in order. Without a rule the verdict is `default`.

    How far an address is expanded follows from the rules (most labels, most slashes),
    so a long address costs no more expressions than rules could match. The join compares
    hash prefixes of `short_digits` hex digits, and no digest travels to it; that of an expression is
    computed again for the pairs that meet, and confirmed. Spark broadcasts the
    rules if their known size allows it and shuffles by hash prefix otherwise.

    A null url, or one without ://, has an empty host and path and gets the default.
    Repeated rows each get their row; a null key is a key like others; other columns of
    `pages` are not read; without rules all rows get the default.
    """
    rules = _prepared(rules, short_digits)
    reach = rules.select(
        F.max(_labels(F.col("rule_host"))),
        F.max(F.size(F.split(F.substr("rule", F.length("rule_host") + 1), "/")) - 1),
    ).first()
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url")).select(
        "key", "url", F.xxhash64("url").alias("url_hash"),
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
    )
    rules = rules.select(
        "short", "digest", "rule", "rule_verdict", F.length("rule_host").alias("host_length")
    )
    found = expressions(F.col("host"), F.col("path"), reach[0] or 0, reach[1] or 0)
    looked_up = (
        rows.filter(F.col("host") != "")
        .select("key", "url_hash", F.explode_outer(found).alias("expression"))
        .withColumn("expression_short", short_hash(F.col("expression"), short_digits))
    )
    # Both bounds instead of an equality, which Spark would make a key of the join.
    sha = F.sha2("expression", 256)
    confirmed = looked_up.join(
        rules, (F.col("expression_short") == F.col("short")) & (sha >= F.col("digest")) & (sha <= F.col("digest"))
    )
    best = confirmed.groupBy(F.col("key").alias("k"), F.col("url_hash").alias("h")).agg(
        F.max(F.struct(F.length("rule"), "host_length", "rule", "rule_verdict")).alias("best")
    )
    return rows.join(best, same(F.col("key"), F.col("k")) & (F.col("url_hash") == F.col("h")), "left").select(
        F.col("key").alias(key), F.col("url"), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
