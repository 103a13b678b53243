"""Secret scan with corpus-wide ownership frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import same, store

#: kind -> (pattern, group of the value, fewest characters of it); the order breaks ties of spans.
BASE = {
    "assign": (
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
#: Any long run of token characters is a candidate too.
TOKEN = ("token", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|change_?me|your|xxxx|test_?key|1234567"


def _matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """All matches in order: kind, ordinal, gap before it, length, value. Empty without one.

    The pieces between matches give the positions, so no expression needs offsets.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(F.split(text, pattern).alias("gap"), found.alias("whole"), values.alias("value"))
    rows = F.transform(
        F.filter(zipped, lambda m: m["whole"].isNotNull()),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("ordinal"),
            F.length(m["gap"]).cast("bigint").alias("gap"),
            F.length(m["whole"]).cast("bigint").alias("length"), m["value"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:string,ordinal:int,gap:bigint,length:bigint,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def looks_live(value: Column) -> Column:
    """16+ characters, 8+ different ones, a digit and a letter, and no word of examples."""
    different = F.size(F.array_distinct(F.split(value, "")))
    return (
        (F.length(value) >= 16) & (different >= 8) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        & ~value.rlike(PLACEHOLDER)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """One row per match that is long enough: owner, repo, kind, start, end, value_start, value.

    Positions are code points. Matches of a text are numbered and their lengths summed in a
    window per text, so the cost is linear in the matches.
    """
    kinds = [(k, *v) for k, v in BASE.items()] + [TOKEN]
    text = F.col("text")
    found = docs.select(
        "doc_id", "text_hash", "owner", "repo",
        F.explode_outer(F.concat(*[_matches(text, k, p, g) for k, p, g, _ in kinds])).alias("m"),
    ).filter("m is not null").select("doc_id", "text_hash", "owner", "repo", "m.*")
    so_far = W.partitionBy("doc_id", "text_hash", "owner", "repo", "kind").orderBy("ordinal")
    # Repeated rows give the same matches; each counts once.
    placed = found.dropDuplicates(["doc_id", "text_hash", "owner", "repo", "kind", "ordinal"]).withColumn(
        "end", F.sum(F.col("gap") + F.col("length")).over(so_far)
    )
    long_enough = F.lit(False)
    for kind, _, _, least in kinds:
        long_enough = long_enough | ((F.col("kind") == kind) & (F.length("value") >= least))
    return placed.filter(long_enough).select(
        "doc_id", "text_hash", "owner", "repo", "kind",
        (F.col("end") - F.col("length")).alias("start"), "end",
        (F.col("end") - F.length("value")).alias("value_start"), "value",
    )


def ownership(
    found: DataFrame, max_owners: int = 1, copied_owners: int = 3, copied_repos: int = 4
) -> DataFrame:
    """Per candidate hash: n_owners, n_repos and whether it is copied, shared or specific.

    Copied: with `copied_owners` owners or in `copied_repos` repositories, be they of one owner.
    Specific: with `max_owners` at most and not copied. Shared: all between.

    Distinct (hash, owner, repo) first, combined before the shuffle, then sums: a value that
    stands in any part of the documents is a few rows per task.
    """
    owned = found.groupBy("value_hash", "owner", "repo").agg(F.lit(1).alias("one"))
    per_owner = owned.groupBy("value_hash", "owner").agg(F.count("*").alias("repos"))
    return (
        per_owner.groupBy(F.col("value_hash").alias("hash"))
        .agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))
        .withColumn(
            "spread",
            F.when((F.col("n_owners") >= copied_owners) | (F.col("n_repos") >= copied_repos), "copied")
            .when(F.col("n_owners") > max_owners, "shared").otherwise("specific"),
        )
    )


def scan(docs: DataFrame, max_owners: int = 1, copied_owners: int = 3, copied_repos: int = 4) -> DataFrame:
    """Secrets of every document, judged by who else has them.

    `docs` has doc_id, text, owner, repo. Matches of the `BASE` kinds are spans as they are.
    Every value found, and every other long token, is a candidate: its hash is counted over
    distinct owners and repositories of the whole corpus (see `ownership`). A specific one that
    looks live (see `looks_live`) adds a span of kind `live` over the value; a shared one that looks live is
    counted in n_shared, and a widely copied one, an example, in n_copied.

    Returns doc_id, n_assign, n_access, n_hex, n_live, n_shared, n_copied, base_sha256, spans, copied
    (spans of widely copied candidates) and owned: kind:start:end:owners:repositories of all candidates
    that are live, shared or copied. A null text is empty; a null owner or repository is
    one of its own; repeated rows each get the same row; an empty table gives none; a text
    without a match has empty lists; other columns are not read.
    """
    keyed = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.md5("text").alias("text_hash"),
        F.coalesce(F.col("owner").cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col("repo").cast("string"), F.lit("")).alias("repo"),
    )
    found = store(candidates(keyed).withColumn("value_hash", F.sha2("value", 256)), "secrets")
    spread = ownership(found, max_owners, copied_owners, copied_repos)
    judged = found.join(spread, F.col("value_hash") == F.col("hash"))
    order = {k: i for i, k in enumerate([*BASE, "live", "shared", "copied"])}

    def span(kind: Column, start: str, end: str, rank: Column) -> Column:
        text = F.concat_ws(":", kind, F.col(start).cast("string"), F.col(end).cast("string"))
        owned = F.concat_ws(":", text, F.col("n_owners").cast("string"), F.col("n_repos").cast("string"))
        return F.struct(
            F.col(start).alias("start"), rank.alias("rank"), F.col(end).alias("end"), text.alias("text"), owned.alias("owned")
        )

    rank = F.create_map(*[F.lit(x) for k in BASE for x in (k, order[k])])
    base = F.when(F.col("kind").isin(*BASE), span(F.col("kind"), "start", "end", rank[F.col("kind")]))

    def judged_as(kind: str, spread: str, which: Column) -> Column:
        return F.when(
            (F.col("spread") == spread) & which, span(F.lit(kind), "value_start", "end", F.lit(order[kind]))
        )

    live = judged_as("live", "specific", looks_live(F.col("value")))
    shared = judged_as("shared", "shared", looks_live(F.col("value")))
    copied = judged_as("copied", "copied", F.lit(True))
    key = ["doc_id", "text_hash", "owner", "repo"]
    per_doc = (
        judged.select(*key, F.explode_outer(F.array(base, live, shared, copied)).alias("s"))
        .filter("s is not null")
        .groupBy(*[F.col(k).alias(f"_{k}") for k in key])
        .agg(F.array_sort(F.collect_set("s")).alias("all"))
    )

    def ranked(*kinds: str) -> Column:
        return F.filter("all", lambda s: s["rank"].isin(*[order[k] for k in kinds]))

    def joined(spans: Column, field: str = "text") -> Column:
        return F.array_join(F.transform(spans, lambda s: s[field]), ",")

    def number(kind: str) -> Column:
        return F.coalesce(F.size(ranked(kind)), F.lit(0)).cast("bigint").alias(f"n_{kind}")

    on = same(F.col("doc_id"), F.col("_doc_id")) & same(F.col("text_hash"), F.col("_text_hash"))
    on = on & (F.col("owner") == F.col("_owner")) & (F.col("repo") == F.col("_repo"))
    rows = keyed.select(*key).join(per_doc, on, "left").withColumn(
        "all", F.coalesce("all", F.array().cast(per_doc.schema["all"].dataType))
    )
    return rows.select(
        "doc_id", *[number(k) for k in order], F.sha2(joined(ranked(*BASE)), 256).alias("base_sha256"),
        joined(ranked(*BASE, "live")).alias("spans"), joined(ranked("copied")).alias("copied"),
        joined(ranked("live", "shared", "copied"), "owned").alias("owned"),
    )
