"""Language identification by Bayesian fusion of text, markup, address and host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, same, store
from tidemark.llm.url_filter import host_of

BINS = 1 << 14  # hashed byte trigrams: the text model has a row of this many per language
#: Log odds the text may give: neighbouring trigrams repeat each other, so long texts are sure anyway.
TEXT_WEIGHT = 0.5


def trigram_bins(text: str) -> np.ndarray:
    """Hash bin of every byte trigram of a lower-cased text."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.uint32)
    packed = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return (packed * np.uint32(0x9E3779B1)) >> np.uint32(18)


def train(labelled: DataFrame, languages: list[str]) -> np.ndarray:
    """Log likelihood of every trigram bin per language, from all rows of (lang, text).

    Each task adds up its rows; at most one row per task, language and bin is shuffled.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((len(languages), BINS), np.int64)
        at = {lang: i for i, lang in enumerate(languages)}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                totals[at[lang]] += np.bincount(trigram_bins(text), minlength=BINS)
        lang, found = np.nonzero(totals)
        yield pd.DataFrame({"lang": lang, "bin": found, "n": totals[lang, found]})

    counted = labelled.filter(F.col("lang").isin(languages) & F.col("text").isNotNull()).select("lang", "text")
    rows = counted.mapInPandas(count, "lang int, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    table = rows.toPandas()
    totals = np.full((len(languages), BINS), 0.5)
    totals[table["lang"], table["bin"]] += table["n"]
    return np.log(totals / totals.sum(axis=1, keepdims=True))


def text_of(html: Column) -> Column:
    """What a page shows: without scripts, styles, comments, tags; five entities decoded."""
    shown = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    shown = F.regexp_replace(shown, r"<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        shown = F.replace(shown, F.lit(entity), F.lit(char))
    return shown


def declared(html: Column) -> Column:
    """Primary language of the lang attribute of the html element, lower-case; else empty."""
    found = F.regexp_extract(html, r"""(?i)<html\b[^>]*\slang\s*=\s*["']?([A-Za-z]+)""", 1)
    return F.coalesce(ascii_lower(found), F.lit(""))


def domain_of(host: Column) -> Column:
    """Last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _likelihoods(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """`rows` with `text_logp`: log likelihood of the text per language, best one 0."""

    def score(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            n = np.bincount(trigram_bins(text or ""), minlength=BINS)
            seen = np.flatnonzero(n)
            logp = TEXT_WEIGHT * (model[:, seen] @ n[seen].astype(float))
            out.append(logp - logp.max())
        return pd.Series(out)

    return rows.withColumn("text_logp", F.pandas_udf(score, "array<double>")("text")).drop("text")


def _posterior(logp: Column) -> Column:
    """Normalised probabilities of an array of log weights."""
    weights = F.transform(logp, lambda x: F.exp(x - F.array_max(logp)))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _add(*arrays: Column) -> Column:
    out = arrays[0]
    for other in arrays[1:]:
        out = F.zip_with(out, other, lambda a, b: a + b)
    return out


def _sums(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Per value of `by`: the sum of `text_p` per language, as an array. Rounded to 1e-6 in
    each row, so that sums don't depend on the order of rows."""
    return rows.groupBy(F.col(by).alias(f"{by}_key")).agg(
        F.array(*[F.sum(F.floor(F.get("text_p", F.lit(i)) * 1_000_000)) / 1_000_000 for i in range(n)]).alias(f"{by}_n")
    )


def identify(
    rows: DataFrame, languages: list[str], model: np.ndarray, host_weight: float = 20.0, domain_weight: float = 50.0
) -> DataFrame:
    """Language of every row: the columns of `rows` but text, and lang, confidence, text_lang.

    `rows` has text, markup, host and a key. Four kinds of evidence are multiplied:

    - text: likelihood of hashed byte trigrams under `model`;
    - markup: P(declared | language), and address suffix: P(suffix | language), both learned
      from all rows, weighted by their text posteriors, with one row of smoothing;
    - host prior: shares of languages among the host's other rows, smoothed with
      `host_weight` rows of its domain's shares, these with `domain_weight` rows of all rows' shares.
      A row's own part is taken out of every count, so that it isn't evidence for itself.

    The tables of hosts, domains, suffixes and declarations are grouped sums, combined before their
    shuffle; Spark broadcasts one where its size allows and splits a skewed join otherwise.

    A null text, markup or host is empty: empty text leaves the other evidence, an empty host
    is a host of its own. Of languages as likely the first in order wins. Repeated rows each
    get a row; an empty table gives none.
    """
    n = len(languages)
    rows = rows.withColumns({
        "text": F.coalesce("text", F.lit("")), "markup": F.coalesce("markup", F.lit("")),
        "host": F.coalesce("host", F.lit("")),
    }).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    scored = store(_likelihoods(rows, model).withColumn("text_p", _posterior(F.col("text_logp"))), "scored")

    zero = F.array(*[F.lit(0.0)] * n)
    all_rows = scored.select(F.lit("").alias("root"), "text_p")
    total = _sums(all_rows, "root", n).first()  # one number per language
    root = [float(x) for x in total["root_n"]] if total else [0.0] * n
    joined = scored
    for by in ("host", "domain", "suffix", "markup"):
        sums = store(_sums(scored, by, n), f"by-{by}")
        joined = joined.join(sums, F.col(by) == F.col(f"{by}_key"), "left").drop(f"{by}_key")

    def others(counts: Column) -> Column:
        return F.zip_with(counts, "text_p", lambda c, p: F.greatest(c - p, F.lit(0.0)))

    def shares(counts: Column, weight: float, prior: Column) -> Column:
        whole = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b) + weight
        return F.zip_with(counts, prior, lambda c, p: (c + weight * p) / whole)

    flat = F.array(*[F.lit(1.0 / n)] * n)
    totals = F.array(*[F.lit(x) for x in root])

    def given(counts: str) -> Column:
        """P(value | language) of the row's value, by the other rows."""
        return F.zip_with(
            others(F.col(counts)), others(totals), lambda c, t: F.log((c + 0.1) / (t + 1.0))
        )

    prior_root = shares(others(totals), 1.0, flat)
    prior_domain = shares(others(F.col("domain_n")), domain_weight, prior_root)
    prior = shares(others(F.col("host_n")), host_weight, prior_domain)
    evidence = joined.withColumn("prior", F.transform(prior, lambda p: F.log(p))).withColumn(
        "logp",
        _add(
            F.col("text_logp"), F.col("prior"),
            F.when(F.col("markup") != "", given("markup_n")).otherwise(zero),
            F.when(F.col("suffix") != "", given("suffix_n")).otherwise(zero),
        ),
    ).withColumn("p", _posterior(F.col("logp")))
    names = F.array(*[F.lit(x) for x in languages])

    def best(p: Column) -> Column:
        return F.get(names, (F.array_position(p, F.array_max(p)) - 1).cast("int"))

    own = [c for c in rows.columns if c not in ("text", "domain", "suffix")]
    return evidence.select(
        *own, best(F.col("p")).alias("lang"), F.round(F.array_max("p"), 6).alias("confidence"),
        best(F.col("text_p")).alias("text_lang"),
    )


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, text, markup, host of raw pages."""
    return pages.select(
        "page_id", text_of(F.col("html")).alias("text"), declared(F.col("html")).alias("markup"),
        host_of(F.col("url")).alias("host"),
    )
