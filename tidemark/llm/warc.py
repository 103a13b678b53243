"""WARC derivatives: metadata and plain-text conversion records of responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.language import text_of
from tidemark.llm.url_filter import host_of

CRLF = "\r\n"
SOFTWARE = "tidemark"
#: Digits of base 32 (RFC 4648), for digests.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _uuid(name: Column) -> Column:
    """urn:uuid made of a name, the same in every run (version 5 layout over SHA-1)."""
    h = F.sha1(name)
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"),
        F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"),
        F.substring(h, 21, 12), F.lit(">"),
    )


def digest(block: Column) -> Column:
    """sha1: and the base-32 SHA-1 of a block's UTF-8 bytes."""
    h = F.sha1(block)
    groups = [F.conv(F.substring(h, 1 + 5 * i, 5), 16, 10).cast("bigint") for i in range(8)]
    digits = [
        F.substring(F.lit(_BASE32), 1, 32).substr((F.shiftright(g, 5 * (3 - k)) % 32 + 1).cast("int"), F.lit(1))
        for g in groups for k in range(4)
    ]
    return F.concat(F.lit("sha1:"), *digits)


def _length(block: Column) -> Column:
    return F.octet_length(block).cast("bigint")


def header(name: str, value: Column) -> Column:
    """One header line; null without a value, so that it is left out."""
    clean = F.regexp_replace(value.cast("string"), r"[\r\n]+", " ")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean))


def http_fields(http: Column) -> Column:
    """Names and values of an HTTP header block, in order, names lower-cased."""
    lines = F.filter(F.split(http, r"\r?\n"), lambda x, i: (i > 0) & x.contains(":"))
    return F.transform(
        lines,
        lambda x: F.concat(
            F.lower(F.trim(F.substring_index(x, ":", 1))), F.lit(": "),
            F.trim(F.substr(x, F.length(F.substring_index(x, ":", 1)) + 2)),
        ),
    )


def responses(pages: DataFrame, date: str, server: str = "unknown") -> DataFrame:
    """Raw pages as response records: page_id, record_id, target_uri, warc_date, http, payload."""
    html = F.coalesce("html", F.lit(""))
    http = F.concat_ws(
        CRLF, F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), _length(html).cast("string")), F.lit(f"Server: {server}"),
    )
    name = F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), "url", F.md5(html))
    return pages.select(
        "page_id", _uuid(name).alias("record_id"), F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"), http.alias("http"), html.alias("payload"),
    )


def plain_text(html: Column) -> Column:
    """Text of a page: a line per block element, runs of blanks and empty lines closed up."""
    broken = F.regexp_replace(html, r"(?i)<(/?(p|div|h[1-6]|li|ul|ol|tr|table|article|section|nav|title|pre|blockquote)|br)\b[^>]*>", "\n")
    lines = F.transform(
        F.split(text_of(broken), "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\r\f\x0B\xA0]+", " "))
    )
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def derive(records: DataFrame, key: str = "page_id") -> DataFrame:
    """Two records per response: `metadata` and `conversion`, one row each.

    `records` has a key, record_id, target_uri, warc_date, http (header block) and payload
    (html). Both records refer to the response by WARC-Refers-To, with its target address and date,
    and keep its digests: the metadata block lists the source's payload and block digests, its
    HTTP headers, title, host and the conversion's id; the conversion holds the plain text.
    Record ids are hashes of the source's id and the type, so that a rerun, or a retried
    task, gives the same records.

    Returns key, record_type, record_id, refers_to, target_uri, warc_date, content_type,
    content_length, block_digest, payload_digest, source_payload_digest, block, record (the
    whole record with its headers). Rows are independent of each other; nothing is shuffled.

    A null payload is empty and has a conversion of length 0; a null address or date is left out of
    the headers; a null record_id gives a null refers_to; repeated rows give repeated
    records; an empty table gives none; other columns are not read.
    """
    payload = F.coalesce("payload", F.lit(""))
    http = F.coalesce("http", F.lit(""))
    block = F.concat(http, F.lit(CRLF * 2), payload)
    title = F.regexp_extract(payload, r"(?is)<title[^>]*>(.*?)</title", 1)
    source = records.select(
        F.col(key).alias("key"), F.col("record_id").alias("source_id"), "target_uri", "warc_date",
        digest(payload).alias("source_payload_digest"), digest(block).alias("source_block_digest"),
        http_fields(http).alias("fields"), F.regexp_replace(title, r"\s+", " ").alias("title"),
        plain_text(payload).alias("text"),
        _uuid(F.concat_ws("|", "record_id", F.lit("conversion"))).alias("conversion_id"),
        _uuid(F.concat_ws("|", "record_id", F.lit("metadata"))).alias("metadata_id"),
    )
    about = F.concat(
        F.array_join(
            F.array_compact(
                F.concat(
                    F.array(
                        header("source-record", F.col("source_id")),
                        header("source-payload-digest", F.col("source_payload_digest")),
                        header("source-block-digest", F.col("source_block_digest")),
                        header("conversion-record", F.col("conversion_id")),
                        header("host", host_of(F.col("target_uri"))),
                        header("title", F.when(F.col("title") != "", F.col("title"))),
                        header("text-length", F.length("text")),
                    ),
                    F.transform("fields", lambda f: F.concat(F.lit("http-"), f)),
                )
            ),
            CRLF,
        ),
        F.lit(CRLF),
    )
    kinds = F.array(
        F.struct(
            F.lit("metadata").alias("record_type"), F.col("metadata_id").alias("record_id"),
            F.lit("application/warc-fields").alias("content_type"), about.alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("record_type"), F.col("conversion_id").alias("record_id"),
            F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block"),
        ),
    )
    rows = source.select(
        "key", "source_id", "target_uri", "warc_date", "source_payload_digest", F.inline(kinds)
    ).withColumns({"block_digest": digest(F.col("block")), "content_length": _length(F.col("block"))})
    lines = [
        F.lit("WARC/1.1"), header("WARC-Type", F.col("record_type")), header("WARC-Record-ID", F.col("record_id")),
        header("WARC-Date", F.col("warc_date")), header("WARC-Target-URI", F.col("target_uri")),
        header("WARC-Refers-To", F.col("source_id")),
        header("WARC-Refers-To-Target-URI", F.when(F.col("source_id").isNotNull(), F.col("target_uri"))),
        header("WARC-Refers-To-Date", F.when(F.col("source_id").isNotNull(), F.col("warc_date"))),
        header("WARC-Block-Digest", F.col("block_digest")), header("WARC-Payload-Digest", F.col("block_digest")),
        header("Content-Type", F.col("content_type")), header("Content-Length", F.col("content_length")),
    ]
    record = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), F.col("block"))
    return rows.select(
        F.col("key").alias(key), "record_type", "record_id", F.col("source_id").alias("refers_to"), "target_uri",
        "warc_date", "content_type", "content_length", "block_digest",
        F.col("block_digest").alias("payload_digest"), "source_payload_digest", "block", record.alias("record"),
    )


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files, one per task: each record and the two line ends that close it."""
    records.select("record").write.option("lineSep", CRLF * 2).option("compression", compression).text(path)
