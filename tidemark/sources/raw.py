"""Raw JSON events: one object per line, any extra fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The whole record is kept as a variant, so no schema is inferred and JSON types survive.
_SCHEMA = "payload variant, _corrupt_record string"
_OPTIONS = {"singleVariantColumn": "payload"}
MAX_FILE_AGE = "36500d"


def _with_origin(df: DataFrame) -> DataFrame:
    return df.select(
        "payload",
        F.col("_corrupt_record").alias("raw_text"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def read_raw(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """Batch read: `payload` (NULL for broken JSON), `raw_text` (only then), `source_file`."""
    reader = spark.read.schema(_SCHEMA).options(**_OPTIONS)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return _with_origin(reader.json(path))


def stream_raw(
    spark: SparkSession, path: str, files_per_batch: int | None = None, archive: str | None = None
) -> DataFrame:
    """Stream read of new files. A file is read once, so writers must add files, not rewrite them.

    `archive` names a folder to move finished files to, which keeps the listing of a busy
    source short. A file's modification time may lie up to `MAX_FILE_AGE` before the newest one
    seen; the default of a week would skip restored history without a word.
    """
    reader = spark.readStream.schema(_SCHEMA).options(**_OPTIONS).option("maxFileAge", MAX_FILE_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _with_origin(reader.json(path))


def from_text(df: DataFrame, column: str = "value") -> DataFrame:
    """The same three columns from JSON text that did not come from files (a queue, a table)."""
    payload = F.try_parse_json(column)
    return df.select(
        payload.alias("payload"),
        F.when(payload.isNull(), F.col(column)).alias("raw_text"),
        F.lit(None).cast("string").alias("source_file"),
    )
