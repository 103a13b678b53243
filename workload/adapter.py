"""The test `events` table as application events.

The table has no country, ingestion time, late or repeated deliveries, so those are
derived from its columns: 20 % of the events arrive 30 to 1440 minutes late and
every tenth is delivered a second time two days later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import utc_timestamp
from tidemark.operators import bronze as bronze_ops

# What the derived columns are filled with.
COUNTRIES = ["US", "CA", "GB", "DE", "FR"]
PAGES = ["/home", "/search", "/product", "/checkout", "/pricing", "/account"]
ERRORS = ["TimeoutError", "NullPointerException", "SchemaMismatchError", "ConnectionRefused"]

PROCESSED_AT = "2024-02-05 00:00:00"
LATER_PROCESSED_AT = "2024-02-05 00:10:00"
BATCH_CUT = "2024-01-20 00:00:00"


def test_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _iso(time: Column) -> Column:
    return F.translate(time.cast("string"), " ", "T")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery of every event, as it would be sent: times are ISO text."""
    kind = F.col("event_type")
    delay = F.when(F.col("id") % 5 == 0, 30 + F.col("id") % 1411).otherwise(1)
    resend = F.when(F.col("id") % 10 == 0, F.array(F.lit(0), F.lit(2880))).otherwise(F.array(F.lit(0)))
    arrival = F.col("ts") + F.make_dt_interval(mins=(F.col("delay") + F.col("resend")).cast("int"))
    # A file of one row group is read by one task, so the rows are spread before the work on them.
    return (
        test_events(spark, sf_dir)
        .repartition("event_id", "ts", "user_id")
        .withColumnRenamed("event_id", "id")
        .withColumns({"k": F.get_json_object("props", "$.k").cast("bigint"), "delay": delay})
        .withColumn("resend", F.explode(resend))
        .select(
            F.col("id").cast("string").alias("event_id"),
            F.when(kind == "view", "page_view")
            .when(kind == "click", "search")
            .otherwise(kind)
            .alias("event_type"),
            _iso(F.col("ts")).alias("event_ts"),
            "user_id",
            _pick(COUNTRIES, F.col("k")).alias("country"),
            F.when(kind == "view", _pick(PAGES, F.col("k"))).alias("page"),
            F.when(kind == "click", F.concat(F.lit("query "), (F.col("k") % 5).cast("string"))).alias("query"),
            F.when(kind == "purchase", F.col("value")).alias("amount"),
            F.when(kind == "error", _pick(ERRORS, F.col("k"))).alias("error_message"),
            _iso(arrival).alias("ingested_at"),
        )
    )


def first_batch(events: DataFrame) -> DataFrame:
    return events.filter(utc_timestamp(F.col("ingested_at")) <= F.lit(BATCH_CUT).cast("timestamp_ntz"))


def second_batch(events: DataFrame) -> DataFrame:
    return events.filter(utc_timestamp(F.col("ingested_at")) > F.lit(BATCH_CUT).cast("timestamp_ntz"))


def as_bronze(events: DataFrame, processed_at: str = PROCESSED_AT) -> DataFrame:
    """Deliveries with the bronze metadata, without going through files."""
    at = F.lit(processed_at).cast("timestamp_ntz")
    return bronze_ops.enrich(events, at).withColumn("source_file", F.lit("adapter"))


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_bronze(deliveries(spark, sf_dir))


def imperfect_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test event as JSON text, with the ways a record can be odd or broken taking turns."""
    turn = F.col("event_id") % 16
    user = F.col("user_id").cast("string")

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    event_id = (
        F.when(turn == 10, F.lit(None).cast("string"))
        .when(turn == 11, field("event_id", F.col("event_id").cast("string")))
        .otherwise(field("event_id", quoted(F.col("event_id").cast("string"))))
    )
    user_id = (
        F.when(turn == 1, quoted(user))
        .when(turn == 2, quoted(F.concat(F.lit(" "), user, F.lit(" "))))
        .when(turn == 3, F.concat(user, F.lit(".0")))
        .when(turn == 4, quoted(F.concat(user, F.lit(".0"))))
        .when(turn == 5, F.lit("true"))
        .when(turn == 6, F.concat(user, F.lit(".5")))
        .when(turn == 7, F.lit('"abc"'))
        .when(turn == 8, F.lit("null"))
        .otherwise(user)
    )
    event_ts = F.when(turn == 15, F.lit('"not a time"')).otherwise(quoted(_iso(F.col("ts"))))
    country = F.when(turn == 12, F.lit('""')).otherwise(F.lit('"US"'))
    fields = F.concat_ws(
        ",",
        event_id,
        field("event_type", quoted(F.col("event_type"))),
        field("event_ts", event_ts),
        F.when(turn != 9, field("user_id", user_id)),
        field("country", country),
        F.when(turn == 13, field("context", F.col("props"))),
    )
    return test_events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("record"),
        F.concat(F.lit("{"), fields, F.when(turn != 14, F.lit("}")).otherwise(F.lit(""))).alias("value"),
    )
