"""One query per operator, over the whole test tables.

Dates and timestamps leave as text, so that results compare as plain values.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import utc_timestamp
from tidemark.functions.pieces import Busy
from tidemark.operators import bronze as bronze_ops
from tidemark.operators import checks, marts, scd
from tidemark.operators import silver as silver_ops
from tidemark.operators.ingest import ingestion_log
from tidemark.operators.validate import extract_fields, validate
from tidemark.plans.dimension import last_run, read_dimension, update_dimension
from tidemark.plans.marts import MARTS, read_mart, update_marts
from tidemark.plans.paths import Paths
from tidemark.plans.pipeline import backfill_bronze, not_promoted, promote, run_pipeline
from tidemark.plans.registry import history, register
from tidemark.sources.raw import from_text, read_raw, stream_raw
from tidemark.sources.scratch import scratch_dir
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.state import RunState
from tidemark.sources.tables import (
    read_bronze,
    read_silver,
    write_load,
    write_silver,
)
from tidemark.streaming.jobs import land_events, load_bronze
from workload import adapter

# A date after all test events; caps the checkpoint as the processing date would.
TODAY = dt.date(2024, 2, 5)
SILVER_OUT = [
    "event_id", "event_type", "event_ts", "event_date", "user_id", "country",
    "page", "query", "amount", "error_message", "ingested_at",
]


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text in one fixed format."""
    formats = {T.DateType: "yyyy-MM-dd", T.TimestampNTZType: "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    return df.select(
        *[
            F.date_format(f.name, formats[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in formats
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _ingested(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", utc_timestamp(F.col("ingested_at")))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_ops.silver(adapter.bronze_rows(spark, sf))


def _stg(spark: SparkSession, sf: str) -> DataFrame:
    return marts.stg_events(_silver(spark, sf))


def _dim_events(spark: SparkSession, sf: str) -> DataFrame:
    return scd.dimension_events(_silver(spark, sf))


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write an intermediate result that several branches read, and read it back."""
    path = scratch_dir(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _busy(spark: SparkSession, sf: str) -> Busy | None:
    """Busy users, found on all deliveries before any shuffle."""
    deliveries = silver_ops.normalize(adapter.bronze_rows(spark, sf))
    return scd.busy_timelines(scd.dimension_events(deliveries))


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    events, busy = _dim_events(spark, sf), _busy(spark, sf)
    if busy is not None:  # then the events are read more than once
        events = _stored(spark, events)
    return scd.full_build(events, busy)


def _cut() -> Column:
    return F.lit(adapter.BATCH_CUT).cast("timestamp_ntz")


# --- raw and bronze ---------------------------------------------------------


def raw_json_scan(spark, sf):
    path = scratch_dir(spark, "raw")
    adapter.deliveries(spark, sf).write.json(path)
    found = extract_fields(read_raw(spark, path)).select(
        "event_id", "event_type", utc_timestamp(F.col("event_ts")).alias("event_ts"), "user_id",
        "country", "page", "query", F.col("amount").try_cast("double").alias("amount"),
        "error_message", "ingested_at",
    )
    return as_text(_ingested(found))


def bronze_enrich(spark, sf):
    path = scratch_dir(spark, "raw")
    rows = adapter.deliveries(spark, sf).withColumn("folder", F.col("event_type"))
    rows.write.partitionBy("folder").json(path)
    at = F.lit(adapter.PROCESSED_AT).cast("timestamp_ntz")
    enriched = bronze_ops.bronze(read_raw(spark, path), at).select(
        "event_id", "event_type", "user_id", utc_timestamp(F.col("event_ts")).alias("event_ts"),
        "ingested_at", "event_date", "ingested_processing_ts",
        F.regexp_extract("source_file", "folder=([^/]+)/", 1).alias("source_folder"),
    )
    return as_text(_ingested(enriched))


def _store_bronze(deliveries: DataFrame, paths: Paths, processed_at: str, load: int = 0) -> None:
    """Add deliveries to a bronze table as the bronze job would have."""
    raw = from_text(deliveries.select(F.to_json(F.struct("*")).alias("value")))
    at = F.lit(processed_at).cast("timestamp_ntz")
    rows = bronze_ops.bronze(raw.withColumn("source_file", F.lit("adapter")), at)
    write_load(rows, paths.bronze, load)


def bronze_lookback_scan(spark, sf):
    paths = Paths(scratch_dir(spark, "lake"))
    _store_bronze(adapter.deliveries(spark, sf), paths, adapter.PROCESSED_AT)
    bronze = read_bronze(spark, paths.bronze, dt.date(2024, 1, 28))
    window = bronze_ops.lookback(bronze, "2024-01-30")
    return as_text(_ingested(window.select("event_id", "event_type", "event_date", "ingested_at")))


def _in_bronze(spark: SparkSession, paths: Paths) -> DataFrame:
    bronze = read_bronze(spark, paths.bronze)
    return as_text(_ingested(bronze.select("event_id", "event_type", "event_date", "ingested_at")))


def bronze_two_streams(spark, sf):
    """Part of the deliveries comes as raw files, the rest as text, each by a stream of its own."""
    paths = Paths(scratch_dir(spark, "lake"))
    arrivals, queue = adapter.deliveries(spark, sf), f"{paths.root}/queue"
    adapter.first_batch(arrivals).write.json(paths.raw)
    adapter.second_batch(arrivals).select(F.to_json(F.struct("*"))).write.text(queue)
    files, texts = stream_raw(spark, paths.raw), from_text(spark.readStream.text(queue))
    load_bronze(files, paths.bronze, paths.stream("files")).awaitTermination()
    load_bronze(texts, paths.bronze, paths.stream("queue")).awaitTermination()
    return _in_bronze(spark, paths)


def bronze_backfill_twice(spark, sf):
    """A backfill after each of two batches of raw files; the second finds the first one loaded."""
    paths = Paths(scratch_dir(spark, "lake"))
    arrivals = adapter.deliveries(spark, sf)
    for part in (adapter.first_batch(arrivals), adapter.second_batch(arrivals)):
        part.write.mode("append").json(paths.raw)
        backfill_bronze(spark, paths, modified_after="2020-01-01T00:00:00")
    return _in_bronze(spark, paths)


# --- silver -----------------------------------------------------------------


def silver_dedup_latest(spark, sf):
    kept = silver_ops.latest(
        adapter.bronze_rows(spark, sf).select(
            "event_id", "user_id", "country", "ingested_at", "ingested_processing_ts", "source_file"
        )
    )
    return as_text(_ingested(kept.select("event_id", "user_id", "country", "ingested_at")))


def silver_events(spark, sf):
    paths = Paths(scratch_dir(spark, "lake"))
    write_silver(_silver(spark, sf), paths.silver, "first")
    return as_text(_ingested(read_silver(spark, paths.silver)))


def _two_promotions(spark, sf, lookback: int, after_each=lambda paths: None) -> Paths:
    """Silver after a run on the first batch and another after the second arrived."""
    paths = Paths(scratch_dir(spark, "lake"))
    arrivals = adapter.deliveries(spark, sf)
    runs = (
        (adapter.first_batch(arrivals), adapter.PROCESSED_AT),
        (adapter.second_batch(arrivals), adapter.LATER_PROCESSED_AT),
    )
    for load, (part, at) in enumerate(runs):
        _store_bronze(part, paths, at, load)
        promote(spark, paths, lookback, TODAY)
        after_each(paths)
    return paths


def silver_incremental(spark, sf, lookback: int = 2):
    paths = _two_promotions(spark, sf, lookback)
    return as_text(_ingested(read_silver(spark, paths.silver).select(SILVER_OUT)))


def silver_incremental_short_lookback(spark, sf):
    return silver_incremental(spark, sf, lookback=1)


def silver_idle_run(spark, sf):
    """Two more promotions after the last batch change nothing."""
    paths = _two_promotions(spark, sf, 2)
    for _ in range(2):
        promote(spark, paths, 2, TODAY)
    return as_text(_ingested(read_silver(spark, paths.silver).select(SILVER_OUT)))


def silver_snapshot_read(spark, sf):
    """What a reader sees after the second promotion that keeps to the snapshot of the first one."""
    pinned: list[int] = []
    paths = _two_promotions(spark, sf, 2, lambda paths: pinned.append(Snapshots(spark, paths.silver).begin().number))
    kept = read_silver(spark, paths.silver, snapshot=pinned[0])
    return as_text(_ingested(kept.select(SILVER_OUT)))


def late_not_promoted(spark, sf):
    """What came too late for the windows of two promotions with the short lookback."""
    late = not_promoted(spark, _two_promotions(spark, sf, 1))
    return as_text(_ingested(late.select("event_id", "event_type", "event_date", "country", "ingested_at")))


def silver_by_type(spark, sf):
    paths = Paths(scratch_dir(spark, "lake"))
    write_silver(_silver(spark, sf), paths.silver, "first")
    tables = silver_ops.type_tables(read_silver(spark, paths.silver))
    tagged = [t.withColumn("table_name", F.lit(name)) for name, t in tables.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return as_text(_ingested(union))


def checkpoint_max_date(spark, sf):
    """The checkpoint that two promotions have saved."""
    state = RunState(spark, _two_promotions(spark, sf, 2).state)
    return spark.createDataFrame([(state.get("silver_checkpoint"),)], "last_processed_event_date string")


def scd_watermark(spark, sf):
    """The ingestion watermark that the dimension has saved after two runs."""
    paths = _two_promotions(spark, sf, 2, lambda paths: update_dimension(spark, paths))
    saved = last_run(RunState(spark, paths.state))["watermark"]
    row = spark.createDataFrame([(saved,)], "watermark string")
    return as_text(row.select(utc_timestamp(F.col("watermark")).alias("watermark")))


# --- staging and marts ------------------------------------------------------


def stg_events(spark, sf):
    return as_text(_ingested(_stg(spark, sf)))


def mart_dau(spark, sf):
    return as_text(marts.mart_dau(_stg(spark, sf)))


def mart_revenue(spark, sf):
    mart = marts.mart_revenue(_stg(spark, sf))
    return as_text(mart.withColumn("daily_revenue", F.round("daily_revenue", 2)))


def mart_event_mix(spark, sf):
    return as_text(marts.mart_event_mix(_stg(spark, sf)))


def mart_funnel(spark, sf):
    return as_text(marts.mart_funnel(_stg(spark, sf)))


def mart_funnel_join(spark, sf):
    return as_text(marts.mart_funnel_join(_stg(spark, sf)))


def _stored_marts(spark, paths: Paths) -> DataFrame:
    """All stored marts in one long table."""
    t = {name: read_mart(spark, paths, name) for name in MARTS}
    steps = t["mart_funnel"].unpivot(
        ["event_date", "user_id"], list(marts.FUNNEL_STEPS), "step", "n"
    )

    def rows(df, name, item, amount):
        return df.select(
            F.lit(name).alias("mart"), "event_date", item.alias("item"),
            amount.cast("double").alias("amount"),
        )

    parts = [
        rows(t["mart_dau"], "mart_dau", F.lit(""), F.col("daily_active_users")),
        rows(t["mart_revenue"], "mart_revenue", F.lit(""), F.round("daily_revenue", 2)),
        rows(t["mart_event_mix"], "mart_event_mix", F.col("event_type"), F.col("event_count")),
        rows(steps, "mart_funnel", F.concat_ws("/", F.col("user_id").cast("string"), "step"), F.col("n")),
    ]
    return as_text(reduce(DataFrame.unionByName, parts))


def mart_incremental(spark, sf):
    paths = _two_promotions(spark, sf, 2, lambda paths: update_marts(spark, paths))
    return _stored_marts(spark, paths)


def preview_dau(spark, sf):
    return as_text(marts.preview(marts.mart_dau(_stg(spark, sf)), "event_date"))


# --- user dimension ---------------------------------------------------------


def scd_incremental_filter(spark, sf):
    since = F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")
    fresh = scd.newer_than(_dim_events(spark, sf), since)
    return as_text(fresh.select("user_id", "country", "event_ts", "ingested_at"))


def scd2_full_build(spark, sf):
    return as_text(_dim(spark, sf))


def scd2_full_build_pieces(spark, sf):
    """The same build with every timeline longer than 20 events cut into pieces."""
    events = _stored(spark, _dim_events(spark, sf))
    busy = scd.busy_timelines(events, rows_per_piece=20)
    return as_text(scd.full_build(events, busy))


def _two_batches(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame, Busy | None]:
    """All events, the dimension after the first batch, the second batch, and the busy users."""
    events = _stored(spark, _dim_events(spark, sf))
    busy = _busy(spark, sf)
    before = scd.full_build(events.filter(F.col("ingested_at") <= _cut()), busy)
    return events, _stored(spark, before), events.filter(F.col("ingested_at") > _cut()), busy


def scd2_incremental_apply(spark, sf):
    _, dim, batch, busy = _two_batches(spark, sf)
    return as_text(scd.apply_batch(dim, batch, busy))


def scd2_rebuild_touched(spark, sf):
    events, dim, batch, busy = _two_batches(spark, sf)
    return as_text(scd.rebuild_users(dim, events, batch, busy))


def scd2_replay(spark, sf):
    """Late-safe update from four days before the cut, the longest an event is late."""
    events, dim, _, busy = _two_batches(spark, sf)
    return as_text(scd.replay(dim, events, _cut() - F.expr("INTERVAL 4 DAYS"), busy))


def dim_user_current(spark, sf):
    return as_text(scd.current_users(_dim(spark, sf)))


def preview_current_users(spark, sf):
    return as_text(marts.preview(scd.current_users(_dim(spark, sf)), "user_id"))


# --- ingestion --------------------------------------------------------------


def validate_events(spark, sf):
    records = adapter.imperfect_records(spark, sf)
    raw = records.select(
        F.try_parse_json("value").alias("payload"),
        F.col("value").alias("raw_text"),
        F.col("record").alias("source_file"),
    )
    return validate(raw).select(
        F.col("source_file").alias("record"),
        "verdict",
        F.coalesce("reason", F.lit("")).alias("reason"),
        F.coalesce(
            F.when(F.col("reason").isNull(), F.col("user_id").cast("string")), F.lit("")
        ).alias("user_id"),
    )


def landing_stream(spark, sf):
    """Records arriving as files, landed by the stream: what raw, log and quarantine hold."""
    root = scratch_dir(spark, "landing")
    adapter.imperfect_records(spark, sf).select("value").write.text(f"{root}/incoming")
    incoming = from_text(spark.readStream.text(f"{root}/incoming"))
    land_events(
        incoming, f"{root}/raw", f"{root}/logs", f"{root}/rejected", f"{root}/stream"
    ).awaitTermination()
    landed = extract_fields(read_raw(spark, f"{root}/raw")).filter(
        "ingested_at is not null and request_id is not null"
    )
    logged = spark.read.schema("event_id string").json(f"{root}/logs")
    rejected = spark.read.schema("reason string").json(f"{root}/rejected")
    one = F.lit(1).cast("bigint").alias("n")
    return (
        landed.select(F.lit("raw").alias("sink"), F.col("event_id").alias("item"), one)
        .unionByName(logged.select(F.lit("log").alias("sink"), F.col("event_id").alias("item"), one))
        .unionByName(
            rejected.groupBy(F.lit("rejected").alias("sink"), F.col("reason").alias("item")).agg(
                F.count("*").alias("n")
            )
        )
    )


def schema_evolution(spark, sf):
    """Raw files of two schema generations: a nested field and error messages appear later."""
    path = scratch_dir(spark, "raw")
    events = adapter.test_events(spark, sf)
    later = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    nested = F.from_json("props", "k bigint")
    common = [F.col("event_id").cast("string").alias("event_id"), F.col("event_type")]
    events.filter(~later).select(*common).write.mode("append").json(path)
    message = F.when(F.col("event_type") == "error", F.col("event_type"))
    events.filter(later).select(
        *common, message.alias("error_message"), nested.alias("context")
    ).write.mode("append").json(path)
    raw = extract_fields(read_raw(spark, path))
    return raw.select(
        "event_id",
        F.coalesce(F.try_variant_get("payload", "$.context.k", "bigint"), F.lit(-1)).alias("nested_k"),
        F.coalesce("error_message", F.lit("")).alias("error_message"),
    )


def schema_registry(spark, sf):
    """Versions after two generations of records: fields come, one is widened, one changes its type."""
    paths = Paths(scratch_dir(spark, "lake"))
    events = adapter.test_events(spark, sf)
    later = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    number = F.col("user_id")
    generations = (
        (~later, [number.alias("score"), number.alias("session")]),
        (later, [(number + 0.5).alias("score"), F.concat(F.lit("s"), number).alias("session"),
                 F.from_json("props", "k bigint").alias("context")]),
    )
    for i, (chosen, fields) in enumerate(generations):
        records = events.filter(chosen).select(F.col("event_id").cast("string").alias("event_id"), *fields)
        register(from_text(records.select(F.to_json(F.struct("*")).alias("value"))), paths, f"generation {i + 1}")
    found = history(spark, paths)
    return as_text(found.withColumn("type_before", F.coalesce("type_before", F.lit(""))))


def ingestion_log_records(spark, sf):
    stamped = adapter.deliveries(spark, sf).withColumn("request_id", F.md5("event_id"))
    return as_text(_ingested(ingestion_log(stamped)))


# --- checks -----------------------------------------------------------------


def _checked(spark, sf, kind: str) -> DataFrame:
    """Checks over staging and marts built from all deliveries, so that some of them fail."""
    stg = marts.stg_events(silver_ops.normalize(adapter.bronze_rows(spark, sf)))
    tables = {
        "stg_events": stg,
        **{name: mart(stg) for name, (mart, _, _) in MARTS.items()},
        "dim_user_current": scd.current_users(_dim(spark, sf)),
    }
    return checks.run_checks(tables, (kind,))


def dq_not_null(spark, sf):
    return _checked(spark, sf, "not_null")


def dq_unique(spark, sf):
    return _checked(spark, sf, "unique")


def dq_accepted_values(spark, sf):
    return _checked(spark, sf, "accepted_values")


# --- everything together ----------------------------------------------------


def _two_pipeline_runs(spark, sf) -> Paths:
    """The whole pipeline after the first batch of raw files and again after the second."""
    paths = Paths(scratch_dir(spark, "lake"))
    arrivals = adapter.deliveries(spark, sf)
    for part in (adapter.first_batch(arrivals), adapter.second_batch(arrivals)):
        part.write.mode("append").json(paths.raw)
        run_pipeline(spark, paths, today=TODAY)
    return paths


def pipeline_dimension(spark, sf):
    return as_text(read_dimension(spark, _two_pipeline_runs(spark, sf)))


def pipeline_marts(spark, sf):
    return _stored_marts(spark, _two_pipeline_runs(spark, sf))


def dimension_lookback_change(spark, sf):
    """Runs with a lookback of 2 days that settle versions, then one with 10."""
    paths = Paths(scratch_dir(spark, "lake"))
    arrivals = adapter.deliveries(spark, sf)
    early = adapter.first_batch(arrivals)
    start = F.col("ingested_at") <= "2024-01-10T00:00:00"
    for part, lookback in ((early.filter(start), 2), (early.filter(~start), 2), (adapter.second_batch(arrivals), 10)):
        part.write.mode("append").json(paths.raw)
        backfill_bronze(spark, paths)
        promote(spark, paths, lookback, TODAY)
        update_dimension(spark, paths, lookback)
    return as_text(read_dimension(spark, paths))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        raw_json_scan, bronze_enrich, bronze_lookback_scan, bronze_two_streams, bronze_backfill_twice,
        silver_dedup_latest, silver_events, silver_incremental, silver_incremental_short_lookback,
        silver_idle_run, silver_snapshot_read, late_not_promoted,
        silver_by_type, checkpoint_max_date, scd_watermark,
        stg_events, mart_dau, mart_revenue, mart_event_mix, mart_funnel, mart_funnel_join,
        mart_incremental, preview_dau,
        scd_incremental_filter, scd2_full_build, scd2_full_build_pieces, scd2_incremental_apply,
        scd2_rebuild_touched, scd2_replay, dim_user_current, preview_current_users,
        validate_events, landing_stream, schema_evolution, schema_registry,
        dq_not_null, dq_unique, dq_accepted_values,
        pipeline_dimension, pipeline_marts, dimension_lookback_change,
    )
}
QUERIES["ingestion_log"] = ingestion_log_records
