"""Marts, checks and the views."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checks, marts
from tidemark.operators.silver import type_tables

STG = "user_id bigint, event_date date, event_type string, amount double"
DAY = dt.date(2024, 1, 1)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_one_shuffle_funnel_equals_the_joins(spark):
    rng = random.Random(5)
    users, days = [None, 1, 2, 3], [None, DAY, dt.date(2024, 1, 2)]
    kinds = ["search", "page_view", "purchase", "error", None]
    rows = [(rng.choice(users), rng.choice(days), rng.choice(kinds), 1.0) for _ in range(60)]
    for part in (rows, rows[:7], []):
        stg = spark.createDataFrame(part, STG)
        assert bag(marts.mart_funnel(stg)) == bag(marts.mart_funnel_join(stg))


def test_funnel_has_one_shuffle_and_combines_before_it(spark):
    plan = marts.mart_funnel(spark.createDataFrame([], STG).repartition(3))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_count" in text


def test_daily_marts(spark):
    stg = spark.createDataFrame(
        [
            (1, DAY, "purchase", 2.5), (1, DAY, "purchase", None), (2, DAY, "search", None),
            (None, DAY, "search", None), (1, dt.date(2024, 1, 2), "purchase", None),
        ],
        STG,
    )
    assert bag(marts.mart_dau(stg)) == [(DAY, 2), (dt.date(2024, 1, 2), 1)]
    assert bag(marts.mart_revenue(stg)) == [(DAY, 2.5), (dt.date(2024, 1, 2), None)]
    assert bag(marts.mart_event_mix(stg)) == [
        (DAY, "purchase", 2), (DAY, "search", 2), (dt.date(2024, 1, 2), "purchase", 1)
    ]
    assert bag(marts.preview(marts.mart_dau(stg), "event_date", 1)) == [(DAY, 2)]


def test_declared_checks():
    declared = [
        (table, kind, column)
        for table, kinds in checks.CHECKS.items()
        for kind, columns in kinds.items()
        for column in columns
    ]
    kinds = [kind for _, kind, _ in declared]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (20, 4, 2)


def test_checks_count_failures(spark):
    stg = spark.createDataFrame(
        [("a", "search"), ("a", "search"), ("b", "odd"), ("c", "odd"), (None, None), (None, "x")],
        "event_id string, event_type string",
    ).select("*", *[F.lit(1).alias(c) for c in ("user_id", "event_ts", "ingested_at", "country")])
    tables = {"stg_events": stg}
    found = {(r.check, r.column): r.failing_rows for r in checks.run_checks(tables).collect()}
    assert found[("not_null", "event_id")] == 2
    assert found[("not_null", "event_type")] == 1
    assert found[("not_null", "country")] == 0
    assert found[("unique", "event_id")] == 1
    assert found[("accepted_values", "event_type")] == 2
    bad = checks.failing_rows(tables)
    assert bag(bad[("stg_events", "unique", "event_id")]) == [("a", 2)]
    assert bag(bad[("stg_events", "accepted_values", "event_type")]) == [("odd", 2), ("x", 1)]
    assert bad[("stg_events", "not_null", "event_id")].count() == 2


def test_type_tables(spark):
    silver = spark.createDataFrame([], schemas.SILVER_SCHEMA)
    tables = type_tables(silver)
    assert tables["silver_purchases"].columns == [*schemas.COMMON_COLUMNS, "amount"]
    assert len(tables) == 4
