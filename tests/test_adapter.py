"""Test tables as application events."""

import io
from contextlib import redirect_stdout

from workload import adapter


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    """One task reads such a file; the work on its rows is behind a shuffle."""
    rows = spark.range(40).selectExpr(
        "id as event_id", "timestamp_ntz '2024-01-02 03:04:05' as ts", "id % 3 as user_id",
        "'view' as event_type", "1.5D as value", "'{\"k\": 7}' as props",
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = adapter.deliveries(spark, str(tmp_path))
    text = io.StringIO()
    with redirect_stdout(text):
        found.explain()
    plan = text.getvalue()
    assert "hashpartitioning(event_id" in plan
    assert plan.index("get_json_object") < plan.index("hashpartitioning(event_id") < plan.index("FileScan")
    assert found.count() == 44
