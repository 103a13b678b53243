"""Every registered query gives the rows its SQL gives."""

import duckdb
import pytest

from __spark_entry__ import entry
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return connection


def plain(value):
    return f"{value:.6f}" if isinstance(value, float) else value


def rows(header, records):
    order = sorted(range(len(header)), key=lambda i: header[i])
    return sorted(
        (tuple(plain(record[i]) for i in order) for record in records),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLE_SQL[name])
    header = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(header)
    want = rows(header, expected.fetchall())
    assert want
    assert rows(result.columns, result.collect()) == want


def test_entry(spark):
    assert entry(spark).count() == 30
