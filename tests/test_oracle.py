"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from conftest import SMALL  # noqa: E402
from forecourt.queries import ORACLES, QUERIES  # noqa: E402
from forecourt.sources.bindings import PARQUET_TABLES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in PARQUET_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(ORACLES[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_is_registered_with_a_counterpart():
    assert set(QUERIES) == set(ORACLES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
