from __future__ import annotations

import duckdb
import pytest

from forecourt.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, name):
    got = QUERIES[name](spark, small)
    columns = sorted(got.columns)
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(
        map(str, (tuple(r[i] for i in order) for r in want.fetchall()))
    )


def test_a_query_for_each_operator():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
