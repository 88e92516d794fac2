from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import rows
from forecourt.operators import retrieval
from forecourt.operators.vector_table import VectorTable
from forecourt.session import working_folder


@pytest.fixture(scope="module")
def groups(spark):
    """Twelve far groups of vectors; the first holds a third of all rows."""
    rng = np.random.default_rng(5)
    heads = rng.normal(size=(12, 8)) * 20
    own = [0] * 150 + [1 + i % 11 for i in range(300)]
    data = [(i, [float(x) for x in np.round(heads[g] + rng.normal(size=8) * 0.1, 3)]) for i, g in enumerate(own)]
    return data, spark.createDataFrame(data, "id long, v array<double>").repartition(4)


def brute(queries, corpus, k, skip_self):
    out = []
    for q, a in queries:
        scored = sorted((-round(float(np.dot(a, b)), 6), i) for i, b in corpus if not (skip_self and i == q))
        out += [(q, i, -s + 0.0, n + 1) for n, (s, i) in enumerate(scored[:k])]
    return out


def asked(df):
    return df.select(df.id.alias("query_id"), df.v.alias("vector"))


@pytest.fixture(scope="module")
def table(spark, groups):
    path = working_folder(spark, "groups")
    VectorTable.build(groups[1], "id", "v", path, block_bytes=3000)
    return VectorTable(spark, path, block_bytes=3000)  # opened again from its files


@pytest.mark.parametrize("skip_self", [False, True])
def test_rows_of_a_full_comparison(table, groups, skip_self):
    found = retrieval.placed(table.search(asked(groups[1]), 3, skip_self).hits, 3)
    assert sorted((q, i, s + 0.0, p) for q, i, s, p in rows(found)) == sorted(brute(groups[0], groups[0], 3, skip_self))


def test_most_clusters_are_skipped(table, groups):
    n = len(table.directory.cluster)
    visits = table.search(asked(groups[1]), 3).visits.count() + len(groups[0])
    assert n >= 10 and visits < len(groups[0]) * n / 3


def test_every_row_lies_within_the_radius_of_its_cluster(table):
    known = table.directory
    at = {c: i for i, c in enumerate(known.cluster)}
    stored = table.rows.collect()
    assert len(stored) == 450 == known.rows.sum()
    for r in stored:
        assert np.linalg.norm(np.array(r.vector) - known.centre[at[r.cluster]]) <= known.radius[at[r.cluster]] + 1e-9


def test_a_large_cluster_is_cut_into_pieces(spark, groups):
    table = VectorTable.build(groups[1], "id", "v", working_folder(spark, "large"), block_bytes=3000, clusters=2)
    sizes = [r["count"] for r in table.rows.groupBy("cluster", "piece").count().collect()]
    assert len(table.directory.cluster) <= 2 and len(sizes) >= 10 and max(sizes) < 80


def test_values_that_are_not_finite_are_always_visited(spark):
    data = [(i, [float(i), 1.0]) for i in range(20)] + [(50, [math.inf, 1.0]), (51, [math.nan, 1.0]), (52, None)]
    df = spark.createDataFrame(data, "id long, v array<double>")
    table = VectorTable.build(df, "id", "v", working_folder(spark, "odd"), block_bytes=400)
    found = retrieval.placed(table.search(asked(df.filter("id = 3")), 2).hits, 2)
    assert rows(found) == [(3, 50, math.inf, 1), (3, 19, 58.0, 2)]


def test_more_places_than_rows_and_an_empty_corpus(spark, groups):
    few = groups[1].filter("id < 2")
    table = VectorTable.build(few, "id", "v", working_folder(spark, "few"), block_bytes=50)
    assert table.search(asked(few), 9).hits.count() == 4
    none = VectorTable.build(few.filter("id < 0"), "id", "v", working_folder(spark, "none"))
    assert none.search(asked(few), 2).hits.count() == 0
    assert table.search(asked(few.filter("id < 0")), 2).hits.count() == 0


def test_copies_of_one_row_and_text_keys(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0])] * 40 + [("é", [2.0, 0.0])], "id string, v array<float>")
    table = VectorTable.build(df, "id", "v", working_folder(spark, "copies"), block_bytes=400)
    found = retrieval.placed(table.search(asked(df.filter("id = 'é'")), 2).hits, 2)
    assert rows(found) == [("é", "é", 4.0, 1), ("é", "a", 2.0, 2)]


def _spread(n: int):
    """Vectors in every direction, so that hardly a cluster can be skipped."""
    rng = np.random.default_rng(11)
    return [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(rng.normal(size=(n, 16)))]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_queries_visit_a_shelf_once_however_many_clusters_it_holds(spark, kind):
    data = _spread(600)
    df = spark.createDataFrame(data, f"id long, v array<{kind}>").repartition(3)
    table = VectorTable.build(df, "id", "v", working_folder(spark, "spread"), block_bytes=1500)
    table.cell_bytes = 20_000
    search = table.search(asked(df), 3, True)
    found = retrieval.placed(search.hits, 3)
    assert sorted((q, i, s + 0.0, p) for q, i, s, p in rows(found)) == sorted(brute(data, data, 3, True))
    # A row for each cluster would be 600 times 40 or more.
    assert len(table.directory.cluster) >= 40 and search.visits.count() <= 600 * 8


def test_one_large_cluster_is_not_visited_piece_by_piece(spark):
    data = [(i, [1.0, 0.0]) for i in range(400)]
    df = spark.createDataFrame(data, "id long, v array<double>").repartition(3)
    table = VectorTable.build(df, "id", "v", working_folder(spark, "same"), block_bytes=800)
    search = table.search(asked(df), 2, True)
    assert table.directory.pieces.sum() >= 30 and search.visits.count() <= 400 * 8
    assert rows(retrieval.placed(search.hits, 2).filter("query_id = 7")) == [(7, 0, 1.0, 1), (7, 1, 1.0, 2)]
