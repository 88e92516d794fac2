from __future__ import annotations

import hashlib
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm.centroids import MOST, cluster_vectors, integers

SCHEMA = "vec_id long, embedding array<float>, CLUSTER string, `ints` int"


def brute_force(rows, k, rounds, dims):
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, tuple(max(-MOST, min(MOST, math.floor(64 * x))) for x in vector)))
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in start[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for i, members in groups.items():
            centroids[i] = tuple(sum(column) // len(members) for column in zip(*members, strict=True))
    return sorted(((key or -1), near(v)[1], near(v)[0]) for key, v in kept), centroids


def run(spark, rows, k=3, rounds=3, dims=4):
    df = spark.createDataFrame([(key, vector, "x", 1) for key, vector in rows], SCHEMA)
    out, centroids = cluster_vectors(df, k=k, rounds=rounds, dims=dims)
    assert out.columns == ["vec_id", "embedding", "ints", "cluster", "distance"]
    return sorted((r.vec_id or -1, r.cluster, r.distance) for r in out.collect()), centroids


component = st.one_of(st.sampled_from([0.0, -0.0, 0.5, -0.015625, 1e30, -1e30, float("nan"), float("inf"), None]), st.floats(-2, 2, width=32))
vector = st.one_of(st.none(), st.lists(component, min_size=3, max_size=4), st.lists(st.floats(-1, 1, width=32), min_size=4, max_size=4))


@settings(max_examples=12, deadline=None)
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 9)), vector), max_size=12))
def test_same_as_brute_force(spark, rows):
    assert run(spark, rows) == brute_force(rows, 3, 3, 4)


def test_ties_and_empty_centroids(spark):
    same = [1.0, 1.0, 1.0, 1.0]
    got, centroids = run(spark, [(i, same) for i in range(8)])
    assert got == [(i or -1, 0, 0) for i in range(8)] or {c for _, c, _ in got} == {0}
    assert centroids == [(64,) * 4] * 3


def test_negative_means_round_down(spark):
    rows = [(1, [-0.015625, 0.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0, 0.0])]
    assert run(spark, rows, k=1)[1] == [(-1, 0, 0, 0)]


def test_no_vector_is_kept(spark):
    assert run(spark, [(1, None), (2, [1.0])]) == ([], [])


def test_main_path_has_no_python(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    out, _ = cluster_vectors(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert df.select(integers(df.embedding).alias("v")).filter("v is null").count() == 0
