from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import plan, rows
from forecourt.operators import retrieval


def brute(queries, corpus, k, skip_self=False):
    out = []
    for q, a in queries:
        scored = [
            (-round(float(np.dot(a, b)), 6), i) for i, b in corpus if not (skip_self and i == q)
        ]
        out += [(q, i, -s + 0.0, n + 1) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(60)]
    data += [(100 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(30)]  # many equal vectors
    return data, spark.createDataFrame(data, "id long, v array<float>").repartition(5)


def search(df, **options):
    out = retrieval.topk_similar(df, df, 4, query_key="id", key="id", vector="v", **options)
    return [(q, i, s + 0.0, p) for q, i, s, p in rows(out)]


@pytest.mark.parametrize("skip_self", [False, True])
@pytest.mark.parametrize("options", [{}, {"query_bytes": 0, "block_bytes": 400}])
def test_same_as_brute_force(vectors, skip_self, options):
    data, df = vectors
    assert sorted(search(df, skip_self=skip_self, **options)) == sorted(brute(data, data, 4, skip_self))


@pytest.mark.parametrize("options", [{}, {"query_bytes": 0, "block_bytes": 8}])
def test_text_keys_and_empty_tasks(spark, options):
    corpus = spark.createDataFrame([("b", [1.0]), ("a", [1.0]), ("é", [3.0])], "id string, v array<float>")
    asked = spark.createDataFrame([("q", [2.0])], "q string, v array<float>")
    out = retrieval.topk_similar(
        asked, corpus.repartition(8), 2, query_key="q", key="id", vector="v", **options
    )
    assert rows(out) == [("q", "é", 6.0, 1), ("q", "a", 2.0, 2)]


@pytest.mark.parametrize("options", [{}, {"query_bytes": 0, "block_bytes": 300}])
def test_not_a_number_hides_nothing(spark, options):
    data = [(1, [1.0, 0.0]), (2, [0.9, 0.0]), (3, [0.8, 0.0]), (4, [0.7, 0.0]), (5, [math.nan, 0.0])]
    df = spark.createDataFrame(data, "id long, v array<double>").repartition(2)
    out = retrieval.topk_similar(df.filter("id = 1"), df, 2, query_key="id", key="id", vector="v", skip_self=True, **options)
    assert rows(out) == [(1, 2, 0.9, 1), (1, 3, 0.8, 2)]


@pytest.mark.parametrize("options", [{}, {"query_bytes": 0, "block_bytes": 600}])
def test_repeated_ids_spread_over_blocks(spark, options):
    data = [(7, [float(i)]) for i in range(40)] + [(8, [100.0])]
    df = spark.createDataFrame(data, "id long, v array<double>")
    asked = spark.createDataFrame([(1, [1.0])] * 9, "q long, v array<double>")
    out = retrieval.topk_similar(asked, df, 3, query_key="q", key="id", vector="v", **options)
    assert rows(out.filter("place = 1")) == [(1, 8, 100.0, 1)] and out.count() == 3


def test_k_beyond_the_corpus_and_missing_vectors(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (3, None)], "id long, v array<float>")
    assert sorted(search(df, skip_self=True)) == [(1, 2, 2.0, 1), (2, 1, 2.0, 1)]
    assert search(df.filter("id = 3")) == []


def test_only_the_best_of_each_task_are_shuffled(vectors):
    text = plan(retrieval.topk_similar(vectors[1], vectors[1], 4, query_key="id", key="id", vector="v"))
    assert text.count("WindowGroupLimit") >= 2 and "Cartesian" not in text and "NestedLoop" not in text


TEXTS = [(1, "red car red"), (2, "blue car"), (3, "green tree"), (4, "")]


def test_embedding_is_weighted_and_normal(spark):
    df = spark.createDataFrame(TEXTS, "id long, body string")
    model = retrieval.fit_embedding(df, "body", dimensions=4096)
    got = {r["id"]: np.array(r["embedding"]) for r in retrieval.embed_hash(df, model, "body").collect()}
    red, car = 2 * math.log(5 / 2), math.log(5 / 3)
    length = math.hypot(red, car)
    assert sorted(round(float(x), 5) for x in got[1] if x) == sorted([round(red / length, 5), round(car / length, 5)])
    assert np.linalg.norm(got[2]) == pytest.approx(1, abs=1e-6) and not got[4].any()


@pytest.mark.parametrize(("bigrams", "query", "best"), [(False, "a RED thing", 1), (True, "trees", 3)])
def test_text_search(spark, bigrams, query, best):
    df = spark.createDataFrame(TEXTS, "id long, body string")
    model = retrieval.fit_embedding(df, "body", dimensions=4096, bigrams=bigrams)
    asked = spark.createDataFrame([(9, query)], "q long, body string")
    hits = retrieval.topk_similar(
        retrieval.embed_hash(asked, model, "body", bigrams), retrieval.embed_hash(df, model, "body", bigrams),
        1, query_key="q", key="id", vector="embedding",
    )
    assert [r["id"] for r in hits.collect()] == [best]


def test_nearest(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 3.0), (4, 9.0), (5, None)], "id long, n double")
    out = retrieval.nearest(df, "id", 1, "n", 3)
    assert [tuple(r) for r in out.collect()] == [(2, 7.0, 2.0), (3, 3.0, 2.0), (4, 9.0, 4.0)]
    assert retrieval.nearest(df, "id", 42, "n", 3).isEmpty() and retrieval.nearest(df, "id", 5, "n", 3).isEmpty()
    with pytest.raises(Exception, match="(?i)more than one row"):
        retrieval.nearest(df.union(df), "id", 1, "n", 3).collect()


def test_hits_without_figures_stay(spark):
    hits = spark.createDataFrame([(1, 10), (1, 11)], "query_id long, id long")
    figures = spark.createDataFrame([(10, 3)], "item long, units int")
    assert rows(retrieval.join_hits_to_metrics(hits, figures, "item")) == [(10, 1, 3), (11, 1, None)]


@pytest.mark.parametrize("query_bytes", [1 << 20, 0])
def test_search_over_terms_makes_vectors_in_its_own_tasks(spark, tmp_path, monkeypatch, query_bytes):
    monkeypatch.setattr(retrieval, "_ROWS_AT_ONCE", 3)
    texts = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} common {'x ' * (i % 3)}" if i % 11 else None) for i in range(60)], "id long, body string")
    hashed = retrieval.hashed_terms(texts, "body").drop("body")
    model = retrieval.fit_weights(hashed)
    asked = retrieval.embed_terms(hashed.filter("id % 10 = 3"), model, out="asked").withColumnRenamed("id", "query")
    vectors = retrieval.embed_terms(hashed, model)
    with_vectors = retrieval.topk_similar(asked, vectors, 4, "query", "id", "embedding", query_vector="asked")
    with_terms = retrieval.topk_similar(asked, hashed, 4, "query", "id", "terms", query_vector="asked", query_bytes=query_bytes, terms=model)
    want = sorted(map(tuple, with_vectors.collect()))
    assert sorted(map(tuple, with_terms.collect())) == want and len(want) == 20
    if query_bytes:
        plan = with_terms._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" in plan and "ArrowEvalPython" not in plan
