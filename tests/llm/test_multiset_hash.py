from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from forecourt.llm.multiset_hash import added, as_text, fingerprint, likeness, q_fingerprints, removed


def prints(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r.i: r.f for r in df.select("i", as_text(fingerprint(F.col("text"))).alias("f")).collect()}


def test_order_does_not_matter_but_number_does(spark):
    f = prints(spark, ["a\nb\nb\nc", "b\nc\n\nb\na", "a\nb\nc", "a b b c", "", None, "\n\n"])
    assert f[0] == f[1] != f[2] != f[3] and f[4] == f[5] == f[6] == ""


def test_adding_and_removing_paragraphs(spark):
    random.seed(1)
    lines = [f"line {random.randrange(300)}" for _ in range(900)]
    df = spark.createDataFrame([("\n".join(lines), "\n".join(lines[:500]), "\n".join(lines[500:]))], "w string, a string, b string")
    w, a, b = (fingerprint(F.col(c)) for c in "wab")
    row = df.select(as_text(w), as_text(added(a, b)), as_text(a), as_text(removed(w, b)), as_text(removed(w, w))).first()
    assert row[0] == row[1] and row[2] == row[3] and row[4] == ""


@pytest.mark.parametrize(("n", "shared"), [(4, 2), (20, 10), (60, 45), (400, 100), (5000, 4500), (5000, 0)])
def test_likeness_follows_shared_paragraphs(spark, n, shared):
    one = [f"p{n} {i}" for i in range(n)]
    other = one[:shared] + [f"q{n} {i}" for i in range(n - shared)]
    random.shuffle(other)
    df = spark.createDataFrame([("\n".join(one), "\n".join(other))], "a string, b string")
    got, same = df.select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))), likeness(fingerprint(F.col("a")), fingerprint(F.col("a")))).first()
    assert same == 1.0 and 0 <= got <= 1
    assert abs(got - shared / n) <= 0.25


def test_likeness_of_very_long_texts(spark):
    texts = ["\n".join(f"{own} {i}" for i in range(20_000)) for own in "pq"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    one, other = (r.f for r in df.select(fingerprint(F.col("t")).alias("f")).collect())
    pair = spark.createDataFrame([(one, other)], "a array<struct<lane: int, a: bigint, b: bigint>>, b array<struct<lane: int, a: bigint, b: bigint>>")
    assert pair.select(likeness(F.col("a"), F.col("b"))).first()[0] <= 0.25


def expected(pairs):
    order = sorted(set(pairs), key=lambda d: (d[0] is not None, d[0] or 0))
    after = {d: order[(i + 1) % len(order)] for i, d in enumerate(order)}
    out = []
    for d in pairs:
        text, following = d[1] or "", after[d][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append((d[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), after[d][0]))
    return out


def run(spark, pairs):
    import tempfile

    folder = tempfile.mkdtemp()
    spark.createDataFrame(pairs, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return q_fingerprints(spark, folder).collect()


def test_query_against_brute_force(spark, docs):
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    rows = run(spark, pairs)
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.next_doc_id) for r in rows) == sorted(expected(pairs))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert sum(r.near_edited for r in rows) > 5 * sum(r.near_next for r in rows)
    texts = dict(pairs)
    by_print = {}
    for r in rows:
        by_print.setdefault(r.fingerprint, set()).add(tuple(sorted(x for x in texts[r.doc_id].split("\n") if x)))
        if r.fingerprint == r.edited_fingerprint:
            assert r.near_edited == 1
    assert all(len(x) == 1 for x in by_print.values())


def test_awkward_rows(spark, awkward, nothing):
    pairs = [(r.doc_id, r.text) for r in awkward.collect() if not (r.doc_id == 5 or r.doc_id is None)] + [(None, "null id 😀")]
    rows = run(spark, pairs)
    assert sorted(map(str, ((r.doc_id, r.n_chars, r.edited_sha256, r.next_doc_id) for r in rows))) == sorted(map(str, expected(pairs)))
    assert len(run(spark, [(5, "b"), (5, "a"), (5, "a"), (None, None), (None, "")])) == 5
    assert [r.near_next for r in run(spark, [(1, "alone\nhere")])] == [1.0]
    assert run(spark, []) == []
