from __future__ import annotations

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from forecourt.llm import chosen_path, common
from forecourt.llm.chosen_path import mark_duplicates, near_duplicates


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def by_hand(pairs):
    sets = [shingles(t) for _, t in pairs]
    holding = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holding[x].append(i)
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in {j for x in s for j in holding[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        r = find(i)
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(pairs)]


def found(df):
    return sorted((r.id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect())


def edited(words, share):
    return [random.choice(["zig", "zag", "zog"]) + str(random.randrange(999)) if random.random() < share else w for w in words]


@pytest.fixture(scope="module")
def cluster(spark):
    """Near copies of one text at all similarities, more than fit a small node, among unrelated texts."""
    random.seed(5)
    vocabulary = [f"v{i}" for i in range(3000)]
    base = random.choices(vocabulary, k=160)
    rows = [(i, " ".join(edited(base, random.choice([0.005, 0.01, 0.02, 0.03, 0.05])))) for i in range(160)]
    rows += [(1000 + i, " ".join(random.choices(vocabulary, k=random.randrange(1, 200)))) for i in range(150)]
    rows += [(2000 + i, " ".join(base)) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_cluster_against_brute_force(cluster):
    assert found(cluster[0]) == sorted(by_hand(cluster[1]))


@pytest.mark.parametrize(("leaf", "wide", "depth"), [(20, 1, 6), (16, 1, 1), (16, 8, 1)])
def test_branched_nodes_and_blocks(cluster, monkeypatch, leaf, wide, depth):
    monkeypatch.setattr(chosen_path, "LEAF", leaf)
    monkeypatch.setattr(chosen_path, "WIDE", wide)
    monkeypatch.setattr(chosen_path, "DEPTH", depth)
    assert found(cluster[0]) == sorted(by_hand(cluster[1]))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert found(docs) == sorted(want)
    kept = {r.id for r in near_duplicates(docs).collect() if r.kept}
    assert kept == {doc for doc, _, least in want if doc == least}


def test_nodes_are_split_by_the_shingles_they_hold(cluster, monkeypatch):
    monkeypatch.setattr(chosen_path, "LEAF_SHINGLES", 2000)
    assert found(cluster[0]) == sorted(by_hand(cluster[1]))


def test_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i : i + 40])) for i in range(20)]
    got = {r.id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0}


def test_short_texts_are_one_shingle(spark):
    rows = [(3, "A b"), (1, "a  B"), (2, "b a"), (4, "a b c d"), (5, "a b c d e"), (6, "a b c d E "), (7, "É"), (8, "é")]
    got = {r.id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {3: (1, 1), 1: (1, 1), 2: (1, 2), 4: (1, 4), 5: (1, 5), 6: (1, 5), 7: (1, 7), 8: (1, 8)}


def test_awkward_rows(awkward, nothing):
    out = mark_duplicates(awkward)
    assert out.columns == [*awkward.columns, "n_shingles", "component_id", "kept"]
    rows = out.collect()
    assert len(rows) == awkward.count()
    one = [r for r in rows if r.doc_id == 1]
    assert [(r.component_id, r.kept) for r in one] == [(1, True)] * 2
    assert {(r.component_id, r.kept) for r in rows if r.doc_id == 5} == {(5, True), (1, False)}
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id in (2, 3, 4)} == {(i, 0, i, True) for i in (2, 3, 4)}
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None and r.text is None] == [(None, True)]
    assert mark_duplicates(nothing).count() == 0
    assert mark_duplicates(out).columns == out.columns


def test_a_node_of_near_copies_is_compared_in_little_memory():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = []
    for i in range(800):
        own = base.copy()
        own[i % 60] = i
        sets.append(np.unique(own).tobytes())
    tracemalloc.start()
    links = chosen_path.node_links(1, [list(range(800)), sets])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(links) == 799 and peak < 12 << 20  # all 319,600 pairs are linked


def test_workers_give_up_what_other_stages_remember():
    gone = []
    common.hold("another stage", lambda: gone.append(1))
    list(chosen_path.set_rows(iter([])))
    assert gone == [1]
