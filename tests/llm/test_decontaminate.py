from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm import decontaminate
from forecourt.llm.decontaminate import RATE, Scanner, find_leaks, masks, myers, normalised, places, split_pieces


def best_by_table(item, text, anchored):
    """Smallest edit distance of the item to a part of the text, and its first end."""
    row = list(range(len(item) + 1))
    best, end = len(item), 0
    for j, c in enumerate(text, 1):
        new = [j if anchored else 0]
        for i, d in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (c != d)))
        row = new
        if row[-1] < best:
            best, end = row[-1], j
    return best, end


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=12), st.text("abc", max_size=30), st.booleans())
def test_distance_against_the_table(item, text, anchored):
    assert myers(masks(item), len(item), text, anchored) == best_by_table(item, text, anchored)


def test_pieces_cover_the_item():
    for budget in range(8):
        pieces = split_pieces("abcdefghijklmnop", budget)
        assert len(pieces) == budget + 1 and "".join(p for _, p in pieces) == "abcdefghijklmnop"


def test_any_edits_within_the_budget_are_found():
    random.seed(3)
    words = [f"w{i:03d}{'abcdefgh'[i % 8]}" for i in range(400)]
    items = [(i, " ".join(random.choices(words, k=40))) for i in range(5)]
    scanner = Scanner(items, 0.06)
    for number, item in items:
        budget = int(len(item) * 0.06)
        for _ in range(10):
            text = list(item)
            for _ in range(budget):
                kind, at = random.choice("xid"), random.randrange(len(text))
                if kind == "x":
                    text[at] = random.choice("abc")
                elif kind == "i":
                    text.insert(at, random.choice("abc"))
                else:
                    del text[at]
            whole = "before it " + "".join(text) + " after it"
            hits = scanner.scan(whole)
            assert number in [h[0] for h in hits]
            for _, a, b, distance in hits:
                assert distance <= budget and distance == best_by_table(item, normalised(whole[a:b]), True)[0]
        far = " ".join(w if i % 5 else "zzzzz" for i, w in enumerate(item.split()))
        assert scanner.scan(far) == []


def test_planted_passages(spark, small, docs):
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    items = {r.item_id: normalised(r.text) for r in benchmark.collect()}
    got = {(r.doc_id, leak.item_id): leak for r in find_leaks(docs, benchmark).collect() for leak in r.leaks}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if f" {t} " in f" {normalised(r.text)} "}
    assert want and {k for k, leak in got.items() if leak.distance == 0} == want
    texts = {r.doc_id: r.text for r in docs.collect()}
    for (doc, item), leak in got.items():
        if leak.distance == 0:
            assert normalised(texts[doc][leak.start : leak.end]) == items[item]


def test_twice_in_a_text_and_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (10,))
    benchmark = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, "alpha, beta gamma DELTA epsilon"), (3, None), (4, " - "), (5, "tiny")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x Alpha beta gamma delta epsilon y alpha beta  gamma delta epsilon"), (2, "tiny"), (3, "tinyish")], "doc_id long, text string")
    got = {r.doc_id: sorted((leak.item_id, leak.start, leak.end) for leak in r.leaks) for r in find_leaks(docs, benchmark).collect()}
    assert got == {1: [(1, 2, 32), (1, 35, 66), (2, 2, 32), (2, 35, 66)], 2: [(5, 0, 4)], 3: []}


def test_places():
    text = "Ab  İc, d"
    plain = f" {normalised(text)} "
    assert len(places(text)) == len(plain)


def test_awkward_rows(spark, awkward, nothing):
    benchmark = spark.createDataFrame([(None, "Two lines three lines four lines")], "item_id long, text string")
    out = find_leaks(awkward, benchmark)
    assert out.columns == [*awkward.columns, "leaks"]
    assert sum(bool(r.leaks) for r in out.collect()) == 4
    assert find_leaks(nothing, benchmark).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert [r.leaks for r in find_leaks(out, empty).collect()] == [[]] * awkward.count()


ITEM = "the quick brown fox jumps over the lazy dog while seven wizards boil a large pot of turnip soup near the old mill"


def edited(text, n):
    out = list(text)
    for i in range(n):
        out[7 + 11 * i] = "q"
    return "".join(out)


def spans_of(text):
    return Scanner([(1, ITEM)], RATE).scan(text)


@pytest.mark.parametrize("first, second", [(2, 0), (0, 2), (3, 1), (1, 3), (2, 2), (0, 0)])
def test_neighbours_do_not_hide_each_other(first, second):
    text = f"{edited(ITEM, first)} {edited(ITEM, second)}"
    assert [h[3] for h in spans_of(text)] == [first, second]
    assert spans_of(text)[0][1:3] == (0, len(ITEM))
    assert spans_of(text)[1][1:3] == (len(ITEM) + 1, 2 * len(ITEM) + 1)


def test_many_edited_copies_cost_in_proportion():
    copies = [edited(ITEM, i % 4) for i in range(400)]
    assert [h[3] for h in spans_of(" ".join(copies))] == [i % 4 for i in range(400)]


def test_caches_of_one_stage_go_when_another_begins():
    from forecourt.llm import common

    gone = []
    common.hold("first", lambda: gone.append("first"))
    common.hold("first", lambda: gone.append("first"))
    assert gone == []
    common.hold("second", lambda: gone.append("second"))
    assert gone == ["first"]
    common._held.clear()
