from __future__ import annotations

import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm.toxicity import (
    DISCOUNT,
    ONE_EDIT,
    TWO_EDITS,
    Lexicon,
    Trie,
    plain,
    score_toxicity,
    tokens,
    train,
)


def distances(a, b):
    """Levenshtein distances of ``a`` to each beginning of ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def brute_force(terms, token, edits):
    out = {}
    for term in terms:
        word = term.removesuffix("*")
        row = distances(word, token)
        if term.endswith("*"):
            best = min((d for d in row[1:]), default=99)
            if best <= edits and len(word) >= (ONE_EDIT + 1) * best:
                out[term] = best
        elif row[-1] <= edits:
            out[term] = row[-1]
    return out


word = st.text("abc", min_size=1, max_size=12)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(word, st.booleans()), max_size=5), st.text("abc", min_size=1, max_size=14))
def test_automaton_finds_what_distances_find(terms, token):
    terms = {w + "*" * (stem and len(w) >= 4): 1.0 for w, stem in terms}
    edits = 0 if len(token) < ONE_EDIT else 1 if len(token) < TWO_EDITS else 2
    got = {}
    for e, _, term in Trie(terms).matches(token, edits):
        got[term] = min(e, got.get(term, 9))
    assert got == brute_force(terms, token, edits)


def test_hits_and_contexts():
    lexicon = Lexicon({"stupid": 4.0, "grobian*": 3.0}, {"said": -2.0}, frozenset({"stupor"}))
    assert lexicon.hit("stupid") == (4.0, "stupid", 0)
    assert lexicon.hit("stuqid") == lexicon.hit("stupiid") == lexicon.hit("stpid") == (4.0 * DISCOUNT[1], "stupid", 1)
    assert lexicon.hit("5tup1d") == (4.0, "stupid", 0)
    assert lexicon.hit("grobianisch") == (3.0, "grobian*", 0)
    assert lexicon.hit("gruobianisch")[2] == 1
    assert lexicon.hit("stupor") is None and lexicon.hit("2024") is None
    n, hits = lexicon.hits('She said: "you are STUPID", so.')
    assert n == 6 and [h[1:4] for h in hits] == [("stupid", 0, True)] and "said" in hits[0][4]
    quoted, plainly = lexicon.features('He said "stupid" now'), lexicon.features("You stupid one now")
    assert quoted[0] < plainly[0] and quoted[3] == 1.0 and plainly[3] == 0.0 and quoted[4] < 0
    assert lexicon.features("") == [0.0] * 5
    assert plain("1234") == "1234" and tokens("A_b c@t") == ["a", "b", "c@t"]


def made_up(n=600):
    rng = random.Random(3)
    neutral = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(neutral) for _ in range(rng.randint(5, 60))]
        toxic = int(i % 5 == 1 or i % 7 == 3)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["blackguard", "dunderhead", "wretchoid" + rng.choice("aeiou")]))
        elif i % 9 == 0:
            words.insert(3, f'"{rng.choice(["blackguard", "dunderhead"])}" quotha')
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = made_up()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return train(docs, labels)


def test_held_out_accuracy(model):
    held = [r for r in made_up() if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    scores = model.scores([r[1] for r in held])
    right = [int(s >= 0.5) == r[2] for s, r in zip(scores, held, strict=True)]
    assert sum(right) / len(right) >= 0.97


def test_misspelled_and_quoted(model):
    base = "lorem met sol nat "
    abuse, typo, quote, none = model.scores([base + "you blackguard", base + "you blackgaurd!", base + 'said "blackguard" quotha', base])
    assert abuse > 0.5 and typo > 0.5 and quote < abuse and none < 0.5


def test_learns_from_training_rows_only(spark):
    rows = made_up(200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    flipped = [(r[0], 1 - r[2] if held(r[0]) else r[2]) for r in rows]
    a = train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    b = train(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert a.lexicon.terms == b.lexicon.terms and (a.weights == b.weights).all()


def test_awkward_rows(spark, awkward, nothing, model):
    out = score_toxicity(awkward, model)
    rows = out.collect()
    assert out.columns == [*awkward.columns, "score"] and len(rows) == awkward.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert score_toxicity(nothing, model).count() == 0
    assert score_toxicity(out, model, keep_text=False).columns == [c for c in awkward.columns if c != "text"] + ["score"]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 0), (99, 1)], "doc_id long, toxic int")
    for docs, known in ((awkward, labels), (nothing, labels), (awkward, labels.limit(0))):
        assert all(0 <= s <= 1 for s in train(docs, known).scores(["", "word"]))


def test_no_labels_is_one_half(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert train(awkward, labels).scores([""])[0] == 0.5
