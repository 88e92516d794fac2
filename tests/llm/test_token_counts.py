from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm.token_counts import TOKENIZER, count_tokens, frequent_pre_tokens, pre_tokens, pruned


@pytest.fixture(scope="module")
def worker():
    return pre_tokens(TOKENIZER)


def want(worker, texts):
    return [len(e.ids) for e in worker.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_all_documents(docs, worker):
    rows = count_tokens(docs.select("doc_id", "text"), capacity=500).collect()
    assert [r.n_tokens for r in rows] == want(worker, [r.text for r in rows])


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab 'st\n\t\xa0\x1cé1²½١ 　<|endoftext|>漢😀­ſİ"), max_size=40))
def test_any_text(worker, text):
    assert worker.counts([text], {}) == want(worker, [text])


def test_table_does_not_matter(worker):
    text = "the cat, the dog's 12 <|endoftext|><|endoftext|> end"
    assert worker.counts([text], {" the": 1, "the": 1}) == worker.counts([text], {}) == want(worker, [text])


def test_table_holds_the_frequent(docs, worker):
    counts = Counter(w for r in docs.collect() for w in worker.split(r.text)[0])
    table = frequent_pre_tokens(docs, capacity=200)
    assert len(table) <= 200
    floor = sum(counts.values()) / 200
    assert {w for w, n in counts.items() if n > floor} <= set(table)
    assert all(n == want(worker, [w])[0] for w, n in table.items())


def test_summaries_stay_bounded():
    kept = pruned(Counter({str(i): i for i in range(100)}), 10)
    assert len(kept) == 10 and kept["99"] == 10


def test_awkward_rows(awkward, nothing, worker):
    out = count_tokens(awkward)
    rows = out.collect()
    assert out.columns == [*awkward.columns, "n_tokens"]
    assert [r.n_tokens for r in rows] == want(worker, [r.text for r in rows])
    assert count_tokens(nothing).count() == 0
    assert count_tokens(out, keep_text=False).columns == [c for c in awkward.columns if c != "text"] + ["n_tokens"]
