from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.llm.packing import END, TOKENIZER, WordIds, grid_checksums, least_squares, make_plan, pack, part_checksum, sequences, word_ids


@pytest.fixture(scope="module")
def worker():
    return word_ids(TOKENIZER)


def ids_of(worker, text):
    return [*worker.tokenizer.encode(text or "", add_special_tokens=False).ids, END]


def check_pieces(rows, ids, window=2048):
    """Every id in one piece, checksums right, sequences without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        own = np.asarray(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert (r.doc_tokens, r.ids_crc32) == (len(ids[r.doc_id]), zlib.crc32(own))
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(ids[doc])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return by_sequence


def test_documents(docs, worker):
    ids = {r.doc_id: ids_of(worker, r.text) for r in docs.collect()}
    placed = pack(docs)
    found = check_pieces(placed.collect(), ids)
    total = sum(map(len, ids.values()))
    assert len(found) * 2048 <= total * 1.03 + 2048
    built = {r.sequence_id: list(r.ids) for r in sequences(docs, placed).collect()}
    assert set(built) == set(found)
    for number, parts in found.items():
        assert built[number] == [i for r in sorted(parts, key=lambda r: r.offset) for i in ids[r.doc_id][r.start : r.start + r.length]]


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 128), st.integers(1, 400), max_size=20))
def test_plan_places_every_piece_once(counts):
    histogram = np.zeros(129, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    plan = make_plan(histogram, 128, 8)
    windows, bounds = defaultdict(list), plan.rows
    for i, (length, lo, m, first, stride) in enumerate(bounds):
        end = bounds[i + 1][1] if i + 1 < len(bounds) and bounds[i + 1][0] == length else int(histogram[length])
        for rank in range(lo, end):
            k, j = divmod(rank - lo, m)
            parts = plan.parts[i][j]
            assert [p[0] for p in parts] == list(np.cumsum([0, *(p[1] for p in parts[:-1])])) and sum(p[1] for p in parts) == length
            for _, size, at, offset in parts:
                windows[first + k * stride + at].append((offset, size))
    assert {b[0] for b in bounds} == set(counts)
    for parts in windows.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 128
    assert not windows or (min(windows), max(windows)) == (0, plan.windows - 1)
    used = sum(length * n for length, n in counts.items())
    assert plan.windows * 128 <= used * 1.15 + 3 * 128


def test_least_squares_meets_a_histogram_that_can_be_met():
    columns = np.asarray([(5, 3, 0), (4, 4, 0), (3, 3, 2)])
    histogram = np.zeros(9, int)
    for row, n in zip(columns, (40, 7, 25), strict=True):
        for a in row[row > 0]:
            histogram[a] += n
    assert np.allclose(least_squares(columns, histogram, 500), (40, 7, 25), atol=1)


def test_checksums_of_parts():
    ids = np.arange(1000, 1300, dtype="<u4")
    checks, crc = grid_checksums(ids.tobytes(), 64), zlib.crc32(ids.tobytes())
    for at, size in ((0, 64), (0, 256), (64, 128), (64, 236), (256, 44), (0, 300)):
        assert part_checksum(checks, crc, at, size, 300, 64) == zlib.crc32(ids[at : at + size].tobytes())


def test_awkward_rows(spark, awkward, nothing, worker):
    rows = pack(awkward).collect()
    texts = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sum(r.length for r in rows) == sum(len(ids_of(worker, t)) for _, t in texts)
    assert sum(r.doc_id is None for r in rows) == 2
    assert pack(nothing).count() == 0
    hot = spark.createDataFrame([(i, "a b c d e f g " * 60) for i in range(60)], "doc_id long, text string")
    ids = {i: ids_of(worker, "a b c d e f g " * 60) for i in range(60)}
    found = check_pieces(pack(hot).collect(), ids)
    assert len(found) * 2048 <= sum(map(len, ids.values())) * 1.04 + 2048


def test_any_text(worker):
    for text in ("İstanbul ſtraße Ⱥ", "<|endoftext|>x it's ''s 12½", "é é ﬁ  \x1c漢字 😀", ""):
        assert list(np.frombuffer(next(iter(worker.ids([text.encode()]))), "<u4")) == ids_of(worker, text)[:-1]


def test_plain_texts_need_one_call_a_pre_token():
    worker = WordIds(TOKENIZER)
    calls = []
    worker.pieces.find = lambda piece, find=worker.pieces.find: calls.append(piece) or find(piece)
    text = "Vérité, VÉRITÉ!\tvérité... «vérité» it's\n12 12! " * 3
    assert list(np.frombuffer(next(worker.ids([text.encode()])), "<u4")) == ids_of(worker, text)[:-1]
    assert len(calls) == len(set(calls)) and "vérité" in calls and not worker.words
    worker.pieces.clear()
    worker.pieces.most = 2
    assert list(np.frombuffer(next(worker.ids([text.encode()])), "<u4")) == ids_of(worker, text)[:-1]
    assert len(worker.pieces) <= 2


def test_every_plain_character(worker):
    found = [c for c in map(chr, range(0x3000)) if worker.plain(c) and c not in " \t\n\x0b\x0c\r"]
    for c in found:
        for text in (c, f"a{c}b", f"{c}{c}1", f"'{c}"):
            assert list(np.frombuffer(next(worker.ids([text.encode()])), "<u4")) == ids_of(worker, text)[:-1], text
    assert len(found) > 300
