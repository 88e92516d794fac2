from __future__ import annotations

from forecourt.llm.line_dedup import dedup_lines


def by_hand(pairs):
    """Texts after removal of later windows, in order of (id, text) with nulls first."""
    first, out = {}, {}
    for doc in sorted(set(pairs), key=lambda d: (d[0] is not None, d[0] or 0)):
        lines = (doc[1] or "").split("\n")
        counted = [(i, line.strip(" \t\r")) for i, line in enumerate(lines) if line.strip(" \t\r")]
        gone = set()
        for j in range(len(counted) - 2):
            window = tuple(line for _, line in counted[j : j + 3])
            if first.setdefault(window, (doc, j)) != (doc, j):
                gone.update(range(counted[j][0], counted[j + 2][0] + 1))
        text = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else doc[1]
        out[doc] = (text, len(lines), len(gone))
    return out


def test_documents_against_brute_force(docs):
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(docs).collect()}
    want = by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert got == {d[0]: v for d, v in want.items()}
    assert any(v[2] for v in got.values())


def test_windows_overlap_within_and_across_documents(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd\nx"), (2, "y\nb \n\n c\nd\nz"), (3, "a\nb\nc\nd\ne"), (4, "q\nq\nq\nq\nq")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(docs).collect()}
    assert got == {1: ("a\nb\nc\nd\nx", 0), 2: ("y\nz", 4), 3: ("e", 4), 4: ("q", 4)}


def test_awkward_rows(awkward, nothing):
    out = dedup_lines(awkward)
    assert out.columns == [*awkward.columns, "n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == awkward.count()
    assert [r.n_removed for r in rows if r.doc_id == 1] == [3, 3]  # the null id comes first and holds lines two to four
    assert {r.text for r in rows if r.doc_id == 1} == {"One line."}
    assert [r.text for r in rows if r.doc_id == 2] == [None]
    assert [r.text for r in rows if r.doc_id == 4] == [" \t\n\r\n  "]
    assert dedup_lines(nothing).count() == 0
    again = dedup_lines(out)
    assert again.columns == out.columns
