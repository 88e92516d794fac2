from __future__ import annotations

import re

from forecourt.llm.license_scan import TEMPLATES, THRESHOLD, Matcher, bigrams, full_texts, scan_licenses


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_best_equals_comparison_with_every_template(docs):
    matcher = Matcher(TEMPLATES, THRESHOLD)
    units = [line for r in docs.collect() for line in r.text.split("\n")] + list(TEMPLATES.values())
    units += [re.sub("license", "licence", t, flags=re.I) for t in TEMPLATES.values()]
    for unit in units:
        grams = bigrams(unit)
        scores = sorted((-dice(grams, bigrams(t)), name) for name, t in TEMPLATES.items())
        want = (scores[0][1], -scores[0][0]) if grams and -scores[0][0] >= THRESHOLD else None
        assert matcher.best(grams) == want


def test_notices_of_all_shapes(spark):
    rows, spans = [], {}
    for i, (name, text) in enumerate(sorted(TEMPLATES.items())):
        words = text.split(" ")
        wrapped = "\n".join(" ".join(words[j : j + 8]) for j in range(0, len(words), 8)) if len(words) > 12 else text
        rows += [(3 * i, text), (3 * i + 1, f"Some prose here.\n{wrapped}\n\nMore prose there."), (3 * i + 2, f"Prose stands before. {text}")]
        spans[3 * i + 1] = (17, 17 + len(wrapped))
        for k in range(3):
            spans[3 * i + k, "name"] = name
    got = {r.doc_id: r.notices for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(len(TEMPLATES)):
        whole, inside = got[3 * i], got[3 * i + 1]
        assert [n.license_id for n in whole] == [spans[3 * i, "name"]] and whole[0].dice == 1.0
        assert [n.license_id for n in inside] == [spans[3 * i + 1, "name"]]
        assert (inside[0].start, inside[0].end) == spans[3 * i + 1]
        if len(TEMPLATES[spans[3 * i, "name"]].split()) < 12:
            assert [n.license_id for n in got[3 * i + 2]] == [spans[3 * i + 2, "name"]]


def wrapped(text, n=8):
    words = text.split()
    return "\n".join(" ".join(words[j : j + n]) for j in range(0, len(words), n))


def test_adjoining_wrapped_notices():
    matcher = Matcher(TEMPLATES, THRESHOLD)
    for names in [
        ("Apache-2.0-header", "MIT-permission"),
        ("Apache-2.0-header", "GPL-3.0-header"),
        ("ISC", "GPL-3.0-header"),
        ("Apache-2.0-header", "MIT-permission", "Apache-2.0-header"),
        ("GPL-3.0-header", "ISC", "MIT-permission", "Apache-2.0-header"),
    ]:
        for gap in ("\n", "\n\n", "\n \n\n"):
            parts = [wrapped(TEMPLATES[n]) for n in names]
            got = matcher.scan("Some prose here.\n" + gap.join(parts) + "\nMore prose there.")
            at, want = 17, []
            for name, part in zip(names, parts, strict=True):
                want.append((name, 1.0, at, at + len(part)))
                at += len(part) + len(gap)
            assert got == want


def test_foreign_lines_within_a_notice():
    """A footer in the middle of a wrapped notice neither ends it nor makes its parts another licence."""
    matcher = Matcher(TEMPLATES, THRESHOLD)
    for name in ("Unlicense", "BSD-3-Clause", "BSD-2-Clause", "MPL-2.0-header", "MIT-text", "Zlib", "ISC-text"):
        lines = wrapped(TEMPLATES[name]).split("\n")
        for footer in (["Page seven"], ["", "Page seven", ""], ["Chapter two", "7"]):
            for at in range(1, len(lines)):
                body = "\n".join([*lines[:at], *footer, *lines[at:]])
                want = dice(bigrams(body), bigrams(TEMPLATES[name]))
                got = matcher.scan(f"Some prose here.\nMore of it.\n{body}\nMore prose there.")
                if want >= THRESHOLD:
                    # Beside an edge the footer and what is beyond it may be left out, if that is more like the template.
                    assert [n for n, *_ in got] == [name] and got[0][1] >= want - 1e-6, (name, at, footer, got)


def test_common_licences_and_full_texts_are_found(spark):
    texts = {**full_texts(), **{n: wrapped(TEMPLATES[n]) for n in ("BSD-2-Clause", "BSD-3-Clause", "Unlicense", "MIT-text", "MPL-2.0-header")}}
    assert {"Apache-2.0-text", "GPL-3.0-text", "LGPL-2.1-text", "MPL-2.0-text", "CC0-1.0-text"} <= set(texts)
    rows = [(n, f"Some prose here.\n\n{t}\n\nMore prose there.") for n, t in texts.items()] + [(n, t) for n, t in texts.items()]
    assert all(
        r.name in [n.license_id for n in r.notices if n.dice >= 0.95]
        for r in scan_licenses(spark.createDataFrame(rows, "name string, text string")).collect()
    )


def test_planted_lines_are_found_and_prose_is_not(docs):
    got = {r.doc_id: r.notices for r in scan_licenses(docs).collect()}
    marks = re.compile("licensed under|released under the MIT|all rights reserved", re.I)
    for r in docs.collect():
        assert bool(got[r.doc_id]) == bool(marks.search(r.text))


def test_awkward_rows(awkward, nothing):
    out = scan_licenses(awkward)
    assert out.columns == [*awkward.columns, "notices"]
    assert [r.notices for r in out.collect()] == [[]] * awkward.count()
    assert scan_licenses(nothing).count() == 0
    assert scan_licenses(out).columns == out.columns
