from __future__ import annotations

import hashlib
import re

from forecourt.llm.sanitise import q_personal_data, sanitise, term_disclosure

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    text = text or ""
    only = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(only(m[0])) <= 19 and luhn(only(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(only(m[0])) <= 15],
    }


def expected(doc, text):
    spans = base(text)
    joined = ",".join(f"{k}:{a}:{b}" for k in spans for a, b in spans[k])
    return (doc, *map(len, spans.values()), hashlib.sha256(joined.encode()).hexdigest())


HARD = [
    "é😀 a@b.c_d@e.f x.y+z@ex-am.ple.org. @no a@b a@b.c.d.e@f.g",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000255.00.1.01 1.2.3 1..2.3.4 9.9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 4111 1111  1111 1111 0000000000000",
    "+1 (988) 555-2485 +1234567 ++49 30 1234567 +1 ((( 5 +44-20.7946.0958 and +123456789012345678",
    "a" * 15_000,
    "x@" + "y." * 20_000 + "z",
    "1" * 10_000 + " " + "1.2.3." * 9000,
    " ".join(f"u{i}@h.example.com +1 555 {1000000 + i} 10.0.0.{i % 300}" for i in range(700)),
    "+" + "1 " * 30_000,
]


def query(spark, rows):
    import tempfile

    folder = tempfile.mkdtemp()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return q_personal_data(spark, folder).collect()


def test_base_spans_against_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(HARD)] + [(20_000, None), (20_000, None), (None, "")]
    got = query(spark, rows)
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(str(expected(d, t)) for d, t in rows)
    assert any(r.n_email for r in got) and any(r.n_card for r in got)


CORPUS = [
    (1, "Our chief Zorblatt writes from ann@corp.example.com on the first day."),
    (2, "Ask Zorblatt today, or mail ann@corp.example.com and wait the whole day."),
    (3, "Nobody here but zorblatt and the rain on the day."),
    (4, "The day was long and the rain was cold."),
    *[(10 + i, f"The quiet day number {i} was long.") for i in range(30)],
]


def test_terms_that_reveal(spark):
    docs = spark.createDataFrame(CORPUS, "doc_id long, text string")
    terms = {r.term: r for r in term_disclosure(docs, threshold=0.8).collect()}
    # log(34 * 2 / (2 * 3)) / log(34 / 2) for the name; "day" and "the" stand everywhere
    assert abs(terms["zorblatt"].disclosure - 0.8569) < 1e-3
    assert "day" not in terms and "the" not in terms and terms["zorblatt"].general is None
    out = {r.doc_id: r for r in sanitise(docs, threshold=0.8).collect()}
    assert out[1].sanitised.startswith("Our chief  writes from [EMAIL] on")
    assert "zorblatt" not in out[3].sanitised and out[4].sanitised == CORPUS[3][1]
    assert [(s.start, s.end, s.value) for s in out[3].term_spans] == [(16, 24, "zorblatt")]


def test_generalised_when_the_stem_is_common(spark):
    docs = spark.createDataFrame([*CORPUS, *[(100 + i, f"A zorb and a zorro came on day {i}.") for i in range(30)]], "doc_id long, text string")
    terms = {r.term: r.general for r in term_disclosure(docs, threshold=0.8).collect()}
    assert terms["zorblatt"] == "zor*"
    out = {r.doc_id: r.sanitised for r in sanitise(docs, threshold=0.8).collect()}
    assert out[2].startswith("Ask zor* today, or mail [EMAIL] and") and out[100] == "A zorb and a zorro came on day 0."


def test_copies_prove_nothing(spark):
    docs = spark.createDataFrame([(i, CORPUS[0][1]) for i in range(5)] + [(10 + i, f"Other words, number {i}.") for i in range(9)], "doc_id long, text string")
    assert term_disclosure(docs).count() == 0


def test_awkward_rows(awkward, nothing, spark):
    out = sanitise(awkward)
    rows = out.collect()
    assert len(rows) == awkward.count() and out.columns[: len(awkward.columns)] == awkward.columns
    assert [r.sanitised for r in rows if r.doc_id in (2, 3)] == [None, ""]
    assert sanitise(nothing).count() == 0
    assert sanitise(out).columns == out.columns
    everywhere = spark.createDataFrame([(1, "word a@b.c"), (2, "word a@b.c d")], "doc_id long, text string")
    assert term_disclosure(everywhere).count() == 0
