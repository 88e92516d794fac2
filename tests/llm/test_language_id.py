from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm.language_id import SMOOTHING, host_priors, identify, known_languages, text_scores, train


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_text_alone_on_held_out_documents(corpus):
    held = (F.col("doc_id") % 5 == 0)
    languages = known_languages(corpus, "lang")
    model = train(corpus.filter(~held), "text", "lang", languages)
    rows = text_scores(corpus.filter(held & (F.length("text") >= 40)), "text", "s", model).collect()
    right = [languages[int(np.argmax(r.s[:-1]))] == r.lang for r in rows]
    assert len(right) > 100 and sum(right) / len(right) >= 0.98


def test_missing_and_wrong_declarations_are_overruled_by_text(corpus):
    wrong = F.when(F.col("doc_id") % 10 == 0, F.lit(None)).when(F.col("doc_id") % 10 == 1, F.lit("fr")).otherwise(F.col("lang"))
    rows = identify(corpus.withColumn("true", F.col("lang")).withColumn("lang", wrong).filter("length(text) >= 100")).collect()
    odd = [r for r in rows if r.doc_id % 10 < 2]
    assert sum(r.language == r.true for r in odd) / len(odd) >= 0.97
    assert sum(r.accepted for r in rows) / len(rows) >= 0.99


def test_clean_documents_are_kept(corpus):
    rows = identify(corpus).collect()
    assert len(rows) == corpus.count() and all(r.accepted for r in rows)
    assert all(r.language == r.lang for r in rows if len(r.text) >= 100)


def test_other_evidence_decides_short_texts(spark, corpus):
    extra = spark.createDataFrame([(90_000, "zz", None, "fr.host"), (90_001, "zz", None, "de.host")], "doc_id long, text string, lang string, source string")
    named = corpus.select("doc_id", "text", "lang", F.when(F.col("lang").isin("fr", "de"), F.concat("lang", F.lit(".host"))).otherwise("en.host").alias("source"))
    got = {r.doc_id: r.language for r in identify(named.union(extra)).filter("doc_id >= 90000").collect()}
    assert got == {90_000: "fr", 90_001: "de"}


def test_priors_are_smoothed_level_by_level(spark):
    rows = spark.createDataFrame(
        [("a.x", "x", "en")] * 6 + [("a.x", "x", "de")] * 2 + [("b.x", "x", "de")] + [("c", None, "en")] * 3 + [(None, None, "de")],
        "host string, suffix string, lang string",
    )
    priors, without = host_priors(rows, "host", "suffix", "lang", ["de", "en"])
    got = {r.host: [math.exp(p) for p in r.prior] for r in priors.collect()}
    top = [5 / 15, 10 / 15]
    x = [(3 + SMOOTHING * top[0]) / (9 + SMOOTHING), (6 + SMOOTHING * top[1]) / (9 + SMOOTHING)]
    assert got["a.x"] == pytest.approx([(2 + SMOOTHING * x[0]) / (8 + SMOOTHING), (6 + SMOOTHING * x[1]) / (8 + SMOOTHING)])
    assert got["b.x"] == pytest.approx([(1 + SMOOTHING * x[0]) / (1 + SMOOTHING), SMOOTHING * x[1] / (1 + SMOOTHING)])
    assert set(got) == {"a.x", "b.x", "c"} and [math.exp(p) for p in without] == pytest.approx(top)


def test_every_declared_code_is_a_language(spark):
    draw = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{i:02}": ["".join(draw.choices(letters, k=6)) for _ in range(30)] for i in range(70)}
    rows = []
    for i, (code, words) in enumerate(own.items()):
        for _ in range(8 if i < 64 else 4):
            rows.append((len(rows), " ".join(draw.choices(words, k=60)), code, "h"))
    rare = [r for r in rows if r[2] >= "l64"]
    undeclared = [(1000 + i, " ".join(draw.choices(own[f"l{64 + i}"], k=60)), None, None) for i in range(6)]
    docs = spark.createDataFrame([*rows, *undeclared], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in identify(docs).collect()}
    assert len(rare) == 24 and len(got) == len(rows) + 6
    assert all(got[i].language == got[i].text_language == code and got[i].accepted for i, _, code, _ in rows)
    assert [got[1000 + i].language for i in range(6)] == [f"l{64 + i}" for i in range(6)]


def test_pages(spark, small):
    from forecourt.llm.language_id import q_page_language

    rows = q_page_language(spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/pages.parquet").count()
    declared = [r for r in rows if r.declared]
    assert declared and sum(r.language == r.declared for r in declared) / len(declared) >= 0.9


def test_awkward_rows(spark, awkward, nothing):
    out = identify(awkward)
    rows = out.collect()
    assert out.columns == [*awkward.columns, "language", "probability", "text_language", "accepted"]
    assert len(rows) == awkward.count()
    assert not any(r.accepted for r in rows if not (r.text or "").strip())
    assert all(r.language for r in rows)
    assert identify(nothing).count() == 0
    undeclared = spark.createDataFrame([(1, "some text", None, "h")], "doc_id long, text string, lang string, source string")
    assert [(r.language, r.accepted) for r in identify(undeclared).collect()] == [(None, False)]
    assert identify(out).columns == out.columns


def test_variants_of_a_code_are_one_language(spark, docs):
    variant = F.when(F.col("doc_id") % 2 == 0, F.concat("lang", F.lit("-US"))).when(F.col("doc_id") % 3 == 0, F.upper("lang"))
    mixed = docs.withColumn("lang", F.coalesce(variant, "lang"))
    columns = ["doc_id", "language", "accepted", "probability"]
    plain, other = (sorted(map(tuple, identify(d, keep_text=False).select(columns).collect())) for d in (docs, mixed))
    assert plain == other
