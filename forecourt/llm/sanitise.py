"""Personal data and the terms that give it away.

Base spans (e-mail, IP address, card, phone) are found by pattern and check. Each distinct value is a protected entity.
What else reveals an entity is estimated from the corpus: with N documents, n(e) of them holding the entity, n(t)
holding a term and n(e, t) holding the term within a few words of the entity, the pointwise mutual information

    log(N * n(e, t) / (n(e) * n(t)))   of at most   log(N / n(e)),

reached when the term never occurs without the entity. Their ratio is the term's disclosure. Terms of at least
``threshold`` are generalised to their first letters if those stay below it for every entity, and removed if not. A
term counts only if it stands beside the entity in at least ``support`` documents with different surroundings, so that
copies of one passage prove nothing; and it is then treated wherever it occurs, also in documents without the entity.

All counts cover all documents. What is shuffled to count are terms already combined per task; a hot entity or term is
one row per task. Terms found are looked for through a bitmap of fixed size before anything of a document is
shuffled; whatever passes is joined exactly. All expressions are Spark's own.

Defined results: a null text is empty; an entity in every document reveals nothing (disclosure 0); repeated rows count as
often as they occur and are all treated alike; other columns pass through, those of the results' names are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import bitmap_test, documents, drop_names, free_name, in_bitmap, text_key, text_or_empty, written
from forecourt.llm.spans import folded, found_spans, let, listed

BASE = ("email", "ip", "card", "phone")
TERM = "term"
REACH = 80  # code points beside an entity in which terms count as its surroundings
THRESHOLD = 0.95
SUPPORT = 2
STEM = 3  # letters that a generalised term keeps

_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})?"
_WORD = r"\p{L}{3,}+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """13 to 19 digits whose check digit is right."""

    def weighed(digit: Column, i: Column) -> Column:
        d = digit.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    def passes(digits: Column) -> Column:
        total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), weighed), F.lit(0), lambda s, d: s + d)
        return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(F.lit(False))

    return let(_digits(value), passes)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind."""
    return {
        "email": found_spans(text, _EMAIL, text.contains("@")),
        "ip": found_spans(text, _IP, text.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        "card": found_spans(text, _CARD, text.rlike("[0-9](?:[ -]?[0-9]){12}"), _luhn),
        "phone": found_spans(text, _PHONE, text.contains("+"), lambda v: F.length(_digits(v)).between(9, 15)),
    }


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _stem(term: Column) -> Column:
    return F.concat(F.left(term, F.lit(STEM)), F.lit("*"))


def _with_stems(words: Column) -> Column:
    """Distinct words and their generalised forms."""
    return let(F.array_distinct(words), lambda w: F.concat(w, F.array_distinct(F.transform(w, _stem))))


def _surroundings(text: Column, span: Column) -> Column:
    """Whole words beside a span."""
    before = F.substring(text, F.greatest(span["start"] - REACH, F.lit(0)).cast("int") + 1, F.least(span["start"], F.lit(REACH)).cast("int"))
    after = F.substring(text, span["end"].cast("int") + 1, F.lit(REACH))
    before = F.when(span["start"] > REACH, F.regexp_replace(before, r"^\S+", "")).otherwise(before)
    after = F.when(F.length(text) > span["end"] + REACH, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
    return F.concat(before, F.lit(" \n "), after)


def term_disclosure(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """Terms whose disclosure reaches the threshold: ``term``, ``disclosure`` (of the entity it reveals most) and
    ``general``, the form to put in its place, or null to remove it."""
    texts = docs.select(text_or_empty(text_col).alias("text"))
    everything = _with_base(texts, "text")
    entities = everything.filter(F.size("email") + F.size("ip") + F.size("card") + F.size("phone") > 0)

    def of_kind(kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")),
        )

    spans = F.concat(*map(of_kind, BASE))
    beside = entities.select(
        F.xxhash64("text").alias("doc"),
        F.transform(
            spans,
            lambda s: F.struct(F.concat(s["kind"], F.lit(":"), F.lower(s["value"])).alias("entity"), _surroundings(F.col("text"), s).alias("around")),
        ).alias("beside"),
    )

    def terms_beside(key: Callable[[Column, Column], list[Column]]) -> Column:
        # Keys are strings, which Spark tells apart by hashing; an entity holds no line feed.
        own = F.transform("beside", lambda x: F.transform(_with_stems(_words(x["around"])), lambda t: F.concat_ws("\n", *key(x, t))))
        return F.explode(F.array_distinct(F.flatten(own))).alias("p")

    def part(i: int, name: str) -> Column:
        return F.split("p", "\n")[i].alias(name)

    holding = beside.select(F.explode(F.array_distinct(F.col("beside.entity"))).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = beside.select(terms_beside(lambda x, t: [x["entity"], t])).select(part(0, "entity"), part(1, "term"))
    counted = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_joint"))
    # One place per document: neither copies of a passage nor a document that repeats itself prove anything.
    placed = beside.select("doc", terms_beside(lambda x, t: [x["entity"], t, F.md5(F.lower(x["around"]))]))
    places = (
        placed.select("doc", part(0, "entity"), part(1, "term"), part(2, "around"))
        .groupBy("entity", "term", "doc")
        .agg(F.min("around").alias("around"))
        .groupBy("entity", "term")
        .agg(F.count_distinct("around").alias("places"))
        .filter(F.col("places") >= support)
    )
    joint = counted.join(places, ["entity", "term"])

    having = (
        texts.select(F.explode(_with_stems(_words(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    )
    n = F.lit(float(texts.count()))
    n_e, n_t, n_et = (F.col(c).cast("double") for c in ("n_entity", "n_term", "n_joint"))
    # A term cut at the edge of its surroundings is none, yet two texts can differ in what a word is there.
    n_et = F.least(n_et, n_t)
    disclosure = F.when(n_e >= n, F.lit(0.0)).otherwise(F.log(n * n_et / (n_e * n_t)) / F.log(n / n_e))
    scored = (
        joint.join(holding, "entity")
        .join(having, "term")
        .groupBy("term")
        .agg(F.max(disclosure).alias("disclosure"))
        .filter(F.col("disclosure") >= threshold)
    )
    general = scored.filter(F.col("term").endswith("*")).select(F.col("term").alias("stem"), F.lit(True).alias("reveals"))
    terms = scored.filter(~F.col("term").endswith("*")).withColumn("stem", _stem(F.col("term")))
    return terms.join(general, "stem", "left").select(
        "term", "disclosure", F.when(F.col("reveals").isNull(), F.col("stem")).alias("general")
    )


def _with_base(docs: DataFrame, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.withColumns(base_spans(text))


def find_terms(docs: DataFrame, terms: DataFrame, text_col: str = "text", out_col: str = "term_spans") -> DataFrame:
    """``docs`` with the spans of the terms in each text, and what to put there (``general``, null for nothing)."""
    docs = drop_names(docs, out_col)
    shape = "array<struct<start: bigint, end: bigint, value: string, general: string>>"
    bitmap = bitmap_test(terms.select(F.xxhash64("term").alias("h")), "h")
    if bitmap is None:
        return docs.withColumn(out_col, F.array().cast(shape))
    keyed = docs.select(text_key(text_col).alias("key"), text_or_empty(text_col).alias("text"))

    candidates = keyed.select("key", F.explode(F.filter(F.array_distinct(_words(F.col("text"))), lambda w: in_bitmap(bitmap, F.xxhash64(w)))).alias("term"))
    key, t_key, t_terms = (free_name(docs.columns, n) for n in ("key", "t_key", "t_terms"))
    per_text = (
        candidates.distinct()
        .join(terms.select("term", "general"), "term")
        .groupBy(F.col("key").alias(t_key))
        .agg(F.collect_list(F.struct("term", "general")).alias(t_terms))
    )
    joined = docs.withColumn(key, text_key(text_col)).join(per_text, F.col(key) == F.col(t_key), "left")
    names = F.col(f"{t_terms}.term")

    def spans(text: Column) -> Column:
        values = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
        items = let(
            F.split(text, _WORD, -1),
            lambda g: F.transform(values, lambda v, i: F.struct(F.get(g, i).alias("gap"), v.alias("value"))),
        )
        return folded(items, lambda v: F.array_contains(names, F.lower(v)))

    general = F.map_from_entries(t_terms)
    found = F.transform(
        spans(text_or_empty(text_col)),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.element_at(general, F.lower(s["value"])).alias("general")),
    )
    return joined.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.when(F.col(t_terms).isNotNull(), found).otherwise(F.array()).cast(shape).alias(out_col),
    )


def sanitise(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``docs`` with spans per base kind, ``term_spans`` and the ``sanitised`` text: entities become their kind's
    name, terms their general form or nothing."""
    found = _with_base(drop_names(docs, *BASE, "term_spans", "sanitised"), text_col)
    terms = written(term_disclosure(docs, text_col, threshold, support), "terms")
    found = find_terms(found, terms, text_col)

    def replaced(kind: str) -> Column:
        name = F.lit(f"[{kind.upper()}]").alias("put")
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), name))

    base = F.concat(*map(replaced, BASE))
    free = F.filter("term_spans", lambda t: ~F.exists(base, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    found = found.withColumn("term_spans", free)
    every = F.array_sort(
        F.concat(base, F.transform("term_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.coalesce(s["general"], F.lit("")).alias("put"))))
    )
    text = text_or_empty(text_col)

    def put(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        more = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, s["put"]).alias("out"))
        return F.when(s["start"] >= acc["at"], more).otherwise(acc)

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    rebuilt = F.aggregate(every, start, put, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, F.length(text))))
    return found.withColumn("sanitised", F.when(F.size(every) > 0, rebuilt).otherwise(F.col(f"`{text_col}`")))


def q_personal_data(spark, sf_dir):
    """Personal data in every document, and the terms that reveal it."""
    found = sanitise(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.concat(*(listed(F.col(k), k) for k in BASE))
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
        F.concat_ws(",", F.concat(base, listed(F.col("term_spans"), TERM))).alias("spans"),
        F.size("term_spans").cast("long").alias("n_term"),
    )
