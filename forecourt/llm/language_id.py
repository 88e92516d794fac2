"""Language identification by fusing evidence.

For each language, a row's score is the sum of
  * the log-likelihood of its text under the language's model of letter trigrams, tempered, since neighbouring
    trigrams are not independent;
  * the log-probability of the language that the row declares, given the true one: how often declarations agree with
    what the texts alone say, counted over all rows;
  * the log-prior of its host. Host priors are counts of declared languages by host, smoothed towards those of the
    host's address suffix, which are smoothed towards the whole: (n(host, l) + K * p(l | suffix)) / (n(host) + K).

Every code that some row declares is a language, told by its primary subtag in lower case, so that variants of one
language (``en``, ``en-US``) don't stand against each other. Models, agreement and priors come from grouped aggregation over all
rows. A text costs a table lookup per character; trigrams are hashed into a table of fixed size. Models are trained and
broadcast in blocks of languages, of which the driver and a task hold one at a time. Texts are not shuffled as long as
hosts and codes are few enough to be broadcast (checked); beyond that, rows are joined to their host's prior and
to their declaration, and Spark splits a hot one.

A row is accepted if its text has letters, some model explains them better than chance, and the fused probability
of the best language reaches a bound.

Defined results: a null or letterless text is rejected, with the language that the other evidence favours; null or unknown
declarations and hosts are no evidence; ties go to the language first in order; repeated rows are all judged; an empty
table gives an empty result; other columns pass through, those of the results' names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.common import broadcast_if_few, documents, drop_names, free_name, hold, written

BUCKETS = 1 << 16
BLOCK = 64  # languages whose models are held at a time
FEW = 1_280_000  # values that a table of arrays may have to be broadcast
TEMPER = 0.1
SMOOTHING = 20.0  # rows that a prior one level up weighs
ROWS = 1024  # texts that are scored together
SURE = 0.6  # fused probability that is enough

# Lower-case letters; all else that is ASCII becomes a blank.
_FOLD = bytes(c | 32 if c < 128 and chr(c).isalpha() else (c if c > 127 else 32) for c in range(256))


def folded_bytes(text: str | None) -> bytes:
    return b" " + b" ".join((text or "").encode().translate(_FOLD).split()) + b" "


def trigrams(text: str | None) -> np.ndarray:
    """Hash buckets of the letter trigrams of a text."""
    raw = np.frombuffer(folded_bytes(text), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.uint32)
    grams = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (grams * np.uint32(2654435761)) >> np.uint32(16)


def known_languages(labelled: DataFrame, declared: str) -> list[str]:
    """Every declared code, in alphabetical order."""
    return sorted(r[0] for r in labelled.select(declared).filter(F.col(declared).isNotNull()).distinct().collect())


def trigram_counts(labelled: DataFrame, text_col: str, declared: str, languages: list[str]) -> DataFrame:
    """How often each bucket occurs in the rows that declare a language: ``language`` (its number), ``bucket``, ``n``."""
    number = {l: i for i, l in enumerate(languages)}

    def rows(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, own in counts.items():
            bucket = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(bucket), i), pa.int32()), pa.array(bucket, pa.int32()), pa.array(own[bucket], pa.int64())],
                ["language", "bucket", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            waiting: dict[int, list[np.ndarray]] = {}

            def add(i: int) -> None:
                counts[i] += np.bincount(np.concatenate(waiting.pop(i)), minlength=BUCKETS)

            for text, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (i := number.get(language)) is not None:
                    if i not in counts:
                        if len(counts) >= BLOCK:  # hand on what is counted rather than hold more languages
                            for j in [*waiting]:
                                add(j)
                            yield from rows(counts)
                            counts = {}
                        counts[i] = np.zeros(BUCKETS, np.int64)
                    waiting.setdefault(i, []).append(trigrams(text))
                    if len(waiting[i]) >= 256:
                        add(i)
            for j in [*waiting]:
                add(j)
        yield from rows(counts)

    counted = labelled.select(F.col(f"`{text_col}`"), F.col(declared)).mapInArrow(count, "language int, bucket int, n long")
    return counted.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def _model(counted: DataFrame, first: int, width: int) -> np.ndarray:
    """Log-probabilities of buckets, a column per language of a block."""
    counts = np.full((BUCKETS, width), 0.5)
    found = counted.filter(F.col("language").between(first, first + width - 1)).toPandas()  # at most width * buckets rows
    counts[found["bucket"], found["language"] - first] += found["n"]
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def train(labelled: DataFrame, text_col: str, declared: str, languages: list[str]) -> np.ndarray:
    """Log-probabilities of buckets, a column per language, from all rows that declare one of them."""
    return _model(trigram_counts(labelled, text_col, declared, languages), 0, len(languages))


def train_blocks(labelled: DataFrame, text_col: str, declared: str, languages: list[str]) -> list[Broadcast]:
    """``train``, broadcast in blocks of languages."""
    share = labelled.sparkSession.sparkContext.broadcast
    counted = trigram_counts(labelled, text_col, declared, languages)
    if len(languages) > BLOCK:
        counted = written(counted, "trigrams")
    return [share(_model(counted, i, min(BLOCK, len(languages) - i))) for i in range(0, len(languages), BLOCK)]


def text_scores(
    docs: DataFrame, text_col: str, out_col: str, model: np.ndarray | list[Broadcast], keep_text: bool = True
) -> DataFrame:
    """``docs`` with the log-likelihood of the text per language, and last the number of trigrams; an array."""
    tables = model if isinstance(model, list) else [docs.sparkSession.sparkContext.broadcast(model)]
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    schema = T.StructType([*(docs.schema.fields[i] for i in kept), T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("language", lambda: None)  # what other stages remember in this worker goes
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, len(whole), ROWS)):
                grams = [trigrams(text) for text in batch.column(at).to_pylist()]
                parts = []
                for table in tables:
                    logs = table.value
                    parts.append(np.stack([logs[own].sum(axis=0, dtype=np.float64) for own in grams]))
                    if len(tables) > 1:
                        vars(table).pop("_value", None)  # read again when it is needed: one block at a time
                scores = np.hstack([*parts, np.array([[float(len(own))] for own in grams])])
                ends = pa.array(np.arange(len(grams) + 1) * scores.shape[1], pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(scores.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), lists], schema.names)

    return docs.mapInArrow(score, schema)


def host_priors(rows: DataFrame, host: str, suffix: str, declared: str, languages: list[str]) -> tuple[DataFrame, list[float]]:
    """``host``, ``prior`` (log-probability per language), and the logs for rows without a host."""
    known = rows.filter(F.col(declared).isin(languages)).groupBy(
        F.col(host).alias("host"), F.col(suffix).alias("own"), F.col(declared).alias("said")
    ).agg(F.count("*").cast("double").alias("n"))
    whole = dict(known.groupBy("said").agg(F.sum("n")).collect())
    total = sum(whole.values())
    top = [(whole.get(l, 0.0) + 1.0) / (total + len(languages)) for l in languages]

    def counts(grouped: DataFrame, *by: str) -> DataFrame:
        """``size`` and ``counts`` by code, of the codes that occur."""
        own = grouped.groupBy(*by, "said").agg(F.sum("n").alias("n")).groupBy(*by)
        return own.agg(F.sum("n").alias("size"), F.map_from_entries(F.collect_list(F.struct("said", "n"))).alias("counts"))

    def smoothed(above: Column, log: bool = False) -> Column:
        def share(p: Column, l: Column) -> Column:
            value = (F.coalesce(F.try_element_at("counts", l), F.lit(0.0)) + SMOOTHING * p) / (F.col("size") + SMOOTHING)
            return F.log(value) if log else value

        return F.zip_with(above, constant(languages), share)

    per_suffix = counts(known, "own").select(F.col("own").alias("s"), smoothed(constant(top)).alias("p"))
    joined = counts(known.filter("host IS NOT NULL"), "host", "own").join(per_suffix, F.col("own").eqNullSafe(F.col("s")))
    return joined.select("host", smoothed(F.col("p"), log=True).alias("prior")), [float(np.log(p)) for p in top]


def agreement(scores: DataFrame, score_col: str, declared: str, languages: list[str]) -> DataFrame:
    """``declared`` and ``agreed``: its log-probability given each true one, as far as texts alone tell."""
    k = len(languages)
    by_text = F.slice(score_col, 1, k)
    told = scores.filter(F.get(F.col(score_col), F.lit(k)) > 0).select(
        (F.array_position(by_text, F.array_max(by_text)) - 1).cast("int").alias("true"), F.col(declared).alias("declared")
    )
    found = told.filter(F.col("declared").isNotNull()).groupBy("true", "declared").count()
    # At most k * k rows, of which only those that occur are collected.
    number = {l: i for i, l in enumerate(languages)}
    sizes, counts = np.full(k, float(k)), {}
    for true, said, n in found.collect():
        sizes[true] += n
        counts.setdefault(number[said], []).append((true, n + 1.0))

    def logs(i: int) -> list[float]:
        own = np.ones(k)
        for true, n in counts.get(i, []):
            own[true] = n
        return np.log(own / sizes).tolist()

    return scores.sparkSession.createDataFrame(((l, logs(i)) for i, l in enumerate(languages)), "declared string, agreed array<double>")


def primary_code(code: Column) -> Column:
    """The language of a declared code, however it is written: ``en`` of ``en-US``, ``EN`` and ``en_Latn_GB``."""
    return F.nullif(F.regexp_extract(F.lower(code), r"^\s*([^\s_-]+)", 1), F.lit(""))


def constant(values: list) -> Column:
    return F.array(*map(F.lit, values))


def identify(
    docs: DataFrame,
    text_col: str = "text",
    declared: str | None = "lang",
    host: str | None = "source",
    suffix: str | None = None,
    sure: float = SURE,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``language``, its fused ``probability``, the language by ``text_language`` alone, and ``accepted``.

    ``declared``, ``host`` and ``suffix`` name columns; the suffix defaults to what follows the host's last stop.
    """
    docs = drop_names(docs, "language", "probability", "text_language", "accepted")
    names = docs.columns
    said, at_host, at_suffix, score, prior, of_host, agreed, of_code = (
        free_name(names, n) for n in ("said", "at_host", "at_suffix", "score", "prior", "of_host", "agreed", "of_code")
    )
    nothing = F.lit(None).cast("string")
    rows = docs.withColumn(said, primary_code(F.col(f"`{declared}`").cast("string")) if declared else nothing)
    rows = rows.withColumn(at_host, F.col(f"`{host}`").cast("string") if host else nothing)
    last = F.nullif(F.regexp_extract(F.col(at_host), r"\.([^.]+)$", 1), F.lit(""))
    rows = rows.withColumn(at_suffix, F.col(f"`{suffix}`").cast("string") if suffix else last)

    languages = known_languages(rows, said)
    if not languages:
        out = rows.withColumns(
            {"language": nothing, "probability": F.lit(None).cast("double"), "text_language": nothing, "accepted": F.lit(False)}
        ).drop(said, at_host, at_suffix)
        return out if keep_text else out.drop(text_col)
    k = len(languages)
    model = train_blocks(rows, text_col, said, languages)
    codes = agreement(text_scores(rows.select(F.col(f"`{text_col}`"), said), text_col, score, model, keep_text=False), score, said, languages)
    priors, without = host_priors(rows, at_host, at_suffix, said, languages)

    scored = text_scores(rows, text_col, score, model, keep_text)
    few = min(20_000, FEW // k)
    priors = broadcast_if_few(priors.select(F.col("host").alias(of_host), F.col("prior").alias(prior)), few)
    codes = broadcast_if_few(codes.select(F.col("declared").alias(of_code), F.col("agreed").alias(agreed)), few)
    joined = scored.join(priors, F.col(at_host) == F.col(of_host), "left").drop(of_host)
    joined = joined.join(codes, F.col(said) == F.col(of_code), "left").drop(of_code)

    declaration = F.coalesce(F.col(agreed), F.array_repeat(F.lit(0.0), k))
    likelihood = F.slice(score, 1, k)
    parts = F.zip_with(
        F.zip_with(likelihood, F.coalesce(F.col(prior), constant(without)), lambda x, y: x * TEMPER + y), declaration, lambda x, y: x + y
    )
    fused, n = free_name(names, "fused"), F.get(F.col(score), F.lit(k))
    joined = joined.withColumn(fused, parts)
    best = F.array_max(fused)
    every = constant(languages)

    def winner(values: Column | str) -> Column:
        return F.get(every, (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    probability = 1 / F.aggregate(fused, F.lit(0.0), lambda s, x: s + F.exp(x - best))
    explained = F.array_max(likelihood) > n * float(np.log(1.0 / BUCKETS))
    out = joined.withColumns(
        {
            "language": winner(F.col(fused)),
            "probability": F.round(probability, 6),
            "text_language": F.when(n > 0, winner(likelihood)),
        }
    )
    out = out.withColumn("accepted", (n > 0) & explained & (F.col("probability") >= sure))
    return out.drop(said, at_host, at_suffix, score, prior, agreed, fused)


def q_language_id(spark, sf_dir):
    """The language of every document from text, declaration and source, and whether it is accepted."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return identify(docs, keep_text=False).select("doc_id", F.col("lang").alias("declared"), "language", "text_language", "probability", "accepted")


def q_page_language(spark, sf_dir):
    """The language of every web page from its text, the language its markup declares, its host and address suffix."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<[^>]*>|&[a-z]+;", " ")
    shaped = pages.select(
        "page_id",
        bare.alias("text"),
        F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([a-z]{2,3})", 1)), F.lit("")).alias("declared"),
        F.lower(F.expr("try_parse_url(url, 'HOST')")).alias("host"),
    )
    return identify(shaped, declared="declared", host="host", keep_text=False).drop("host")
