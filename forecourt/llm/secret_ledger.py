"""Secrets in documents, by an incremental ledger of scanned contents.

Every version of every document is addressed by the SHA-256 of its text. The ledger has a row for each pair of content and
rule version that was scanned, with what was found. A run scans only contents that the ledger lacks for the
current rules, once each however many documents share them, appends the results, and joins findings back to all
paths (the rows of ``documents``). A second run over the same contents scans nothing; a new rule version scans anew.

Equal contents are first reduced to one per task and then shuffled by address, so a text that a third of all rows
share crosses the network once per task. What joins back are addresses and findings, not texts; Spark splits the hot
address there, as every path is one small row. All expressions are Spark's own.

Defined results: a null text is empty (address of the empty text); repeated rows are paths of one content and each
get its findings; rows without an id keep a null id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import documents, drop_names, shared_folder, text_or_empty
from forecourt.llm.spans import SPANS, found_spans

RULES = "2"  # to be raised whenever a rule below changes
BASE = ("assign", "access", "hex")
EXTRA = ("pem", "jwt", "prefixed")

_ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
# Token formats as their issuers publish them.
_EXTRA_PATTERNS = {
    "pem": r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "prefixed": r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{20,}+|sk_live_[A-Za-z0-9]{24,}+)",
}


def findings(text: Column) -> dict[str, Column]:
    """Spans per kind: the base kinds, then those that this method adds."""
    spans = {
        "assign": found_spans(
            text,
            _ASSIGN,
            text.rlike(_ASSIGN),
            lambda v: F.length(F.regexp_extract(v, _ASSIGN, 1)) >= 8,
        ),
        "access": found_spans(text, r"AKIA[A-Z0-9]++", text.contains("AKIA"), lambda v: F.length(v) >= 16),
        "hex": found_spans(text, r"(?<![0-9a-f])[0-9a-f]{32,}+", text.rlike("[0-9a-f]{32}")),
    }
    gates = {"pem": text.contains("PRIVATE KEY"), "jwt": text.contains("eyJ"), "prefixed": text.rlike("gh[pousr]_|xox|sk_live_")}
    for kind in EXTRA:
        spans[kind] = found_spans(text, _EXTRA_PATTERNS[kind], gates[kind])
    return spans


def ledger_schema() -> str:
    return "blob binary, rules string, " + ", ".join(f"`{k}` {SPANS}" for k in (*BASE, *EXTRA))


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    if path is None:
        return spark.createDataFrame([], ledger_schema())
    return spark.read.schema(ledger_schema()).parquet(path)


def address(text_col: str = "text") -> Column:
    return F.unhex(F.sha2(text_or_empty(text_col), 256))


def unseen(versions: DataFrame, ledger: DataFrame, rules: str = RULES, text_col: str = "text") -> DataFrame:
    """One row, ``blob`` and ``text``, for each content that the ledger lacks under these rules."""
    blobs = versions.select(address(text_col).alias("blob"), text_or_empty(text_col).alias("text"))
    seen = ledger.filter(F.col("rules") == rules).select("blob").distinct()
    return blobs.groupBy("blob").agg(F.first("text").alias("text")).join(seen, "blob", "left_anti")


def scan(contents: DataFrame, rules: str = RULES) -> DataFrame:
    """Ledger rows for contents."""
    spans = findings(F.col("text"))
    return contents.select("blob", F.lit(rules).alias("rules"), *(spans[k].alias(k) for k in (*BASE, *EXTRA)))


def update(versions: DataFrame, path: str, rules: str = RULES, text_col: str = "text", fresh: bool = False) -> DataFrame:
    """Scans what the ledger at ``path`` lacks, appends it there and returns the ledger. ``fresh``: there is none yet."""
    spark = versions.sparkSession
    new = scan(unseen(versions, read_ledger(spark, None if fresh else path), rules, text_col), rules)
    # A failed run leaves no part of its rows: the committer moves them in only when all tasks are done.
    new.write.mode("append").parquet(path)
    return read_ledger(spark, path)


def join_paths(versions: DataFrame, ledger: DataFrame, rules: str = RULES, text_col: str = "text") -> DataFrame:
    """Every row of ``versions`` (without its text) with its address, ``blob``, and the findings in its content.

    Columns of ``versions`` that are called like these are replaced.
    """
    versions = versions.withColumn(text_col, address(text_col))
    versions = drop_names(versions, *({"blob", *BASE, *EXTRA} - {text_col}))
    paths = versions.select(
        *(F.col(f"`{c}`") for c in versions.columns if c != text_col), F.col(f"`{text_col}`").alias("blob")
    )
    current = ledger.filter(F.col("rules") == rules).drop("rules").dropDuplicates(["blob"])
    return paths.join(current, "blob", "left")


def q_secret_scan(spark, sf_dir):
    """Secrets in every document, found through a ledger that begins empty."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ledger = update(docs, shared_folder(spark, "ledger"), fresh=True)
    kinds = (*BASE, *EXTRA)
    found = join_paths(docs, ledger).select(
        "doc_id", *(F.coalesce(F.col(k), F.array().cast(SPANS)).alias(k) for k in kinds)
    )

    def entries(kind: str, place: int) -> Column:
        def entry(s: Column) -> Column:
            shown = F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
            return F.struct(s["start"].alias("at"), F.lit(place).alias("place"), shown.alias("shown"))

        return F.transform(kind, entry)

    def joined(names: tuple[str, ...]) -> Column:
        # by start, then kind as listed
        found_entries = F.concat(*(entries(kind, place) for place, kind in enumerate(names)))
        return F.concat_ws(",", F.transform(F.array_sort(found_entries), lambda e: e["shown"]))

    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(joined(BASE), 256).alias("base_sha256"),
        joined(kinds).alias("spans"),
    )
