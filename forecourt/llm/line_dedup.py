"""Line dedup over overlapping windows of three lines.

A line is what stands between line feeds; lines that hold only spaces, tabs and carriage returns are not counted.
Every three consecutive counted lines form a window, and windows overlap. Windows are compared by 128 bits of hash
over their trimmed lines. In order of (document, position) the first occurrence of a window stays; every later
one is covered, from its first to its third line, and the union of the covered positions is cut out.

Only hashes and positions are shuffled to find repeats. The counts are combined in each task before the shuffle, so
that a window which occurs in a third of all documents arrives as one row per task; the join back to occurrences
is left to Spark's splitting of skewed partitions. Texts move once, to meet the positions to cut.

Defined results: a null text is empty and stays null; a document with fewer than three counted lines is never
changed; rows alike in id and text are one document written twice and are cut alike, so that a repeated row does
not count as a later occurrence; rows with one id and different texts are ordered by the hash of the text; rows
without an id come first in order. Other columns pass through; existing ``n_lines`` and ``n_removed`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import drop_names, free_name, text_key, text_or_empty

WINDOW = 3
BLANK = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _counted(lines: Column) -> Column:
    """Structs of position and trimmed line, without blank lines."""
    trimmed = F.transform(
        lines, lambda line, i: F.struct(i.cast("int").alias("i"), F.trim(line, F.lit(BLANK)).alias("line"))
    )
    return F.filter(trimmed, lambda x: x["line"] != "")


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per window: ``doc`` (id and hash of the text), ``first`` and ``last`` line, hashes ``h1`` and ``h2``."""

    def window(counted: Column, j: Column) -> Column:
        items = [F.get(counted, j + k) for k in range(size)]
        texts = [x["line"] for x in items]
        return F.struct(
            items[0]["i"].alias("first"),
            items[-1]["i"].alias("last"),
            F.xxhash64(*texts).alias("h1"),
            F.xxhash64(F.lit(1), *texts).alias("h2"),
        )

    counted = docs.select(
        F.struct(F.col(f"`{id_col}`").alias("id"), text_key(text_col).alias("key")).alias("doc"),
        _counted(_lines(text_or_empty(text_col))).alias("counted"),
    ).filter(F.size("counted") >= size)
    starts = F.sequence(F.lit(0), F.size("counted") - size)
    # explode(transform(...)) keeps the lines in one array per document; only positions and hashes are multiplied.
    return counted.select("doc", F.explode(F.transform(starts, lambda j: window(F.col("counted"), j))).alias("w")).select(
        "doc", "w.*"
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` with later occurrences cut from the text, and ``n_lines`` (before) and ``n_removed`` (lines cut)."""
    windows = line_windows(docs, id_col, text_col, size)
    at = F.struct("doc", "first")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(at).alias("kept"), F.max(at).alias("latest"))
        .filter(F.col("kept") < F.col("latest"))
        .select("h1", "h2", "kept")
    )
    later = windows.join(repeated, ["h1", "h2"]).filter(F.col("kept") < at)
    docs = drop_names(docs, "n_lines", "n_removed")
    key, lines, cut, c_id, c_key, c_spans = (
        free_name(docs.columns, n) for n in ("key", "lines", "cut", "c_id", "c_key", "c_spans")
    )
    covered = later.groupBy(F.col("doc.id").alias(c_id), F.col("doc.key").alias(c_key)).agg(
        F.collect_set(F.struct("first", "last")).alias(c_spans)
    )
    names = [F.col(f"`{c}`") for c in docs.columns]
    joined = docs.withColumn(key, text_key(text_col)).join(
        covered, F.col(f"`{id_col}`").eqNullSafe(F.col(c_id)) & (F.col(key) == F.col(c_key)), "left"
    )
    positions = F.array_distinct(F.flatten(F.transform(c_spans, lambda s: F.sequence(s["first"], s["last"]))))
    shaped = joined.select(
        *names, _lines(text_or_empty(text_col)).alias(lines), F.coalesce(positions, F.array().cast("array<int>")).alias(cut)
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(cut))
    text = F.when(
        F.size(cut) > 0, F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    ).otherwise(F.col(f"`{text_col}`"))
    return shaped.select(
        *(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(cut).cast("long").alias("n_removed"),
    )


def q_line_dedup(spark, sf_dir):
    """Every document with the lines left, how many it had and how many were cut."""
    from forecourt.llm.common import documents

    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), counted AS (
  SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(13)) AS l FROM lines
  WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
), windows AS (
  SELECT doc_id, i AS first, lead(i, 2) OVER d AS last, l AS l1, lead(l) OVER d AS l2, lead(l, 2) OVER d AS l3
  FROM counted WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), later AS (
  SELECT doc_id, first, last FROM (
    SELECT *, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, first) AS nth
    FROM windows WHERE last IS NOT NULL
  ) WHERE nth > 1
), cut AS (
  SELECT DISTINCT doc_id, unnest(generate_series(first, last)) AS i FROM later
), marked AS (
  SELECT lines.*, cut.i IS NOT NULL AS gone FROM lines LEFT JOIN cut USING (doc_id, i)
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM marked GROUP BY doc_id
"""
