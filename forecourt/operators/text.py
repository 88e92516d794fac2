"""Documents to elements and chunks; notes to topics and profile attributes.

Only column expressions: nothing leaves the JVM, and every pattern runs over the
whole text in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks put into the markup: where an element starts, and where its kind ends.
_START, _KIND = "\x1e", "\x1f"
# Text in these never shows.
_HIDDEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
_ELEMENT = r"(?i)<(title|h[1-6]|p)(?:\s[^>]*)?>"
# Any other block-level tag ends the element before it.
_BLOCK = (
    r"(?i)</?(?:title|h[1-6]|p|html|head|body|main|article|section|div|nav|aside|header|footer"
    r"|ul|ol|li|table|tr|td|th|form|blockquote|pre)(?:\s[^>]*)?>"
)
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def elements(html: str | Column) -> Column:
    """Titles, headings and paragraphs in document order, as array<struct<kind, text>>.

    An element reaches from its opening tag to the next block-level tag, so
    missing closing tags do no harm. Other tags are removed, common entities
    decoded, white space collapsed; empty elements are left out. Characters that
    serve as marks here are removed from the page first.
    """
    text = F.translate(html, _START + _KIND, "")
    text = F.regexp_replace(text, _HIDDEN, " ")
    text = F.regexp_replace(text, _ELEMENT, f"{_START}$1{_KIND}")
    text = F.regexp_replace(text, _BLOCK, _START)
    text = F.regexp_replace(text, r"<[^>]*>", "")
    for entity, plain in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(plain))
    pieces = F.filter(F.split(text, _START), lambda p: F.contains(p, F.lit(_KIND)))
    parsed = F.transform(
        pieces,
        lambda p: F.struct(
            F.lower(F.split_part(p, F.lit(_KIND), F.lit(1))).alias("kind"),
            F.trim(F.regexp_replace(F.split_part(p, F.lit(_KIND), F.lit(2)), r"[ \t\r\n]+", " ")).alias(
                "text"
            ),
        ),
    )
    return F.filter(parsed, lambda e: e["text"] != "")


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with their elements, the first title and the counts of headings and paragraphs.

    ``tree`` holds the elements as VARIANT, for callers that address them by path.
    """

    def kinds(pattern: str) -> Column:
        return F.size(F.filter("elements", lambda e: e["kind"].rlike(pattern)))

    return (
        pages.withColumn("elements", elements(html))
        .drop(html)
        .withColumns(
            {
                "title": F.try_element_at(
                    F.filter("elements", lambda e: e["kind"] == "title"), F.lit(1)
                )["text"],
                "n_headings": kinds("^h[1-6]$"),
                "n_paragraphs": kinds("^p$"),
                "tree": F.parse_json(F.to_json("elements")),
            }
        )
    )


def page_elements(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row per element: key, position from 0, kind, text."""
    parsed = pages.select(key, F.posexplode(elements(html)).alias("pos", "element"))
    return parsed.select(key, "pos", "element.kind", "element.text")


def chunk(
    df: DataFrame, key: str, text: str, size: int = 500, overlap: int = 100, keep: Sequence[str] = ()
) -> DataFrame:
    """Overlapping pieces of ``size`` characters: key, pos, chunk_id, chunk_to_embed, n_chars.

    Pieces start every ``size - overlap`` characters; a piece is left out if the
    one before already reaches the end of the text. The text is cut into steps
    by one pass of a pattern, and each piece joined from the steps it covers, so
    the work grows with the length of the text, not with its square.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap
    covered = -(-size // step)  # steps a piece touches
    steps = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    last = F.floor((F.greatest(F.length(text) - overlap, F.lit(1)) - 1) / step)
    pieces = F.transform(
        F.sequence(F.lit(0), last.cast("int")),
        lambda i: F.left(F.array_join(F.slice("_steps", i + 1, covered), ""), F.lit(size)),
    )
    return (
        df.filter(F.length(text) > 0)
        .select(key, *keep, text, steps.alias("_steps"))
        .select(key, *keep, F.posexplode(pieces).alias("pos", "chunk_to_embed"))
        .withColumn("chunk_id", F.concat_ws("-", F.col(key).cast("string"), "pos"))
        .withColumn("n_chars", F.length("chunk_to_embed"))
    )


def sections(pages: DataFrame, key: str, html: str = "html", separator: str = " > ") -> DataFrame:
    """One row per section of a page: key, section, level, heading, parent, path, n_paragraphs, body.

    A title (level 0) or heading (1 to 6) starts a section; its parent is the nearest section before it of a smaller
    level, and ``path`` the headings from the root down to its own. What stands before the first heading is section 0,
    without heading and parent, and there only if it has text. ``body`` holds the paragraphs directly below the heading, one per line.

    Of each level the last heading so far is carried along; it is on the path if it comes after those of all smaller
    levels. That takes one sort of a page's elements, however many there are; grouping needs no second shuffle.
    """
    found = page_elements(pages, key, html)
    level = F.when(F.col("kind") == "title", 0).when(F.col("kind") != "p", F.substring("kind", 2, 1).cast("int"))
    so_far = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("_level", level)
    found = found.withColumn("section", F.count("_level").over(so_far).cast("int"))
    own = F.struct("pos", F.col("section"), F.col("_level").alias("level"), F.col("text").alias("heading"))
    last = [F.last(F.when(F.col("_level") == k, own), ignorenulls=True).over(so_far).alias(f"_h{k}") for k in range(7)]
    found = found.select(key, "section", "pos", "text", "_level", *last)
    on_path = []
    for k in range(7):
        above = [F.coalesce(F.col(f"_h{j}.pos"), F.lit(-1)) for j in range(k)]
        newest = F.greatest(F.lit(-1), *above) if above else F.lit(-1)
        on_path.append(F.when(F.col(f"_h{k}.pos") > newest, F.col(f"_h{k}")))
    found = found.withColumn("_path", F.array_compact(F.array(*on_path)))
    texts = F.array_sort(F.collect_list(F.when(F.col("_level").isNull(), F.struct("pos", "text"))))
    grouped = found.groupBy(key, "section").agg(F.first("_path").alias("_path"), texts.alias("_texts"))
    here = F.try_element_at("_path", F.lit(-1))
    return grouped.select(
        key,
        "section",
        here["level"].alias("level"),
        here["heading"].alias("heading"),
        F.when(F.size("_path") > 1, F.get("_path", F.size("_path") - 2)["section"]).alias("parent"),
        F.array_join(F.col("_path.heading"), separator).alias("path"),
        F.size("_texts").alias("n_paragraphs"),
        F.array_join(F.col("_texts.text"), "\n").alias("body"),
    )


def section_chunks(
    pages: DataFrame, key: str, html: str = "html", size: int = 500, overlap: int = 100, separator: str = " > "
) -> DataFrame:
    """Chunks that end with their section: key, section, path, pos, chunk_id, chunk_to_embed, n_chars.

    ``chunk_to_embed`` is the piece below its heading path, ``n_chars`` the length of the piece alone.
    """
    parts = sections(pages, key, html, separator)
    named = parts.withColumn("_id", F.concat_ws("-", F.col(key).cast("string"), "section"))
    pieces = chunk(named, "_id", "body", size, overlap, keep=[key, "section", "path"])
    headed = F.when(F.col("path") == "", F.col("chunk_to_embed")).otherwise(F.concat_ws("\n", "path", "chunk_to_embed"))
    return pieces.withColumn("chunk_to_embed", headed).drop("_id")


def _quoted(word: str) -> str:
    return "\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def topic_scores(
    text: str | Column, labels: Mapping[str, Sequence[str]], whole_words: bool
) -> dict[str, Column]:
    """How often the keywords of each label occur, ignoring case."""
    before, after = (r"(?<!\p{L})", r"(?!\p{L})") if whole_words else ("", "")
    return {
        label: F.regexp_count(
            text, F.lit(f"(?iu){before}(?:{'|'.join(_quoted(w) for w in words)}){after}")
        )
        for label, words in labels.items()
    }


def classify(
    df: DataFrame,
    text: str,
    labels: Mapping[str, Sequence[str]],
    other: str = "other",
    whole_words: bool = True,
) -> DataFrame:
    """``df`` with ``topic``, the label whose keywords occur most, and ``topic_score``.

    Of equal labels the first listed wins; without any keyword the topic is ``other``.
    """
    scores = topic_scores(text, labels, whole_words)
    scored = df.withColumns({f"_score_{i}": score for i, score in enumerate(scores.values())})
    names = [f"_score_{i}" for i in range(len(scores))]
    best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    topic = F.when(best == 0, F.lit(other))
    for name, label in zip(names, scores):
        topic = topic.when(F.col(name) == best, F.lit(label))
    return scored.withColumns({"topic": topic, "topic_score": best}).drop(*names)


def extract_profile(
    notes: DataFrame, key: str, order: str, text: str, rules: Mapping[str, str]
) -> DataFrame:
    """One row per ``key`` with the latest value found for each attribute.

    A rule is a pattern whose first group is the value. A note without a match
    does not hide an earlier one; ``order`` must be unique within a key.
    """
    found = notes.select(
        key,
        order,
        *(
            F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).alias(name)
            for name, pattern in rules.items()
        ),
    )
    return found.groupBy(key).agg(
        *(F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name) for name in rules)
    )
