"""Document, note and retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from forecourt.operators import retrieval, silver, text
from forecourt.operators.vector_table import VectorTable
from forecourt.queries.registry import query, rounded
from forecourt.session import working_folder
from forecourt.sources.bindings import with_tables

_ELEMENTS_SQL = r"""pieces AS (
  SELECT page_id, list_filter(string_split(
    replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(translate(html, chr(30) || chr(31), ''),
        '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'),
        '(?i)<(title|h[1-6]|p)(?:\s[^>]*)?>', chr(30) || '\1' || chr(31), 'g'),
        '(?i)</?(?:title|h[1-6]|p|html|head|body|main|article|section|div|nav|aside|header|footer|ul|ol|li|table|tr|td|th|form|blockquote|pre)(?:\s[^>]*)?>', chr(30), 'g'),
        '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'),
    chr(30)), lambda p: contains(p, chr(31))) AS p FROM pages),
parsed AS (
  SELECT page_id, list_filter(list_transform(p, lambda e: {
    'kind': lower(split_part(e, chr(31), 1)),
    'text': trim(regexp_replace(split_part(e, chr(31), 2), '[ \t\r\n]+', ' ', 'g'))}),
    lambda e: e.text <> '') AS elements FROM pieces)"""


@query(
    "doc_elements",
    "WITH "
    + _ELEMENTS_SQL
    + """
SELECT page_id, CAST(i - 1 AS INT) AS pos, elements[i].kind AS kind, elements[i].text AS text
FROM parsed, unnest(range(1, len(elements) + 1)) AS r(i)""",
)
def doc_elements(spark, t):
    """Titles, headings and paragraphs of every page, in order."""
    return text.page_elements(t["pages"], "page_id")


@query(
    "doc_outline",
    "WITH "
    + _ELEMENTS_SQL
    + """
SELECT page_id, list_filter(elements, lambda e: e.kind = 'title')[1].text AS title,
  CAST(len(list_filter(elements, lambda e: regexp_matches(e.kind, '^h[1-6]$'))) AS INT) AS n_headings,
  CAST(len(list_filter(elements, lambda e: e.kind = 'p')) AS INT) AS n_paragraphs,
  elements[1].kind AS first_kind
FROM parsed""",
)
def doc_outline(spark, t):
    """Title and element counts per page, and a value read from the VARIANT tree by path."""
    return text.parse_pages(t["pages"]).select(
        "page_id",
        "title",
        "n_headings",
        "n_paragraphs",
        F.try_variant_get("tree", "$[0].kind", "string").alias("first_kind"),
    )


@query(
    "doc_chunks",
    """
SELECT doc_id, doc_id || '-' || i AS chunk_id, CAST(i AS INT) AS pos, lang,
  substring(text, CAST(i * 400 + 1 AS INT), 500) AS chunk_to_embed,
  CAST(length(substring(text, CAST(i * 400 + 1 AS INT), 500)) AS INT) AS n_chars
FROM documents, unnest(range(0, CAST(floor((greatest(length(text) - 100, 1) - 1) / 400) AS BIGINT) + 1)) AS r(i)
WHERE length(text) > 0""",
)
def doc_chunks(spark, t):
    """Every document in overlapping chunks of 500 characters."""
    return text.chunk(t["documents"], "doc_id", "text", 500, 100, keep=["lang"])


# The pages have a title and one heading; bold openings and short paragraphs are made headings below it.
_MARKED = (("<p><b>", "<h2>"), ("<p>([^<]{1,80})</p>", r"<h3>\1</h3>"))
_SECTIONS_SQL = (
    "WITH RECURSIVE marked AS (SELECT page_id, regexp_replace(replace(html, '<p><b>', '<h2>'), "
    + rf"'{_MARKED[1][0]}', '{_MARKED[1][1]}', 'g') AS html FROM pages),"
    + _ELEMENTS_SQL.replace("FROM pages)", "FROM marked)")
    + """,
element AS (
  SELECT page_id, i AS pos, elements[i].kind AS kind, elements[i].text AS text,
    CASE WHEN elements[i].kind = 'title' THEN 0 WHEN elements[i].kind <> 'p' THEN CAST(elements[i].kind[2] AS INT) END AS level
  FROM parsed, unnest(range(1, len(elements) + 1)) AS r(i)),
numbered AS (
  SELECT *, CAST(count(level) OVER (PARTITION BY page_id ORDER BY pos) AS INT) AS section FROM element),
head AS (
  SELECT h.page_id, h.pos, h.level, h.section, h.text, max(g.pos) AS above
  FROM numbered h LEFT JOIN numbered g ON g.page_id = h.page_id AND g.pos < h.pos AND g.level < h.level
  WHERE h.level IS NOT NULL GROUP BY ALL),
tree AS (
  SELECT page_id, pos, level, section, text, CAST(NULL AS INT) AS parent, text AS path FROM head WHERE above IS NULL
  UNION ALL
  SELECT h.page_id, h.pos, h.level, h.section, h.text, t.section, t.path || ' > ' || h.text
  FROM head h JOIN tree t ON t.page_id = h.page_id AND t.pos = h.above),
body AS (
  SELECT page_id, section, CAST(count(*) FILTER (level IS NULL) AS INT) AS n_paragraphs,
    coalesce(string_agg(text, chr(10) ORDER BY pos) FILTER (level IS NULL), '') AS body
  FROM numbered GROUP BY 1, 2),
sections AS (
  SELECT b.page_id, b.section, t.level, t.text AS heading, t.parent, coalesce(t.path, '') AS path, n_paragraphs, body
  FROM body b LEFT JOIN tree t ON t.page_id = b.page_id AND t.section = b.section)"""
)


def _marked(t):
    html = F.replace("html", F.lit(_MARKED[0][0]), F.lit(_MARKED[0][1]))
    return t["pages"].select("page_id", F.regexp_replace(html, _MARKED[1][0], "<h3>$1</h3>").alias("html"))


@query("doc_sections", _SECTIONS_SQL + "\nSELECT * FROM sections")
def doc_sections(spark, t):
    """The tree of sections of every page, with the headings above each."""
    return text.sections(_marked(t), "page_id")


@query(
    "section_chunks",
    _SECTIONS_SQL
    + """
SELECT page_id, section, path, CAST(i AS INT) AS pos, page_id || '-' || section || '-' || i AS chunk_id,
  CASE WHEN path = '' THEN '' ELSE path || chr(10) END || substring(body, CAST(i * 160 + 1 AS INT), 200) AS chunk_to_embed,
  CAST(length(substring(body, CAST(i * 160 + 1 AS INT), 200)) AS INT) AS n_chars
FROM sections, unnest(range(0, CAST(floor((greatest(length(body) - 40, 1) - 1) / 160) AS BIGINT) + 1)) AS r(i)
WHERE length(body) > 0""",
)
def section_chunks(spark, t):
    """Chunks of 200 characters that do not cross a section and carry its heading path."""
    return text.section_chunks(_marked(t), "page_id", size=200, overlap=40)


# Function words that occur in the notes; they tell the language, which stands for the topic.
NOTE_TOPICS = {
    "english": ("the", "of", "and", "with", "from"),
    "german": ("der", "die", "und", "von", "mit"),
    "french": ("le", "les", "et", "dans", "pour"),
    "spanish": ("el", "los", "y", "se", "por"),
}
_WORDS_SQL = "string_split_regex(lower(text), '[^\\p{L}]+')"
_SCORES_SQL = ", ".join(
    f"len(list_filter(w, lambda x: x IN ({', '.join(repr(k) for k in keys)}))) AS {label}"
    for label, keys in NOTE_TOPICS.items()
)


@query(
    "note_topics",
    with_tables("sl_notes")
    + f"""
SELECT note_id, turn, role, CAST(best AS INT) AS topic_score,
  CASE WHEN best = 0 THEN 'other' {" ".join(f"WHEN {k} = best THEN '{k}'" for k in NOTE_TOPICS)} END AS topic
FROM (SELECT *, greatest({", ".join(NOTE_TOPICS)}) AS best
  FROM (SELECT note_id, turn, role, {_SCORES_SQL}
    FROM (SELECT note_id, turn, role, {_WORDS_SQL} AS w FROM sl_notes)))""",
)
def note_topics(spark, t):
    """The topic of every note by keyword counts."""
    return text.classify(t["sl_notes"], "text", NOTE_TOPICS).drop("text")


@query(
    "silver_inquiries_enriched",
    with_tables("sl_notes", "sl_inquiries")
    + f""", scored AS (
  SELECT note_id, turn, best,
    CASE WHEN best = 0 THEN 'other' {" ".join(f"WHEN {k} = best THEN '{k}'" for k in NOTE_TOPICS)} END AS topic
  FROM (SELECT *, greatest({", ".join(NOTE_TOPICS)}) AS best
    FROM (SELECT note_id, turn, {_SCORES_SQL} FROM (SELECT note_id, turn, {_WORDS_SQL} AS w FROM sl_notes))))
SELECT i.*, t.topic, t.notes FROM sl_inquiries i LEFT JOIN (
  SELECT note_id, topic, notes FROM (SELECT *, count(*) OVER (PARTITION BY note_id) AS notes,
      row_number() OVER (PARTITION BY note_id ORDER BY best DESC, turn) AS place FROM scored)
  WHERE place = 1) t ON i.inquiry_id = t.note_id""",
)
def inquiries_enriched(spark, t):
    """Inquiries with the topic of their notes."""
    return silver.enrich_inquiries(
        t["sl_inquiries"], t["sl_notes"], "note_id", "turn", "text", NOTE_TOPICS
    )


NOTE_RULES = {
    "opening": r"^([A-Za-zÀ-ÿ]+)",
    "relation": r"[ \n](with|from|mit|von|avec|dans|con|para)[ ,.\n]",
    "last_word": r"([A-Za-zÀ-ÿ]+)[.]?\z",
}
_PROFILE_SQL = """profile AS (
  SELECT note_id, """ + ", ".join(
    f"max_by({name}, turn) FILTER (WHERE {name} IS NOT NULL) AS {name}" for name in NOTE_RULES
) + """
  FROM (SELECT note_id, turn, """ + ", ".join(
    f"nullif(regexp_extract(text, '{rule}', 1), '') AS {name}" for name, rule in NOTE_RULES.items()
) + """ FROM sl_notes) GROUP BY 1)"""


def _profile(t):
    return text.extract_profile(t["sl_notes"], "note_id", "turn", "text", NOTE_RULES)


@query(
    "note_profile",
    with_tables("sl_notes") + ", " + _PROFILE_SQL + "\nSELECT * FROM profile",
)
def note_profile(spark, t):
    """Attributes found in the notes, the latest of each."""
    return _profile(t)


@query(
    "silver_customers_enriched",
    with_tables("sl_notes", "sl_customers")
    + ", "
    + _PROFILE_SQL
    + """
SELECT c.customer_id, c.name, c.registered_store_id,
  coalesce(CASE WHEN c.customer_id % 3 <> 0 THEN c.area END, p.opening) AS area, c.segment, c.budget,
  c.phone, p.relation, p.last_word
FROM sl_customers c LEFT JOIN profile p ON c.customer_id = p.note_id""",
)
def customers_enriched(spark, t):
    """Customers with what the notes say; master values win, and every third customer has no area there."""
    profile = _profile(t).withColumnsRenamed({"note_id": "customer_id", "opening": "area"})
    gaps = F.when(F.col("customer_id") % 3 != 0, F.col("area"))
    return silver.enrich_customers(t["sl_customers"].withColumn("area", gaps), profile, "customer_id")


_TOPK_SQL = """hits AS (
  SELECT query_id, id, similarity, CAST(place AS INT) AS place FROM (
    SELECT query_id, id, similarity,
      row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS place
    FROM (SELECT q.vec_id AS query_id, c.vec_id AS id,
        round(list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6) AS similarity
      FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id))
  WHERE place <= 5)"""


def _hits(t, k=5):
    vectors = t["embeddings"]
    return retrieval.topk_similar(
        vectors, vectors, k, query_key="vec_id", key="vec_id", vector="embedding", skip_self=True
    )


@query("vector_topk", "WITH " + _TOPK_SQL + "\nSELECT * FROM hits")
def vector_topk(spark, t):
    """The five most similar vectors of every vector."""
    return _hits(t)


def _stored_hits(spark, t, k=5):
    """The same hits from a table stored by cluster, which skips clusters that hold none."""
    vectors = t["embeddings"]
    table = VectorTable.build(vectors, "vec_id", "embedding", working_folder(spark, "vectors"), block_bytes=1 << 20)
    asked = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return retrieval.placed(table.search(asked.filter("vector IS NOT NULL"), k, skip_self=True).hits, k)


@query("vector_topk_table", "WITH " + _TOPK_SQL + "\nSELECT * FROM hits")
def vector_topk_table(spark, t):
    """The five most similar vectors of every vector, from the table stored by cluster."""
    return _stored_hits(spark, t)


_HITS_SQL = (
    with_tables("sl_vehicles", "sl_contracts")
    + ", "
    + _TOPK_SQL
    + """
SELECT h.id, h.query_id, h.similarity, h.place, m.units, round(m.sales, 4) AS sales, m.status, m.listing_price
FROM hits h LEFT JOIN (
  SELECT v.vehicle_id, coalesce(c.units, 0) AS units, coalesce(c.sales, 0.0) AS sales, v.status, v.listing_price
  FROM sl_vehicles v LEFT JOIN (SELECT vehicle_id, count(*) AS units, sum(actual_price) AS sales
    FROM sl_contracts GROUP BY 1) c ON v.vehicle_id = c.vehicle_id) m ON h.id = m.vehicle_id"""
)


def _with_metrics(hits, t):
    sold = (
        t["sl_contracts"]
        .groupBy("vehicle_id")
        .agg(F.count(F.lit(1)).alias("units"), F.sum("actual_price").alias("sales"))
    )
    metrics = (
        t["sl_vehicles"]
        .select("vehicle_id", "status", "listing_price")
        .join(sold, "vehicle_id", "left")
        .na.fill(0, ["units", "sales"])
    )
    return rounded(retrieval.join_hits_to_metrics(hits, metrics, "vehicle_id"), {"sales": 4})


@query("hits_with_metrics", _HITS_SQL)
def hits_with_metrics(spark, t):
    """Search hits together with sales and stock of the vehicle they describe."""
    return _with_metrics(_hits(t), t)


@query("hits_with_metrics_table", _HITS_SQL)
def hits_with_metrics_table(spark, t):
    """The same from the table stored by cluster."""
    return _with_metrics(_stored_hits(spark, t), t)


_EMBED_SQL = """buckets AS (
  SELECT key, unnest(list_transform(regexp_extract_all(lower(body), '[\\p{L}\\p{N}]+'),
    lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 256)) AS bucket FROM texts),
weights AS (SELECT bucket, ln((n + 1) / (df + 1)) AS weight FROM (
  SELECT bucket, count(DISTINCT key) AS df FROM buckets WHERE starts_with(key, 'c') GROUP BY 1),
  (SELECT count(*) AS n FROM texts WHERE starts_with(key, 'c'))),
terms AS (SELECT key, bucket, count(*) * coalesce(any_value(weight), (SELECT ln(count(*) + 1) FROM texts WHERE starts_with(key, 'c'))) AS value
  FROM buckets LEFT JOIN weights USING (bucket) GROUP BY 1, 2),
units AS (SELECT key, bucket, value / sqrt(sum(value * value) OVER (PARTITION BY key)) AS value FROM terms)"""


@query(
    "chunk_topk",
    """
WITH chunks AS (
  SELECT doc_id || '-' || i AS chunk_id, substring(text, CAST(i * 400 + 1 AS INT), 500) AS body
  FROM documents, unnest(range(0, CAST(floor((greatest(length(text) - 100, 1) - 1) / 400) AS BIGINT) + 1)) AS r(i)
  WHERE length(text) > 0),
texts AS (SELECT 'c' || chunk_id AS key, body FROM chunks UNION ALL SELECT 'b' || item_id, text FROM benchmark),
"""
    + _EMBED_SQL
    + """
SELECT query_id, id, similarity, CAST(place AS INT) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS place FROM (
    SELECT b.item_id AS query_id, c.chunk_id AS id, round(coalesce(similarity, 0.0), 6) AS similarity
    FROM benchmark b CROSS JOIN chunks c LEFT JOIN (
      SELECT q.key AS query_key, u.key AS chunk_key, sum(q.value * u.value) AS similarity
      FROM units q JOIN units u USING (bucket) WHERE starts_with(q.key, 'b') AND starts_with(u.key, 'c') GROUP BY 1, 2)
    ON query_key = 'b' || b.item_id AND chunk_key = 'c' || c.chunk_id))
WHERE place <= 3""",
)
def chunk_topk(spark, t):
    """The three chunks nearest to each benchmark text, by hashed term weights.

    The chunks are stored with their hashed terms, then weighed and searched from there.
    """
    chunks = text.chunk(t["documents"], "doc_id", "text").select("chunk_id", "chunk_to_embed")
    stored = f"{working_folder(spark, 'chunks')}/chunks"
    retrieval.hashed_terms(chunks, "chunk_to_embed").drop("chunk_to_embed").write.parquet(stored)
    hashed = spark.read.parquet(stored)
    model = retrieval.fit_weights(hashed)
    return retrieval.topk_similar(
        retrieval.embed_hash(t["benchmark"], model, "text"),
        hashed,
        k=3,
        query_key="item_id",
        key="chunk_id",
        vector="terms",
        query_vector="embedding",
        terms=model,
    )


@query(
    "nearest_items",
    with_tables("sl_vehicles")
    + """
SELECT vehicle_id, model, body_type, mileage_km, listing_price,
  round(abs(listing_price - (SELECT listing_price FROM sl_vehicles WHERE vehicle_id = 42)), 4) AS distance
FROM sl_vehicles WHERE vehicle_id <> 42
ORDER BY abs(listing_price - (SELECT listing_price FROM sl_vehicles WHERE vehicle_id = 42)), vehicle_id LIMIT 10""",
)
def nearest_items(spark, t):
    """The ten vehicles nearest in price to one vehicle."""
    vehicles = t["sl_vehicles"].select("vehicle_id", "model", "body_type", "mileage_km", "listing_price")
    return rounded(retrieval.nearest(vehicles, "vehicle_id", 42, "listing_price", 10), {"distance": 4})
