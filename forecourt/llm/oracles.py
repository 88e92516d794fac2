"""Plain SQL (DuckDB) that must give the same rows as the registered queries, where SQL can express them.

Written from the contracts of the queries, not from the operators: sets of shingles are joined pair by pair, spans are
found by the base patterns as they are stated.
"""

from __future__ import annotations

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_UPPER}), '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reached r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id"""


def _spans(kind: str, place: int, pattern: str, keep: str, table: str = "documents") -> str:
    """Rows doc_id, place, kind, a, b, v of a pattern's matches that meet ``keep``, a condition on ``v``."""
    pattern = pattern.replace("'", "''")
    keep = keep.replace("{p}", pattern)
    return f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, a, a + length(v) AS b, v FROM (
    SELECT doc_id, v[i] AS v, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(v[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
    FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS g, regexp_extract_all(text, '{pattern}') AS v FROM {table}),
      unnest(range(1, len(v) + 1)) AS r(i)) WHERE {keep}"""


def _joined(order: str, only: str = "true") -> str:
    return f"coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY {order}) FILTER ({only}), '')"


_SECRETS = "\n  UNION ALL ".join(
    (
        _spans(
            "assign",
            0,
            r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            "length(regexp_extract(v, '{p}', 1)) >= 8",
        ),
        _spans("access", 1, "AKIA[A-Z0-9]+", "length(v) >= 16"),
        _spans("hex", 2, "[0-9a-f]+", "length(v) >= 32"),
        _spans("pem", 3, "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", "true"),
        _spans("jwt", 4, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "true"),
        _spans("prefixed", 5, r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{24,})", "true"),
    )
)

SECRET_SCAN = f"""
WITH spans AS (
  {_SECRETS}
)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, sha256({_joined("a, place", "place < 3")}) AS base_sha256,
  {_joined("a, place", "kind IS NOT NULL")} AS spans
FROM documents d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""

_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
      CASE WHEN i % 2 = 0 THEN [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][CAST(substring(reverse({_DIGITS}), i, 1) AS INT) + 1]
      ELSE CAST(substring(reverse({_DIGITS}), i, 1) AS INT) END)) % 10 = 0"""
_PERSONAL = "\n  UNION ALL ".join(
    (
        _spans("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        _spans(
            "ip",
            1,
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "list_max(list_transform(string_split(v, '.'), lambda x: CAST(x AS HUGEINT))) <= 255",
        ),
        _spans("card", 2, r"[0-9]([\x20-]?[0-9])+", _LUHN),
        _spans("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    )
)

PERSONAL_DATA = f"""
WITH base AS (
  {_PERSONAL}
), beside AS (
  SELECT DISTINCT doc_id, kind || ':' || lower(v) AS entity, lower(
    CASE WHEN a > 80 THEN regexp_replace(substring(text, a - 79, 80), '^\\S+', '') ELSE substring(text, 1, a) END || ' ' || chr(10) || ' ' ||
    CASE WHEN length(text) > b + 80 THEN regexp_replace(substring(text, b + 1, 80), '\\S+$', '') ELSE substring(text, b + 1, 80) END) AS around
  FROM base JOIN documents USING (doc_id)
), words AS (
  SELECT DISTINCT doc_id, unnest(list_concat(w, list_transform(w, lambda x: left(x, 3) || '*'))) AS term
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '\\p{{L}}{{3,}}') AS w FROM documents)
), pairs AS (
  SELECT DISTINCT doc_id, entity, around, unnest(list_concat(w, list_transform(w, lambda x: left(x, 3) || '*'))) AS term
  FROM (SELECT *, regexp_extract_all(around, '\\p{{L}}{{3,}}') AS w FROM beside)
), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM documents),
holding AS (SELECT entity, count(DISTINCT doc_id) AS n_entity FROM beside GROUP BY 1),
having_term AS (SELECT term, count(*) AS n_term FROM words GROUP BY 1),
joint AS (
  SELECT entity, term, count(*) AS n_joint
  FROM (SELECT doc_id, entity, term, min(md5(around)) AS place FROM pairs GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING count(DISTINCT place) >= 2),
scored AS (
  SELECT DISTINCT term FROM joint JOIN holding USING (entity) JOIN having_term USING (term), n
  WHERE n_entity < n AND ln(n * least(n_joint, n_term) / (CAST(n_entity AS DOUBLE) * n_term)) / ln(n / n_entity) >= 0.95
), found AS (
  {_spans("term", 4, r"\p{L}{3,}", "lower(v) IN (SELECT term FROM scored)")}
), spans AS (
  SELECT * FROM base UNION ALL SELECT * FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM base x WHERE x.doc_id = f.doc_id AND x.a < f.b AND f.a < x.b)
)
SELECT d.doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
  count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
  sha256({_joined("place, a", "place < 4")}) AS base_sha256, {_joined("place, a", "kind IS NOT NULL")} AS spans,
  count(*) FILTER (kind = 'term') AS n_term
FROM documents d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id"""
