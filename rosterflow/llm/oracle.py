"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from rosterflow.llm.license_scan import EQUIVALENT, KNOWN

VECTOR_SEARCH = """
WITH g AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM g q, g c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

URL_FILTER = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), j AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""

COLLOCATIONS = r"""
WITH t AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), p AS (
  SELECT lang, regexp_extract_all(piece, '[^ \x09]+') AS ws FROM (SELECT lang, unnest(pieces) AS piece FROM t)
), f AS (
  SELECT lang, 1 AS k, [unnest(ws)] AS ws FROM p
  UNION ALL SELECT lang, 2, ws[i:i + 1] FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM p)
  UNION ALL SELECT lang, 3, ws[i:i + 2] FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM p)
), c AS (
  SELECT lang, k, ws, count(*) AS f FROM f GROUP BY ALL
), n AS (
  SELECT lang, sum(f) AS n FROM c WHERE k = 1 GROUP BY lang
), cuts AS (
  SELECT x.lang, x.k, x.ws, x.f AS a, y.k AS cut, y.f AS l, z.f AS r,
         (1000000::HUGEINT * x.f * x.f) // (y.f::HUGEINT * z.f) AS score
  FROM c x JOIN c y ON y.lang = x.lang AND y.k < x.k AND y.ws = x.ws[1:y.k]
           JOIN c z ON z.lang = x.lang AND z.k = x.k - y.k AND z.ws = x.ws[y.k + 1:]
  WHERE x.k > 1 AND x.f >= 10
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, ws ORDER BY score, cut) AS i FROM cuts) WHERE i = 1
), covered AS (
  SELECT DISTINCT b.lang, b.ws FROM best b JOIN best o ON o.lang = b.lang AND o.k = 3 AND (o.ws[1:2] = b.ws OR o.ws[2:3] = b.ws)
  WHERE b.k = 2 AND 100 * o.a >= 50 * b.a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank,
         array_to_string(ws, ' ') AS phrase, a, l, r, score
  FROM best ANTI JOIN covered USING (lang, ws)
)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def license_scan_sql() -> str:
    """The canonical forms by list functions; known licences stand as values."""
    spell = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in EQUIVALENT.items())

    def lines(column: str) -> str:
        folded = (f"regexp_replace(regexp_replace(lower({column}), "
                  r"'(?m)^[ \t]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*$', '', 'g'), "
                  r"'[^\p{L}\p{N}\n]+', ' ', 'g')")
        return (f"list_transform(list_filter(list_transform(string_split({folded}, chr(10)), lambda x: trim(x)), "
                f"lambda x: x <> ''), lambda x: array_to_string(list_transform(string_split(x, ' '), "
                f"lambda w: CASE w {spell} ELSE w END), ' '))")

    known = ", ".join(f"({_quoted(a)}, {_quoted(b)}, {_quoted(c)})" for a, b, c in KNOWN)
    return f"""
WITH k AS (
  SELECT unit, digest, min(licence) AS licence FROM (
    SELECT licence, unit, sha256(array_to_string({lines('t')}, ' ')) AS digest
    FROM (VALUES {known}) v(licence, unit, t)) GROUP BY unit, digest
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({lines('text')}, []) AS ls FROM documents
), l AS (
  SELECT r, sha256(x) AS digest FROM (SELECT r, unnest(ls) AS x FROM d)
), hits AS (
  SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS line_licences, count(*) AS n_lines
  FROM l JOIN k ON k.digest = l.digest AND k.unit = 'line' GROUP BY r
), whole AS (
  SELECT r, doc_id, CASE WHEN len(ls) > 0 THEN sha256(array_to_string(ls, ' ')) END AS canon_sha256 FROM d
)
SELECT doc_id, canon_sha256, k.licence AS text_licence,
       coalesce(line_licences, '') AS line_licences, coalesce(n_lines, 0) AS n_lines
FROM whole LEFT JOIN hits USING (r) LEFT JOIN k ON k.digest = canon_sha256 AND k.unit = 'document'
"""
