"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH cut AS (
  SELECT doc_id, t.pos AS pos, t.line AS line,
         translate(trim(t.line, {_SPACE}), '{_UP}', '{_LOW}') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS pos) t
), heavy AS (
  SELECT k, max(doc_id) AS keeper FROM cut WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT cut.doc_id, pos, line, keeper IS NOT NULL AND cut.doc_id IS DISTINCT FROM keeper AS dropped
  FROM cut LEFT JOIN heavy ON cut.k = heavy.k
)"""

LINE_DEDUP = LINES + """
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

URL_FILTERS = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rule, h, p, v) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), fits AS (
  SELECT page_id, rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC) AS n
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT split.page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM split LEFT JOIN fits ON split.page_id = fits.page_id AND n = 1
"""

PHRASES = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, '{_UP}', '{_LOW}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), cut AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)
), counted AS (
  SELECT lang, phrase, k AS size, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), words AS (
  SELECT lang, sum(len(w)) AS n FROM cut GROUP BY lang
), cuts AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counted WHERE size > 1
), scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN (SELECT lang, phrase, f FROM counted) y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
), lowest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o
                 FROM scored) WHERE o = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, f, size, w, k, unnest(range(1, size - k + 2)) AS i
        FROM (SELECT lang, f, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS k FROM counted WHERE size > 2))
  GROUP BY ALL
), ranked AS (
  SELECT lang, phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN words USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op7_line_dedup": LINE_DEDUP,
    "op10_url_filters": URL_FILTERS,
    "op13_phrase_collocations": PHRASES,
}
