"""DuckDB SQL for the queries of this package that SQL can express."""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source IS NULL AS absent, coalesce(source, '') AS src,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
ranked_sources AS (
  SELECT absent, src, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY absent, src) AS pos
  FROM sized GROUP BY absent, src),
weighted AS (
  SELECT *, CAST(CASE (pos - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS w,
         3 * source_size AS cap FROM ranked_sources),
prefixes AS (
  SELECT *, sum(source_size) OVER () AS t, sum(w) OVER () AS ws,
         coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / w, absent, src
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
         coalesce(sum(w) OVER (ORDER BY CAST(cap AS DOUBLE) / w, absent, src
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ws_before
  FROM weighted),
stops AS (
  SELECT *, CAST(cap AS HUGEINT) * CAST(ws - ws_before AS HUGEINT)
            <= CAST(t - caps_before AS HUGEINT) * w AS stop FROM prefixes),
leftover AS (
  SELECT *, coalesce(sum(CASE WHEN stop THEN cap END) OVER (), 0) AS stopped,
         coalesce(sum(CASE WHEN stop THEN w END) OVER (), 0) AS stopped_w FROM stops),
targets AS (
  SELECT absent, src, source_size,
         CASE WHEN stop THEN CAST(cap AS DOUBLE)
              ELSE CAST(t - stopped AS DOUBLE) * w / CAST(ws - stopped_w AS DOUBLE) END AS target,
         (CAST(('0x' || substr(md5('mix-1' || CASE WHEN absent THEN 'true' ELSE 'false' END || src), 1, 3)) AS INTEGER)
          + 0.5::DOUBLE) / 4096::DOUBLE AS u
  FROM leftover),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY absent, src ORDER BY
         CASE WHEN len(bin(size + 1)) < 4 THEN len(bin(size + 1)) * 8
              ELSE len(bin(size + 1)) * 8 + ((size + 1) >> (len(bin(size + 1)) - 4)) % 8 END,
         CAST(('0x' || substr(k, 1, 4)) AS INTEGER) % 256, size, k, doc_id) AS r
  FROM sized)
SELECT p.doc_id, p.size, t.source_size, t.target,
       CAST(least(floor(rate * p.r + t.u) - floor(rate * (p.r - 1) + t.u), 3) * p.size AS BIGINT) AS taken
FROM placed p
JOIN (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets) t
  ON p.absent = t.absent AND p.src = t.src
"""

EXACT = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY coalesce(text, ''))
         AND row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

LEAKS = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS g FROM starts),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts),
ahead AS (
  SELECT r, p, list(word) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS n FROM words),
runs AS (
  SELECT r, p, k, array_to_string(n[1 : k], ' ') AS g
  FROM ahead, (SELECT DISTINCT k FROM windows) AS sizes WHERE len(n) >= k),
found AS (SELECT r, p, runs.k, item FROM runs JOIN windows ON runs.g = windows.g AND runs.k = windows.k),
hit AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT r, unnest(range(p, p + k)) AS place FROM found) AS covered GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, item FROM found) AS pairs GROUP BY r)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.listed, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hit h ON t.r = h.r LEFT JOIN named n ON t.r = n.r
"""

_BLOCK_TAGS = (
    "(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main"
    "|nav|ol|p|pre|section|table|td|th|title|tr|ul)(?:\\s[^<>]*)?/?>"
)
SITE_LINES = rf"""
WITH bare AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->', chr(10), 'g'),
           '(?is)<script(?:\s[^<>]*)?>.*?</script\s*>', chr(10), 'g'),
           '(?is)<style(?:\s[^<>]*)?>.*?</style\s*>', chr(10), 'g') AS t
  FROM pages),
lined AS (
  SELECT page_id, host, list_filter(list_transform(string_split(regexp_replace(regexp_replace(
           regexp_replace(t, '{_BLOCK_TAGS}', chr(10), 'g'), '<[!/a-zA-Z][^<>]*>', '', 'g'), '[ \t\r\f]+', ' ', 'g'), chr(10)),
           lambda x: trim(x)), lambda x: x <> '') AS lines,
         row_number() OVER () AS r
  FROM bare),
totals AS (SELECT host, count(*) AS pages FROM lined GROUP BY host),
line AS (SELECT r, host, unnest(list_distinct(lines)) AS line FROM lined),
common AS (
  SELECT l.host, l.line FROM line l JOIN totals t ON l.host = t.host
  GROUP BY l.host, l.line, t.pages
  HAVING count(*) > 1 AND count(*) > t.pages * 0.1::DOUBLE),
listed AS (SELECT host, list(line) AS common FROM common GROUP BY host)
SELECT p.page_id, p.host, CAST(len(p.lines) AS BIGINT) AS n_lines,
       CAST(len(p.lines) - len(list_filter(p.lines, lambda x: NOT list_contains(coalesce(c.common, []), x))) AS BIGINT) AS n_dropped,
       array_to_string(list_filter(p.lines, lambda x: NOT list_contains(coalesce(c.common, []), x)), chr(10)) AS kept_text
FROM lined p LEFT JOIN listed c ON p.host = c.host
"""

NEIGHBOURS = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x, row_number() OVER () AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.r AS asking, q.vec_id AS query_id, c.vec_id, c.r,
         CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.r <> c.r
  WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY asking ORDER BY score DESC, vec_id NULLS LAST, r) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""

ORACLE_SQL = {
    "op4_decontaminate": LEAKS,
    "op8_site_lines": SITE_LINES,
    "op6_mix_sources": MIX,
    "op7_exact_dedup": EXACT,
    "op12_voronoi_join": NEIGHBOURS,
}
