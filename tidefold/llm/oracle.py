"""SQL with the rows of those queries that SQL can express, for DuckDB."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bs)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
       FROM (SELECT d.doc_id, d.w, x.n, unnest(range(1, len(d.w) - x.n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) AS x)),
h AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, s)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, strlen(body) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(h, 10 * (j // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (j % 8))) & 31) AS INTEGER) + 1, 1) FOR j IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT DISTINCT a AS doc_id, a AS reached FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) AS c USING (doc_id)
"""

REPEATS = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, md5(b[i : i + 199]) AS h FROM (SELECT *, unnest(range(1, n - 198)) AS i FROM d)),
r AS (SELECT doc_id, i FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
g AS (SELECT *, CASE WHEN i > lag(i) OVER o + 200 OR lag(i) OVER o IS NULL THEN 1 ELSE 0 END AS new FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS e FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) GROUP BY doc_id, k),
p AS (SELECT doc_id, a, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 1) AS since, e FROM s),
k AS (SELECT doc_id, sum(e - a) AS removed, count(*) AS spans, max(e) AS last FROM s GROUP BY doc_id),
x AS (SELECT doc_id, string_agg(hex(b[since : a - 1]), '' ORDER BY a) AS kept FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || hex(b[coalesce(last, 1) : n]))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN x USING (doc_id)
"""

SQL = {"op2_decontaminate": DECONTAMINATE, "op6_warc_index": WARC, "op8_ngram_jaccard_join": JACCARD, "op10_repeated_strings": REPEATS}
