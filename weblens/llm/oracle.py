"""The queries of this folder in SQL for DuckDB, where SQL can express them."""

from weblens.llm.licences import RULES, SENTENCES

LINE_DEDUP = r"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS no FROM cut),
keyed AS (
  SELECT doc_id, line, no,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
),
marked AS (
  SELECT k.*, s.first IS NULL OR s.first = k.doc_id AS stays
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents
),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark
),
starts AS (
  SELECT item_id, words, unnest(range(1, greatest(len(words) - 13, 0) + 2)) AS s
  FROM b WHERE len(words) > 0
),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[s:s + 12], ' ') AS phrase
  FROM starts
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS s
  FROM d, sizes WHERE len(words) >= size
),
grams AS (SELECT doc_id, size, s, array_to_string(words[s:s + size - 1], ' ') AS phrase FROM places),
hits AS (SELECT g.doc_id, g.s, g.size, w.item_id FROM grams g JOIN windows w USING (size, phrase)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

WARC = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
),
firsts AS (SELECT payload, min(page_id) AS first FROM p GROUP BY payload),
fives AS (
  SELECT page_id, p.payload, first,
    list_transform(range(0, 8), lambda j: CAST('0x' || substr(hex, CAST(5 * j + 1 AS INT), 5) AS INT)) AS v
  FROM p JOIN firsts ON p.payload = firsts.payload
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(v, lambda x:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 15) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31) + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM fives
"""

LICENCES = r"""
WITH known(sentence, name) AS (VALUES
@sentences@
),
rules(sequence, licence) AS (VALUES
@rules@
),
parts AS (
  SELECT doc_id, regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.!?;:]+[ \t\f\r\n]+|[\r\n]+') AS parts FROM documents
),
places AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS no FROM parts),
named AS (
  SELECT doc_id, no, name FROM places
  JOIN known ON trim(regexp_replace(part, '[^a-z0-9]+', ' ', 'g')) = sentence
),
found AS (SELECT doc_id, string_agg(name, ' ' ORDER BY no) AS names FROM named GROUP BY doc_id),
fitting AS (
  SELECT doc_id, sequence, licence FROM found JOIN rules
  ON contains(' ' || names || ' ', sequence)
),
longest AS (
  SELECT DISTINCT doc_id, licence FROM fitting f WHERE NOT EXISTS (
    SELECT 1 FROM fitting g WHERE g.doc_id IS NOT DISTINCT FROM f.doc_id
    AND g.sequence <> f.sequence AND contains(g.sequence, f.sequence)
  )
),
licences AS (SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS licences FROM longest GROUP BY doc_id)
SELECT d.doc_id, coalesce(replace(names, ' ', ','), '') AS sentence_ids, coalesce(licences, '') AS licences
FROM documents d LEFT JOIN found USING (doc_id) LEFT JOIN licences USING (doc_id)
"""

def _values(rows: list[tuple[str, str]]) -> str:
    return ",\n".join(f"  ('{a}', '{b}')" for a, b in rows)


LICENCES = LICENCES.replace("@sentences@", _values([(t, n) for n, t in SENTENCES.items()]))
LICENCES = LICENCES.replace("@rules@", _values([(f" {k} ", v) for k, v in RULES.items()]))

TOP_K = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
    vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

JACCARD_JOIN = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
),
places AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS s
  FROM cut WHERE len(words) > 0
),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[s:s + 4], ' ') AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT x, y FROM met JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * o >= 80 * (a.n + b.n - o)
),
reached(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
),
firsts AS (SELECT x, min(y) AS first FROM reached GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(first, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN firsts f ON f.x = d.doc_id
"""

DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
),
w AS (SELECT row_no, lang, source, unnest(words) AS term FROM d),
uses AS (
  SELECT row_no, lang, source, term, count(*) AS n FROM w GROUP BY row_no, lang, source, term
),
kept AS (
  SELECT lang, term, sum(n) AS total FROM uses GROUP BY lang, term HAVING count(*) >= 30
),
langs AS (SELECT lang, count(*) AS v, sum(total) AS size FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (
  SELECT lang, source, term, sum(u.n) AS n FROM uses u JOIN kept USING (lang, term)
  GROUP BY lang, source, term
),
sizes AS (SELECT lang, source, sum(n) AS size FROM counts GROUP BY lang, source),
valued AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.size, 0) + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 5)) // (l.size + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN sizes s USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM valued a JOIN valued b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM valued WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
  FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 50
"""

ORACLE = {
    "op2_warc": WARC,
    "op4_decontamination": DECONTAMINATION,
    "op5_top_k": TOP_K,
    "op6_licences": LICENCES,
    "op7_line_dedup": LINE_DEDUP,
    "op10_jaccard_join": JACCARD_JOIN,
    "op13_divergence": DIVERGENCE,
}
