"""SQL twins of the operators on terms, shingles and conversations."""

DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS c FROM o GROUP BY ALL HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
  1 + 1000000000 * (coalesce(c.c, 0) + 1) // (n.n + v.v) AS p, 1 + 1000000000 * (k.c + 1) // (v.n + v.v) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN n USING (lang, source) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
ranked AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value,
  row_number() OVER (PARTITION BY lang, source ORDER BY coalesce(value, 0) DESC, item) AS rank
  FROM pairs LEFT JOIN sums USING (lang, source, item)
UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q,
  row_number() OVER (PARTITION BY lang, source ORDER BY (p - q) * (p - q) // q DESC, term) FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS u, doc_id AS v FROM d UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.u = d.doc_id"""


def _crc_byte(x: str) -> str:
    """One of the eight steps of CRC-32 for a byte."""
    return f"xor({x} >> 1, 3988292384 * ({x} & 1))"


TRIE = rf"""
WITH RECURSIVE b AS (SELECT i, i AS c, 0 AS step FROM range(256) r(i)
  UNION ALL SELECT i, {_crc_byte("c")}, step + 1 FROM b WHERE step < 8),
t AS (SELECT i, c FROM b WHERE step = 8),
x AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
y AS (SELECT conv_id, s, 0 AS pos, 4294967295::BIGINT AS c FROM x
  UNION ALL SELECT conv_id, s, pos + 1, xor(y.c >> 8, t.c) FROM y JOIN t ON t.i = xor(y.c, ascii(s[pos + 1])::BIGINT) & 255 WHERE pos < length(s)),
h AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h FROM y WHERE pos = length(s)),
o AS (SELECT conv_id, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k,
  length(coalesce(text, '')) AS chars, turn FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, k, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS place FROM o),
r AS (SELECT h.conv_id, n.place, n.k, n.chars FROM h JOIN n ON n.conv_id = h.conv_id - h.conv_id % 100 AND n.place <= h.h
  UNION ALL SELECT h.conv_id, n.place, n.k, n.chars FROM h JOIN n ON n.conv_id = h.conv_id AND n.place > h.h),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, k, chars FROM r),
p AS (SELECT conv_id, depth, string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path, chars FROM q
  UNION ALL SELECT conv_id, 0, '', 0 FROM h),
z AS (SELECT conv_id, max(path) AS path FROM p GROUP BY conv_id),
m AS (SELECT path, depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY path, depth),
e AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM z GROUP BY path),
c AS (SELECT m.*, u.conv_id AS parent_conv_id, (SELECT count(*) FROM m w WHERE w.depth = m.depth + 1 AND w.path[:32 * m.depth] = m.path) AS n_children
  FROM m LEFT JOIN m u ON u.depth = m.depth - 1 AND u.path = m.path[:32 * (m.depth - 1)])
SELECT c.conv_id, c.depth::BIGINT AS depth, c.parent_conv_id, c.n_convs::BIGINT AS n_convs, c.n_children::BIGINT AS n_children,
  count(*) FILTER (s.n_children = 0)::BIGINT AS n_leaves, sum((s.n_convs - 1) * s.chars)::BIGINT AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM c JOIN c s ON s.path[:32 * c.depth] = c.path AND s.depth >= c.depth LEFT JOIN e ON e.path = c.path
GROUP BY c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, c.path, e.ids"""
