"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

_ALNUM = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8 = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS p
  FROM b, UNNEST(range(1, greatest(len(w) - 13, 0) + 2)) AS t(i) WHERE len(w) > 0
),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p
  FROM (SELECT doc_id, w, n, UNNEST(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, p)),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, UNNEST(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP6 = f"""
WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS p FROM (SELECT doc_id, w, UNNEST(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY p ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
hit AS (SELECT DISTINCT doc_id, UNNEST(range(i, i + 20)) AS pos FROM late),
gone AS (SELECT doc_id, count(*) AS n, list(pos) AS ps FROM hit GROUP BY doc_id),
word AS (SELECT doc_id, UNNEST(w) AS x, UNNEST(range(1, len(w) + 1)) AS pos FROM d WHERE len(w) > 0),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY pos) AS t FROM word ANTI JOIN hit USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_LOWERED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_LOWERED} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(len(w), 5) - 1), ' ') AS g
  FROM (SELECT doc_id, w, UNNEST(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * x >= 85 * (na.n + nb.n - x)),
r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id, d.doc_id <= coalesce(c, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

OP12 = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0
),
positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""

#: Words with every code point taken out in turn: two words are near if one is a word of the other's, or both share one at the same place.
OP13 = """
WITH RECURSIVE bits AS (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS x FROM range(256) AS t(b)),
crc AS (SELECT list(x ORDER BY b) AS x FROM bits),
run AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, UNNEST(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL
),
byte AS (
  SELECT doc_id, run, n, flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END)) AS bytes FROM run
),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(bytes, lambda b: b::BIGINT)), lambda c, b: xor(c >> 8, x[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM byte, crc),
word AS (
  SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
less AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, UNNEST(range(1, length(word) + 1)) AS i FROM word)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN word w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN word w ON l.rest = w.word
),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top, min(struct_pack(m := -other_n, o := other)).o AS other FROM near GROUP BY word),
form AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN other END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n FROM word w LEFT JOIN best USING (word)),
walk AS (SELECT word, coalesce(form, word) AS at FROM form UNION SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.at WHERE form.form IS NOT NULL),
root AS (SELECT walk.word, walk.at AS root FROM walk JOIN form ON form.word = walk.at WHERE form.form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM form JOIN root USING (word)
"""

SQL = {
    "op6_substring_dedup": OP6,
    "op8_decontamination": OP8,
    "op10_near_dedup": OP10,
    "op12_hard_negatives": OP12,
    "op13_spelling_variants": OP13,
}
