"""DuckDB SQL with the rows of those queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op4_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLES["op6_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
"""

ORACLES["op8_chat_format"] = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
    12 + length(replace(replace(replace(role, '%', '%25'), '<|', '<%7C'), chr(10), '%0A')) + 1
      + length(replace(replace(text, '%', '%25'), '<|', '<%7C')) + 11 AS shown
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), f AS (
  SELECT *, sum(shown) OVER (PARTITION BY conv_id ORDER BY place) AS until FROM e
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(until) FILTER (role = 'assistant' OR place = n))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

ORACLES["op9_superminhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END)) AS s
  FROM w WHERE len(w) > 0
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id AS id, doc_id AS v FROM documents
  UNION SELECT r.id, e.b FROM r JOIN e ON r.v = e.a
), c AS (SELECT id, min(v) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

_ROUND = """, {new}n AS MATERIALIZED (
  SELECT k, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT v.k, v.p, c.e, CAST(list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) ** 2)) AS BIGINT) AS d
    FROM v JOIN {old} c ON v.p = c.p
  ) GROUP BY k, p
)"""
_BETTER = """, {new} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM {old} c LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS x FROM (
      SELECT n.p, n.e, i, CAST(floor(sum(v.x[i]) / count(*)) AS BIGINT) AS m
      FROM {new}n n JOIN v ON v.k = n.k AND v.p = n.p, range(1, 5) r(i) GROUP BY n.p, n.e, i
    ) GROUP BY p, e
  ) m ON m.p = c.p AND m.e = c.e
)"""

ORACLES["op13_vector_codes"] = (
    """
WITH g AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS k, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (SELECT k, p, v[4 * p + 1:4 * p + 4] AS x FROM g, range(0, 16) r(p)),
b0 AS MATERIALIZED (SELECT p, k - 1 AS e, x FROM v WHERE k <= 64)"""
    + _ROUND.format(new="b1", old="b0") + _BETTER.format(new="b1", old="b0")
    + _ROUND.format(new="b2", old="b1") + _BETTER.format(new="b2", old="b1") + _ROUND.format(new="b3", old="b2")
    + """, s AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2),
c AS (SELECT k, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM b3n GROUP BY k)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM g JOIN c USING (k), s
"""
)

ORACLES["op11_prefix_trie"] = """
WITH o AS (
  SELECT conv_id, list(struct_pack(b := bytes, k := key) ORDER BY turn NULLS FIRST, key) AS t FROM (
    SELECT conv_id, turn, strlen(coalesce(text, '')) AS bytes, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key FROM conversations
  ) WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT *, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda a, c: list_reduce(range(0, 8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(a, c)), 4294967295::BIGINT), 4294967295::BIGINT) % 9 AS h FROM o
), r AS (
  SELECT a.conv_id, list_concat(coalesce(b.t, [])[1:a.h], a.t[a.h + 1:]) AS t FROM h a LEFT JOIN o b ON b.conv_id = a.conv_id - a.conv_id % 5
), p AS MATERIALIZED (
  SELECT conv_id, d, len(t) AS len, coalesce(t[d].b, 0) AS b, sha256(array_to_string(list_transform(t[1:d], lambda x: x.k), ',')) AS k
  FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM r)
), n AS MATERIALIZED (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, max(b) AS b, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = d), '') AS ends FROM p GROUP BY k, d
), u AS MATERIALIZED (SELECT n.*, q.k AS up FROM n LEFT JOIN p q ON q.conv_id = n.conv_id AND q.d = n.d - 1),
c AS MATERIALIZED (SELECT up AS k, d - 1 AS d, count(*) AS c FROM u WHERE d > 0 GROUP BY ALL),
s AS (
  SELECT q.k, q.d, count(*) FILTER (c.c IS NULL) AS leaves, sum((n.n - 1) * n.b) AS saved
  FROM n LEFT JOIN c ON c.k = n.k AND c.d = n.d JOIN p q ON q.conv_id = n.conv_id AND q.d <= n.d GROUP BY ALL
)
SELECT u.conv_id, CAST(u.d AS BIGINT) AS depth, m.conv_id AS parent_conv_id, u.n AS n_convs, coalesce(c.c, 0) AS n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(u.ends) AS ends_sha256
FROM u JOIN s ON s.k = u.k AND s.d = u.d LEFT JOIN c ON c.k = u.k AND c.d = u.d LEFT JOIN n m ON m.k = u.up AND m.d = u.d - 1
"""
