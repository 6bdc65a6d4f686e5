"""DuckDB statements for the queries that SQL can express."""

ORACLE = {}

ORACLE["op2_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(regexp_replace(role, '[\\#<:]', '##', 'g'))
                + length(regexp_replace(text, '[\\#<]', '##', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLE["op5_exact_dedup"] = r"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t)
"""

ORACLE["op7_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
pairs AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, p.w FROM reach r JOIN pairs p ON p.u = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT v.vec_id, (SELECT count(*) FROM pairs WHERE u = v.vec_id) AS n_links, component_id,
       v.vec_id = component_id AS kept
FROM v JOIN least USING (vec_id)
"""

ORACLE["op8_passage_dedup"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS p FROM d),
win AS MATERIALIZED (SELECT doc_id, p, hash(substr(h, 2 * p + 1, 100)) AS k FROM places),
shared AS (SELECT k FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
strings AS (SELECT w.doc_id, p, substr(h, 2 * p + 1, 100) AS s
            FROM win w SEMI JOIN shared USING (k) JOIN d ON d.doc_id = w.doc_id),
own AS (SELECT doc_id, p, first FROM strings JOIN (SELECT s, min(doc_id) AS first FROM strings GROUP BY s) USING (s)),
hit AS (SELECT doc_id, p FROM own WHERE first < doc_id),
runs AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM runs),
spans AS (SELECT doc_id, run, min(p) AS s, max(p) + 50 AS e FROM numbered GROUP BY doc_id, run),
ends AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM spans),
cut AS (SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed,
               string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS front, max(e) AS last
        FROM ends JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN cut.doc_id IS NULL THEN h ELSE front || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
"""


def _floored_mean(total: str, count: str) -> str:
    """Floor of a quotient of whole numbers; ``//`` alone rounds towards zero."""
    return f"(({total}) - ((({total}) % ({count})) + ({count})) % ({count})) // ({count})"


def _clusters(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Plain k-means, round by round: all distances of all vectors, the least by (distance, place)."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, x
  FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h LIMIT {k}))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, any_value(v.x) AS x, min(c) AS c, min(d) AS d FROM (
    SELECT vec_id, v.x, c, d FROM (
      SELECT vec_id, v.x, c, list_sum(list_transform(range(1, {dim + 1}), lambda i: (v.x[i] - c{i}.x[i]) * (v.x[i] - c{i}.x[i]))) AS d
      FROM v, c{i}) v QUALIFY d = min(d) OVER (PARTITION BY vec_id)) v GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT c, p, {_floored_mean('sum(x[p])', 'count(*)')} AS m FROM a{i}, range(1, {dim + 1}) r(p) GROUP BY c, p),
c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.x, c{i}.x) AS x FROM c{i} LEFT JOIN (SELECT c, list(CAST(m AS BIGINT) ORDER BY p) AS x FROM m{i} GROUP BY c) n USING (c))""")
    return f"""WITH {','.join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)"""


ORACLE["op11_centroid_clustering"] = _clusters()


def _codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Product quantisation with all distances compared in every round."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT max(len(x)) // {parts} AS w FROM v),
s AS MATERIALIZED (SELECT vec_id, p, x[p * w + 1 : (p + 1) * w] AS x FROM v, w, range({parts}) r(p)),
c0 AS MATERIALIZED (
  SELECT p, e - 1 AS e, x FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS e FROM v) JOIN s USING (vec_id) WHERE e <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min(e) AS e, min(d) AS d FROM (
    SELECT vec_id, s.p, s.x, e, list_sum(list_transform(list_zip(s.x, c{i}.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM s JOIN c{i} ON s.p = c{i}.p QUALIFY d = min(d) OVER (PARTITION BY vec_id, s.p)) GROUP BY vec_id, p)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT p, e, q, {_floored_mean('sum(x[q])', 'count(*)')} AS m FROM a{i}, range(1, 65) r(q) WHERE q <= len(x) GROUP BY p, e, q),
c{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n.x, c{i}.x) AS x
  FROM c{i} LEFT JOIN (SELECT p, e, list(CAST(m AS BIGINT) ORDER BY q) AS x FROM m{i} GROUP BY p, e) n USING (p, e))""")
    return f"""WITH {','.join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN v USING (vec_id), book"""


ORACLE["op12_vector_codes"] = _codes()
