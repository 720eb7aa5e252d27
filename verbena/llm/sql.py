"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""

_FINITE = "list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))"


def clustering(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024) -> str:
    """The rounds written out one after the other; a vector's components are rows only in the sums."""
    far = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    floor = "((s - ((s % n) + n) % n) // n)::BIGINT"
    parts = [f"""
k AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {dims} AND {_FINITE}),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1)::INT AS cluster, v
  FROM k QUALIFY cluster < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT k.r, arg_min(c.cluster, {{'d': {far}, 'c': c.cluster}}) AS cluster, min({far}) AS distance
  FROM k CROSS JOIN c{i} c GROUP BY k.r)""")
        if i < rounds:
            parts.append(f"""
m{i + 1} AS (
  SELECT cluster, list({floor} ORDER BY j) AS v FROM (
    SELECT a.cluster, j, sum(k.v[j]) AS s, count(*) AS n
    FROM a{i} a JOIN k USING (r) CROSS JOIN generate_series(1, {dims}) g(j) GROUP BY a.cluster, j) GROUP BY cluster),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i + 1} m USING (cluster))""")
    return f"""WITH {",".join(parts)}
SELECT k.vec_id, a.cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN k USING (r) JOIN c{rounds} c ON c.cluster = a.cluster
"""


HARD_NEGATIVES = f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_resize(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)),
                     (SELECT max(len(embedding)) FROM embeddings), 0.0) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND coalesce({_FINITE}, true)),
s AS MATERIALIZED (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.id))::INT AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""

SQL = {
    "op11_centroid_clustering": clustering(),
    "op12_exact_dedup": EXACT_DEDUP,
    "op13_hard_negatives": HARD_NEGATIVES,
}
