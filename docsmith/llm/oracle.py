"""DuckDB SQL of the operators that SQL can express; the other queries are tested
against brute force in tests/llm."""

from __future__ import annotations

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

MIX = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS order_key, md5(coalesce(text, '')) AS text_key
  FROM documents),
sized AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS n FROM d GROUP BY source),
weighted AS (
  SELECT source, source_size, [5, 2, 1][(n - 1) % 3 + 1] AS weight FROM sized),
levels AS (
  SELECT *, source_size * 3 / weight AS bound,
    CAST(sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (
      ORDER BY source_size * 3 / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(weight) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS here,
    row_number() OVER (ORDER BY source_size * 3 / weight, source NULLS LAST) AS place
  FROM weighted),
level AS (SELECT arg_min(here, place) AS here FROM levels WHERE here <= bound),
targets AS (
  SELECT source, source_size,
    least(level.here * weight, CAST(source_size * 3 AS DOUBLE)) AS target FROM weighted, level),
placed AS MATERIALIZED (
  SELECT d.*, t.source_size, t.target, row_number() OVER (PARTITION BY d.source
      ORDER BY order_key, text_key, size, uid) AS n,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
-- the last epoch, a document of every source at a time: it is taken if it fits
walk AS (
  SELECT source, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS uid, false AS extra,
    max(target - epochs * source_size) AS gap FROM placed GROUP BY source
  UNION ALL
  SELECT w.source, p.n, p.uid, p.size > 0 AND p.size <= w.gap,
    w.gap - CASE WHEN p.size > 0 AND p.size <= w.gap THEN p.size ELSE 0 END
  FROM walk w JOIN placed p ON p.source IS NOT DISTINCT FROM w.source AND p.n = w.n + 1),
chosen AS (SELECT p.*, w.extra FROM placed p JOIN walk w USING (uid)),
gaps AS (SELECT source, min(gap) AS gap FROM walk GROUP BY source),
fills AS (
  SELECT uid FROM (
    SELECT c.uid, row_number() OVER (PARTITION BY c.source
      ORDER BY abs(size - gap), order_key, text_key, c.uid) AS n
    FROM chosen c JOIN gaps g ON c.source IS NOT DISTINCT FROM g.source
    WHERE NOT extra AND size > 0 AND abs(size - gap) < gap) x WHERE n = 1)
SELECT doc_id, size, source_size, target, size * least(CAST(epochs AS BIGINT)
    + CASE WHEN extra OR uid IN (SELECT uid FROM fills) THEN 1 ELSE 0 END, 3) AS taken
FROM chosen
"""

#: One round of ``CLUSTER``: assign every vector, then move the non-empty centroids.
CLUSTER_ROUND = """
near{r} AS MATERIALIZED (
  SELECT uid, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
    SELECT uid, cluster, list_sum(list_transform(list_zip(k.v, c.v),
      lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM kept k, centroid{r} c) GROUP BY uid),
centroid{next} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centroid{r} c LEFT JOIN (
    SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY place) AS v FROM (
      SELECT n.cluster, place, sum(k.v[place]) AS total, count(*) AS n
      FROM near{r} n JOIN kept k USING (uid), range(1, 65) p(place) GROUP BY ALL) GROUP BY cluster
  ) m USING (cluster))"""

CLUSTER = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding,
    lambda x: CAST(greatest(-134217728, least(134217728, floor(256 * CAST(x AS DOUBLE)))) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
centroid0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY key, v) - 1 AS cluster, v FROM (
    SELECT sha256('2:' || vec_id) AS key, v FROM kept WHERE vec_id IS NOT NULL ORDER BY key, v LIMIT 40)),
""" + ",".join(CLUSTER_ROUND.format(r=r, next=r + 1) for r in range(6)) + """
SELECT k.vec_id, CAST(n.cluster AS INTEGER) AS cluster, CAST(n.distance AS BIGINT) AS distance,
  CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(n.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM near5 n JOIN kept k USING (uid) JOIN centroid5 c ON c.cluster = n.cluster
"""

ORACLE: dict[str, str] = {
    "op5_no_random_access_topk": TOP_K,
    "op6_curriculum_mix": MIX,
    "op12_orchard_clustering": CLUSTER,
}
