"""SQL (DuckDB) for the operators that SQL can express."""

from __future__ import annotations

from tickloom.llm import clusters


def _clusters_sql(k: int = clusters.CLUSTERS, rounds: int = clusters.ROUNDS) -> str:
    """Plain rounds: every vector against every centroid, exact means rounded down."""
    finite = "c IS NOT NULL AND NOT isnan(c) AND NOT isinf(c)"
    steps = [
        f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: {finite})) = 64),
named AS (SELECT x, sha256(concat('3:', CAST(vec_id AS VARCHAR))) AS h FROM kept),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, x FROM named ORDER BY h, x LIMIT {k})"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
d{n} AS (
  SELECT kept.r, kept.vec_id, kept.x, c.j,
    CAST(list_sum(list_transform(list_zip(kept.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
  FROM kept CROSS JOIN c{n} AS c),
a{n} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x,
    min(struct_pack(d := d, j := j)).d AS d, min(struct_pack(d := d, j := j)).j AS j
  FROM d{n} GROUP BY r)""")
        if n < rounds:
            # Division that rounds down: the remainder of the sum is made positive first.
            steps.append(f"""
u{n} AS (
  SELECT j, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS v FROM (
    SELECT j, i, sum(v) AS s, count(*) AS n FROM (
      SELECT j, unnest(x) AS v, unnest(range(64)) AS i FROM a{n}) y GROUP BY j, i) z),
c{n + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(m.x, c.x) AS x FROM c{n} AS c LEFT JOIN (
    SELECT j, list(v ORDER BY i) AS x FROM u{n} GROUP BY j) m ON c.j = m.j)""")
    return (
        "WITH"
        + ",".join(steps)
        + f"""
SELECT a.vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON a.j = c.j"""
    )


ORACLES: dict[str, str] = {"op11_clusters": _clusters_sql()}
