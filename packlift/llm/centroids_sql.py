"""Oracle SQL of the centroid clustering: the rounds written out, every distance computed."""

K, ROUNDS, DIMS = 8, 10, 64


def _assign(r: int) -> str:
    return f"""a{r} AS MATERIALIZED (
  SELECT rid, vec_id, v, c, d FROM (
    SELECT k.rid, k.vec_id, k.v, m.c, list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM kept k CROSS JOIN c{r} m)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)"""


def _move(r: int) -> str:
    return f"""s{r} AS MATERIALIZED (
  SELECT c, pos, sum(x) AS s, count(*) AS n FROM (
    SELECT c, unnest(v) AS x, unnest(range({DIMS})) AS pos FROM a{r}) GROUP BY c, pos),
c{r + 1} AS MATERIALIZED (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v FROM s{r} GROUP BY c
  UNION ALL SELECT c, v FROM c{r} WHERE c NOT IN (SELECT c FROM s{r}))"""


def clusters_sql() -> str:
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h, v LIMIT {K}))"""]
    for r in range(ROUNDS):
        steps += [_assign(r), _move(r)]
    steps.append(_assign(ROUNDS))
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} m USING (c)"""
