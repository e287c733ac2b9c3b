"""Centroid clustering of integer vectors with higher-order functions on literal centroid arrays.

Distances come from zip_with and aggregate, the nearest centroid from array_min of structs, and
new centroids from one sum for each component, combined before the shuffle. What reaches the
driver in a round is a row for each centroid; it returns to the executors as a literal.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import load, written

DIMS, K, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2"
#: Larger integer components are set to this bound, so that a squared distance of 64 components fits a long.
BOUND = 2**27

Centroids = list[list[int]]


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, of the vectors with exactly `dims` finite components."""
    e = F.col("_e")
    rows = df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("_e"))
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = rows.where((F.size(e) == dims) & sound)
    limit = float(BOUND)
    return held.select("vec_id", F.transform(e, lambda x: F.floor(F.least(F.greatest(x * float(scale), F.lit(-limit)), F.lit(limit)))).alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: str = SEED) -> Centroids:
    """The k vectors with the smallest SHA-256 of seed:vec_id, then components; null ids come last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in vectors.select("v", digest.alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).select("v").collect()]


def nearest(v: Column, centroids: Centroids) -> Column:
    """Struct of the squared distance and the number of the nearest centroid; of equal distances the smaller number."""
    literal = F.from_json(F.lit(json.dumps(centroids)), "array<array<bigint>>")  # folded to one literal array

    def one(c: Column, number: Column) -> Column:
        gaps = F.zip_with(v, c, lambda a, b: a - b)
        return F.struct(F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g * g).alias("distance"), number.alias("cluster"))

    return F.array_min(F.transform(literal, one))


def next_centroids(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """The floored means of the vectors of each centroid; a centroid without vectors stays."""
    dims = len(centroids[0])
    near = vectors.select("v", nearest(F.col("v"), centroids)["cluster"].alias("cluster"))
    sums = [F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dims)]
    new = list(centroids)
    for r in near.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():  # at most a row for each centroid
        new[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
    return new


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = SEED) -> Centroids:
    """Centroids after the given rounds; fewer than k if there are fewer vectors, none if there are none."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = next_centroids(vectors, centroids)
    return centroids


def cluster_vectors(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = DIMS, k: int = K, rounds: int = ROUNDS, seed: str = SEED
) -> DataFrame:
    """For each kept vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Vectors that are null, of another length, or with a null or non-finite component are left out;
    repeated rows and null ids are clustered as any other. Components beyond BOUND count as BOUND,
    and a sum of distances over the range of a long is null. Each round reads `df` once, so it
    should be a stored table; an empty one gives no rows. Other columns are not read.
    """
    vectors = integer_vectors(df, vec_id, embedding, dims)
    centroids = fit(vectors, k, rounds, seed)
    kind = df.schema[vec_id].dataType.simpleString()
    if not centroids:
        return df.sparkSession.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    near = vectors.select("vec_id", nearest(F.col("v"), centroids).alias("near"))
    found = written(near.select("vec_id", "near.cluster", "near.distance"))
    of_each = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    of_all = of_each.groupBy().agg(F.try_sum("cluster_inertia").alias("inertia"))
    digests = F.from_json(F.lit(json.dumps([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids])), "array<string>")
    sums = of_each.crossJoin(F.broadcast(of_all))  # one row
    # a row for each centroid
    return found.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.get(digests, F.col("cluster")).alias("centroid_sha256")
    )


def op11_centroids(spark, sf_dir: str) -> DataFrame:
    return cluster_vectors(load(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same rounds in SQL, a row for each vector and component."""
    steps = [
        f"""each AS (
  SELECT vec_id, d, CAST(embedding[d] AS DOUBLE) AS x FROM embeddings, range(1, {DIMS + 1}) AS dims(d) WHERE len(embedding) = {DIMS})""",
        f"good AS MATERIALIZED (SELECT vec_id FROM each GROUP BY vec_id HAVING count(*) FILTER (WHERE isfinite(x)) = {DIMS})",
        f"parts AS MATERIALIZED (SELECT vec_id, d, CAST(floor({SCALE} * x) AS BIGINT) AS x FROM each JOIN good USING (vec_id))",
        f"""chosen AS (
  SELECT vec_id, row_number() OVER (ORDER BY h) - 1 AS c FROM (SELECT vec_id, sha256('{SEED}:' || vec_id) AS h FROM good ORDER BY h LIMIT {K}))""",
        "c0 AS MATERIALIZED (SELECT c, d, x AS y FROM chosen JOIN parts USING (vec_id))",
    ]
    for n in range(ROUNDS + 1):
        steps.append(
            f"""near{n} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, (dist, c)) AS c, min(dist) AS dist
  FROM (SELECT vec_id, c, CAST(sum((x - y) * (x - y)) AS BIGINT) AS dist FROM parts JOIN c{n} USING (d) GROUP BY vec_id, c) GROUP BY vec_id)"""
        )
        if n < ROUNDS:
            steps.append(
                f"""mean{n} AS (
  SELECT c, d, sum(x) AS s, count(*) AS n FROM near{n} JOIN parts USING (vec_id) GROUP BY c, d)"""
            )
            steps.append(
                f"""c{n + 1} AS MATERIALIZED (
  SELECT c, d, CASE WHEN n IS NULL THEN y ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS y FROM c{n} LEFT JOIN mean{n} USING (c, d))"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
named AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, dist AS distance, CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{ROUNDS} JOIN named USING (c)"""
    )


OP11_SQL = _sql()
