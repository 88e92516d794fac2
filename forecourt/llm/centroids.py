"""Clustering of vectors by rounded centroids, in JVM expressions throughout.

Components become integers, ``floor(64 * x)``. Centroids are constants of the plan: ``zip_with`` and ``aggregate`` give the
squared distance to each, ``array_min`` over (distance, number) picks the cluster, ties to the smaller number, and a grouped sum
of one column per component gives the next centroids. A round reads the vectors where they lie and shuffles at most
one partial row per cluster and task, so that a cluster holding a third of all rows is nothing special; only the sums,
at most ``k`` rows, come to the driver, where they are divided exactly.

Defined results: rows whose vector is null, of another length, or has a null or non-finite component are not kept.
Integers beyond 2^27 in size count as 2^27, so that distances fit in a long; an inertia that does not fit is null. The
start is the ``k`` vectors whose keys hash least (``seed:key``; null keys last, equal hashes by their vectors), each row
counting for itself; fewer rows give fewer centroids, none an empty result. Repeated rows are each assigned.
Other columns pass through, existing columns of the result's names are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import drop_names, free_name, written

DIMS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = "1"
MOST = 1 << 27  # 64 squares of twice this fit in a long

Centroid = tuple[int, ...]


def integers(vector: Column, dims: int = DIMS, scale: int = SCALE) -> Column:
    """The vector as an array of longs, or null if it is not kept."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(
        vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))), F.lit(-float(MOST))))
    )
    return F.when((F.size(vector) == dims) & ~bad, scaled)


def _literal(centroid: Centroid) -> Column:
    return F.from_json(F.lit(str(list(centroid))), "array<bigint>")


def distance(vector: Column, centroid: Centroid) -> Column:
    """The squared Euclidean distance to a constant."""
    squares = F.zip_with(vector, _literal(centroid), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda total, square: total + square)


def nearest(vector: Column, centroids: list[Centroid]) -> Column:
    """``struct<distance, cluster>`` of the nearest centroid."""
    return F.array_min(
        F.array(
            *(
                F.struct(distance(vector, c).alias("distance"), F.lit(i).cast("int").alias("cluster"))
                for i, c in enumerate(centroids)
            )
        )
    )


def first_centroids(kept: DataFrame, key: str, vector: str, k: int = CLUSTERS, seed: str = SEED) -> list[Centroid]:
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{key}`").cast("string")), 256)
    start = kept.select(hashed.alias("h"), F.col(vector).alias("v")).orderBy(F.asc_nulls_last("h"), "v").limit(k)
    return [tuple(row.v) for row in start.collect()]


def next_centroids(kept: DataFrame, vector: str, centroids: list[Centroid]) -> list[Centroid]:
    """Means of the assigned vectors, rounded down; a centroid without vectors stays."""
    dims = len(centroids[0])
    assigned = kept.select(F.col(vector).alias("v"), nearest(F.col(vector), centroids)["cluster"].alias("c"))
    columns = assigned.select("c", *(F.col("v")[i].alias(f"s{i}") for i in range(dims)))
    sums = columns.groupBy("c").agg(F.count(F.lit(1)).alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(dims)))
    out = list(centroids)
    for row in sums.collect():  # at most one row per centroid
        out[row.c] = tuple(row[f"s{i}"] // row.n for i in range(dims))
    return out


def fit(kept: DataFrame, key: str, vector: str, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> list[Centroid]:
    """Centroids after ``rounds`` rounds over ``kept``, whose ``vector`` holds integers."""
    centroids = first_centroids(kept, key, vector, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = next_centroids(kept, vector, centroids)
    return centroids


def cluster_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, list[Centroid]]:
    """The kept rows of ``df`` with ``cluster`` and ``distance`` (squared, between integers), and the final centroids."""
    df = drop_names(df, "cluster", "distance")
    ints, best = free_name(df.columns, "ints"), free_name(df.columns, "best")
    kept = df.withColumn(ints, integers(F.col(f"`{vector}`"), dims, scale)).filter(F.col(ints).isNotNull())
    centroids = fit(kept, key, ints, k, rounds, seed)
    if not centroids:
        found = F.lit(None).cast("struct<distance: bigint, cluster: int>")
    else:
        found = nearest(F.col(ints), centroids)
    own = [F.col(f"`{c}`") for c in df.columns]
    out = kept.withColumn(best, found).select(*own, F.col(best)["cluster"].alias("cluster"), F.col(best)["distance"].alias("distance"))
    return out, centroids


def q_centroids(spark, sf_dir):
    """Every kept vector with its cluster, its distance, the inertia of the cluster and of all, and its centroid's hash."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    assigned, centroids = cluster_vectors(vectors)
    assigned = written(assigned.drop("embedding"), "centroids")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = {row.cluster: int(row.s) for row in sums.collect()}  # at most one row per centroid
    fits = lambda n: n if n < 1 << 63 else None
    total = fits(sum(inertia.values()))
    named = [
        (i, fits(inertia[i]), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids)
        if i in inertia
    ]
    per_cluster = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _rounds_sql() -> str:
    """The three rounds as common table expressions c0 (start) to c3, and a0 to a3 (assignments to them)."""

    def assign(r: int) -> str:
        squares = f"list_sum([(v[i] - c.c[i]) * (v[i] - c.c[i]) for i in range(1, {DIMS + 1})])::BIGINT"
        return f"""a{r} AS (
          SELECT row_id, vec_id, v, min(struct_pack(d := d, k := k)) AS best
          FROM (SELECT row_id, vec_id, v, c.k, {squares} AS d FROM kept, c{r} AS c)
          GROUP BY row_id, vec_id, v)"""

    def update(r: int) -> str:
        return f"""m{r} AS (
          SELECT best.k AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{r - 1}, generate_series(1, {DIMS}) AS g(i) GROUP BY 1, 2),
        f{r} AS (
          SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM m{r} GROUP BY k),
        c{r} AS (
          SELECT o.k, coalesce(f.c, o.c) AS c FROM c{r - 1} o LEFT JOIN f{r} f ON f.k = o.k)"""

    parts = [assign(0)]
    for r in range(1, ROUNDS + 1):
        parts += [update(r), assign(r)]
    return ",\n".join(parts)


CENTROIDS_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS row_id, vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS k, v AS c
  FROM kept ORDER BY k LIMIT {CLUSTERS}
),
{_rounds_sql()}
SELECT a.vec_id, a.best.k::INT AS cluster, a.best.d AS distance,
  sum(a.best.d) OVER (PARTITION BY a.best.k)::BIGINT AS cluster_inertia, sum(a.best.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.k = a.best.k
"""
