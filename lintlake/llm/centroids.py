"""Centroid clustering of integer vectors by expressions that stay in the JVM.

Method
    Components become integers, so every step is exact and the same on any partitioning.
    The centroids are literal arrays in the plan: `zip_with` and `aggregate` give the
    squared distance to each of them, `array_min` over (distance, number) structs chooses
    the nearest, ties going to the smaller number. New centroids come from one grouping by
    cluster with a plain sum per component, which code generation turns into one loop.

Scale
    Vectors are made integers once and handed over; a round reads them and shuffles one row
    of sums per task and cluster (partial aggregation), whatever the size of a cluster or
    the number of equal vectors. The driver sees `k` rows a round, and k centroids.

Edge cases
    Vectors that are null, of another length, or hold null or non-finite components are left
    out. Integers are bounded at `LIMIT` in size, so that distances fit a long; floor(1024 x)
    reaches it at |x| of 131,072. Equal ids are rows of their own; where they tie for a
    starting place, the lesser vector goes first. A null id hashes as empty text. With fewer
    than k vectors there are as many centroids as vectors; a cluster that loses all vectors
    keeps its centroid. The sum of all distances that would exceed a long is given as the
    largest long. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import handed_over

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
LIMIT = 1 << 27
LARGEST = (1 << 63) - 1

Centroid = tuple[int, ...]


def integer_vectors(
    embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(vec_id, v): the kept vectors with components floor(scale * x) as array<long>."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    bounded = lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.least(
        F.lit(float(LIMIT)), F.greatest(F.lit(-float(LIMIT)), x * F.lit(float(scale)))))))
    kept = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("x")).where(
        (F.size("x") == dims) & F.forall("x", finite)
    )
    return kept.select("vec_id", F.transform("x", bounded).alias("v"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = 3) -> list[Centroid]:
    """The k vectors with the smallest SHA-256 of `seed:vec_id`, in that order."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = vectors.select(place.alias("place"), "v").orderBy("place", "v").limit(k).collect()
    return [tuple(r.v) for r in found]


def _literal(centroid: Centroid) -> Column:
    return F.expr(f"array({', '.join(f'{c}L' for c in centroid)})")


def _distance(vector: Column, centroid: Centroid) -> Column:
    squares = F.zip_with(vector, _literal(centroid), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda total, s: total + s)


def assigned(vectors: DataFrame, centroids: list[Centroid]) -> DataFrame:
    """`vectors` with `cluster` and `distance`, the squared distance to the nearest centroid."""
    choices = [
        F.struct(_distance(F.col("v"), c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)
    ]
    nearest = vectors.withColumn("nearest", F.array_min(F.array(*choices)))
    return nearest.select(*vectors.columns, F.col("nearest.cluster").alias("cluster"), F.col("nearest.distance").alias("distance"))


def moved(vectors: DataFrame, centroids: list[Centroid]) -> list[Centroid]:
    """One round: every cluster that holds vectors moves to floor(sum / count) of each component."""
    dims = len(centroids[0])
    sums = [F.expr(f"sum(v[{i}]) AS s{i}") for i in range(dims)]
    found = assigned(vectors, centroids).groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()
    out = list(centroids)
    for row in found:
        out[row["cluster"]] = tuple(row[f"s{i}"] // row["n"] for i in range(dims))
    return out


def fit(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> list[Centroid]:
    """The centroids after `rounds` rounds; none if there are no vectors."""
    centroids = first_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids)
    return centroids


def centroid_digest(centroid: Centroid) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = 3,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256), one row per kept vector."""
    vectors = handed_over(integer_vectors(embeddings, dims, scale, vec_id, vector), "integer-vectors")
    centroids = fit(vectors, k, rounds, seed)
    if not centroids:
        return vectors.selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "v AS centroid",
            "'' AS centroid_sha256",
        )
    placed = handed_over(assigned(vectors, centroids).drop("v"), "clusters")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    inertia = {row["cluster"]: int(row["sum"]) for row in sums}

    def by_cluster(value) -> Column:
        """A literal for each cluster that has vectors."""
        return reduce(lambda rest, c: F.when(F.col("cluster") == c, value(c)).otherwise(rest), inertia, F.lit(None))

    long = lambda n: F.lit(min(n, LARGEST)).cast("long")
    return placed.select(
        "vec_id", "cluster", "distance",
        by_cluster(lambda c: long(inertia[c])).alias("cluster_inertia"),
        long(sum(inertia.values())).alias("inertia"),
        by_cluster(lambda c: _literal(centroids[c])).alias("centroid"),
        by_cluster(lambda c: F.lit(centroid_digest(centroids[c]))).alias("centroid_sha256"),
    )
