"""Centroid clustering by built-in expressions on integer vectors.

Vectors are cut to a grid (``floor(scale * x)``), so distances, sums and new
centroids are integers and the same on every run and every partitioning.
Centroids are few (``k``) and enter the plan as literal arrays: ``zip_with``
and ``aggregate`` compute a vector's squared distance to each, ``array_min`` of
(distance, number) structs takes the nearest, the smaller number on ties.  One
partial aggregate a round sums the components of each cluster; its k rows are
all that reaches the driver, and all that is ever shuffled, so neither a hot
cluster nor many copies of one vector weigh on a task.  Vectors are written
once and assigned by narrow scans.

Defined results
* a vector is kept if it has ``dims`` components, none of them null or not finite;
  other rows are not returned;
* the first centroids are the kept vectors with the smallest hashes of
  ``seed:id`` (a null id hashes as the empty text; equal hashes: by vector);
  fewer than ``k`` vectors give fewer centroids;
* repeated rows and ids are vectors of their own;
* an empty cluster keeps its centroid; an empty table gives an empty result;
* arithmetic is in longs: components up to 2**28 of the grid are exact (64 of
  them), beyond that ANSI mode reports an overflow rather than a wrong sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import stored

K = 16
ROUNDS = 3
DIMS = 64
SCALE = 64
SEED = 1


def grid(vector: Column, scale: int) -> Column:
    """Components as integers: floor of ``scale`` times the component as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def finite(vector: Column) -> Column:
    """True where no component is null, NaN or infinite (null for a null vector)."""
    ok = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))
    return F.forall(vector, lambda x: F.coalesce(ok(x), F.lit(False)))


def kept_vectors(rows: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): the vectors with ``dims`` finite components, on the grid."""
    good = (F.size("embedding") == dims) & finite(F.col("embedding"))
    return rows.where(good).select("vec_id", grid(F.col("embedding"), scale).alias("vector"))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The k vectors with the smallest hashes of their ids, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    least = vectors.select(F.sha2(name, 256).alias("h"), "vector").orderBy("h", "vector").limit(k)
    return [r["vector"] for r in least.collect()]


def nearest(vector: Column, centroids: Sequence[Sequence[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid; ties go to the smaller number."""

    def to(number: int, centroid: Sequence[int]) -> Column:
        literal = F.array(*[F.lit(int(c)).cast("long") for c in centroid])
        squares = F.zip_with(vector, literal, lambda a, b: (a - b) * (a - b))
        distance = F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)
        return F.struct(distance.alias("distance"), F.lit(number).alias("cluster"))

    return F.array_min(F.array(*[to(i, c) for i, c in enumerate(centroids)]))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Each centroid at the floor of its vectors' mean; where it has none, as it was."""
    sums = [F.sum(F.col("vector")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    near = vectors.select("vector", nearest(F.col("vector"), centroids)["cluster"].alias("cluster"))
    out = list(centroids)
    for r in near.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # k rows at most
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(len(sums))]
    return out


def clustered(rows: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance, cluster_inertia, inertia) of every kept vector, and the final centroids."""
    vectors = stored(kept_vectors(rows, dims, scale), "cluster-vectors")
    centroids = first_centroids(vectors, k)
    if not centroids:
        empty = vectors.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return empty, []
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    at = vectors.select("vec_id", nearest(F.col("vector"), centroids).alias("at")).select("vec_id", "at.cluster", "at.distance")
    at = stored(at, "cluster-assigned")
    sums = {r["cluster"]: r["total"] for r in at.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # k rows at most
    of_cluster = F.array(*[F.lit(sums.get(i, 0)).cast("long") for i in range(len(centroids))])
    out = at.withColumn("cluster_inertia", F.get(of_cluster, F.col("cluster"))).withColumn("inertia", F.lit(sum(sums.values())).cast("long"))
    return out, centroids


def digests(centroids: list[list[int]]) -> list[str]:
    """SHA-256 of each centroid's components as decimal numbers joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
