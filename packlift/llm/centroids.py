"""Centroid clustering by Orchard search.

Every centroid keeps the other centroids sorted by their distance from it. A
vector starts at one centroid and walks that centroid's list; a closer centroid
(equally close: a smaller number) becomes the current one and its list is
walked instead. Centroids met before are marked and skipped. By the triangle
inequality a list can be left once it is strictly beyond twice the current
distance: what follows cannot come nearer, nor tie.

Vectors are integers (``floor(scale * x)``), so distances and means are exact
and the clusters do not depend on partitioning. A round is one pass over the
stored integers: each task emits one partial sum per centroid, Spark adds them
per (cluster, component), and the driver holds no more than k centroids.

Defined cases: a vector is kept if it has exactly ``dims`` components and none
is null or non-finite (a null vector is not kept); repeated ids and repeated
vectors count as rows of their own; a null id is kept (its start key is that of
an empty id); equal start keys are ordered by components; with fewer than k
kept vectors there are as many centroids; without any the result is empty. A
component so large that a squared distance may leave 64 bits is refused by an
error, not wrapped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import stored

SCALE = 1024
PARTIAL = "cluster int, n bigint, sums array<decimal(38,0)>"


def kept_vectors(df: DataFrame, dims: int, scale: int = SCALE, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """``vec_id, v``: the usable vectors as integers ``floor(scale * x)``, x as double."""
    v = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    usable = (F.size(F.col(vector_column)) == dims) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    limit = _component_limit(dims)

    def component(x):
        y = F.floor(F.lit(float(scale)) * x)
        return F.when(F.abs(F.lit(float(scale)) * x) < float(limit), y).otherwise(
            F.raise_error(F.lit(f"a component reaches {limit} after scaling by {scale}"))).cast("bigint")

    return (df.where(F.coalesce(usable, F.lit(False)))
            .select(F.col(id_column).alias("vec_id"), F.transform(v, component).alias("v")))


def _component_limit(dims: int) -> int:
    """The largest power of two under which squared distances of ``dims`` components stay below 2^60."""
    bits = 30
    while dims * (2 << bits) ** 2 >= 1 << 60:
        bits -= 1
    return 1 << bits


class Orchard:
    """The neighbour lists of k centroids and the search over them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        gaps = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
        order = np.empty((k, max(k - 1, 0)), dtype=np.int64)
        for c in range(k):
            near = np.lexsort((np.arange(k), gaps[c]))
            order[c] = near[near != c]
        self.neighbours = order
        self.gaps = np.take_along_axis(gaps, order, axis=1) if k > 1 else np.empty((k, 0), dtype=np.int64)

    def _distance(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        return ((x - self.centroids[c]) ** 2).sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row of ``x``: number and squared distance of its nearest centroid (ties: smaller number).

        All rows walk their own lists at once; a row leaves when its list ends or
        passes twice its distance (four times, squared).
        """
        n, k = len(x), len(self.centroids)
        at = np.zeros(n, dtype=np.int64)
        best = self._distance(x, at)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, 0] = True
        step = np.zeros(n, dtype=np.int64)
        walking = np.arange(n)
        while len(walking):
            walking = walking[step[walking] < k - 1]
            c, s = at[walking], step[walking]
            near = self.gaps[c, s] <= 4 * best[walking]
            walking, c, s = walking[near], c[near], s[near]
            other = self.neighbours[c, s]
            step[walking] += 1
            new = ~seen[walking, other]
            rows, other = walking[new], other[new]
            seen[rows, other] = True
            d = self._distance(x[rows], other)
            closer = (d < best[rows]) | ((d == best[rows]) & (other < at[rows]))
            rows, other, d = rows[closer], other[closer], d[closer]
            at[rows], best[rows], step[rows] = other, d, 0
        return at, best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def _partial_sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row per task and centroid: the sum of the vectors that it draws."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        sums, counts = [[0] * dims for _ in range(k)], [0] * k
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            at, _ = search.nearest(x)
            for c in np.unique(at):
                mine = x[at == c]
                counts[c] += len(mine)
                sums[c] = [a + b for a, b in zip(sums[c], mine.sum(axis=0).tolist())]
        got = [c for c in range(k) if counts[c]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(got, pa.int32()), pa.array([counts[c] for c in got], pa.int64()),
             pa.array([[Decimal(s) for s in sums[c]] for c in got], pa.list_(pa.decimal128(38, 0)))],
            names=["cluster", "n", "sums"])

    return vectors.select("v").mapInArrow(run, PARTIAL)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floors of the clusters' exact means; a centroid without vectors stays."""
    total = (_partial_sums(vectors, centroids)
             .select("cluster", "n", F.posexplode("sums").alias("pos", "s"))
             .groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    out = centroids.copy()
    for row in total.collect():      # at most k x dims rows
        out[row["cluster"], row["pos"]] = int(row["s"]) // row["n"]
    return out


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    dims = centroids.shape[1]
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for batch in batches:
            at, best = search.nearest(_matrix(batch.column(1), dims))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int32()), pa.array(best, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(run, f"vec_id {id_type}, cluster int, distance bigint")


def start_centroids(vectors: DataFrame, k: int, prefix: str) -> list[list[int]]:
    """The k vectors of smallest sha256 of ``<prefix><vec_id>``, in that order."""
    key = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [row["v"] for row in vectors.select(key.alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def cluster(df: DataFrame, k: int, rounds: int, dims: int, scale: int = SCALE, prefix: str = "3:",
            id_column: str = "vec_id", vector_column: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` (squared) per kept vector, and the final centroids."""
    vectors = stored(kept_vectors(df, dims, scale, id_column, vector_column), "vectors")
    start = start_centroids(vectors, k, prefix)
    if not start:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    centroids = np.array(start, dtype=np.int64)
    for _ in range(rounds):
        centroids = _moved(vectors, centroids)
    return stored(_assigned(vectors, centroids), "clusters"), centroids.tolist()


def centroid_clusters(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64) -> DataFrame:
    """The clusters with their inertia and their centroid's digest, one row per kept vector."""
    assigned, centroids = cluster(df, k, rounds, dims)
    spark = df.sparkSession
    inertia = {row["cluster"]: int(row["s"]) for row in
               assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, inertia.get(c, 0), sum(inertia.values()),
             hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    totals = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return (assigned.join(F.broadcast(totals), "cluster")     # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
