"""Centroid clustering whose assignments follow the threshold algorithm (Fagin, Lotem, Naor).

Every dimension has a list of the centroids, sorted by value. For a vector each list is walked outward from the vector's own
value, one centroid a step, so a list's centroids come by growing distance in that dimension. A centroid that comes up
for the first time gets its exact distance. The squared distances of the centroids read last, summed over the lists, bound
every centroid that has not come up; the walk stops when that sum strictly exceeds the best exact distance, or when all
have come up. All vectors of a batch walk together.

Values are whole numbers, so distances, means and results are exact and do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import written

#: Greatest size of a component: 64 squared differences of such add up to less than 2 ** 63.
LIMIT = 1 << 27
#: Vectors that walk together.
TOGETHER = 2048


def whole_numbers(vectors: DataFrame, width: int = 64, scale: int = 256) -> DataFrame:
    """(vec_id, v) of the vectors of exactly `width` components, none null or not finite; v: floor(scale * component).

    A component that leaves the range in which distances are exact raises.
    """
    usable = (F.size("embedding") == width) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    checked = F.transform(scaled, lambda x: F.when(F.abs(x) < LIMIT, F.floor(x).cast("int")).otherwise(F.raise_error(F.lit("component out of range")).cast("int")))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), checked.alias("v"))


class Lists:
    """A sorted list of the centroids per dimension."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable").T
        self.values = np.take_along_axis(centroids.T, self.order, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per vector: number of its nearest centroid (the smaller of equals), squared distance, exact distances taken."""
        (n, width), k = x.shape, len(self.centroids)
        best, label, taken = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64), np.zeros(n, np.int64)
        right = np.stack([np.searchsorted(v, c) for v, c in zip(self.values, x.T, strict=True)], axis=1)
        left = right - 1
        seen = np.zeros((n, k), dtype=bool)
        live, list_of = np.arange(n), np.arange(width)
        far = np.iinfo(np.int64).max
        while len(live):
            at = x[live]
            below = np.where(left >= 0, at - self.values[list_of, np.maximum(left, 0)], far)
            above = np.where(right < k, self.values[list_of, np.minimum(right, k - 1)] - at, far)
            lower = below <= above
            frontier = np.where(lower, below, above)
            came = self.order[list_of, np.where(lower, np.maximum(left, 0), np.minimum(right, k - 1))]
            left, right = left - lower, right + ~lower
            now = np.zeros((len(live), k), dtype=bool)
            now[np.arange(len(live))[:, None], came] = True
            row, centroid = np.nonzero(now & ~seen[live])
            seen[live] |= now
            apart = at[row] - self.centroids[centroid]
            distance = np.full((len(live), k), far)
            distance[row, centroid] = np.einsum("ij,ij->i", apart, apart)
            taken[live] += np.bincount(row, minlength=len(live))
            number = distance.argmin(axis=1)
            least = distance[np.arange(len(live)), number]
            better = (least < best[live]) | ((least == best[live]) & (number < label[live]))
            best[live], label[live] = np.where(better, least, best[live]), np.where(better, number, label[live])
            going = ~((np.einsum("ij,ij->i", frontier, frontier) > best[live]) | seen[live].all(axis=1))
            live, left, right = live[going], left[going], right[going]
        return label, best, taken


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, width)


def _walked(batch: pa.RecordBatch, lists: Lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of a batch with their nearest centroids and distances."""
    x = _matrix(batch.column("v"), lists.centroids.shape[1])
    found = [lists.nearest(x[a : a + TOGETHER])[:2] for a in range(0, len(x), TOGETHER)]
    return x, np.concatenate([f[0] for f in found] or [np.empty(0, np.int64)]), np.concatenate([f[1] for f in found] or [np.empty(0, np.int64)])


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of "seed:vec_id", in that order; equal hashes by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()
    return np.array([r.v for r in rows], dtype=np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid that has vectors goes to the floor of their mean; a task sends one row of sums per centroid."""
    lists, width = Lists(centroids), centroids.shape[1]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros(centroids.shape, dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            x, label, _ = _walked(batch, lists)
            np.add.at(sums, label, x)
            count += np.bincount(label, minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    partial = vectors.select("v").mapInArrow(summed, "cluster long, n long, sums array<long>")
    total = partial.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    out = centroids.copy()
    for row in total.collect():  # at most a row per centroid
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(width)]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    lists = Lists(centroids)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, label, distance = _walked(batch, lists)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(label.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(walked, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance, cluster_inertia, inertia) of every vector of `vectors` (vec_id, v), and the centroids.

    All v are whole numbers of one length. Ties go to the smaller number, a centroid without vectors stays where it is,
    and fewer vectors than k give fewer centroids. Repeated rows are vectors each; one without vec_id takes part and is a
    first centroid only after all others. An empty table gives no rows.
    """
    vectors = written(vectors.select("vec_id", "v"), "whole-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        none = vectors.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return none, centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    rows = written(assigned(vectors, centroids), "clusters")
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # at most a row per centroid
    totals = rows.sparkSession.createDataFrame([(r.cluster, r.cluster_inertia, sum(x.cluster_inertia for x in sums)) for r in sums], "cluster int, cluster_inertia long, inertia long")
    return rows.join(F.broadcast(totals), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia"), centroids


def digests(centroids: np.ndarray) -> list[str]:
    """SHA-256 of each centroid's components, written as whole numbers with commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
