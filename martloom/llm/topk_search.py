"""Exact top-k search by inner product, by no-random-access aggregation (after Fagin, Lotem, Naor, "Optimal aggregation
algorithms for middleware").

Vectors and queries are dealt to a grid of blocks; a task has one block of each. In it, every dimension is a list of its
vectors, sorted by value, read from the top for positive query components and from the bottom for negative ones. After
each stretch of reading, a vector's score lies between a lower bound (unread components at the worst value of the list)
and an upper bound (unread ones at the last value read). Vectors whose upper bound is below the k-th best lower bound are
out. A query ends when few are left, whose scores are resolved in full; the others read on, over the vectors that are
still in for one of them, until the lists end, where both bounds are the score. Bounds of many queries are computed
together as matrix products. The k best of every block are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shared import partitions, written

VECTORS, QUERIES, TOGETHER = 16_384, 8_192, 128
#: Parts of the lists read before bounds are looked at, the last being all of them, and the part of a block that may be left
#: to resolve.
STRETCHES, FEW = (0.05, 0.3, 0.7, 1.0), 0.02


def _kind(x: np.ndarray, q: np.ndarray) -> type:
    """The fastest number type in which all sums are whole numbers without rounding; scores beyond 64 bits raise."""
    most = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0)) * max(1, x.shape[1])
    if most >= 1 << 62:
        raise ValueError("scores do not fit 64 bits")
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Block:
    """Sorted lists of a block of vectors. `ended` counts the queries that ended after each stretch, `rows` the bounds computed."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, kind: type) -> None:
        self.ids, self.x = ids, x.astype(kind)
        order = np.argsort(self.x, axis=0, kind="stable")
        self.rank = np.empty(order.shape, dtype=np.int32)
        np.put_along_axis(self.rank, order.astype(np.int64), np.arange(len(ids), dtype=np.int32)[:, None], axis=0)
        self.ordered = np.take_along_axis(self.x, order, axis=0)
        self.ended, self.rows = [0] * len(STRETCHES), 0

    def _bounds(self, depth: int, inside: np.ndarray) -> tuple[np.ndarray, ...]:
        """Components after `depth` places of each list were read from the top and from the bottom: as read, or at best and worst."""
        x, rank, n = self.x[inside], self.rank[inside], len(self.ids)
        read_top, read_low = rank >= n - depth, rank < depth
        last_top, last_low = self.ordered[n - depth], self.ordered[depth - 1]
        return np.where(read_top, x, last_top), np.where(read_low, x, last_low), np.where(read_top, x, self.ordered[0]), np.where(read_low, x, self.ordered[-1])

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        q = q.astype(self.x.dtype)
        n = len(self.ids)
        worst = np.iinfo(np.int64).min // 4 if self.x.dtype.kind == "i" else -np.inf
        out: list = [None] * len(q)
        still, inside = np.arange(len(q)), np.arange(n)
        for turn, part in enumerate(STRETCHES):
            depth = min(n, max(1, int(np.ceil(part * n))))
            up, down = np.maximum(q[still], 0), np.minimum(q[still], 0)
            top, low, floor, ceiling = self._bounds(depth, inside)
            upper = up @ top.T + down @ low.T
            lower = upper.copy() if depth == n else up @ floor.T + down @ ceiling.T
            self.rows += upper.size
            own = query_ids[still][:, None] == self.ids[inside][None, :]
            upper[own] = lower[own] = worst
            least = np.partition(lower, -k, axis=1)[:, -k] if len(inside) > k else np.full(len(still), worst)
            left = (upper >= least[:, None]) & ~own
            done = (left.sum(axis=1) <= max(4 * k, FEW * n)) | (depth == n)
            for i in np.flatnonzero(done):
                keep = inside[left[i]]
                scores = upper[i, left[i]] if depth == n else self.x[keep] @ q[still[i]]
                out[still[i]] = _best(self.ids[keep], scores, k)
            self.ended[turn] += int(done.sum())
            if done.all():
                break
            still, left = still[~done], left[~done]
            inside = inside[left.any(axis=0)]
        return out


def _searched(table: pa.Table, k: int) -> pa.Table:
    is_query = np.asarray(table["is_query"].combine_chunks())
    ids = np.asarray(table["vec_id"].combine_chunks())
    lists = table["v"].combine_chunks()
    x = np.asarray(lists.flatten()).reshape(len(ids), -1)
    vectors, queries = x[~is_query], x[is_query]
    rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(vectors) and len(queries):
        block, query_ids = Block(ids[~is_query], vectors, _kind(vectors, queries)), ids[is_query]
        for a in range(0, len(queries), TOGETHER):
            some = query_ids[a : a + TOGETHER]
            for name, (found, scores) in zip(some, block.search(some, queries[a : a + TOGETHER], k), strict=True):
                rows.append((np.full(len(found), name), found, scores.astype(np.int64)))
    columns = [np.concatenate(c) if rows else np.empty(0, np.int64) for c in (zip(*rows, strict=True) if rows else ((), (), ()))]
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for every query its k best other vectors by inner product, ties to the smaller vec_id.

    Both sides have vec_id and v, an array of whole numbers; rows with a null there, or a null inside v, take no part. A vector's own
    vec_id is never among its results. Vectors of another length have no score. Repeated query rows count once,
    repeated vectors each. Fewer than k others: all of them. Scores beyond 64 bits raise. Empty tables give no rows.
    """
    usable = "vec_id is not null and v is not null and not exists(v, x -> x is null) and size(v) > 0"
    vectors = vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    queries = queries.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), "v").dropDuplicates()
    vectors, queries = written(vectors, "vectors"), written(queries, "queries")
    rows, asked = max(1, -(-vectors.count() // VECTORS)), queries.count()
    # A small table's queries are dealt more finely, so that there is work for all partitions.
    columns = max(1, -(-asked // QUERIES), min(-(-asked // (2 * TOGETHER)), -(-partitions(vectors.sparkSession) // rows)))
    row, column = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(rows)), F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(columns))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = vectors.select(F.lit(False).alias("is_query"), "vec_id", "v", row.alias("row"), every(columns).alias("column")).union(
        queries.select(F.lit(True), "vec_id", "v", every(rows), column)
    )

    def searched(table: pa.Table) -> pa.Table:
        return _searched(table, k)

    found = dealt.groupBy("row", "column", F.size("v").alias("width")).applyInArrow(searched, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def whole_numbers(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """`embedding` as v: floor(scale * x) of every component as double; null where a component is null or not finite."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.select("vec_id", F.when(~odd, v).alias("v"))
