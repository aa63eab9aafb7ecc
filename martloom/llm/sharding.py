"""Sharding by extendible hashing: a directory indexed by hash-prefix bits, in which only oversized buckets split.

The directory has 2 ** depth cells; each points to its bucket, the shortest prefix whose rows fit the byte limit. Cells
that are oversized at the directory's depth get a directory of their own some bits deeper. Only bytes per cell are added up,
so no row moves until its bucket is known.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.shared import written

LIMIT_BYTES = 16 << 20
#: Bits beyond those that an even spread needs, bits that a deeper directory adds, and bits in all: of the key, then of the row.
SPARE_BITS, MORE_BITS, ALL_BITS = 2, 8, 128
_MADE = ("shard", "shard_bytes", "shard_rows")


def _level(cells: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """Cells (cell, bytes, n) of `depth` bits with their bucket: the shortest prefix that fits; null if the cell is too large."""
    nodes = cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(above), F.lit(depth))).alias("bits")).withColumn("shard", F.expr("substring(cell, 1, bits)"))
    sums = nodes.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
    bucket = nodes.select("cell", "shard").join(fits, "shard").groupBy("cell").agg(F.min(F.struct(F.length("shard").alias("bits"), "shard", "shard_bytes", "shard_rows")).alias("b"))
    return cells.select("cell").join(bucket, "cell", "left").select("cell", *[f"b.{c}" for c in _MADE])


def directory(keyed: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """(depth, cells with their buckets) of each directory, the first over all rows of `keyed` (bits, bytes)."""
    total = keyed.agg(F.sum("bytes")).first()[0] or 0
    depth, above, out = min(ALL_BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total / limit))))), 0, []
    while True:
        cells = keyed.groupBy(F.substring("bits", 1, depth).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
        level = written(_level(written(cells, "cells"), above, depth, limit), "directory")
        out.append((depth, level))
        full = level.where("shard is null")
        if depth == ALL_BITS or full.isEmpty():
            return out
        keyed = keyed.join(full.select("cell"), F.substring("bits", 1, depth) == F.col("cell"), "left_semi")
        above, depth = depth + 1, min(ALL_BITS, depth + MORE_BITS)


def sharded(docs: DataFrame, key: str = "doc_id", limit: int = LIMIT_BYTES) -> DataFrame:
    """Columns of `docs` with shard (its hash prefix as text of 0 and 1, empty for the one shard of a small table), shard_bytes and
    shard_rows. A shard's texts have `limit` UTF-8 bytes at most, unless it is a single larger document.

    A null text has no bytes; a null key is a key like any other. Rows of one key are told apart by a hash of the whole row. Rows
    equal in every column beyond the limit are numbered within their bucket and go on in shards named by prefix,
    `+` and number. An empty table gives no rows. Columns named as the made ones are replaced.
    """
    docs = docs.drop(*_MADE)
    names = [F.col(f"`{c}`") for c in docs.columns]
    # Maps have no hash; their text has.
    hashed = [F.to_json(F.struct(F.map_entries(n) if isinstance(f.dataType, T.MapType) else n)) if "map<" in f.dataType.simpleString() else n for n, f in zip(names, docs.schema, strict=True)]
    bits = F.concat(F.lpad(F.bin(F.xxhash64(F.col(key))), 64, "0"), F.lpad(F.bin(F.xxhash64(*hashed)), 64, "0"))
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    keyed = docs.select(F.struct(*names).alias("row"), bits.alias("bits"), size.alias("bytes"))
    levels = directory(written(keyed.select("bits", "bytes"), "keys"), limit)
    out, rest = None, keyed
    for i, (depth, level) in enumerate(levels):
        placed = rest.withColumn("cell", F.substring("bits", 1, depth)).join(level, "cell")
        done = placed.where("shard is not null").select("row.*", *_MADE)
        out = done if out is None else out.union(done)
        if i + 1 == len(levels):
            if not level.where("shard is null").isEmpty():
                out = out.union(_copies(placed.where("shard is null"), limit))
        else:
            rest = placed.where("shard is null").select("row", "bits", "bytes")
    return out


def _copies(rows: DataFrame, limit: int) -> DataFrame:
    """Equal rows too many for one shard, by number: counted before they are shuffled, then written out again."""
    counted = rows.groupBy("row", "bits", "bytes").agg(F.count(F.lit(1)).alias("n")).withColumn("each", F.greatest(F.lit(1), F.floor(limit / F.col("bytes"))))
    single = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i")).withColumn("part", F.floor(F.col("i") / F.col("each")))
    inside = F.least(F.col("each"), F.col("n") - F.col("part") * F.col("each"))
    return single.select("row.*", F.concat("bits", F.lit("+"), "part").alias("shard"), (inside * F.col("bytes")).alias("shard_bytes"), inside.alias("shard_rows"))


def write_shards(docs: DataFrame, folder: str, key: str = "doc_id", limit: int = LIMIT_BYTES) -> None:
    """One folder of Parquet files per shard below `folder`; a shard is written by one task."""
    sharded(docs, key, limit).repartition("shard").write.partitionBy("shard").parquet(folder)
