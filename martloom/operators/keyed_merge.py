"""Keyed writes as folds over change rows.

A change row is a full row plus ``seq``, its place in arrival order. Merging is associative: folding stored rows with
new ones gives the same result as folding all changes at once, so tables can be kept as appended changes, merged on
read and compacted whenever it suits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.operators.order_join import splittable

FIRST, LAST = "first_seq", "last_seq"


def as_changes(rows: DataFrame, seq: Column | str = "seq") -> DataFrame:
    """Rows of one batch, each standing for itself."""
    place = F.col(seq) if isinstance(seq, str) else seq
    out = rows.withColumns({FIRST: place, LAST: place})
    return out.drop(seq) if isinstance(seq, str) else out


def merge_changes(
    changes: DataFrame,
    key: Sequence[str],
    frozen: Sequence[str],
    live: Sequence[str],
    keep_seq: bool = False,
    added: Sequence[str] = (),
) -> DataFrame:
    """One row per key: ``frozen`` columns from the earliest change, ``live`` columns from the latest, ``added`` summed.

    All are partial aggregates, so a hot key is folded where its rows lie and one row per task is shuffled.
    """
    picks = []
    if frozen:
        picks.append(F.min_by(F.struct(*frozen), FIRST).alias("_frozen"))
    if live:
        picks.append(F.max_by(F.struct(*live), LAST).alias("_live"))
    if keep_seq:
        picks += [F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST)]
    types = {f.name: f.dataType for f in changes.schema}
    picks += [F.sum(c).cast(types[c]).alias(c) for c in added]
    merged = changes.groupBy(*key).agg(*picks)
    parts = [f"_{side}.{c}" for side, names in (("frozen", frozen), ("live", live)) for c in names]
    return merged.select(*key, *parts, *added, *([FIRST, LAST] if keep_seq else []))


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key.

    The rank limit is pushed below the shuffle, so at most one row per key leaves a task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def insert_absent(
    state: DataFrame | None, rows: DataFrame, key: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Rows to add: the first of each key that ``state`` does not hold."""
    fresh = first_per_key(rows, key, order)
    return fresh if state is None else fresh.join(state.select(*key), list(key), "left_anti")


def append_groups(state: DataFrame | None, rows: DataFrame, group: str, seq: str | None = None) -> DataFrame:
    """Rows to append: those of groups ``state`` does not know.

    With ``seq``, a group that came more than once in ``rows`` keeps only the rows of its first message.
    """
    fresh = rows
    if state is not None:
        fresh = fresh.join(splittable(state.select(group).distinct(), group), group, "left_anti")
    if seq is not None:
        first = rows.groupBy(group).agg(F.min(seq).alias("_first"))
        fresh = fresh.join(splittable(first, group), group).filter(F.col(seq) == F.col("_first")).drop("_first")
    return fresh


#: Part of a message that holds a whole order.
WHOLE_ORDER = ""


def judged_parts(offered: DataFrame, stored: DataFrame) -> DataFrame:
    """(order_id, part, seq, fits, known) of the first message of each part in ``offered`` (order_id, part, seq).

    A message without part is the whole order. The first message with items, stored or offered, decides whether an order
    comes whole or in parts; messages of the other kind do not fit. A part in ``stored`` (order_id, part) is known.
    """
    firsts = offered.groupBy("order_id", "part").agg(F.min("seq").alias("seq"))
    parts = stored.select("order_id", "part").distinct()
    whole = F.col("part") == WHOLE_ORDER
    before = parts.groupBy("order_id").agg(F.bool_or(whole).alias("was_whole"))
    kinds = firsts.groupBy("order_id").agg(F.min_by(whole, "seq").alias("comes_whole")).join(before, "order_id", "left")
    kinds = kinds.select("order_id", F.coalesce("was_whole", "comes_whole").alias("whole"))
    known = parts.withColumn("known", F.lit(True))
    return (
        firsts.join(kinds, "order_id")
        .join(known, ["order_id", "part"], "left")
        .select("order_id", "part", "seq", (whole == F.col("whole")).alias("fits"), F.coalesce("known", F.lit(False)).alias("known"))
    )


def upsert_metrics(
    state: DataFrame, new: DataFrame, key: Sequence[str], frozen: Sequence[str], live: Sequence[str]
) -> DataFrame:
    """Stored summary rows with the measures of ``new``; descriptive columns keep their stored value.

    Both sides hold a key once. Keys only in ``state`` stay, keys only in ``new`` are added.
    """
    o, n = state.alias("o"), new.alias("n")
    matched = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key])
    is_new = F.col(f"n.{key[0]}").isNotNull()
    is_old = F.col(f"o.{key[0]}").isNotNull()
    return o.join(n, matched, "full_outer").select(
        *[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in key],
        *[F.when(is_old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in frozen],
        *[F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in live],
    )
