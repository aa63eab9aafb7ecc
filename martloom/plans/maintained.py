"""Totals that are kept up to date by differences: what touched rows gave before is taken off, what they give now is added.

Sums and counts can be taken back; a greatest value cannot. Where a touched row that held it is gone, the key is marked and
looked up again, so that only such keys ever need rows that were not touched. Descriptions keep their first value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.plans.metrics import REGION

MARK = "_again"


@dataclass(frozen=True)
class Totals:
    """How summary rows add up to one row per key; ``rows`` names the number of rows behind a key."""

    key: tuple[str, ...]
    sums: tuple[str, ...]
    described: tuple[str, ...] = ()
    highest: tuple[str, ...] = ()
    rows: str = "days"

    @property
    def columns(self) -> list[str]:
        return [*self.key, *self.described, *self.highest, self.rows, *self.sums]


CATEGORIES = Totals(("category",), ("total_amount", "total_quantity", "order_count", "sku_count"))
USERS = Totals(("buyer_phone",), ("order_count", "total_amount"), ("buyer_name",), ("dt",))
PRODUCTS = Totals(("product_id",), ("total_quantity", "total_amount"), ("product_name", "category", "brand"))
REGION_BUYERS = Totals((*REGION, "buyer_phone"), ("amount",), rows="orders")


def totals(rows: DataFrame, spec: Totals) -> DataFrame:
    """Totals from all summary rows."""
    return moved(None, None, rows, spec).drop(MARK)


def moved(state: DataFrame | None, old: DataFrame | None, new: DataFrame, spec: Totals) -> DataFrame:
    """``state`` after the touched rows, ``old`` before, have become ``new``; keys to be looked up again are marked.

    One partial aggregate over the three sides: only the state and the touched rows are read.
    """
    sides = [("new", 1, new)]
    if state is not None and old is not None:
        sides += [("state", 1, state), ("old", -1, old)]

    def signed(side: str, sign: int, df: DataFrame) -> DataFrame:
        n = F.col(spec.rows) if side == "state" or spec.rows in df.columns else F.lit(1).cast("bigint")
        own = [F.col(c).alias(f"{side}_{c}") for c in (*spec.described, *spec.highest)]
        return df.select(*spec.key, (n * sign).alias(spec.rows), *[(F.col(c) * sign).alias(c) for c in spec.sums], *own)

    union = signed(*sides[0])
    for side in sides[1:]:
        union = union.unionByName(signed(*side), allowMissingColumns=True)
    types = {f.name: f.dataType for f in new.schema}
    known = set(union.columns)

    def most(side: str, c: str) -> Column:
        return F.max(f"{side}_{c}") if f"{side}_{c}" in known else F.lit(None).cast(types[c])

    summed = union.groupBy(*spec.key).agg(
        F.sum(spec.rows).cast("bigint").alias(spec.rows),
        *[F.sum(c).cast(types[c]).alias(c) for c in spec.sums],
        *[most(side, c).alias(f"{side}_{c}") for c in (*spec.described, *spec.highest) for side in ("state", "old", "new")],
    )
    gone = F.lit(False)
    for c in spec.highest:
        held = F.col(f"old_{c}").eqNullSafe(F.col(f"state_{c}")) & F.col(f"old_{c}").isNotNull()
        gone = gone | (held & F.coalesce(F.col(f"new_{c}") < F.col(f"old_{c}"), F.lit(True)))
    return summed.filter(F.col(spec.rows) > 0).select(
        *spec.key,
        *[F.coalesce(f"state_{c}", f"new_{c}").alias(c) for c in spec.described],
        *[F.greatest(f"state_{c}", f"new_{c}").alias(c) for c in spec.highest],
        spec.rows,
        *spec.sums,
        gone.alias(MARK),
    )


def settled(rows: DataFrame, every: DataFrame, spec: Totals) -> DataFrame:
    """``rows`` with the greatest values of marked keys looked up in ``every`` summary row."""
    marked = rows.filter(MARK).select(*spec.key)
    found = every.join(marked, list(spec.key), "left_semi").groupBy(*spec.key).agg(*[F.max(c).alias(f"_{c}") for c in spec.highest])
    joined = rows.join(found, list(spec.key), "left")
    return joined.withColumns({c: F.when(F.col(MARK), F.col(f"_{c}")).otherwise(F.col(c)) for c in spec.highest}).select(*spec.columns)
