"""Joining items with their order and product."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def created_or(as_of: datetime | Column | None = None) -> Column:
    """Time of the order; an item without an order takes the run's time (NULL when none is given)."""
    created = F.col("created_at")
    if as_of is None:
        return created
    return F.coalesce(created, as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp"))


def order_day(as_of: datetime | Column | None = None) -> Column:
    return F.to_date(created_or(as_of))


def items_with_orders(items: DataFrame, orders: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Every item with its order's columns and ``dt``.

    ``orders`` has one row per order, so only the item side can hold a hot key and a split of that side is exact: the
    adaptive skew join does it for a left join. A small order side is broadcast by Spark's own size check.
    """
    repeated = [c for c in orders.columns if c in items.columns and c != "order_id"]
    return items.join(orders.drop(*repeated), "order_id", "left").withColumn("dt", order_day(as_of))


def defaulted_orphans(joined: DataFrame, columns: list[str]) -> DataFrame:
    """Fill the order columns of items whose order is missing: texts '' and amounts 0."""
    types = {f.name: f.dataType for f in joined.schema}
    filled = {}
    for name in columns:
        kind = types[name]
        if isinstance(kind, T.StringType):
            filled[name] = F.coalesce(F.col(name), F.lit(""))
        elif isinstance(kind, T.NumericType):
            filled[name] = F.coalesce(F.col(name), F.lit(0).cast(kind))
    return joined.withColumns(filled)


def splittable(df: DataFrame, key: str) -> DataFrame:
    """An aggregate about to be joined back by its text key, re-keyed so that the join shuffles it once more.

    An aggregate is already placed by its key and would go into the join as it is; the adaptive skew join can only
    split the other side's hot keys when both sides come straight from a shuffle.
    """
    return df.withColumn(key, F.concat(F.col(key), F.lit("")))


def with_product(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with the product table's descriptive fields, or the item's own snapshot when the product is unknown.

    ``products`` has one row per product; a best seller is hot only on the item side.
    """
    fields = {"product_name": "name", "brand": "brand", "category": "category", "sub_category": "sub_category"}
    known = products.select("product_id", *[F.col(src).alias(f"known_{dst}") for dst, src in fields.items()])
    return (
        items.join(splittable(known, "product_id"), "product_id", "left")
        .withColumns({dst: F.coalesce(F.col(f"known_{dst}"), F.col(dst)) for dst in fields})
        .drop(*[f"known_{dst}" for dst in fields])
    )
