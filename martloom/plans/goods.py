"""Goods dimension: one row per sellable unit and validity period, built from the product table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.amounts import MONEY
from martloom.functions.vocabulary import OPEN_END
from martloom.operators.order_join import splittable
from martloom.plans.detail import load_time

DESCRIBED = [
    "product_id",
    "spu_name",
    "sku_name",
    "brand_name",
    "first_category_name",
    "second_category_name",
    "price_min",
    "price_max",
    "sku_price",
    "price_delta",
    "variant_suffix",
    "image_url",
    "keywords",
]


def goods_info(products: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Current goods. Units sharing a name form one product line with a common price range.

    The range is a plain aggregate joined back, not a window, so a name shared by a third of all units is folded where
    the rows lie and the hot unit side of the join can be split.
    """
    price = F.col("price")
    lines = products.groupBy("name").agg(F.min(price).alias("price_min"), F.max(price).alias("price_max"))
    suffix = F.concat_ws(" ", F.nullif("brand", F.lit("")), F.nullif("category", F.lit("")))
    words = F.when(F.coalesce("keywords", F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split("keywords", ",")
    )
    return products.join(splittable(lines, "name"), "name").select(
        F.col("product_id").alias("sku_id"),
        "product_id",
        F.col("name").alias("spu_name"),
        F.concat_ws(" ", "name", suffix).alias("sku_name"),
        F.col("brand").alias("brand_name"),
        F.col("category").alias("first_category_name"),
        F.col("sub_category").alias("second_category_name"),
        "price_min",
        "price_max",
        price.alias("sku_price"),
        (price - F.col("price_min")).cast(MONEY).alias("price_delta"),
        suffix.alias("variant_suffix"),
        "image_url",
        words.alias("keywords"),
        F.to_date("created_at").alias("start_date"),
        F.lit(OPEN_END).cast("date").alias("end_date"),
        F.lit(1).alias("is_active"),
        F.col("created_at").alias("dw_create_time"),
        F.col("created_at").alias("dw_update_time"),
        *carried,
    )


VERSIONED = ("name", "brand", "category", "sub_category", "price", "image_url", "keywords")


def goods_history(versions: DataFrame, time: str = "created_at", order: str | None = None) -> DataFrame:
    """Goods of all versions, each with the days it was valid: from its own day to the day before the next version's.

    ``versions`` has a row per product and report, with the time it came into force. The last report of a day counts
    (``order`` breaks ties); a day that changes nothing belongs to the version before it. A unit's last version is open and
    active. Reports are folded to one row per unit and day before they are ordered, so a unit reported a third of all times
    is a row per day. The price range of a line spans all versions under its name.
    """
    last = F.struct(time, *([order] if order else []))
    fields = F.struct(*VERSIONED, F.col(time).alias("created_at"))
    daily = versions.groupBy("product_id", F.to_date(time).alias("_from")).agg(F.max_by(fields, last).alias("_v"))
    w = Window.partitionBy("product_id").orderBy("_from")
    same = F.struct(*[F.col(f"_v.{c}") for c in VERSIONED])
    changed = daily.withColumn("_before", F.lag(same).over(w)).filter(~F.col("_before").eqNullSafe(same) | F.col("_before").isNull())
    until = F.date_sub(F.lead("_from").over(w), 1)
    rows = changed.withColumn("_until", until).select("product_id", "_from", "_until", "_v.*")
    still = F.col("_until").isNull()
    # The start is the day already at hand: read from `created_at` it would make the versions a wider table here than for
    # the price range, and Spark would shuffle them once for each.
    return goods_info(rows, carried=("_from", "_until")).withColumns(
        {
            "start_date": F.col("_from"),
            "end_date": F.coalesce("_until", F.lit(OPEN_END).cast("date")),
            "is_active": F.when(still, 1).otherwise(0),
        }
    ).drop("_from", "_until")


def refreshed_goods(state: DataFrame, current: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Stored goods brought up to ``current``: a changed unit's open row is closed and a new one opened.

    A unit that is gone is closed as well. Both sides of the join hold a unit once.
    """
    stamp = load_time(as_of)
    today = F.to_date(stamp)
    closed = state.filter(F.col("is_active") != 1)
    was = state.filter(F.col("is_active") == 1)
    o, n = was.alias("o"), current.alias("n")
    pairs = o.join(n, F.col("o.sku_id") == F.col("n.sku_id"), "full_outer").withColumn(
        "_same",
        F.struct(*[F.col(f"o.{c}") for c in DESCRIBED]).eqNullSafe(F.struct(*[F.col(f"n.{c}") for c in DESCRIBED])),
    )
    has_old, has_new = F.col("o.sku_id").isNotNull(), F.col("n.sku_id").isNotNull()
    changed = has_old & has_new & ~F.col("_same")
    ended = {"end_date": F.date_sub(today, 1), "is_active": F.lit(0), "dw_update_time": stamp}
    opened = {"start_date": today, "dw_create_time": stamp, "dw_update_time": stamp}

    def row(side: str, **overrides: Column) -> Column:
        return F.struct(*[overrides.get(c, F.col(f"{side}.{c}")).alias(c) for c in was.columns])

    rows = F.array(
        F.when(has_old & has_new & F.col("_same"), row("o")),
        F.when(has_old & (~has_new | ~F.col("_same")), row("o", **ended)),
        F.when(changed, row("n", **opened)),
        F.when(has_new & ~has_old, row("n")),
    )
    merged = pairs.select(F.explode(F.array_compact(rows)).alias("row")).select("row.*")
    return closed.unionByName(merged)
