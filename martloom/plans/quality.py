"""Data-quality checks: each returns one small table of counts, where 0 violations means good."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.amounts import MONEY_SUM, ratio_or_null, ratio_or_zero
from martloom.functions.vocabulary import SUBTOTAL, TIER_BOUNDS, value_tier


def violation_counts(broken: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("checked"), F.count_if(broken).alias("violations")]


def _violations(name: str, df: DataFrame, broken: Column) -> DataFrame:
    return df.agg(F.lit(name).alias("check"), *violation_counts(broken))


def blank_counts(columns: Sequence[str]) -> list[Column]:
    """Null and blank values per column."""
    return [F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").alias(c) for c in columns]


def share_and_rank_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("categories"),
        F.sum("percentage").cast("decimal(15,2)").alias("percentage_sum"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
    ]


def wrong_price() -> Column:
    return _differs("avg_price", ratio_or_zero(F.col("total_amount"), F.col("total_quantity")))


def wrong_average() -> Column:
    return _differs("avg_order_amount", ratio_or_null(F.col("total_sales_amount"), F.col("total_order_count")))


def wrong_tier(bounds: tuple[int, int] = TIER_BOUNDS) -> Column:
    return _differs("value_tier", value_tier(F.col("total_monetary"), bounds))


def _differs(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return ~a.eqNullSafe(b)


def wide_vs_items(wide: DataFrame, items: DataFrame) -> DataFrame:
    """Row counts of the wide table and the items; they differ by items repeating a product within an order."""
    counts = wide.agg(F.count(F.lit(1)).alias("wide_rows")).unionByName(
        items.agg(F.count(F.lit(1)).alias("item_rows")), allowMissingColumns=True
    )
    merged = counts.agg(F.max("wide_rows").alias("wide_rows"), F.max("item_rows").alias("item_rows"))
    return merged.withColumn("missing_rows", F.col("item_rows") - F.col("wide_rows"))


def ratios(product_days: DataFrame, trend: DataFrame) -> DataFrame:
    """Stored averages against their definition."""
    return _violations("avg_price", product_days, wrong_price()).unionByName(
        _violations("avg_order_amount", trend, wrong_average())
    )


def share_and_rank(revenue: DataFrame) -> DataFrame:
    """Sum of the shares and the range of ranks; without ties the ranks run from 1 to the number of rows."""
    tied = (F.count(F.lit(1)) - F.countDistinct("rank")).alias("tied_rows")
    return revenue.agg(*share_and_rank_counts(), tied)


def tiers(users: DataFrame, bounds: tuple[int, int] = TIER_BOUNDS) -> DataFrame:
    return _violations("value_tier", users, wrong_tier(bounds))


def required_fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and blank values per column, counted in one pass."""
    counted = df.agg(*blank_counts(columns))
    return counted.unpivot([], list(columns), "column_name", "blank_rows")


def region_rollup(regions: DataFrame) -> DataFrame:
    """Province subtotals against the sum of their cities."""
    is_city = (F.col("city") != SUBTOTAL) & (F.col("district") == SUBTOTAL)
    provinces = regions.groupBy("province").agg(
        F.max(F.when(F.col("city") == SUBTOTAL, F.col("total_amount"))).alias("province_amount"),
        F.sum(F.when(is_city, F.col("total_amount"))).cast(MONEY_SUM).alias("city_amount"),
    )
    return _violations("province_amount", provinces, _differs("province_amount", "city_amount"))


def sku_count(category_days: DataFrame, item_orders: DataFrame) -> DataFrame:
    """Stored product counts against distinct products per category and day."""
    truth = item_orders.groupBy("category", "dt").agg(F.countDistinct("product_id").alias("true_count"))
    joined = category_days.join(truth, ["category", "dt"], "full_outer")
    return _violations("sku_count", joined, _differs("sku_count", "true_count"))


def user_trace(user_days: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Buyer days without detail orders, and detail buyer days missing from the summary."""
    ordered = items.select("order_id").distinct()
    detail = (
        orders.filter(F.coalesce("buyer_phone", F.lit("")) != "")
        .join(ordered, "order_id", "left_semi")
        .select("buyer_phone", F.to_date("created_at").alias("dt"))
        .distinct()
    )
    key = ["buyer_phone", "dt"]
    sides = user_days.select(*key, F.lit(1).alias("_summary"), F.lit(0).alias("_detail")).unionByName(
        detail.select(*key, F.lit(0).alias("_summary"), F.lit(1).alias("_detail"))
    )
    merged = sides.groupBy(*key).agg(F.max("_summary").alias("_summary"), F.max("_detail").alias("_detail"))
    return merged.agg(
        F.count(F.lit(1)).alias("buyer_days"),
        F.count_if(F.col("_detail") == 0).alias("without_orders"),
        F.count_if(F.col("_summary") == 0).alias("without_summary"),
    )
