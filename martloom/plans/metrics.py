"""Metric layer: category revenue, daily trend, buyer value, product ranking and regional sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.amounts import MONEY_SUM, count_sum, money_sum, percent, ratio_or_null
from martloom.functions.vocabulary import SUBTOTAL, TIER_BOUNDS, value_tier
from martloom.operators.ranking import rank_by

REGION = ("province", "city", "district")


def _with_share_and_rank(totals: DataFrame, dense: bool) -> DataFrame:
    """Share of the grand total and rank. A shop has a short list of categories, so windows over all of them are small
    and, unlike joining a total back, need the sales only once."""
    everything = Window.partitionBy()
    by_amount = everything.orderBy(F.desc("total_amount"))
    grand = F.sum("total_amount").over(everything).cast(MONEY_SUM)
    columns = {
        "percentage": percent(F.col("total_amount"), grand),
        "rank": F.rank().over(by_amount).cast("bigint"),
    }
    if dense:
        columns["dense_rank"] = F.dense_rank().over(by_amount).cast("bigint")
    return totals.withColumns(columns)


def category_revenue(category_days: DataFrame, dense: bool = False) -> DataFrame:
    """Totals, share of all sales and rank per category. Order and product counts are sums of daily counts."""
    totals = category_days.groupBy("category").agg(
        money_sum(F.col("total_amount")).alias("total_amount"),
        count_sum(F.col("total_quantity")).alias("total_quantity"),
        count_sum(F.col("order_count")).alias("order_count"),
        count_sum(F.col("sku_count")).alias("sku_count"),
    )
    ranked = _with_share_and_rank(totals, dense)
    return ranked.select(
        "category",
        "total_amount",
        "total_quantity",
        "order_count",
        "sku_count",
        "percentage",
        "rank",
        *(["dense_rank"] if dense else []),
    )


def category_revenue_exact(items: DataFrame) -> DataFrame:
    """As above, with orders and products counted once over all days."""
    totals = items.groupBy("category").agg(
        money_sum(F.col("subtotal")).alias("total_amount"),
        count_sum(F.col("quantity")).alias("total_quantity"),
        F.countDistinct("order_id").alias("order_count"),
        F.countDistinct("product_id").alias("sku_count"),
    )
    return _with_share_and_rank(totals, dense=False).select(
        "category", "total_amount", "total_quantity", "order_count", "sku_count", "percentage", "rank"
    )


def daily_trend(category_days: DataFrame) -> DataFrame:
    """Amount, orders and average order per day with sales. An order counts once per category it touches."""
    days = category_days.groupBy("dt").agg(
        money_sum(F.col("total_amount")).alias("total_sales_amount"),
        count_sum(F.col("order_count")).alias("total_order_count"),
    )
    return _with_average(days, "total_sales_amount", "total_order_count")


def daily_trend_exact(item_orders: DataFrame) -> DataFrame:
    """As above, with each order counted once."""
    days = item_orders.groupBy("dt").agg(
        money_sum(F.col("subtotal")).alias("total_sales_amount"),
        F.countDistinct("order_id").alias("total_order_count"),
    )
    return _with_average(days, "total_sales_amount", "total_order_count")


def _with_average(df: DataFrame, amount: str, count: str) -> DataFrame:
    return df.withColumn("avg_order_amount", ratio_or_null(F.col(amount), F.col(count)))


def daily_trend_change(trend: DataFrame) -> DataFrame:
    """Each day with the amount of the sales day before it and the change since then.

    ``trend`` has one row per calendar day, so the one window over all days stays at some thousand rows.
    """
    days = Window.orderBy("dt")
    amount, before = F.col("total_sales_amount"), F.col("previous_amount")
    return (
        trend.withColumns(
            {"previous_dt": F.lag("dt").over(days), "previous_amount": F.lag("total_sales_amount").over(days)}
        )
        .withColumn("amount_change", (amount - before).cast(MONEY_SUM))
        .withColumn("change_percent", percent(F.col("amount_change"), before, MONEY_SUM))
        .select("dt", "total_sales_amount", "previous_dt", "previous_amount", "amount_change", "change_percent")
    )


def user_value(user_days: DataFrame, bounds: tuple[int, int] = TIER_BOUNDS) -> DataFrame:
    """Last order day, frequency, amount, average and value tier per buyer."""
    users = user_days.groupBy("buyer_phone").agg(
        F.max("buyer_name").alias("buyer_name"),
        F.max("dt").alias("last_order_date"),
        count_sum(F.col("order_count")).alias("order_frequency"),
        money_sum(F.col("total_amount")).alias("total_monetary"),
    )
    return _with_average(users, "total_monetary", "order_frequency").withColumn(
        "value_tier", value_tier(F.col("total_monetary"), bounds)
    )


def product_totals(product_days: DataFrame) -> DataFrame:
    """One row per product, not ranked."""
    return product_days.groupBy("product_id").agg(
        F.max("product_name").alias("product_name"),
        F.max("category").alias("category"),
        F.max("brand").alias("brand"),
        count_sum(F.col("total_quantity")).alias("total_quantity"),
        money_sum(F.col("total_amount")).alias("total_amount"),
    )


RANKED = ("product_id", "product_name", "category", "brand", "total_quantity", "total_amount", "rank")


def product_ranking(product_days: DataFrame) -> DataFrame:
    """Products ranked by quantity sold; equal quantities share a rank."""
    return rank_by(product_totals(product_days), "total_quantity", spread_by="product_id").select(*RANKED)


def top_products(product_days: DataFrame, size: int) -> DataFrame:
    """The first rows of the ranking. All that rank above them are among them, so only these few are ranked."""
    first = product_totals(product_days).orderBy(F.desc("total_quantity"), "product_id").limit(size)
    return first.withColumn("rank", F.rank().over(Window.orderBy(F.desc("total_quantity"))).cast("bigint")).select(*RANKED)


def region_buyers(wide: DataFrame, order_grain: bool = False) -> DataFrame:
    """Orders and amount per finest region and buyer: the set that regional counts are rolled up from.

    An order has one region and one buyer, so counts of orders add up; the buyers of a larger region are the distinct ones.
    ``order_grain`` adds an order's payment once instead of once per wide row.
    """
    base = wide.select(*REGION, "order_id", "buyer_phone", F.col("actual_amount").alias("amount"))
    per_order = (base.distinct() if order_grain else base).groupBy(*REGION, "order_id", "buyer_phone").agg(money_sum(F.col("amount")).alias("amount"))
    return per_order.groupBy(*REGION, "buyer_phone").agg(F.count(F.lit(1)).alias("orders"), money_sum(F.col("amount")).alias("amount"))


def regional_rows(buyers: DataFrame, levels: Sequence[str] = REGION) -> DataFrame:
    """Orders, amount, average and buyers per region from the finest set (region, buyer, orders, amount).

    The levels multiply that set only, which has a row per buyer and region, never the order rows behind it. A buyer of a
    larger region is one row there after the first sum, so buyers are counted without a distinct count. Province rows need a
    province, deeper rows a city.
    """
    sets = [[F.col(c) for c in (*REGION[: REGION.index(level) + 1], "buyer_phone")] for level in levels]
    per_buyer = buyers.groupingSets(sets, *REGION, "buyer_phone").agg(
        F.sum("orders").alias("orders"),
        money_sum(F.col("amount")).alias("amount"),
        F.grouping("city").alias("_no_city"),
        F.grouping("district").alias("_no_district"),
    )
    rows = per_buyer.groupBy(*REGION, "_no_city", "_no_district").agg(
        count_sum(F.col("orders")).alias("total_orders"),
        money_sum(F.col("amount")).alias("total_amount"),
        F.count("buyer_phone").alias("buyer_count"),
    )
    named = F.when(F.col("_no_city") == 1, F.col("province") != "").otherwise(F.col("city") != "")
    return _with_average(rows.filter(named), "total_amount", "total_orders").select(
        "province",
        F.when(F.col("_no_city") == 1, SUBTOTAL).otherwise(F.col("city")).alias("city"),
        F.when(F.col("_no_district") == 1, SUBTOTAL).otherwise(F.col("district")).alias("district"),
        "total_orders",
        "total_amount",
        "avg_order_amount",
        "buyer_count",
    )


def regional_sales(wide: DataFrame, levels: Sequence[str] = REGION) -> DataFrame:
    """Orders, amount, average and buyers per region; the amount adds an order's payment once per wide row."""
    return regional_rows(region_buyers(wide), levels)


def regional_sales_order_grain(wide: DataFrame, levels: Sequence[str] = REGION) -> DataFrame:
    """As above, with an order's payment added once."""
    return regional_rows(region_buyers(wide, order_grain=True), levels)
