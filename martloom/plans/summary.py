"""Daily summary layer: the order-item wide table and the product, category and buyer summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.amounts import count_sum, money_sum, ratio_or_zero
from martloom.functions.vocabulary import CANCELLED, COMPLETED, OPEN_STATES
from martloom.operators.keyed_merge import insert_absent
from martloom.operators.order_join import created_or, defaulted_orphans, items_with_orders, order_day

WIDE_KEY = ["order_id", "product_id"]
WIDE_ORDER_COLUMNS = [
    "order_status",
    "buyer_name",
    "buyer_phone",
    "buyer_email",
    "province",
    "city",
    "district",
    "payment_method",
    "payment_amount",
    "logistics_company",
    "tracking_number",
    "order_amount",
    "discount",
    "actual_amount",
]
WIDE_ITEM_COLUMNS = ["product_name", "brand", "category", "sub_category", "price", "quantity", "subtotal"]
ITEM_ORDER = ["item_no"]


def order_wide(
    items: DataFrame,
    orders: DataFrame,
    as_of: datetime | Column | None = None,
    state: DataFrame | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Wide rows to add, from items and orders."""
    return wide_rows(items_with_orders(items, orders, as_of), as_of, state, tiebreak)


def wide_rows(
    item_orders: DataFrame,
    as_of: datetime | Column | None = None,
    state: DataFrame | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Wide rows to add: one per order and product, orphan items filled, pairs already in ``state`` left alone."""
    filled = defaulted_orphans(item_orders, WIDE_ORDER_COLUMNS)
    rows = insert_absent(state, filled, WIDE_KEY, tiebreak or ITEM_ORDER)
    return rows.select(
        *WIDE_KEY, *WIDE_ITEM_COLUMNS, *WIDE_ORDER_COLUMNS, created_or(as_of).alias("order_created_at"), "dt"
    )


def product_sales(item_orders: DataFrame) -> DataFrame:
    """Quantity, amount, orders and average price per product and day."""
    sums = item_orders.groupBy("product_id", "dt").agg(
        F.max("product_name").alias("product_name"),
        F.max("category").alias("category"),
        F.max("brand").alias("brand"),
        count_sum(F.col("quantity")).alias("total_quantity"),
        money_sum(F.col("subtotal")).alias("total_amount"),
        F.countDistinct("order_id").alias("order_count"),
    )
    return sums.withColumn("avg_price", ratio_or_zero(F.col("total_amount"), F.col("total_quantity")))


def category_sales(item_orders: DataFrame) -> DataFrame:
    """Quantity, amount, orders and products per category and day."""
    return item_orders.groupBy("category", "dt").agg(
        count_sum(F.col("quantity")).alias("total_quantity"),
        money_sum(F.col("subtotal")).alias("total_amount"),
        F.countDistinct("order_id").alias("order_count"),
        F.countDistinct("product_id").alias("sku_count"),
    )


def user_orders(
    items: DataFrame, orders: DataFrame, as_of: datetime | Column | None = None, order_grain: bool = False
) -> DataFrame:
    """Orders, amount, quantity and states per buyer and day.

    The default repeats the running job: an order's amount and state count once per *item*. ``order_grain`` counts
    them once per order, as the requirements say. Either way items are folded to one row per order first, which makes
    the distinct order count a plain count and leaves no hot key for the join.
    """
    per_order = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_items"),
        count_sum(F.col("quantity")).alias("_quantity"),
        money_sum(F.coalesce(F.col("subtotal"), F.lit(0))).alias("_subtotal"),
    )
    known = orders.filter(F.coalesce("buyer_phone", F.lit("")) != "").select(
        "order_id", "buyer_phone", "buyer_name", "order_status", "actual_amount", "created_at"
    )
    weight = F.lit(1) if order_grain else F.col("_items")
    amount = F.coalesce(F.col("actual_amount") * weight, F.col("_subtotal"))

    def in_state(*states: str) -> Column:
        return count_sum(F.when(F.col("order_status").isin(*states), weight).otherwise(0))

    return (
        known.join(per_order, "order_id")
        .groupBy("buyer_phone", order_day(as_of).alias("dt"))
        .agg(
            F.max(F.coalesce("buyer_name", F.lit(""))).alias("buyer_name"),
            F.count(F.lit(1)).alias("order_count"),
            money_sum(amount).alias("total_amount"),
            count_sum(F.col("_quantity")).alias("total_quantity"),
            in_state(COMPLETED).alias("completed_count"),
            in_state(CANCELLED).alias("cancelled_count"),
            in_state(*OPEN_STATES).alias("pending_count"),
        )
    )
