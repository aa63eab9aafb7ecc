"""Dashboard queries over the metric tables and the goods dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.amounts import MONEY_SUM
from martloom.functions.vocabulary import PAGE_SIZE, RANKING_SIZE, SUBTOTAL


def category_revenue(revenue: DataFrame) -> DataFrame:
    return revenue.orderBy("rank", "category")


def daily_trend(trend: DataFrame, start: str | date | None = None, end: str | date | None = None) -> DataFrame:
    """Days from ``start`` to ``end``, both included, in order; a bound that is not given is open."""
    if start:
        trend = trend.filter(F.col("dt") >= F.lit(str(start)).cast("date"))
    if end:
        trend = trend.filter(F.col("dt") <= F.lit(str(end)).cast("date"))
    return trend.orderBy("dt")


def user_value(users: DataFrame, tier: str | None = None) -> DataFrame:
    """Buyers, biggest spenders first, of one tier or all."""
    chosen = users.filter(F.col("value_tier") == tier) if tier else users
    return chosen.orderBy(F.desc("total_monetary"), "buyer_phone")


def tier_distribution(users: DataFrame) -> DataFrame:
    return users.groupBy("value_tier").agg(F.count(F.lit(1)).alias("user_count"))


def product_ranking(
    ranking: DataFrame, top_n: int | None = RANKING_SIZE, category: str | None = None
) -> DataFrame:
    """Best sellers, of one category or all; ranks stay those among all products. No limit when ``top_n`` <= 0."""
    chosen = ranking.filter(F.col("category") == category) if category else ranking
    ordered = chosen.orderBy("rank", "product_id")
    return ordered.limit(top_n) if top_n and top_n > 0 else ordered


def regional_sales(regions: DataFrame, level: str | None = "province") -> DataFrame:
    """Rows of one level, or of all levels for any other ``level``, biggest first."""
    if level == "province":
        regions = regions.filter(F.col("city") == SUBTOTAL)
    elif level == "city":
        regions = regions.filter((F.col("city") != SUBTOTAL) & (F.col("district") == SUBTOTAL))
    return regions.orderBy(F.desc("total_amount"), "province", "city", "district")


def dashboard_kpi(trend: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """One row: all sales, all orders, active buyers, products sold. ``products`` has a row each, ranked or not.

    Each part is reduced to one row by itself; the rows are then merged, not crossed.
    """
    sales = trend.agg(
        F.coalesce(F.sum("total_sales_amount"), F.lit(0)).cast(MONEY_SUM).alias("total_sales_amount"),
        F.coalesce(F.sum("total_order_count"), F.lit(0)).cast("bigint").alias("total_order_count"),
    )
    buyers = users.agg(F.count(F.lit(1)).alias("active_user_count"))
    products = products.agg(F.count(F.lit(1)).alias("active_sku_count"))
    parts = sales.unionByName(buyers, allowMissingColumns=True).unionByName(products, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def _goods(
    goods: DataFrame, category: str | None = None, brand: str | None = None, keyword: str | None = None
) -> DataFrame:
    rows = goods.filter(F.col("is_active") == 1)
    if category:
        rows = rows.filter(F.col("first_category_name") == category)
    if brand:
        rows = rows.filter(F.col("brand_name") == brand)
    if keyword:
        rows = rows.filter(F.col("spu_name").contains(keyword) | F.col("sku_name").contains(keyword))
    return rows


def goods_page(
    goods: DataFrame,
    category: str | None = None,
    brand: str | None = None,
    keyword: str | None = None,
    page: int | None = 1,
    size: int | None = PAGE_SIZE,
) -> DataFrame:
    """One page of active goods, newest first; pages count from 1. All goods when page or size is not positive."""
    rows = _goods(goods, category, brand, keyword).orderBy(F.desc("dw_create_time"), "sku_id")
    if page and size and page > 0 and size > 0:
        rows = rows.offset((page - 1) * size).limit(size)
    return rows


def goods_days(
    goods: DataFrame, category: str | None = None, brand: str | None = None, keyword: str | None = None
) -> DataFrame:
    """Active goods per day of creation, newest first: the index that pages are sought by. One row per calendar day."""
    rows = _goods(goods, category, brand, keyword).groupBy(F.to_date("dw_create_time").alias("day"))
    return rows.agg(F.count(F.lit(1)).alias("goods")).orderBy(F.desc("day"))


def goods_page_sought(
    goods: DataFrame,
    index: Sequence[tuple[date, int]],
    category: str | None = None,
    brand: str | None = None,
    keyword: str | None = None,
    page: int = 1,
    size: int = PAGE_SIZE,
) -> DataFrame:
    """As ``goods_page``, reading only the days that the page lies in; ``index`` are the rows of ``goods_days``."""
    skip, before, chosen = (page - 1) * size, 0, []
    for day, count in index:
        if before + count > skip and before < skip + size:
            chosen.append((day, before))
        before += count
    rows = _goods(goods, category, brand, keyword)
    if not chosen:
        return rows.limit(0)
    newest, oldest = chosen[0][0], chosen[-1][0]
    created = F.col("dw_create_time")
    inside = rows.filter((created >= F.lit(oldest).cast("timestamp")) & (created < F.date_add(F.lit(newest), 1).cast("timestamp")))
    return inside.orderBy(F.desc("dw_create_time"), "sku_id").offset(skip - chosen[0][1]).limit(size)


def goods_after(
    goods: DataFrame,
    created: datetime | None = None,
    sku: str | None = None,
    category: str | None = None,
    brand: str | None = None,
    keyword: str | None = None,
    size: int = PAGE_SIZE,
) -> DataFrame:
    """The page after the unit ``sku`` created at ``created``, or the first one: earlier pages are filtered, not skipped."""
    rows = _goods(goods, category, brand, keyword)
    if created is not None:
        at, time = F.lit(created).cast("timestamp"), F.col("dw_create_time")
        rows = rows.filter((time <= at) & ((time < at) | (F.col("sku_id") > sku)))
    return rows.orderBy(F.desc("dw_create_time"), "sku_id").limit(size)


def goods_count(
    goods: DataFrame, category: str | None = None, brand: str | None = None, keyword: str | None = None
) -> DataFrame:
    return _goods(goods, category, brand, keyword).agg(F.count(F.lit(1)).alias("total"))


def goods_categories(goods: DataFrame) -> DataFrame:
    return _goods(goods).select("first_category_name").distinct().orderBy("first_category_name")


def goods_brands(goods: DataFrame) -> DataFrame:
    return _goods(goods).select("brand_name").distinct().orderBy("brand_name")
