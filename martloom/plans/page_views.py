"""Data work of the dashboard pages: date ranges, top lists and page counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.vocabulary import GOODS_PAGE_SIZE, TIER_HIGH, TIER_LOW
from martloom.plans import serving

HOME_DAYS, USER_DAYS, TREND_DAYS = 7, 30, 90
TOP_PER_DAY, TOP_REGIONS, TOP_USERS, TOP_HOME = 10, 10, 20, 5


def _day(value: date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def recent_trend(trend: DataFrame, as_of: date | str | Column, days: int = HOME_DAYS) -> DataFrame:
    """The last ``days`` days up to ``as_of``, both ends included."""
    last = _day(as_of)
    return trend.filter(F.col("dt").between(F.date_sub(last, days), last)).orderBy("dt")


def daily_top_users(
    users: DataFrame,
    start: date | str | Column | None = None,
    end: date | str | Column | None = None,
    size: int = TOP_PER_DAY,
) -> DataFrame:
    """The ``size`` biggest spenders of each last-order day.

    The rank limit is applied before the shuffle as well, so a busy day sends ``size`` rows per task.
    """
    rows = users.filter(F.col("last_order_date").isNotNull())
    if start is not None:
        rows = rows.filter(F.col("last_order_date") >= _day(start))
    if end is not None:
        rows = rows.filter(F.col("last_order_date") <= _day(end))
    w = Window.partitionBy("last_order_date").orderBy(
        F.desc(F.coalesce("total_monetary", F.lit(0))), "buyer_phone"
    )
    return rows.withColumn("day_rank", F.row_number().over(w)).filter(F.col("day_rank") <= size)


def by_tier(points: DataFrame) -> DataFrame:
    """Number and amount of the chosen points per tier; a missing tier counts as the lowest."""
    tier = F.coalesce(F.nullif("value_tier", F.lit("")), F.lit(TIER_LOW))
    return points.groupBy(tier.alias("value_tier")).agg(
        F.count(F.lit(1)).alias("user_count"), F.sum("total_monetary").cast("decimal(25,2)").alias("total_monetary")
    )


def _numbered(top: DataFrame, order: list[Column | str], size: int) -> DataFrame:
    """The first ``size`` rows, numbered; only those rows reach the numbering window."""
    return top.orderBy(*order).limit(size).withColumn("row_no", F.row_number().over(Window.orderBy(*order)))


def top_regions(regions: DataFrame, level: str = "province", size: int = TOP_REGIONS) -> DataFrame:
    order = [F.desc("total_amount"), F.asc("province"), F.asc("city"), F.asc("district")]
    return _numbered(serving.regional_sales(regions, level), order, size)


def top_high_value(users: DataFrame, size: int = TOP_USERS) -> DataFrame:
    order = [F.desc("total_monetary"), F.asc("buyer_phone")]
    return _numbered(serving.user_value(users, TIER_HIGH), order, size)


def goods_pages(count: DataFrame, size: int = GOODS_PAGE_SIZE) -> DataFrame:
    """Total and number of pages, at least one."""
    return count.select("total", F.greatest(F.ceil(F.col("total") / size), F.lit(1)).cast("bigint").alias("pages"))


def user_recency(users: DataFrame, as_of: date | str | Column) -> DataFrame:
    """Days since each buyer's last order."""
    return users.withColumn("recency_days", F.datediff(_day(as_of), "last_order_date"))


def home_top(revenue: DataFrame, ranking: DataFrame, size: int = TOP_HOME) -> DataFrame:
    """Top categories by amount and top products by quantity, as one list. Of the ranking its first rows suffice."""
    categories = revenue.orderBy("rank", "category").limit(size)
    products = ranking.orderBy("rank", "product_id").limit(size)
    return categories.select(
        F.lit("category").alias("list"), F.col("category").alias("name"), "rank", "total_amount", "total_quantity"
    ).unionByName(
        products.select(
            F.lit("product").alias("list"), F.col("product_id").alias("name"), "rank", "total_amount", "total_quantity"
        )
    )
