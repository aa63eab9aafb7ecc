"""Refresh of the summary and metric layers, over all days or only those the feeds have touched."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.functions.vocabulary import TIER_BOUNDS
from martloom.operators.keyed_merge import upsert_metrics
from martloom.operators.order_join import items_with_orders
from martloom.plans import goods, maintained, metrics, quality, summary
from martloom.plans.maintained import CATEGORIES, PRODUCTS, REGION_BUYERS, USERS, Totals
from martloom.sources.catalog import TABLES
from martloom.sources.warehouse import DAY, GOODS, ORDERS, REFRESH, Change, Warehouse
from martloom.streaming.ingest import _now

# Totals that a refresh moves by what the touched days gave before and give now.
MAINTAINED: dict[str, tuple[str, Totals]] = {
    "sum_category": ("dws_category_sales_1d", CATEGORIES),
    "sum_user": ("dws_user_order_1d", USERS),
    "sum_product": ("dws_product_sales_1d", PRODUCTS),
    "sum_region": ("dws_order_wide", REGION_BUYERS),
}
REQUIRED = ("buyer_name", "province", "city", "category")


@dataclass(frozen=True)
class Refreshed:
    """A published refresh, and what its checks counted in the rows it wrote."""

    version: int
    checks: dict[str, dict[str, int]]


class Checks:
    """Counts taken while tables are written, in the same pass over their rows."""

    def __init__(self) -> None:
        self.watched: dict[str, Observation] = {}

    def on(self, name: str, df: DataFrame, *counts) -> DataFrame:
        self.watched[name] = Observation()
        return df.observe(self.watched[name], *counts)

    def counted(self) -> dict[str, dict[str, int]]:
        return {name: dict(o.get) for name, o in self.watched.items()}


def _contribution(table: str, rows: DataFrame) -> DataFrame:
    return metrics.region_buyers(rows) if table == "dws_order_wide" else rows


def _maintain(wh: Warehouse, change: Change, name: str, old: DataFrame, days: Sequence[str] | None) -> None:
    """Move a table of totals by the touched days, or make it from all days where there is none yet."""
    table, spec = MAINTAINED[name]
    if days is None or name not in change.tables:
        change.replace(name, maintained.totals(_contribution(table, change.read(table)), spec))
        return
    new = _contribution(table, change.read(table, days))
    rows, stage = wh.stage(maintained.moved(change.read(name), _contribution(table, old), new, spec), name)
    if spec.highest and not rows.filter(maintained.MARK).isEmpty():
        rows = maintained.settled(rows, change.read(table), spec)
    change.replace(name, rows.select(*spec.columns))
    wh.drop_stage(stage)


def refresh(
    wh: Warehouse,
    as_of: datetime,
    days: Sequence[str] | None = None,
    overwrite_wide: bool = False,
    bounds: tuple[int, int] = TIER_BOUNDS,
    source: dict | None = None,
) -> Refreshed:
    """Recompute the summaries of the given days (all by default), move the metrics by the difference, publish them together.

    Orders and items are read from one commit of the order feed, ``source`` or the latest, whatever is published meanwhile.
    The wide table only gains rows unless ``overwrite_wide`` is set; summaries keep the descriptions they were stored with
    and take new measures. With ``days``, only rows of these days and one row per category, buyer, product or region are read.
    """
    change = wh.begin(REFRESH)
    source = source or wh.head(ORDERS)
    checks = Checks()
    orders, orders_stage = wh.stage(
        wh.read("dwd_order", days, source).select("order_id", "created_at", *summary.WIDE_ORDER_COLUMNS), "orders"
    )
    items = wh.read("dwd_order_item", days, source).drop(DAY)
    joined = items_with_orders(
        items.select("order_id", "part", "item_no", "product_id", *summary.WIDE_ITEM_COLUMNS), orders, as_of
    )
    joined, stage = wh.stage(checks.on("items", joined, F.count(F.lit(1)).alias("rows")), "item-orders")
    before = {table: change.read(table, days) for table, _ in MAINTAINED.values()}

    wide = summary.wide_rows(joined, as_of, None if overwrite_wide else before["dws_order_wide"], ["part", "item_no"])
    wide = checks.on("wide", wide, F.count(F.lit(1)).alias("rows"), *quality.blank_counts(REQUIRED))
    if overwrite_wide:
        change.replace("dws_order_wide", wide, days)
    else:
        change.append("dws_order_wide", wide)
    summaries = {
        "dws_product_sales_1d": summary.product_sales(joined),
        "dws_category_sales_1d": summary.category_sales(joined),
        "dws_user_order_1d": summary.user_orders(items, orders, as_of),
    }
    for table, rows in summaries.items():
        spec = TABLES[table]
        rows = upsert_metrics(before[table], rows, spec.key, spec.frozen, spec.live)
        if table == "dws_product_sales_1d":
            rows = checks.on("avg_price", rows, *quality.violation_counts(quality.wrong_price()))
        change.replace(table, rows, days)

    incremental = days is not None and all(name in change.tables for name in MAINTAINED)
    touched = days if incremental else None
    for name, (table, _) in MAINTAINED.items():
        _maintain(wh, change, name, before[table], touched)

    trend = metrics.daily_trend(change.read("dws_category_sales_1d", touched))
    if incremental:
        kept = change.read("ads_daily_sales_trend").filter(~F.col(DAY).cast("string").isin(list(days)))
        trend = kept.unionByName(trend)
    revenue = metrics.category_revenue(change.read("sum_category"))
    users = metrics.user_value(change.read("sum_user"), bounds)
    published = {
        "ads_category_revenue": checks.on("share_rank", revenue, *quality.share_and_rank_counts()),
        "ads_daily_sales_trend": checks.on("avg_order_amount", trend, *quality.violation_counts(quality.wrong_average())),
        "ads_user_value": checks.on("value_tier", users, *quality.violation_counts(quality.wrong_tier(bounds))),
        "ads_product_ranking": metrics.product_ranking(change.read("sum_product")),
        "ads_regional_sales": metrics.regional_rows(change.read("sum_region")),
    }
    for table, rows in published.items():
        change.replace(table, rows)
    version = change.commit(order_version=source["version"])
    wh.drop_stage(stage)
    wh.drop_stage(orders_stage)
    return Refreshed(version, checks.counted())


def refresh_touched(wh: Warehouse, as_of: datetime, **options) -> Refreshed | None:
    """Refresh the days touched since the last refresh; None when there are none.

    All rows of an order lie in the day its first message fixed, so these days are recomputed exactly, distinct counts
    included, and late orders simply touch an old day.
    """
    done = wh.head(REFRESH).get("order_version", 0)
    source = wh.head(ORDERS)
    days = wh.days_touched(ORDERS, "dwd_order", done, source["version"])
    return refresh(wh, as_of, days, source=source, **options) if days else None


def refresh_goods(wh: Warehouse, as_of: datetime) -> int:
    """Bring the goods dimension up to the stored products; the first time, with all versions that are stored.

    A unit that has changed gets a new row and its open one is closed, so earlier versions stay.
    """
    change = wh.begin(GOODS)
    if "dim_goods_info" in change.tables:
        rows = goods.refreshed_goods(change.read("dim_goods_info"), goods.goods_info(wh.read("dwd_product")), as_of)
    else:
        rows = goods.goods_history(wh.changes("dwd_product"), "created_at", "last_seq")
    change.replace("dim_goods_info", rows)
    return change.commit()


def start_refresh(
    wh: Warehouse, checkpoint: str, every: str = "30 seconds", clock: Callable[[], datetime] = _now, **options
) -> StreamingQuery:
    """Refresh what the feeds touched, every 30 seconds."""
    ticks = wh.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(lambda _, __: refresh_touched(wh, clock(), **options))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )
