"""Summary, metric, serving, page, check and goods rules on hand-written rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from martloom.functions.amounts import percent, ratio_or_null, ratio_or_zero
from martloom.operators.order_join import items_with_orders, with_product
from martloom.plans import goods, metrics, page_views, quality, serving, summary
from martloom.sources.catalog import TABLES
from pyspark.sql import functions as F

D1, D2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 23, 59)


def make(spark, table, *rows, **types):
    """Rows of a table from dicts; other columns are NULL."""
    schema = TABLES[table].schema
    for f in schema:
        f.nullable = True
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def order(oid, buyer="u1", state="已完成", amount=100, created=D1, province="P", city="C", district="X"):
    return dict(
        order_id=oid, buyer_name=f"n{buyer}", buyer_phone=buyer, order_status=state, actual_amount=Decimal(amount),
        created_at=created, province=province, city=city, district=district, order_amount=Decimal(amount),
    )


def item(oid, pid, no=1, qty=1, amount=10, category="c"):
    return dict(
        order_id=oid, item_no=no, product_id=pid, product_name=f"name {pid}", brand="b", category=category,
        quantity=qty, subtotal=Decimal(amount), price=Decimal(amount),
    )


@pytest.fixture
def sales(spark):
    items = make(
        spark, "dwd_order_item",
        item("o1", "a", 1, 2, 20), item("o1", "b", 2, 1, 30, "d"), item("o1", "a", 3, 1, 11),
        item("o2", "a", 1, 3, 30), item("o3", "b", 1, 0, 5, "d"), item("gone", "a", 1, 1, 9),
    )
    orders = make(
        spark, "dwd_order", order("o1"), order("o2", state="已取消", amount=0),
        order("o3", buyer="u2", state="已付款", amount=50, created=D2, city=""), order("empty", buyer="u3"),
    )
    return items, orders


def collected(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def test_wide_keeps_the_first_row_of_a_pair_and_fills_orphans(sales, as_of):
    wide = collected(summary.order_wide(*sales, as_of), "order_id", "product_id")
    assert [(r["order_id"], r["product_id"], r["subtotal"]) for r in wide] == [
        ("gone", "a", 9), ("o1", "a", 20), ("o1", "b", 30), ("o2", "a", 30), ("o3", "b", 5),
    ]
    orphan = wide[0]
    assert (orphan["order_status"], orphan["actual_amount"], orphan["dt"]) == ("", 0, as_of.date())
    assert len(wide[0]) == 25


def test_wide_state_is_left_alone(sales, as_of):
    items, orders = sales
    state = summary.order_wide(items, orders, as_of)
    paid = orders.withColumn("order_status", F.lit("已取消"))
    assert summary.order_wide(items, paid, as_of, state).count() == 0
    fresh = summary.order_wide(items, paid, as_of)
    assert {r["order_status"] for r in collected(fresh, "order_id")} == {"", "已取消"}


def test_product_and_category_days(sales, as_of):
    joined = items_with_orders(*sales, as_of)
    by_product = {(r["product_id"], r["dt"]): r for r in collected(summary.product_sales(joined), "product_id")}
    a = by_product["a", date(2024, 1, 1)]
    assert (a["total_quantity"], a["total_amount"], a["order_count"], a["avg_price"]) == (6, 61, 2, Decimal("10.17"))
    assert by_product["b", date(2024, 1, 2)]["avg_price"] == 0
    assert ("a", as_of.date()) in by_product
    by_category = {(r["category"], r["dt"]): r for r in collected(summary.category_sales(joined), "category")}
    c = by_category["c", date(2024, 1, 1)]
    assert (c["order_count"], c["sku_count"], c["total_quantity"]) == (2, 1, 6)


def test_user_days_item_and_order_grain(sales):
    run = {r["buyer_phone"]: r for r in collected(summary.user_orders(*sales), "buyer_phone")}
    assert set(run) == {"u1", "u2"}
    assert (run["u1"]["order_count"], run["u1"]["total_amount"], run["u1"]["total_quantity"]) == (2, 300, 7)
    assert (run["u1"]["completed_count"], run["u1"]["cancelled_count"]) == (3, 1)
    once = {r["buyer_phone"]: r for r in collected(summary.user_orders(*sales, order_grain=True), "buyer_phone")}
    assert (once["u1"]["total_amount"], once["u1"]["completed_count"], once["u1"]["cancelled_count"]) == (100, 1, 1)
    assert once["u2"]["pending_count"] == 1


def test_blank_buyers_are_dropped_and_missing_amounts_fall_back(spark, sales):
    items, _ = sales
    orders = make(spark, "dwd_order", {**order("o1"), "actual_amount": None}, {**order("o2"), "buyer_phone": ""})
    rows = collected(summary.user_orders(items, orders), "buyer_phone")
    assert [(r["buyer_phone"], r["total_amount"]) for r in rows] == [("u1", 61)]


def test_three_table_join_falls_back_to_the_snapshot(spark, sales):
    products = make(spark, "dwd_product", dict(product_id="a", name="listed", brand="B", category="k"))
    rows = collected(with_product(sales[0], products), "order_id", "item_no")
    assert {(r["product_id"], r["product_name"], r["category"]) for r in rows} == {
        ("a", "listed", "k"), ("b", "name b", "d"),
    }


def test_ratios(spark):
    df = spark.sql("SELECT cast(a AS decimal(25,2)) a, b FROM VALUES (1.00, 8L), (-1.00, 8L), (5.00, 0L) t(a, b)")
    r = df.select(ratio_or_zero(F.col("a"), F.col("b")).alias("z"), ratio_or_null(F.col("a"), F.col("b")).alias("n"))
    assert [tuple(x) for x in r.collect()] == [
        (Decimal("0.13"), Decimal("0.13")), (Decimal("-0.13"), Decimal("-0.13")), (Decimal(0), None),
    ]
    p = spark.sql("SELECT cast(1 AS decimal(25,2)) a, cast(w AS decimal(25,2)) w FROM VALUES (800), (-800), (0) t(w)")
    assert [x[0] for x in p.select(percent(F.col("a"), F.col("w"))).collect()] == [Decimal("0.13"), Decimal("-0.13"), None]


def test_category_revenue_ties(spark):
    days = make(
        spark, "dws_category_sales_1d",
        *[dict(category=c, dt=D1.date(), total_amount=Decimal(n), total_quantity=1, order_count=1, sku_count=1)
          for c, n in (("a", 50), ("b", 25), ("c", 25), ("d", 0))],
    )
    rows = collected(metrics.category_revenue(days, dense=True), "category")
    assert [(r["rank"], r["dense_rank"], r["percentage"]) for r in rows] == [
        (1, 1, 50), (2, 2, 25), (2, 2, 25), (4, 3, 0),
    ]
    zero = metrics.category_revenue(days.withColumn("total_amount", F.lit(0).cast("decimal(25,2)")))
    assert {r["percentage"] for r in zero.collect()} == {None}
    check = quality.share_and_rank(metrics.category_revenue(days)).first()
    assert (check.percentage_sum, check.first_rank, check.last_rank, check.tied_rows) == (100, 1, 4, 1)


def test_daily_trend_counts_orders_per_category(sales, as_of):
    joined = items_with_orders(*sales, as_of)
    run = collected(metrics.daily_trend(summary.category_sales(joined)), "dt")
    exact = collected(metrics.daily_trend_exact(joined), "dt")
    assert (run[0]["total_order_count"], exact[0]["total_order_count"]) == (3, 2)
    assert run[0]["avg_order_amount"] == Decimal("30.33") and len(run) == 3
    change = collected(metrics.daily_trend_change(metrics.daily_trend(summary.category_sales(joined))), "dt")
    assert change[0]["amount_change"] is None
    assert (change[1]["amount_change"], change[1]["change_percent"]) == (Decimal(-86), Decimal("-94.51"))


def test_tiers_at_their_bounds(spark):
    days = make(
        spark, "dws_user_order_1d",
        *[dict(buyer_phone=p, dt=D1.date(), order_count=1, total_amount=Decimal(a))
          for p, a in (("a", "10000"), ("b", "9999.99"), ("c", "1000"), ("d", "999.99"))],
    )
    users = metrics.user_value(days)
    assert [r["value_tier"] for r in collected(users, "buyer_phone")] == ["高价值", "中价值", "中价值", "低价值"]
    assert quality.tiers(users).first().violations == 0
    assert quality.tiers(users.withColumn("value_tier", F.lit("高价值"))).first().violations == 3
    assert {r.value_tier: r.user_count for r in serving.tier_distribution(users).collect()} == {
        "高价值": 1, "中价值": 2, "低价值": 1,
    }


def test_regions(spark, sales, as_of):
    wide = summary.order_wide(*sales, as_of)
    regions = metrics.regional_sales(wide)
    got = {(r["province"], r["city"], r["district"]): r for r in collected(regions, "province")}
    # The order without a city counts for its province only; the orphan counts nowhere.
    assert set(got) == {("P", "合计", "合计"), ("P", "C", "合计"), ("P", "C", "X")}
    assert (got["P", "合计", "合计"]["total_amount"], got["P", "合计", "合计"]["total_orders"]) == (250, 3)
    assert got["P", "合计", "合计"]["buyer_count"] == 2
    once = metrics.regional_sales_order_grain(wide, ("province",)).first()
    assert (once.total_amount, once.total_orders) == (150, 3)
    assert serving.regional_sales(regions, "province").count() == 1
    assert serving.regional_sales(regions, "city").count() == 1
    assert serving.regional_sales(regions, "anything").count() == 3
    rollup = quality.region_rollup(regions).first()
    assert (rollup.checked, rollup.violations) == (1, 1)


def test_ranking_is_global_and_limited_when_read(spark):
    days = make(
        spark, "dws_product_sales_1d",
        *[dict(product_id=p, dt=D1.date(), category=c, total_quantity=q, total_amount=Decimal(1))
          for p, c, q in (("a", "x", 5), ("b", "y", 9), ("c", "x", 5), ("d", "x", 1))],
    )
    ranking = metrics.product_ranking(days)
    x = [(r.product_id, r["rank"]) for r in serving.product_ranking(ranking, 2, "x").collect()]
    assert x == [("a", 2), ("c", 2)]
    assert serving.product_ranking(ranking, 0).count() == 4
    assert serving.product_ranking(ranking, None).count() == 4
    assert [r["rank"] for r in serving.product_ranking(ranking).collect()] == [1, 2, 2, 4]


def test_trend_range_defaults(spark):
    trend = spark.createDataFrame([(date(2025, 12, 31),), (date(2026, 1, 1),), (date(2026, 2, 1),)], "dt date")
    assert serving.daily_trend(trend).count() == 3
    assert serving.daily_trend(trend, "2026-01-01").count() == 2
    assert serving.daily_trend(trend, None, "2026-01-01").count() == 2
    assert serving.daily_trend(trend, "2025-12-31", "2026-01-01").count() == 2
    assert page_views.recent_trend(trend, "2026-01-07", 7).count() == 2
    assert page_views.recent_trend(trend, "2026-01-07", 6).count() == 1


def test_empty_dashboard(spark):
    empty = [make(spark, t) for t in ("ads_daily_sales_trend", "ads_user_value", "ads_product_ranking")]
    assert tuple(serving.dashboard_kpi(*empty).first()) == (0, 0, 0, 0)


def _products(spark, *rows):
    return make(spark, "dwd_product", *[
        dict(product_id=i, name=n, brand=b, category="c", price=Decimal(p), keywords="k,l", created_at=D1, image_url="")
        for i, n, b, p in rows
    ])


def test_goods(spark, as_of):
    first = goods.goods_info(_products(spark, ("1", "O'Neil 100%", "b", 5), ("2", "O'Neil 100%", "d", 9), ("3", "x_y", "b", 1)))
    got = collected(first, "sku_id")
    assert [(r["price_min"], r["price_max"], r["price_delta"]) for r in got[:2]] == [(5, 9, 0), (5, 9, 4)]
    assert got[0]["keywords"] == ["k", "l"]
    # Wildcards and quotes are searched literally.
    assert serving.goods_count(first, keyword="O'Neil").first().total == 2
    assert serving.goods_count(first, keyword="_").first().total == 1
    assert serving.goods_count(first, keyword="%").first().total == 2
    assert [r.sku_id for r in serving.goods_page(first, page=2, size=2).collect()] == ["3"]
    assert serving.goods_page(first, page=0).count() == 3
    assert page_views.goods_pages(serving.goods_count(first, brand="none")).first().pages == 1

    changed = goods.goods_info(_products(spark, ("1", "O'Neil 100%", "b", 5), ("3", "x_y", "b", 2), ("4", "new", "b", 3)))
    after = collected(goods.refreshed_goods(first, changed, as_of), "sku_id", "start_date")
    today = as_of.date()
    assert [(r["sku_id"], r["is_active"], r["start_date"] == today) for r in after] == [
        ("1", 0, False), ("1", 1, True), ("2", 0, False), ("3", 0, False), ("3", 1, True), ("4", 1, False),
    ]
    again = goods.refreshed_goods(goods.refreshed_goods(first, changed, as_of), changed, as_of)
    assert collected(again, "sku_id", "start_date") == after


def test_top_users(spark):
    users = make(spark, "ads_user_value", *[
        dict(buyer_phone=f"{i:02}", last_order_date=D1.date() if i else None, total_monetary=Decimal(i), value_tier=None)
        for i in range(13)
    ])
    top = page_views.daily_top_users(users)
    assert [r["buyer_phone"] for r in collected(top, "day_rank")] == [f"{i:02}" for i in range(12, 2, -1)]
    assert page_views.daily_top_users(users, "2024-01-02").count() == 0
    assert page_views.by_tier(top).first().value_tier == "低价值"
    assert page_views.user_recency(users.filter("buyer_phone = '05'"), "2024-01-11").first().recency_days == 10


def test_required_fields_and_trace(spark, sales, as_of):
    wide = summary.order_wide(*sales, as_of)
    blanks = {r.column_name: r.blank_rows for r in quality.required_fields(wide, ["city", "category"]).collect()}
    assert blanks == {"city": 2, "category": 0}
    days = summary.user_orders(*sales)
    assert tuple(quality.user_trace(days, *sales).first()) == (2, 0, 0)
    assert tuple(quality.user_trace(days.filter("buyer_phone = 'u1'"), *sales).first()) == (2, 0, 1)
    assert tuple(quality.wide_vs_items(wide, sales[0]).first()) == (5, 6, 1)


def test_catalog():
    assert len(TABLES) == 13
    for name, table in TABLES.items():
        assert set(table.key) | set(table.live) | set(table.partition_by) <= set(table.schema.names), name
        assert not any(f.nullable for f in table.schema if f.name in table.key)
        assert all(f.metadata["comment"] for f in table.schema)
    assert TABLES["dwd_order"].live == ("order_status", "actual_amount", "load_time")
    assert len(TABLES["dwd_order"].schema) == 26
