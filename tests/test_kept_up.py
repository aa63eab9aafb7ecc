"""Totals kept up to date, order days by lookup, goods history, live totals, catalog rules: on small tables and in the jobs."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_streaming import FILES, NOW, interpreted, message, part_of, run, write  # noqa: F401

from martloom.operators.keyed_merge import judged_parts
from martloom.plans import goods, maintained, metrics, quality, serving
from martloom.sources import catalog, feeds
from martloom.sources.warehouse import GOODS, ORDERS, PRODUCTS, REFRESH, WRITERS, Warehouse
from martloom.streaming import ingest, live_totals, refresh

DAYS = "buyer_phone string, buyer_name string, dt date, order_count bigint, total_amount decimal(25,2)"


def day(n):
    return date(2024, 1, n)


def test_totals_follow_their_rows(spark):
    """Added, changed and vanished rows; a greatest day that is gone is looked up again, and only then."""
    before = [("a", "A", day(1), 1, 5), ("a", "A", day(3), 2, 7), ("b", "B", day(3), 1, 1), ("c", "C", day(2), 1, 1)]
    after = [("a", "Z", day(1), 1, 5), ("a", "Z", day(2), 4, 9), ("c", "C", day(2), 1, 1), ("d", "D", day(3), 1, 2)]

    def frame(rows):
        return spark.createDataFrame([(p, n, d, c, Decimal(m)) for p, n, d, c, m in rows], DAYS)

    spec, touched = maintained.USERS, F.col("dt") >= F.lit("2024-01-02").cast("date")
    state = maintained.totals(frame(before), spec)
    moved = maintained.moved(state, frame(before).filter(touched), frame(after).filter(touched), spec)
    assert {r.buyer_phone for r in moved.filter(maintained.MARK).collect()} == {"a"}
    got = {r.buyer_phone: (r.buyer_name, r.dt, r.days, r.order_count, int(r.total_amount)) for r in maintained.settled(moved, frame(after), spec).collect()}
    assert got == {"a": ("A", day(2), 2, 5, 14), "c": ("C", day(2), 1, 1, 1), "d": ("D", day(3), 1, 1, 2)}
    same = maintained.moved(state, frame(before).filter(touched), frame(before).filter(touched), spec)
    assert sorted(same.drop(maintained.MARK).collect()) == sorted(state.collect()) and same.filter(maintained.MARK).count() == 0


def test_regions_roll_up_from_buyers(spark):
    rows = [("p", "c1", "d1", "o1", "u1", 5), ("p", "c1", "d1", "o1", "u1", 5), ("p", "c1", "d2", "o2", "u1", 1), ("p", "c2", "d3", "o3", "u2", 2), ("", "", "", "o4", "", 9)]
    wide = spark.createDataFrame([(*r[:5], Decimal(r[5])) for r in rows], "province string, city string, district string, order_id string, buyer_phone string, actual_amount decimal(15,2)")
    got = {(r.province, r.city, r.district): (r.total_orders, int(r.total_amount), r.buyer_count) for r in metrics.regional_rows(metrics.region_buyers(wide)).collect()}
    assert got == {("p", "合计", "合计"): (3, 13, 2), ("p", "c1", "合计"): (2, 11, 1), ("p", "c2", "合计"): (1, 2, 1), ("p", "c1", "d1"): (1, 10, 1), ("p", "c1", "d2"): (1, 1, 1), ("p", "c2", "d3"): (1, 2, 1)}
    plan = metrics.regional_rows(metrics.region_buyers(wide))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1


def test_refresh_reads_touched_days_only(spark, tmp_path, monkeypatch):
    """Late, repeated and cancelled orders: after every batch the metrics are those of a warehouse made from scratch."""
    (tmp_path / "feed").mkdir()
    for n, lines in enumerate(FILES[:3]):
        write(tmp_path / "feed", n, lines)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run(wh, tmp_path)
    first = refresh.refresh_touched(wh, NOW, overwrite_wide=True)
    assert isinstance(first, refresh.Refreshed)
    write(tmp_path / "feed", 8, [message("2", "cancelled", day=3), message("9", day=2, buyer="u9"), message("1", "completed")])
    run(wh, tmp_path)
    wh.days_touched = lambda *a, original=wh.days_touched: [*original(*a)]
    reads = []
    stored = Warehouse._stored

    def watched(self, table, parts, days):
        reads.append((table, days))
        return stored(self, table, parts, days)

    monkeypatch.setattr(Warehouse, "_stored", watched)
    checks = refresh.refresh_touched(wh, NOW, overwrite_wide=True).checks
    monkeypatch.undo()
    whole = [t for t, d in reads if d is None]
    assert set(whole) <= {*refresh.MAINTAINED, "ads_daily_sales_trend"}
    assert {tuple(d) for _, d in reads if d is not None} == {("2024-01-01", "2024-01-02")}

    other = Warehouse(spark, str(tmp_path / "other"))
    ingest.ingest_orders(other, feeds.file_messages(spark, str(tmp_path / "feed")), NOW)
    refresh.refresh(other, NOW)
    for table in WRITERS[REFRESH]:
        assert sorted(map(str, wh.read(table).collect())) == sorted(map(str, other.read(table).collect())), table
    # What the refresh counted while it wrote is what the checks count in the tables.
    assert checks["value_tier"] == {"checked": wh.read("ads_user_value").count(), "violations": 0}
    ratios = {r.check: (r.checked, r.violations) for r in quality.ratios(wh.read("dws_product_sales_1d", ["2024-01-01", "2024-01-02"]), wh.read("ads_daily_sales_trend")).collect()}
    assert ratios == {k: (checks[k]["checked"], checks[k]["violations"]) for k in ratios}
    blank = {r.column_name: r.blank_rows for r in quality.required_fields(wh.read("dws_order_wide"), refresh.REQUIRED).collect()}
    assert {k: v for k, v in checks["wide"].items() if k != "rows"} == blank
    assert checks["share_rank"]["categories"] == wh.read("ads_category_revenue").count()


def test_mixed_parts_are_rejects(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    write(tmp_path / "feed", 0, [part_of("1", "x", ["a"]), message("1", items=("b",)), part_of("1", "x", ["a"]), message("2"), part_of("2", "y", ["c"])])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    ingest.ingest_orders(wh, feeds.file_messages(spark, str(tmp_path / "feed")), NOW)
    rejects = [(r.reason, json.loads(r.value)["order_id"]) for r in wh.read("rejected_orders").collect()]
    assert sorted(rejects) == [("mixed_parts", "1"), ("mixed_parts", "2")]
    assert sorted(r.product_id for r in wh.read("dwd_order_item").collect()) == ["a", "a", "b"]
    offered = spark.createDataFrame([("1", "", 2), ("1", "p", 1), ("2", "q", 5)], "order_id string, part string, seq int")
    rows = judged_parts(offered, spark.createDataFrame([("2", "")], "order_id string, part string")).collect()
    assert sorted((r.order_id, r.part, r.fits, r.known) for r in rows) == [("1", "", False, False), ("1", "p", True, False), ("2", "q", False, False)]


def scanned(df):
    """Rows that the scan of a filtered table handed on, after row groups were left out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_order_days_are_looked_up(spark, tmp_path):
    """Few ids read few row groups of a large table, and its files are found again after compaction."""
    wh = Warehouse(spark, str(tmp_path / "wh"))
    n = 400_000
    for batch in range(2):
        ids = spark.range(batch, n, 2).select(F.sha2(F.col("id").cast("string"), 256).alias("order_id"), F.struct(F.lit(batch).cast("bigint").alias("batch"), F.lit("f").alias("origin"), F.col("id").alias("position"), F.lit(0).cast("bigint").alias("row")).alias("seq"), F.lit(day(1)).alias("dt"))
        change = wh.begin(ORDERS)
        change.append("order_days", ids)
        change.commit()
    some = spark.range(5).select(F.sha2(F.col("id").cast("string"), 256).alias("order_id"))
    for _ in range(2):
        found = ingest.stored_days(wh.read("order_days"), some)
        assert found.count() == 5 and scanned(found) <= 5 * 10_500  # a row group for each id
        assert ingest.stored_days(wh.read("order_days"), wh.read("order_days")).count() == n
        wh.compact("order_days")


def test_goods_history_shuffles_versions_once(spark):
    """The price range of a line and its versions are read from one shuffle of the versions."""
    rows = [("1", "n", "b", "c", "s", i, "", "", f"2024-01-0{i}") for i in range(1, 4)]
    versions = spark.createDataFrame(rows, "product_id string, name string, brand string, category string, sub_category string, price int, image_url string, keywords string, day string")
    versions = versions.withColumn("price", F.col("price").cast("decimal(15,2)")).withColumn("created_at", F.col("day").cast("timestamp"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        history = goods.goods_history(versions).select("sku_id", "spu_name", "sku_price", "price_min", "price_max", "start_date", "end_date", "is_active")
        plan = history._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning(product_id" in line and "ReusedExchange" not in line]
    assert len(shuffled) == 2, plan


def test_goods_history_and_its_job(spark, tmp_path):
    fields = "product_id string, name string, brand string, category string, sub_category string, price decimal(15,2), image_url string, keywords string, created_at timestamp, n int"
    rows = [("1", "x", 5, 1, 0), ("1", "x", 6, 3, 0), ("1", "x", 6, 4, 0), ("1", "y", 6, 7, 1), ("1", "z", 6, 7, 2), ("1", "x", 5, 9, 0), ("2", "x", 9, 2, 0)]
    versions = spark.createDataFrame([(i, name, "b", "c", "s", Decimal(p), "", "k,l", datetime(2024, 1, d, 5), n) for i, name, p, d, n in rows], fields)
    got = sorted((r.sku_id, r.spu_name, int(r.sku_price), r.start_date.day, str(r.end_date), r.is_active) for r in goods.goods_history(versions, "created_at", "n").collect())
    assert got == [("1", "x", 5, 1, "2024-01-02", 0), ("1", "x", 5, 9, "9999-12-31", 1), ("1", "x", 6, 3, "2024-01-06", 0), ("1", "z", 6, 7, "2024-01-08", 0), ("2", "x", 9, 2, "9999-12-31", 1)]
    assert goods.goods_history(versions.limit(0)).count() == 0

    feed = tmp_path / "products"
    feed.mkdir()
    wh = Warehouse(spark, str(tmp_path / "wh"))

    def report(n, price):
        write(feed, n, [json.dumps({"product_id": "x", "name": "X", "category": "c", "price": price, "created_at": f"2024-01-0{n}T00:00:00"})])
        ingest.start(wh, feeds.file_feed(spark, str(feed), 1), ingest.ingest_products, str(tmp_path / "cp"), clock=lambda: NOW).awaitTermination()

    report(1, 5)
    report(4, 6)
    refresh.refresh_goods(wh, NOW)
    rows = sorted((r.start_date.day, str(r.end_date), int(r.sku_price), r.is_active) for r in wh.read("dim_goods_info").collect())
    assert rows == [(1, "2024-01-03", 5, 0), (4, "9999-12-31", 6, 1)]
    report(5, 7)
    refresh.refresh_goods(wh, NOW)
    rows = sorted((str(r.start_date), str(r.end_date), int(r.sku_price), r.is_active) for r in wh.read("dim_goods_info").collect())
    assert rows == [("2024-01-01", "2024-01-03", 5, 0), ("2024-01-04", "2029-12-31", 6, 0), ("2030-01-01", "9999-12-31", 7, 1)]
    assert wh.head(GOODS)["version"] == 2 and wh.head(PRODUCTS)["version"] == 3


def test_live_totals_equal_the_batch(spark, tmp_path):
    """In update mode, over a restart, with repeated parts; a row far too late is counted for the caller."""
    feed = tmp_path / "feed"
    feed.mkdir()
    write(feed, 0, [message("1"), message("2", day=2), "{broken"])
    write(feed, 1, [message("1"), message("3", day=3, items=("a", "a"))])

    def go():
        items = live_totals.item_feed(feeds.file_feed(spark, str(feed), 1), NOW, "10 days")
        live = live_totals.start(live_totals.daily_totals(items), str(tmp_path / "totals"), str(tmp_path / "cp"))
        live.query.awaitTermination()
        late = live.late_rows()
        live.stop()
        return late

    assert go() == 0
    write(feed, 2, [message("4", day=3), message("2", "completed", day=2), part_of("5", "p", ["a"]), part_of("5", "q", ["b"])])
    assert go() == 0
    wh = Warehouse(spark, str(tmp_path / "wh"))
    ingest.ingest_orders(wh, feeds.file_messages(spark, str(feed)), NOW)
    refresh.refresh(wh, NOW)
    want = wh.read("dws_category_sales_1d").select(*live_totals.KEY, *live_totals.MEASURES)
    got = live_totals.latest(spark, str(tmp_path / "totals")).select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect())
    for n, oid in ((3, "6"), (4, "8")):  # a batch closes days for the batches after the next
        write(feed, n, [json.dumps(json.loads(message(oid)) | {"created_at": f"2024-03-0{n}T00:00:00"})])
    write(feed, 5, [message("7")])
    assert go() == 1
    again = {(r.category, r.dt): r.total_quantity for r in live_totals.latest(spark, str(tmp_path / "totals")).collect()}
    assert again[("ca", day(1))] == {(r.category, r.dt): r.total_quantity for r in want.collect()}[("ca", day(1))]


def test_catalog_fills_and_refuses(spark):
    table = catalog.TABLES["dwd_order_item"]
    given = spark.createDataFrame([("1", "", 1, "p", "n", None), ("1", "", 2, None, "n", None)], "order_id string, part string, item_no int, product_id string, product_name string, price decimal(15,2)")
    rows = catalog.filled(given.drop("price"), table, NOW)
    assert rows.columns == table.schema.names
    first = rows.filter("item_no = 1").first()
    assert (first.price, first.quantity, first.subtotal, first.brand, first.load_time) == (0, 1, 0, None, NOW)
    assert [r.x for r in rows.orderBy("item_no").select(catalog.refusal(table).alias("x")).collect()] == [None, "product_id"]
    assert catalog.filled(given, table, NOW).select(catalog.refusal(table).alias("x")).distinct().count() == 2
    with pytest.raises(Exception, match="dwd_order_item.product_id is NULL"):
        catalog.enforced(rows, table).collect()
    assert catalog.enforced(rows.filter("item_no = 1"), table).count() == 1


def test_typed_rejects(spark):
    texts = ['{"product_id":"1","is_variant":true}', '{"product_id":"2","is_variant":"yes"}', '{"product_id":"3","keywords":5}', '{"product_id":', '[1]', '{"product_id":"4","other":{}}']
    judged = feeds.with_typed_reason(spark.createDataFrame([(t,) for t in texts], "value string"), feeds.PRODUCT_EVENT).collect()
    assert [r.reason for r in judged] == [None, "wrong_type", "wrong_type", "malformed_json", "malformed_json", None]
    assert judged[0].event.is_variant is True and "_bad_record" not in judged[0].event.asDict()


def test_pages_are_sought(spark):
    """Every page equals the one that skips all before it; a late page reads no more days than an early one."""
    n, size = 3000, 7
    rows = spark.range(n).select(
        F.format_string("%05d", "id").alias("sku_id"), F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,cast(id % 300 as int),cast(id % 5 as int))").alias("dw_create_time"),
        F.lit(1).alias("is_active"), F.lit("c").alias("first_category_name"), F.lit("b").alias("brand_name"), F.lit("x").alias("spu_name"), F.lit("x").alias("sku_name"),
    ).cache()
    index = [(r.day, r.goods) for r in serving.goods_days(rows).collect()]
    every = [r.sku_id for r in serving.goods_page(rows, page=1, size=n).collect()]
    for page in (1, 2, 200, 429, 430):
        sought = [r.sku_id for r in serving.goods_page_sought(rows, index, page=page, size=size).collect()]
        assert sought == every[(page - 1) * size : page * size], page
    last = None
    for page in range(3):
        got = serving.goods_after(rows, *((last.dw_create_time, last.sku_id) if last else ()), size=size).collect()
        assert [r.sku_id for r in got] == every[page * size : (page + 1) * size]
        last = got[-1]
    plan = serving.goods_page_sought(rows, index, page=400, size=size)._jdf.queryExecution().optimizedPlan().toString()
    assert "Offset 3" in plan or "Offset" not in plan or int(plan.split("Offset ")[1].split()[0].rstrip(",")) < 20
