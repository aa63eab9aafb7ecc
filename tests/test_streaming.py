"""Feeds into the warehouse, refreshes, and event-time operators."""

import json
import time
from datetime import datetime

import pytest
from martloom.functions.vocabulary import LIVE
from martloom.sources import feeds
from martloom.sources.warehouse import ORDERS, PRODUCTS, REFRESH, WRITERS, Warehouse
from martloom.streaming import event_windows, ingest, refresh
from pyspark.sql import functions as F

NOW = datetime(2030, 1, 1)


def message(oid, state="paid", day=1, items=("a", "b"), buyer="u1", amount=50):
    return json.dumps(
        {
            "order_id": oid,
            "order_status": state,
            "items": [
                {"product_id": p, "product_name": f"n{p}", "category": "c" + p, "quantity": 2, "price": 5, "subtotal": 10}
                for p in items
            ],
            "buyer": {"name": "N", "phone": buyer},
            "shipping_address": {"province": "P", "city": f"C{day}", "district": "D"},
            "payment": {"method": "card", "amount": amount, "paid_at": f"2024-01-0{day}T01:00:00"},
            "order_amount": amount,
            "actual_amount": amount,
            "created_at": f"2024-01-0{day}T00:00:00",
        }
    )


FILES = [
    [message("1"), message("2", buyer="u2"), "{broken"],
    [message("3", day=2, items=("a", "a")), message("1", "completed", items=("z",)), ""],
    [message("4", items=()), message("2", "cancelled", day=3, amount=70), message("5", day=2), message("5", "paid", day=2)],
    [message("6", day=1, buyer=""), message("3", "shipped", day=2)],
]


@pytest.fixture(autouse=True)
def interpreted(spark):
    """A handful of rows is done sooner than its code is compiled."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "2"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture
def folder(tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    for n, lines in enumerate(FILES):
        write(feed, n, lines)
    return tmp_path


def write(feed, n, lines):
    # Streams take files by modification time, so files are written one after another.
    (feed / f"{n:03}.txt").write_text("\n".join(lines) + "\n")
    time.sleep(0.02)


def run(wh, folder, checkpoint="cp", defaults=None, after=None, feed="feed", per_batch=None):
    options = {"defaults": defaults} if defaults else {}
    ingest.start(
        wh, feeds.file_feed(wh.spark, str(folder / feed), per_batch), ingest.ingest_orders, str(folder / checkpoint),
        clock=lambda: NOW, after=after, **options,
    ).awaitTermination()


def content(wh, table, drop=()):
    rows = [r.asDict(recursive=True) for r in wh.read(table).drop("first_seq", "last_seq", *drop).collect()]
    return sorted(map(str, rows))


def test_stream_equals_batch_and_replay_changes_nothing(spark, folder):
    streamed, whole = Warehouse(spark, str(folder / "streamed")), Warehouse(spark, str(folder / "whole"))

    def every_other(version):
        if version % 2 == 0:
            refresh.refresh_touched(streamed, NOW, overwrite_wide=True)

    run(streamed, folder, after=every_other, per_batch=1)
    assert streamed.head(ORDERS)["version"] == len(FILES)
    assert streamed.head(REFRESH)["version"] == len(FILES) // 2

    ingest.ingest_orders(whole, feeds.file_messages(spark, str(folder / "feed")), NOW)
    refresh.refresh(whole, NOW)
    tables = ["dwd_order", "dwd_order_item", "rejected_orders", *WRITERS[REFRESH]]
    first = {t: content(streamed, t) for t in tables}
    assert first == {t: content(whole, t) for t in tables}
    assert len(first["dwd_order"]) == 5 and len(first["rejected_orders"]) == 2

    rows = {r.order_id: r for r in streamed.read("dwd_order").collect()}
    assert (rows["1"].order_status, rows["2"].order_status, rows["3"].order_status) == ("已完成", "已取消", "已发货")
    # Payment and day stay as first seen; a cancelled order's amount becomes 0.
    assert (rows["2"].payment_method, rows["2"].actual_amount, str(rows["2"].dt)) == ("card", 0, "2024-01-01")
    assert sorted(r.product_id for r in streamed.read("dwd_order_item").filter("order_id = '1'").collect()) == ["a", "b"]
    assert streamed.read("dwd_order_item").filter("order_id = '5'").count() == 2

    run(streamed, folder, "another-checkpoint")
    refresh.refresh_touched(streamed, NOW, overwrite_wide=True)
    for t in tables:
        if t != "rejected_orders":
            assert content(streamed, t) == first[t], t


def test_restart_resumes_and_committed_batches_are_skipped(spark, folder):
    wh = Warehouse(spark, str(folder / "wh"))
    run(wh, folder)
    write(folder / "feed", 9, [message("9", day=3)])
    run(wh, folder)
    assert wh.head(ORDERS)["version"] == 2
    assert wh.read("dwd_order").count() == 6
    again = ingest.ingest_orders(
        wh, feeds.file_messages(spark, str(folder / "feed")), NOW, source=str(folder / "cp"), batch_id=0
    )
    assert again is None and wh.head(ORDERS)["version"] == 2


def test_failed_attempt_leaves_nothing_visible(spark, folder):
    wh = Warehouse(spark, str(folder / "wh"))
    run(wh, folder)
    before = content(wh, "dwd_order_item")
    change = wh.begin(ORDERS)
    change.append("dwd_order_item", wh.read("dwd_order_item"))
    assert content(wh, "dwd_order_item") == before
    other = wh.begin(ORDERS)
    other.commit()
    with pytest.raises(RuntimeError):
        change.commit()


def test_live_preset_keeps_empty_orders_and_takes_their_later_items(spark, folder):
    (folder / "live").mkdir()
    write(folder / "live", 0, [message("7", items=())])
    write(folder / "live", 1, [message("7", items=("a",)), message("7", items=("b",))])
    wh = Warehouse(spark, str(folder / "wh"))
    run(wh, folder, defaults=LIVE, feed="live", per_batch=1)
    assert wh.read("dwd_order").first().item_count == 1
    assert [r.product_id for r in wh.read("dwd_order_item").collect()] == ["a"]


def test_wide_rows_stay_stale_unless_overwritten(spark, folder):
    wh = Warehouse(spark, str(folder / "wh"))
    run(wh, folder, after=lambda v: refresh.refresh_touched(wh, NOW) if v in (1, 2) else None, per_batch=1)
    states = {r.order_id: r.order_status for r in wh.read("dws_order_wide").collect()}
    assert (states["1"], states["2"], states["3"]) == ("已付款", "已付款", "已付款")
    assert wh.read("dws_order_wide").filter("order_id = '3'").count() == 1
    refresh.refresh(wh, NOW)
    states = {r.order_id: r.order_status for r in wh.read("dws_order_wide").collect()}
    assert (states["1"], states["2"], states["3"], states["5"]) == ("已付款",) * 4
    refresh.refresh(wh, NOW, overwrite_wide=True)
    states = {r.order_id: r.order_status for r in wh.read("dws_order_wide").collect()}
    assert (states["1"], states["2"], states["3"]) == ("已完成", "已取消", "已发货")
    assert refresh.refresh_touched(wh, NOW) is None


def test_products_compact_and_prune(spark, tmp_path):
    feed = tmp_path / "products"
    feed.mkdir()
    for n in range(4):
        lines = [json.dumps({"product_id": p, "name": f"{p}{n}", "category": f"c{n}", "price": n}) for p in "xyz"[: n + 1]]
        write(feed, n, [*lines, "broken"])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    source = feeds.file_feed(spark, str(feed), 1)
    ingest.start(wh, source, ingest.ingest_products, str(tmp_path / "cp"), clock=lambda: NOW).awaitTermination()
    rows = {r.product_id: (r.name, r.category, int(r.price)) for r in wh.read("dwd_product").collect()}
    assert rows == {"x": ("x3", "c0", 3), "y": ("y3", "c1", 3), "z": ("z3", "c2", 3)}
    before = content(wh, "dwd_product")
    wh.compact("dwd_product")
    assert len(wh.head(PRODUCTS)["tables"]["dwd_product"][""]) == 1
    assert wh.prune(PRODUCTS, keep=1) == 4
    assert content(wh, "dwd_product") == before
    assert wh.read("rejected_products").count() == 4
    with pytest.raises(ValueError):
        wh.compact("dws_order_wide")


def test_orders_compact_then_change(spark, folder):
    wh = Warehouse(spark, str(folder / "wh"))
    run(wh, folder)
    refresh.refresh_touched(wh, NOW)
    wh.compact("dwd_order")
    assert refresh.refresh_touched(wh, NOW) is None
    write(folder / "feed", 9, [message("1", "cancelled")])
    run(wh, folder)
    rows = {r.order_id: r.order_status for r in wh.read("dwd_order").collect()}
    assert rows["1"] == "已取消" and len(rows) == 5
    assert wh.days_touched(ORDERS, "dwd_order", wh.head(REFRESH)["order_version"]) == ["2024-01-01"]
    wh.prune(ORDERS, keep=1)
    assert wh.read("dwd_order").count() == 5


def test_timed_refresh(spark, folder):
    wh = Warehouse(spark, str(folder / "wh"))
    run(wh, folder)
    query = refresh.start_refresh(wh, str(folder / "ticks"), every="1 second", clock=lambda: NOW)
    deadline = time.time() + 90
    while wh.head(REFRESH)["version"] == 0 and time.time() < deadline and query.isActive:
        time.sleep(0.5)
    query.stop()
    assert wh.read("ads_daily_sales_trend").count() == 2


def test_start_positions(spark):
    with pytest.raises(ValueError):
        feeds.kafka_feed(spark, "host:1", feeds.ORDER_TOPIC, start="middle")


@pytest.fixture
def events(spark, tmp_path):
    """Four files in time order; the last one also brings a row of the first day."""
    folder = tmp_path / "events"
    rows = spark.range(400).select(
        "id",
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("ts"),
        (F.col("id") % 3).cast("string").alias("kind"),
        F.lit(1.5).alias("value"),
    )
    late = rows.filter("id = 0").withColumn("id", F.lit(1000).cast("bigint"))
    for n in range(4):
        part = rows.filter(f"id div 100 = {n}")
        (part.unionByName(late) if n == 3 else part).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(folder)), rows


def drained(df, tmp_path, name):
    out, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-cp")
    query = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out), query


def test_daily_windows_close_and_drop_late_rows(events, tmp_path):
    stream, table = events
    closed, query = drained(event_windows.daily_windows(stream, ["kind"], "value"), tmp_path, "days")
    whole = event_windows.daily_windows(table, ["kind"], "value")
    # 400 hours reach into the 17th day; the watermark one day behind has closed the first 15.
    expected = sorted(map(tuple, whole.filter("dt < '2024-01-16'").collect()))
    assert sorted(map(tuple, closed.collect())) == expected
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1


def test_repeats_and_running_distinct(events, tmp_path):
    stream, table = events
    twice = stream.unionByName(stream)
    kept, _ = drained(event_windows.without_repeats(twice, ["id"], delay="30 days"), tmp_path, "once")
    assert kept.count() == 401
    assert event_windows.without_repeats(table.unionByName(table), ["id"]).count() == 400
    about = event_windows.running_distinct(table, ["kind"], "id")
    assert {r.distinct_about for r in about.filter("dt = '2024-01-02'").collect()} == {8}
    closed, _ = drained(event_windows.running_distinct(stream, ["kind"], "id"), tmp_path, "distinct")
    assert closed.count() == 45


def test_messages_without_id_are_rejected(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    nameless = json.dumps({k: v for k, v in json.loads(message("1")).items() if k != "order_id"})
    write(tmp_path / "feed", 0, [message("1"), nameless, nameless])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    ingest.ingest_orders(wh, feeds.file_messages(spark, str(tmp_path / "feed")), NOW)
    assert [r.reason for r in wh.read("rejected_orders").collect()] == ["missing_order_id"] * 2
    assert wh.read("dwd_order").count() == 1
    assert wh.read("dwd_order_item").count() == 2


def part_of(oid, part, items, state="paid"):
    return json.dumps(json.loads(message(oid, state, items=items)) | {"part": part})


def test_an_order_in_several_messages_keeps_all_its_items(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    sizes = {"x": 1000, "y": 1000, "z": 500}
    texts = {p: part_of("1", p, [f"{p}{i}" for i in range(n)]) for p, n in sizes.items()}
    write(tmp_path / "feed", 0, [texts["x"], texts["y"], texts["x"]])
    write(tmp_path / "feed", 1, [texts["z"], texts["y"], message("1", "completed", items=("late whole",))])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run(wh, tmp_path, per_batch=1)

    def stored():
        rows = wh.read("dwd_order_item")
        return rows.count(), rows.select("part", "item_no").distinct().count(), wh.read("dwd_order").first().item_count

    assert stored() == (2500, 2500, 2500)
    run(wh, tmp_path, checkpoint="again")
    assert stored() == (2500, 2500, 2500)
    wh.compact("dwd_order")
    assert stored() == (2500, 2500, 2500)
    assert wh.read("dwd_order").first().order_status == "已完成"


def test_refresh_reads_one_commit(spark, tmp_path, monkeypatch):
    (tmp_path / "feed").mkdir()
    write(tmp_path / "feed", 0, [message("1")])
    wh = Warehouse(spark, str(tmp_path / "wh"))
    ingest.ingest_orders(wh, feeds.file_messages(spark, str(tmp_path / "feed")), NOW)
    (tmp_path / "late").mkdir()
    write(tmp_path / "late", 0, [message("2"), message("3", day=2)])
    late = feeds.file_messages(spark, str(tmp_path / "late"))
    stage, touched, pending = wh.stage, wh.days_touched, [1]

    def once():
        if pending:
            pending.pop()
            ingest.ingest_orders(wh, late, NOW)

    def staged(df, label):
        out = stage(df, label)
        if label == "orders":
            once()
        return out

    def days_touched(*args):
        days = touched(*args)
        once()
        return days

    monkeypatch.setattr(wh, "stage", staged)
    refresh.refresh_touched(wh, NOW)
    assert [r.order_id for r in wh.read("dws_order_wide").select("order_id").distinct().collect()] == ["1"]
    monkeypatch.setattr(wh, "days_touched", days_touched)
    write(tmp_path / "late", 1, [message("4", day=3)])
    late, pending = feeds.file_messages(spark, str(tmp_path / "late")), [1]
    refresh.refresh_touched(wh, NOW)
    refresh.refresh_touched(wh, NOW)
    states = {r.order_id: r.order_status for r in wh.read("dws_order_wide").collect()}
    assert states == dict.fromkeys("1234", "已付款")
    assert [str(r.dt) for r in wh.read("ads_daily_sales_trend").orderBy("dt").collect()] == [f"2024-01-0{d}" for d in (1, 2, 3)]
