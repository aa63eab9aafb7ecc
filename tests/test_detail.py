"""Decoding and cleaning rules on hand-written messages."""

import json
from datetime import date, datetime
from decimal import Decimal

from martloom.functions import json_fields as J
from martloom.functions.vocabulary import DOCUMENTED, LIVE
from martloom.plans import detail
from martloom.sources import feeds, samples
from pyspark.sql import functions as F


def messages(spark, *texts):
    return spark.createDataFrame([(t if t is None or isinstance(t, str) else json.dumps(t),) for t in texts], "value string")


def docs(spark, *texts):
    return feeds.accepted(feeds.with_reject_reason(feeds.parse(feeds.nonempty(messages(spark, *texts)))))


def test_null_and_empty_payloads_are_dropped(spark):
    assert feeds.nonempty(messages(spark, None, "", "{}")).count() == 1


def test_reject_reasons(spark):
    texts = ['{"a":', "[1]", "7", "null", "\n {}", {"order_id": "1", "items": []}, {"order_id": "", "items": [{}]}]
    judged = feeds.with_reject_reason(feeds.parse(messages(spark, *texts)), required=("order_id",), items=True)
    assert [r.reason for r in judged.collect()] == ["malformed_json"] * 4 + [
        "missing_order_id",
        "no_items",
        "missing_order_id",
    ]
    assert feeds.accepted(judged).count() == 0
    assert feeds.rejected(judged).columns == ["value", "reason"]


def test_numbers_are_not_read_from_other_types(spark):
    d = docs(spark, {"a": "12.5", "b": True, "c": [1], "d": 2.345, "e": -2.345, "f": None, "g": 1e3, "h": 10**20})
    row = d.select(*[J.money(F.col("doc"), n).alias(n) for n in "abcdefgh"]).first()
    expected = ["0", "0", "0", "2.35", "-2.35", "0", "1000", "0"]
    assert [row[n] for n in "abcdefgh"] == [Decimal(x) for x in expected]
    row = d.select(*[J.money(F.col("doc"), n, from_text=True).alias(n) for n in "ab"]).first()
    assert list(row) == [Decimal("12.5"), Decimal("0")]


def test_whole_numbers(spark):
    d = docs(spark, {"a": 3.9, "b": -3.9, "c": "4", "d": 3_000_000_000, "e": None})
    row = d.select(*[J.whole(F.col("doc"), n, 1).alias(n) for n in "abcdex"]).first()
    assert list(row) == [3, -3, 1, 1, 1, 1]


def test_texts_flags_and_lists(spark):
    d = docs(spark, {"a": "", "b": 5, "c": True, "d": "true", "e": ["x", "y"], "f": "x", "g": []})
    c = F.col("doc")
    row = d.select(
        J.text(c, "a", "?"), J.text(c, "b", "?"), J.flag(c, "c"), J.flag(c, "d"), J.flag(c, "zz"),
        J.joined_list(c, "e"), J.joined_list(c, "f"), J.joined_list(c, "g"),
    ).first()
    assert list(row) == ["?", "5", True, False, False, "x,y", "", ""]


def test_timestamps(spark, as_of):
    given = ["2024-02-03T04:05:06", "2024-02-03 04:05:06.7", "2024-02-03T04:05", "2024-02-03", "soon", ""]
    d = docs(spark, *[{"t": t} for t in given], {})
    stamp = F.lit(as_of).cast("timestamp")
    rows = d.select(
        J.timestamp(F.col("doc"), "t", stamp).alias("live"),
        J.timestamp(F.col("doc"), "t", stamp, lenient=False).alias("documented"),
    ).collect()
    full = datetime(2024, 2, 3, 4, 5, 6)
    assert [r.live for r in rows] == [full, full] + [as_of] * 5
    assert [r.documented for r in rows] == [full, as_of, datetime(2024, 2, 3, 4, 5)] + [as_of] * 4


def test_product_presets(spark, as_of):
    d = docs(spark, {"price": -5}, {"product_id": "p", "name": "n", "category": "c", "price": 1}, {"price": None})
    live = detail.product_rows(d, as_of, LIVE).collect()
    assert [(r.product_id, r.name, r.category, r.price, r.is_abnormal) for r in live][0] == (
        "-", "?", "", Decimal("-5.00"), False,
    )
    rows = detail.product_rows(d, as_of, DOCUMENTED).collect()
    assert [(r.product_id, r.name, r.category, r.price, r.is_abnormal) for r in rows] == [
        ("UNKNOWN", "未知商品", "其他", Decimal("0.00"), True),
        ("p", "n", "c", Decimal("1.00"), False),
        ("UNKNOWN", "未知商品", "其他", Decimal("0.00"), True),
    ]
    assert len(rows[0]) == 13


ORDER = {
    "order_id": "o1",
    "items": [{"product_id": "a", "quantity": 2, "price": 3, "subtotal": 6.005}, {"quantity": "2"}],
    "item_count": 9,
    "order_amount": 10,
    "actual_amount": 9.5,
    "payment": {"method": "card", "amount": 9.5, "paid_at": "2024-01-01 01:00:00"},
    "logistics": {"company": "x", "shipped_at": "2024-01-02T00:00:00", "estimated_delivery": "2024-01-05"},
    "created_at": "2024-01-01T00:00:00",
}


def test_order_states(spark, as_of):
    states = ["已取消", "已发货", "completed", "已付款", "", "mystery"]
    rows = detail.order_rows(docs(spark, *[{**ORDER, "order_status": s} for s in states]), as_of).collect()
    assert [r.order_status for r in rows] == ["已取消", "已发货", "已完成", "已付款", "待付款", "mystery"]
    cancelled, shipped, completed, paid = rows[:4]
    assert (cancelled.payment_method, cancelled.payment_amount, cancelled.payment_time) == (None, None, None)
    assert cancelled.actual_amount == 0 and cancelled.logistics_company is None
    assert shipped.logistics_company == "x" and shipped.estimated_delivery == date(2024, 1, 5)
    assert completed.shipped_at == datetime(2024, 1, 2)
    assert paid.logistics_company is None and paid.shipped_at is None and paid.payment_amount == Decimal("9.50")
    assert {r.item_count for r in rows} == {2} and len(rows[0]) == 26
    no_date = detail.order_rows(docs(spark, {**ORDER, "order_status": "已发货"}), as_of, keep_delivery_date=False)
    assert no_date.first().estimated_delivery is None


def test_missing_nested_objects(spark, as_of):
    row = detail.order_rows(docs(spark, {"order_id": "o"}), as_of).first()
    assert (row.buyer_name, row.city, row.payment_amount, row.item_count) == ("", "", None, 0)
    assert row.created_at == as_of


def test_header_is_read_in_one_pass_as_its_paths_are(spark, as_of):
    odd = [None, "", "x", 5, 2.5, True, [], [{"name": "n"}], {}, {"name": 1, "method": ["m"], "paid_at": None, "company": {"a": 1}}]
    odd += [{"name": None, "amount": "7", "city": False, "shipped_at": "2024-01-02T00:00:00"}, {"Name": "other"}, "12.5", 10**20]
    names = ("buyer", "shipping_address", "payment", "logistics", "order_amount", "discount", "actual_amount", "remark")
    given = docs(spark, {}, {"order_id": "o"}, *[{n: v} for n in names for v in odd], *[dict.fromkeys(names, v) for v in odd])
    read = given.select("doc", J.fields(F.col("doc"), detail.ORDER_HEADER).alias("h"))
    for path in ("buyer.name", "shipping_address.city", "payment.method", "payment.paid_at", "logistics.company", "remark"):
        alone = F.try_variant_get("doc", f"$.{path}", "string")
        assert read.filter(~alone.eqNullSafe(F.col(f"h.{path}"))).count() == 0, path
    for path in ("payment.amount", "order_amount", "discount", "actual_amount"):
        alone = F.to_json(F.try_variant_get("doc", f"$.{path}", "variant"))
        assert read.filter(~alone.eqNullSafe(F.to_json(F.col(f"h.{path}")))).count() == 0, path
    rows = detail.order_rows(given, as_of)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "$.buyer.name" not in plan and "$.payment" not in plan and "$.logistics" not in plan
    assert rows.filter(F.col("buyer_name") == "1").count() == 2
    assert rows.filter(F.col("payment_method") == '["m"]').count() == 2
    assert rows.filter(F.col("payment_amount") == 7).count() == 2
    assert rows.filter(F.col("payment_amount").isNotNull()).count() == 2 * sum(isinstance(v, dict) for v in odd)
    assert sorted({r.order_amount for r in rows.collect()}) == [Decimal(x) for x in ("0.00", "2.50", "5.00", "12.50")]


def test_length_of_lists_of_anything(spark):
    lists = [[], [1], [None, "x", {}, [1, 2], True], {"a": 1}, "text", None, 3]
    given = docs(spark, *[{"items": v} for v in lists], {}).select(J.list_size(F.col("doc"), "items").alias("n"))
    assert [r.n for r in given.collect()] == [0, 1, 5, 0, 0, 0, 0, 0]
    assert "ArrayType(VariantType" not in given._jdf.queryExecution().optimizedPlan().toString()


def test_begin_of_messages(spark):
    texts = [" \t\r\n{}", "{} \n", "{", "}", " ", "x{}", "\u00a0{}", "{}{}", " [] "]
    parsed = feeds.parse(feeds.nonempty(messages(spark, *texts, "", None)))
    assert [r.value for r in parsed.filter("doc IS NOT NULL").collect()] == [" \t\r\n{}", "{} \n", "{}{}"]
    plan = feeds.parse(messages(spark, "{}"))._jdf.queryExecution().optimizedPlan().toString()
    assert "ltrim" in plan and " trim(" not in plan


def test_headers_of_the_order_feed_are_written_before_items_are_joined(spark, tmp_path):
    def table(name, schema, *rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    day = datetime(2024, 1, 1)
    table("region", "r_regionkey int, r_name string", (1, "R"))
    table("nation", "n_nationkey int, n_name string, n_regionkey int", (1, "N", 1))
    table("customer", "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", (1, 'C "}{"', 1, None))
    orders = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    table("orders", orders, (1, 1, "O", 9.5, day, "p"), (2, 1, None, None, None, None), (None, 1, "F", 1.0, day, "p"), (6, 1, "O", 1.0, day, "p"))
    table("part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", (1, "}", None, "t", 1, 2.0))
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate date"
    bought = [(o, 1, 3, n, 2.0, 4.0, day.date()) for o, n in ((1, 1), (1, 1), (1, 2), (6, 1))]
    table("lineitem", line, *bought, (2, 1, None, None, None, None, None))
    feed = samples.order_feed(spark, str(tmp_path))
    sent = [json.loads(r.value) for r in feed.collect()]
    assert sorted((m.get("order_id", "-"), m["part"], len(m.get("items", []))) for m in sent) == [
        ("-", "none", 0), ("1", "1-3-4.00-2-2024-01-01", 1), ("1", "1-3-4.00-2-2024-01-01", 1), ("1", "2-3-4.00-2-2024-01-01", 1),
        ("2", "", 1), ("6", "1-3-4.00-2-2024-01-01", 0),
    ]
    assert {m["buyer"]["name"] for m in sent} == {'C "}{"'}
    assert [list(m) for m in sent if m.get("order_id") == "1"][0][:5] == ["order_id", "order_status", "part", "items", "item_count"]
    above, below = feed._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter", 1)
    assert "date_format" in below and "date_format" not in above


def test_items(spark, as_of):
    live = detail.item_rows(docs(spark, ORDER, {"order_id": "empty", "items": []}), as_of, LIVE).collect()
    assert [(r.item_no, r.product_id, r.quantity, r.sales_volume, r.subtotal) for r in live] == [
        (1, "a", 2, 1, Decimal("6.01")),
        (2, "", 1, 1, Decimal("0.00")),
    ]
    typed = detail.item_rows(docs(spark, ORDER), as_of).collect()
    assert [(r.product_id, r.product_name, r.category, r.quantity) for r in typed] == [
        ("a", "未知商品", "其他", 2),
        ("UNKNOWN", "未知商品", "其他", 2),
    ]


def test_typed_decode_ignores_unknown_fields(spark):
    row = feeds.decode_orders(messages(spark, {**ORDER, "extra": {"deep": 1}})).first()
    assert row.order_id == "o1" and row.payment.method == "card" and row["items"][0].quantity == 2
    product = feeds.decode_products(messages(spark, {"product_id": "p", "keywords": ["a"], "x": 1})).first()
    assert product.product_id == "p" and product.keywords == ["a"]
