"""Merges, ranks and skewed joins."""

from decimal import Decimal

import pytest
from martloom.operators.keyed_merge import (
    append_groups,
    as_changes,
    first_per_key,
    insert_absent,
    merge_changes,
    upsert_metrics,
)
from martloom.operators.order_join import items_with_orders
from martloom.operators.ranking import rank_by
from martloom.plans import summary
from martloom.plans.goods import goods_info
from pyspark.sql import Window
from pyspark.sql import functions as F


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_merge_keeps_first_and_takes_last(spark):
    changes = spark.createDataFrame(
        [("p", "old", 1, 2), ("p", "new", None, 3), ("p", "older", 5, 1), ("q", "x", 7, 9)],
        "id string, name string, price int, seq int",
    )
    merged = merge_changes(as_changes(changes), ["id"], ["name"], ["price"])
    assert rows(merged, "id") == [("p", "older", None), ("q", "x", 7)]


def test_merge_is_associative(spark):
    data = spark.range(2000).select(
        (F.col("id") % 7).alias("k"), F.hash("id").alias("a"), F.hash(F.col("id") + 1).alias("b"), F.col("id").alias("seq")
    )
    at_once = merge_changes(as_changes(data), ["k"], ["a"], ["b"])
    part = merge_changes(as_changes(data.filter("seq < 900")), ["k"], ["a"], ["b"], keep_seq=True)
    both = part.unionByName(as_changes(data.filter("seq >= 900")))
    assert rows(merge_changes(both, ["k"], ["a"], ["b"]), "k") == rows(at_once, "k")


def test_insert_absent(spark):
    state = spark.createDataFrame([("o1", "a", 0)], "o string, p string, n int")
    new = spark.createDataFrame([("o1", "a", 1), ("o1", "b", 3), ("o1", "b", 2)], "o string, p string, n int")
    assert rows(insert_absent(state, new, ["o", "p"], ["n"]), "p") == [("o1", "b", 2)]
    assert insert_absent(None, new, ["o", "p"], ["n"]).count() == 2


def test_append_groups_takes_the_first_message_only(spark):
    state = spark.createDataFrame([("o1", 1, 0)], "o string, item int, seq int")
    new = spark.createDataFrame([("o1", 9, 1), ("o2", 1, 2), ("o2", 2, 2), ("o2", 1, 3)], "o string, item int, seq int")
    assert rows(append_groups(state, new, "o", "seq"), "item") == [("o2", 1, 2), ("o2", 2, 2)]
    assert append_groups(None, new, "o").count() == 4


def test_upsert_metrics(spark):
    state = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, label string, n int")
    new = spark.createDataFrame([("b", "z", None), ("c", "w", 4)], "k string, label string, n int")
    merged = upsert_metrics(state, new, ["k"], ["label"], ["n"])
    assert rows(merged, "k") == [("a", "x", 1), ("b", "y", None), ("c", "w", 4)]


@pytest.mark.parametrize("spread", [None, "id"])
def test_rank_equals_window_rank(spark, spread):
    third_alike = F.when(F.col("id") % 3 == 0, 1).otherwise((F.hash("id") % 500) * F.col("id"))
    data = spark.range(5000).select("id", F.when(F.col("id") < 4990, third_alike).cast("bigint").alias("v"))
    w = Window.orderBy(F.desc("v"))
    plain = data.filter("v is not null").select("id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("d"))
    ranked = rank_by(data, "v", dense="d", spread_by=spread)
    assert rows(ranked.filter("v is not null").select("id", "rank", "d"), "id") == rows(plain, "id")
    assert {r["rank"] for r in ranked.filter("v is null").collect()} == {None}


def test_rank_of_amounts_and_extremes(spark):
    values = ["-3.10", "0.00", "0.01", "99999999999.99", "99999999999.98", "-3.10"]
    data = spark.createDataFrame([(i, Decimal(v)) for i, v in enumerate(values)], "id int, v decimal(25,2)")
    assert [r["rank"] for r in rank_by(data, "v").orderBy("id").collect()] == [5, 4, 3, 1, 2, 5]
    big = spark.createDataFrame([(1, 2**62), (2, 2**62 + 1), (3, -(2**62))], "id int, v bigint")
    assert [r["rank"] for r in rank_by(big, "v").orderBy("id").collect()] == [2, 1, 3]


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which a test-sized skew counts as one."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _skewed_sales(spark, n=60_000):
    """A third of all items belong to one order."""
    items = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("order_id"),
        (F.col("id") % 900).cast("string").alias("product_id"),
        F.lit("n").alias("product_name"),
        F.lit("b").alias("brand"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("category"),
        F.lit("s").alias("sub_category"),
        F.lit(Decimal("1.00")).cast("decimal(15,2)").alias("price"),
        F.lit(1).alias("quantity"),
        F.lit(Decimal("1.00")).cast("decimal(15,2)").alias("subtotal"),
        F.col("id").cast("int").alias("item_no"),
    )
    ids = spark.range(-1, 5000).select(
        F.when(F.col("id") < 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id")
    )
    blank = {c: F.lit(c) for c in summary.WIDE_ORDER_COLUMNS if not c.endswith(("amount", "discount"))}
    amounts = {c: F.lit(Decimal("2.00")).cast("decimal(15,2)") for c in summary.WIDE_ORDER_COLUMNS if c not in blank}
    orders = ids.withColumns({**blank, **amounts, "created_at": F.lit("2024-01-01").cast("timestamp")})
    return items, orders


@pytest.mark.parametrize("build", [summary.wide_rows, summary.category_sales, summary.product_sales])
def test_hot_order_is_split(spark, small_partitions, build):
    items, orders = _skewed_sales(spark)
    df = build(items_with_orders(items, orders))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan, plan


def test_hot_name_is_split_when_a_total_is_joined_back(spark, small_partitions):
    units = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("name"),
        F.col("id").cast("string").alias("product_id"),
        F.lit("b").alias("brand"),
        F.lit("c").alias("category"),
        F.lit("s").alias("sub_category"),
        F.col("id").cast("decimal(15,2)").alias("price"),
        F.lit("").alias("keywords"),
        F.lit("").alias("image_url"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
    )
    df = goods_info(units)
    assert len(df.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


def test_rank_limit_is_applied_before_the_shuffle(spark):
    df = first_per_key(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
