"""Detail tables and message feeds derived from the order, line item, part and customer tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.amounts import MONEY
from martloom.functions.vocabulary import (
    AWAITING_PAYMENT,
    CANCELLED,
    COMPLETED,
    DISPATCHED_STATES,
    PAID,
    SHIPPED,
    STATE_CODES,
)
from martloom.plans.goods import goods_info
from martloom.sources.feeds import computed_once

# Line items have no key; these columns order them completely (equal rows are exact copies).
LINE_ORDER = ["l_linenumber", "l_suppkey", "subtotal", "quantity", "l_shipdate"]

# Tier bounds under which these tables give all three tiers.
SAMPLE_TIERS = (12_000_000, 6_000_000)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY)


def _day_of(key: str) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col(key), F.lit(365)).cast("int"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Clean product rows."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("string").alias("sub_category"),
        _money("p_retailprice").alias("price"),
        F.lit("").alias("description"),
        F.lit("").alias("image_url"),
        F.concat_ws(",", "p_brand", "p_type").alias("keywords"),
        _day_of("p_partkey").cast("timestamp").alias("created_at"),
        F.lit(False).alias("is_variant"),
        F.lit(False).alias("is_abnormal"),
    )


def goods(spark: SparkSession, folder: str) -> DataFrame:
    """Goods dimension in which every seventh unit has been withdrawn."""
    current = goods_info(products(spark, folder))
    withdrawn = F.pmod(F.col("sku_id").cast("bigint"), F.lit(7)) == 0
    return current.withColumn("is_active", F.when(withdrawn, 0).otherwise(1))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Item rows without the product's own fields, for results that need none of them."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _money("l_extendedprice").alias("subtotal"),
        "l_partkey",
        "l_linenumber",
        "l_suppkey",
        "l_shipdate",
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Clean item rows with the columns of ``LINE_ORDER``."""
    part = table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("string").alias("sub_category"),
        _money("p_retailprice").alias("price"),
    )
    return lines(spark, folder).join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "order_id",
        "product_id",
        "product_name",
        "brand",
        "category",
        "sub_category",
        F.col("price").alias("original_price"),
        "price",
        "quantity",
        F.col("quantity").alias("sales_volume"),
        "subtotal",
        "l_linenumber",
        "l_suppkey",
        "l_shipdate",
    )


def _state() -> Column:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (
        F.when((status == "F") & (priority == "5-LOW"), CANCELLED)
        .when(status == "F", COMPLETED)
        .when((status == "O") & (priority == "1-URGENT"), AWAITING_PAYMENT)
        .when(status == "O", PAID)
        .otherwise(SHIPPED)
    )


def _order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows with their buyer's name and region, nothing cleaned or blanked yet."""
    places = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("province"))
    )
    buyers = (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.col("c_name").alias("buyer_name"),
            F.col("c_custkey").cast("string").alias("buyer_phone"),
            F.concat("c_custkey", F.lit("@example.com")).alias("buyer_email"),
            "province",
            "city",
            F.col("c_mktsegment").alias("district"),
        )
    )
    return _bare_orders(spark, folder).join(buyers, F.col("o_custkey") == F.col("c_custkey"))


def _bare_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderkey").cast("string").alias("order_id"),
        _state().alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        _money("o_totalprice").alias("order_amount"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def order_states(spark: SparkSession, folder: str) -> DataFrame:
    """Order headers without their buyer, for results that need none."""
    return _with_amounts(_bare_orders(spark, folder)).select(
        "order_id", "order_status", "payment_method", "order_amount", "actual_amount", "created_at"
    )


def _with_amounts(facts: DataFrame) -> DataFrame:
    """Blank what a cancelled order does not have."""
    cancelled = F.col("order_status") == CANCELLED
    return facts.withColumns(
        {
            "payment_method": F.when(~cancelled, F.col("payment_method")),
            "payment_amount": F.when(~cancelled, F.col("order_amount")),
            "payment_time": F.when(~cancelled, F.col("created_at") + F.expr("INTERVAL 1 HOUR")),
            "discount": F.lit(0).cast(MONEY),
            "actual_amount": F.when(cancelled, F.lit(0).cast(MONEY)).otherwise(F.col("order_amount")),
        }
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Clean order headers; the item count is left to the feed."""
    sent = F.col("order_status").isin(*DISPATCHED_STATES)
    placed = F.col("created_at")
    return _with_amounts(_order_facts(spark, folder)).select(
        "order_id",
        "buyer_name",
        "buyer_phone",
        "buyer_email",
        "province",
        "city",
        "district",
        "order_status",
        "payment_method",
        "payment_amount",
        "payment_time",
        F.when(sent, F.concat(F.lit("Carrier "), F.col("province"))).alias("logistics_company"),
        F.when(sent, F.concat(F.lit("T"), F.col("order_id"))).alias("tracking_number"),
        F.when(sent, placed + F.expr("INTERVAL 1 DAY")).alias("shipped_at"),
        F.when(sent, F.date_add(F.to_date(placed), 4)).alias("estimated_delivery"),
        "order_amount",
        "discount",
        "actual_amount",
        "created_at",
    )


def product_feed(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON message per part, with defects chosen by the part key."""
    k = F.col("p_partkey")

    def every(n: int, rest: int) -> Column:
        return F.pmod(k, F.lit(n)) == rest

    price = (
        F.when(every(10, 1), "-5.005")
        .when(every(10, 2), "null")
        .when(every(10, 3), '"12.5"')
        .when(every(10, 4), "2.345")
        .otherwise(_money("p_retailprice").cast("string"))
    )
    variant = F.when(every(3, 0), "true").when(every(3, 1), '"true"').otherwise("false")
    keywords = F.when(every(5, 0), '"none"').otherwise(F.to_json(F.array("p_brand", "p_type")))
    day = _day_of("p_partkey").cast("string")
    created = (
        F.when(every(8, 4), F.concat(day, F.lit("T10:30")))
        .when(every(4, 0), F.concat(day, F.lit("T10:30:15")))
        .when(every(4, 1), F.concat(day, F.lit(" 10:30:15")))
        .when(every(4, 2), F.concat(day, F.lit("T10:30:15.250")))
        .otherwise("n/a")
    )
    plain = F.to_json(
        F.struct(
            k.cast("string").alias("product_id"),
            F.when(every(13, 0), "").otherwise(F.col("p_name")).alias("name"),
            F.col("p_brand").alias("brand"),
            F.when(every(17, 1), "").otherwise(F.col("p_type")).alias("category"),
            F.col("p_size").alias("sub_category"),
            created.alias("created_at"),
            F.lit("x").alias("unknown_field"),
        )
    )
    message = F.concat(
        F.lit('{"price":'), price, F.lit(',"is_variant":'), variant, F.lit(',"keywords":'), keywords, F.lit(","),
        F.substring(plain, 2, 1 << 30),
    )
    value = _damaged(message, every(97, 5), every(50, 49))
    return computed_once(table(spark, folder, "part"), "value", value).select("value")


def _damaged(message: Column, empty: Column, cut: Column) -> Column:
    """The message, an empty payload, or a text that breaks off."""
    half = (F.length(message) / 2).cast("int")
    return F.when(empty, "").when(cut, F.substring(message, F.lit(1), half)).otherwise(message)


def order_feed(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON message per item row, and one per order without items, with defects chosen by the order key.

    Each message has the order's header and a ``part`` named by its line's own numbers, so an order of any size is sent the
    same way, no order's items are gathered in one place, and a message reads the same whenever it is made. An exact copy of
    a line is the same message once more. What the messages of an order have in common is written as JSON once, before the
    items are joined.
    """
    rows = items(spark, folder)
    odd_quantity = F.pmod(F.col("order_id").cast("bigint"), F.lit(23)) == 4
    item = F.struct(
        "product_id",
        "product_name",
        "brand",
        "category",
        "sub_category",
        "original_price",
        "price",
        F.when(~odd_quantity, F.col("quantity")).alias("quantity"),
        F.when(odd_quantity, F.col("quantity").cast("string")).alias("sales_volume"),
        "subtotal",
    )
    k = F.col("o_orderkey")

    def every(n: int, rest: int) -> Column:
        return F.pmod(k, F.lit(n)) == rest

    code = F.create_map(*[F.lit(x) for word, name in STATE_CODES.items() for x in (name, word)])[F.col("order_status")]
    placed = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss")
    rounded_up = F.col("order_amount") + F.lit("0.005").cast("decimal(4,3)")
    first = F.struct(
        "order_id",
        F.when(every(31, 8), "").when(every(3, 0), code).otherwise(F.col("order_status")).alias("order_status"),
    )
    rest = F.struct(
        F.lit(99).alias("item_count"),
        F.when(every(10, 4), rounded_up).otherwise(F.col("order_amount")).alias("order_amount"),
        F.lit(0).alias("discount"),
        F.col("order_amount").alias("actual_amount"),
        F.struct(
            F.when(every(13, 0), "").otherwise(F.col("buyer_name")).alias("name"),
            F.col("buyer_phone").alias("phone"),
            F.col("buyer_email").alias("email"),
        ).alias("buyer"),
        F.when(
            ~every(11, 5),
            F.struct(
                "province",
                "city",
                "district",
                F.concat_ws(" ", "city", "district").alias("detail"),
                F.lit("000000").alias("postal_code"),
                F.col("buyer_name").alias("recipient_name"),
                F.col("buyer_phone").alias("recipient_phone"),
            ),
        ).alias("shipping_address"),
        F.when(
            ~every(19, 1),
            F.struct(
                F.col("payment_method").alias("method"),
                F.col("order_amount").alias("amount"),
                F.date_format(F.col("created_at") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss").alias("paid_at"),
            ),
        ).alias("payment"),
        F.struct(
            F.concat(F.lit("Carrier "), F.col("province")).alias("company"),
            F.concat(F.lit("T"), F.col("order_id")).alias("tracking_number"),
            F.date_format(F.col("created_at") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss").alias("shipped_at"),
            F.date_add(F.to_date("created_at"), 4).cast("string").alias("estimated_delivery"),
        ).alias("logistics"),
        F.when(every(7, 2), "unknown").otherwise(placed).alias("created_at"),
    )
    heads = _order_facts(spark, folder).select(
        "o_orderkey",
        "order_id",
        F.regexp_replace(F.to_json(first), r"\}$", ',"part":"').alias("opening"),
        F.regexp_replace(F.to_json(rest), r"^\{", ",").alias("closing"),
    )
    # A part is made of numbers and a day, or "none", so nothing in it needs an escape.
    part = F.concat_ws("-", *[F.col(c).cast("string") for c in LINE_ORDER])
    sent = heads.join(rows.select("order_id", F.array(item).alias("items"), part.alias("part")), "order_id", "left")
    listed = F.to_json(F.when(~every(29, 6), F.col("items")))
    text = F.concat(
        "opening",
        F.coalesce("part", F.lit("none")),
        F.lit('"'),
        F.coalesce(F.concat(F.lit(',"items":'), listed), F.lit("")),
        "closing",
    )
    value = _damaged(F.col("text"), every(37, 9), every(50, 49))
    return computed_once(sent.select("o_orderkey", text.alias("text")), "value", value).select("value")
