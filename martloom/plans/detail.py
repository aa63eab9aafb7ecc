"""Detail layer: cleaned product, order and item rows from parsed messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import json_fields as J
from martloom.functions.amounts import MONEY
from martloom.functions.vocabulary import (
    AWAITING_PAYMENT,
    CANCELLED,
    DISPATCHED_STATES,
    DOCUMENTED,
    Defaults,
    state_name,
)


#: An order's header without what is also asked for alone. Amounts keep their JSON type.
ORDER_HEADER = """struct<buyer: struct<name: string, phone: string, email: string>,
    shipping_address: struct<province: string, city: string, district: string, detail: string, postal_code: string,
        recipient_name: string, recipient_phone: string>,
    payment: struct<method: string, amount: variant, paid_at: string>,
    logistics: struct<company: string, tracking_number: string, shipped_at: string, estimated_delivery: string>,
    order_amount: variant, discount: variant, actual_amount: variant, remark: string>"""


def load_time(as_of: datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def repaired_price(price: Column) -> Column:
    """Missing or negative prices become 0."""
    return F.when(price.isNull() | (price < 0), F.lit(0).cast(MONEY)).otherwise(price)


def is_abnormal(price: Column, *required: Column) -> Column:
    """A price that had to be repaired, or a required text that was blank."""
    bad = price.isNull() | (price < 0)
    for column in required:
        bad = bad | column.isNull()
    return bad


def _carried(docs: DataFrame, *more: str) -> list[str]:
    return [c for c in ("seq", "part", *more) if c in docs.columns]


def product_rows(docs: DataFrame, as_of: datetime | Column, defaults: Defaults = DOCUMENTED) -> DataFrame:
    """One cleaned product row per parsed message."""
    d, stamp = F.col("doc"), load_time(as_of)
    given = F.round(J.number_or_null(d, "price", defaults.numbers_from_text), 2).try_cast(MONEY)
    if defaults.repair_price:
        price = repaired_price(given)
        abnormal = is_abnormal(given, J.raw_text(d, "product_id"), J.raw_text(d, "name"), J.raw_text(d, "category"))
    else:
        price, abnormal = J.money(d, "price", defaults.numbers_from_text), F.lit(False)
    return docs.select(
        J.text(d, "product_id", defaults.product_id).alias("product_id"),
        J.text(d, "name", defaults.product_name).alias("name"),
        J.text(d, "brand").alias("brand"),
        J.text(d, "category", defaults.category).alias("category"),
        J.text(d, "sub_category").alias("sub_category"),
        price.alias("price"),
        J.text(d, "description").alias("description"),
        J.text(d, "image_url").alias("image_url"),
        J.joined_list(d, "keywords").alias("keywords"),
        J.timestamp(d, "created_at", stamp, lenient=not defaults.repair_price).alias("created_at"),
        J.flag(d, "is_variant").alias("is_variant"),
        abnormal.alias("is_abnormal"),
        stamp.alias("load_time"),
        *_carried(docs),
    )


def order_status(doc: Column, defaults: Defaults = DOCUMENTED) -> Column:
    """The order's state: codes become names where the preset says so, other texts are kept, a blank one awaits payment."""
    given = J.raw_text(doc, "order_status")
    names = [state_name(given)] if defaults.codes_to_states else []
    return F.coalesce(*names, given, F.lit(AWAITING_PAYMENT))


def order_rows(
    docs: DataFrame,
    as_of: datetime | Column,
    defaults: Defaults = DOCUMENTED,
    keep_delivery_date: bool | None = None,
    items: Column | None = None,
) -> DataFrame:
    """One order header per parsed message.

    Cancelled orders carry no payment and no amount; only dispatched orders carry logistics. ``items`` is the number of
    items where it was counted over several messages.
    """
    stamp = load_time(as_of)
    if keep_delivery_date is None:
        keep_delivery_date = defaults.keep_delivery_date
    d, typed = F.col("doc"), defaults.numbers_from_text
    flat = docs.withColumns({"order_status": order_status(d, defaults), "_header": J.fields(d, ORDER_HEADER)})
    cancelled = F.col("order_status") == CANCELLED

    def h(name: str) -> Column:
        return F.col(f"_header.{name}")

    paid = ~cancelled & h("payment").isNotNull()
    sent = F.col("order_status").isin(*DISPATCHED_STATES) & h("logistics").isNotNull()
    delivery = h("logistics.estimated_delivery")
    return flat.select(
        J.text(d, "order_id", defaults.order_id).alias("order_id"),
        J.blank_to(h("buyer.name")).alias("buyer_name"),
        J.blank_to(h("buyer.phone")).alias("buyer_phone"),
        J.blank_to(h("buyer.email")).alias("buyer_email"),
        J.blank_to(h("shipping_address.province")).alias("province"),
        J.blank_to(h("shipping_address.city")).alias("city"),
        J.blank_to(h("shipping_address.district")).alias("district"),
        J.blank_to(h("shipping_address.detail")).alias("address_detail"),
        J.blank_to(h("shipping_address.postal_code")).alias("postal_code"),
        J.blank_to(h("shipping_address.recipient_name")).alias("recipient_name"),
        J.blank_to(h("shipping_address.recipient_phone")).alias("recipient_phone"),
        "order_status",
        F.when(paid, J.blank_to(h("payment.method"), None)).alias("payment_method"),
        F.when(paid, J.money(h("payment.amount"), "", typed)).alias("payment_amount"),
        F.when(paid, F.coalesce(J.live_timestamp(h("payment.paid_at")), stamp)).alias("payment_time"),
        F.when(sent, J.blank_to(h("logistics.company"), None)).alias("logistics_company"),
        F.when(sent, J.blank_to(h("logistics.tracking_number"), None)).alias("tracking_number"),
        F.when(sent, F.coalesce(J.live_timestamp(h("logistics.shipped_at")), stamp)).alias("shipped_at"),
        (F.when(sent, F.substring(delivery, 1, 10).try_cast("date")) if keep_delivery_date else F.lit(None).cast("date"))
        .alias("estimated_delivery"),
        J.money(h("order_amount"), "", typed).alias("order_amount"),
        J.money(h("discount"), "", typed).alias("discount"),
        F.when(cancelled, F.lit(0).cast(MONEY)).otherwise(J.money(h("actual_amount"), "", typed)).alias("actual_amount"),
        (item_count(d) if items is None else items).alias("item_count"),
        J.timestamp(d, "created_at", stamp).alias("created_at"),
        J.blank_to(h("remark"), None).alias("remark"),
        stamp.alias("load_time"),
        *_carried(docs),
    )


def item_count(doc: Column) -> Column:
    """Length of the item list; the message's own count is not trusted."""
    return J.list_size(doc, "items")


def item_rows(docs: DataFrame, as_of: datetime | Column, defaults: Defaults = DOCUMENTED) -> DataFrame:
    """One row per element of the order's item list, numbered from 1. A column ``created_at`` goes along."""
    stamp = load_time(as_of)
    items = docs.select(
        J.text(F.col("doc"), "order_id", defaults.order_id).alias("order_id"),
        *_carried(docs, "created_at"),
        F.posexplode(J.list_of(F.col("doc"), "items")).alias("position", "item"),
    )
    i, typed = F.col("item"), defaults.numbers_from_text
    return items.select(
        "order_id",
        (F.col("position") + 1).alias("item_no"),
        J.text(i, "product_id", defaults.item_product_id).alias("product_id"),
        J.text(i, "product_name", defaults.item_product_name).alias("product_name"),
        J.text(i, "brand").alias("brand"),
        J.text(i, "category", defaults.category).alias("category"),
        J.text(i, "sub_category").alias("sub_category"),
        J.money(i, "original_price", typed).alias("original_price"),
        J.money(i, "price", typed).alias("price"),
        J.whole(i, "quantity", 1, typed).alias("quantity"),
        J.whole(i, "sales_volume", 1, typed).alias("sales_volume"),
        J.money(i, "subtotal", typed).alias("subtotal"),
        stamp.alias("load_time"),
        *_carried(docs, "created_at"),
    )

