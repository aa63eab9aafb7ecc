"""Layered table catalog: columns, keys, defaults of each stored table."""

from __future__ import annotations

from dataclasses import dataclass, field

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.amounts import MONEY, MONEY_SUM, SHARE
from martloom.functions.vocabulary import AWAITING_PAYMENT, SUBTOTAL


@dataclass(frozen=True)
class Table:
    """A stored table.

    ``frozen`` columns keep their first value when a key comes again, ``live`` columns take the latest one, and
    ``added`` columns are summed.
    """

    name: str
    comment: str
    key: tuple[str, ...]
    columns: str
    live: tuple[str, ...] = ()
    added: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    not_null: tuple[str, ...] = field(default=())
    defaults: dict[str, str | int] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        parsed = T.StructType.fromDDL(self.columns)
        required = set(self.key) | set(self.not_null)
        return T.StructType(
            [
                T.StructField(f.name, f.dataType, f.name not in required, {"comment": f"{self.name}.{f.name}"})
                for f in parsed
            ]
        )

    @property
    def frozen(self) -> tuple[str, ...]:
        other = {*self.key, *self.live, *self.added}
        return tuple(f.name for f in self.schema if f.name not in other)


#: Default of a time: that of the run.
NOW = "now"


def filled(df: DataFrame, table: Table, as_of: datetime | Column | None = None) -> DataFrame:
    """The table's columns: those that ``df`` leaves out get their default, or NULL. A given NULL stays one."""

    def made(f: T.StructField) -> Column:
        if f.name in df.columns:
            return F.col(f.name).cast(f.dataType).alias(f.name)
        value = table.defaults.get(f.name)
        if value == NOW:
            value = as_of
        return (value if isinstance(value, Column) else F.lit(value)).cast(f.dataType).alias(f.name)

    return df.select(*[made(f) for f in table.schema])


def refusal(table: Table) -> Column:
    """Name of the first required column that is NULL in a row, NULL for a row the table takes."""
    return F.coalesce(*[F.when(F.col(f.name).isNull(), f.name) for f in table.schema if not f.nullable])


def enforced(df: DataFrame, table: Table) -> DataFrame:
    """``df`` whose reading fails at the first row the table refuses."""
    required = [f.name for f in table.schema if not f.nullable and f.name in df.columns]
    return df.withColumns(
        {c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(F.raise_error(F.lit(f"{table.name}.{c} is NULL"))) for c in required}
    )


_ORDER_HEADER = f"""order_id string, buyer_name string, buyer_phone string, buyer_email string, province string,
city string, district string, address_detail string, postal_code string, recipient_name string,
recipient_phone string, order_status string, payment_method string, payment_amount {MONEY}, payment_time timestamp,
logistics_company string, tracking_number string, shipped_at timestamp, estimated_delivery date,
order_amount {MONEY}, discount {MONEY}, actual_amount {MONEY}, item_count int, created_at timestamp, remark string,
load_time timestamp"""

TABLES = {
    t.name: t
    for t in (
        Table(
            "dwd_product",
            "products, cleaned",
            ("product_id",),
            f"""product_id string, name string, brand string, category string, sub_category string, price {MONEY},
            description string, image_url string, keywords string, created_at timestamp, is_variant boolean,
            is_abnormal boolean, load_time timestamp""",
            live=("name", "price", "load_time"),
            not_null=("name", "category", "price", "created_at", "is_variant", "is_abnormal", "load_time"),
            defaults={"price": 0, "created_at": NOW, "is_variant": False, "is_abnormal": False, "load_time": NOW},
        ),
        Table(
            "dwd_order",
            "order headers, one row per order",
            ("order_id",),
            _ORDER_HEADER,
            live=("order_status", "actual_amount", "load_time"),
            added=("item_count",),
            not_null=("order_status", "order_amount", "discount", "actual_amount", "item_count", "created_at", "load_time"),
            defaults={
                "order_status": AWAITING_PAYMENT,
                **dict.fromkeys(("order_amount", "discount", "actual_amount", "item_count"), 0),
                "created_at": NOW,
                "load_time": NOW,
            },
        ),
        Table(
            "dwd_order_item",
            "order items, one row per element of the item lists of an order's parts; a whole order's part is empty",
            ("order_id", "part", "item_no"),
            f"""order_id string, part string, item_no int, product_id string, product_name string, brand string, category string,
            sub_category string, original_price {MONEY}, price {MONEY}, quantity int, sales_volume int,
            subtotal {MONEY}, load_time timestamp""",
            not_null=(
                "product_id", "product_name", "original_price", "price", "quantity", "sales_volume", "subtotal", "load_time"
            ),
            defaults={
                **dict.fromkeys(("original_price", "price", "subtotal"), 0),
                **dict.fromkeys(("quantity", "sales_volume"), 1),
                "load_time": NOW,
            },
        ),
        Table(
            "dws_order_wide",
            "items joined with their order, one row per order and product",
            ("order_id", "product_id"),
            f"""order_id string, product_id string, product_name string, brand string, category string,
            sub_category string, price {MONEY}, quantity int, subtotal {MONEY}, order_status string,
            buyer_name string, buyer_phone string, buyer_email string, province string, city string, district string,
            payment_method string, payment_amount {MONEY}, logistics_company string, tracking_number string,
            order_amount {MONEY}, discount {MONEY}, actual_amount {MONEY}, order_created_at timestamp, dt date""",
            partition_by=("dt",),
            not_null=("dt",),
        ),
        Table(
            "dws_product_sales_1d",
            "sales per product and day",
            ("product_id", "dt"),
            f"""product_id string, dt date, product_name string, category string, brand string,
            total_quantity bigint, total_amount {MONEY_SUM}, order_count bigint, avg_price {MONEY_SUM}""",
            live=("total_quantity", "total_amount", "order_count", "avg_price"),
            partition_by=("dt",),
            defaults=dict.fromkeys(("total_quantity", "total_amount", "order_count", "avg_price"), 0),
        ),
        Table(
            "dws_category_sales_1d",
            "sales per category and day",
            ("category", "dt"),
            f"""category string, dt date, total_quantity bigint, total_amount {MONEY_SUM}, order_count bigint,
            sku_count bigint""",
            live=("total_quantity", "total_amount", "order_count", "sku_count"),
            defaults=dict.fromkeys(("total_quantity", "total_amount", "order_count", "sku_count"), 0),
        ),
        Table(
            "dws_user_order_1d",
            "orders per buyer and day",
            ("buyer_phone", "dt"),
            f"""buyer_phone string, dt date, buyer_name string, order_count bigint, total_amount {MONEY_SUM},
            total_quantity bigint, completed_count bigint, cancelled_count bigint, pending_count bigint""",
            live=(
                "order_count",
                "total_amount",
                "total_quantity",
                "completed_count",
                "cancelled_count",
                "pending_count",
            ),
            partition_by=("dt",),
        ),
        Table(
            "ads_category_revenue",
            "revenue, share and rank per category",
            ("category",),
            f"""category string, total_amount {MONEY_SUM}, total_quantity bigint, order_count bigint,
            sku_count bigint, percentage {SHARE}, rank bigint""",
            live=("total_amount", "total_quantity", "order_count", "sku_count", "percentage", "rank"),
        ),
        Table(
            "ads_daily_sales_trend",
            "sales per day",
            ("dt",),
            f"""dt date, total_sales_amount {MONEY_SUM}, total_order_count bigint, avg_order_amount {MONEY_SUM}""",
            live=("total_sales_amount", "total_order_count", "avg_order_amount"),
        ),
        Table(
            "ads_user_value",
            "recency, frequency, monetary value and tier per buyer",
            ("buyer_phone",),
            f"""buyer_phone string, buyer_name string, last_order_date date, order_frequency bigint,
            total_monetary {MONEY_SUM}, avg_order_amount {MONEY_SUM}, value_tier string""",
            live=("last_order_date", "order_frequency", "total_monetary", "avg_order_amount", "value_tier"),
        ),
        Table(
            "ads_product_ranking",
            "products ranked by quantity sold",
            ("product_id",),
            f"""product_id string, product_name string, category string, brand string, total_quantity bigint,
            total_amount {MONEY_SUM}, rank bigint""",
            live=("total_quantity", "total_amount", "rank"),
        ),
        Table(
            "ads_regional_sales",
            "sales per province, city and district with subtotal rows",
            ("province", "city", "district"),
            f"""province string, city string, district string, total_orders bigint, total_amount {MONEY_SUM},
            avg_order_amount {MONEY_SUM}, buyer_count bigint""",
            live=("total_orders", "total_amount", "avg_order_amount", "buyer_count"),
            defaults={
                **dict.fromkeys(("city", "district"), SUBTOTAL),
                **dict.fromkeys(("total_orders", "total_amount", "avg_order_amount", "buyer_count"), 0),
            },
        ),
        Table(
            "dim_goods_info",
            "goods dimension, one row per sellable unit and validity period",
            ("sku_id", "start_date"),
            f"""sku_id string, product_id string, spu_name string, sku_name string, brand_name string,
            first_category_name string, second_category_name string, price_min {MONEY}, price_max {MONEY},
            sku_price {MONEY}, price_delta {MONEY}, variant_suffix string, image_url string,
            keywords array<string>, start_date date, end_date date, is_active int, dw_create_time timestamp,
            dw_update_time timestamp""",
            live=("end_date", "is_active", "dw_update_time"),
        ),
    )
}

# Tables that only the jobs read: totals that are kept up to date, and the day of every order.
INTERNAL = {
    t.name: t
    for t in (
        Table("sum_category", "totals per category", ("category",), f"category string, days bigint, total_amount {MONEY_SUM}, total_quantity bigint, order_count bigint, sku_count bigint"),
        Table("sum_user", "totals per buyer", ("buyer_phone",), f"buyer_phone string, buyer_name string, dt date, days bigint, order_count bigint, total_amount {MONEY_SUM}"),
        Table("sum_product", "totals per product", ("product_id",), f"product_id string, product_name string, category string, brand string, days bigint, total_quantity bigint, total_amount {MONEY_SUM}"),
        Table("sum_region", "orders and amount per region and buyer", (), f"province string, city string, district string, buyer_phone string, orders bigint, amount {MONEY_SUM}"),
        Table("order_days", "first message and day of an order", ("order_id",), "order_id string, seq struct<batch: bigint, origin: string, position: bigint, row: bigint>, dt date"),
    )
}
