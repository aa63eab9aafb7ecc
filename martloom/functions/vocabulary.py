"""Fixed values of the retail domain: states, labels, tiers and default texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order states.
AWAITING_PAYMENT = "待付款"
PAID = "已付款"
SHIPPED = "已发货"
COMPLETED = "已完成"
CANCELLED = "已取消"
ORDER_STATES = (AWAITING_PAYMENT, PAID, SHIPPED, COMPLETED, CANCELLED)
OPEN_STATES = (AWAITING_PAYMENT, PAID, SHIPPED)
DISPATCHED_STATES = (SHIPPED, COMPLETED)

# Codes a feed may send instead of the state's name.
STATE_CODES = {
    "pending": AWAITING_PAYMENT,
    "paid": PAID,
    "shipped": SHIPPED,
    "completed": COMPLETED,
    "cancelled": CANCELLED,
}

# Label of a subtotal row's missing region levels.
SUBTOTAL = "合计"

# Customer value tiers and their lower bounds.
TIER_HIGH = "高价值"
TIER_MIDDLE = "中价值"
TIER_LOW = "低价值"
TIER_BOUNDS = (10000, 1000)

# Serving defaults.
RANKING_SIZE = 10
PAGE_SIZE = 20
GOODS_PAGE_SIZE = 15

OPEN_END = "9999-12-31"


@dataclass(frozen=True)
class Defaults:
    """What a blank or missing text becomes, per field."""

    order_id: str
    product_id: str
    item_product_id: str
    product_name: str
    item_product_name: str
    category: str
    repair_price: bool
    keep_empty_orders: bool
    numbers_from_text: bool
    codes_to_states: bool
    keep_delivery_date: bool


# "Live" repeats what the streaming job writes: it takes an order's state as it comes and no delivery date. "Documented"
# follows the written requirements, which decode messages into typed events, so that a text such as "12.5" is a number.
LIVE = Defaults(
    order_id="-",
    product_id="-",
    item_product_id="",
    product_name="?",
    item_product_name="",
    category="",
    repair_price=False,
    keep_empty_orders=True,
    numbers_from_text=False,
    codes_to_states=False,
    keep_delivery_date=False,
)
DOCUMENTED = Defaults(
    order_id="UNKNOWN",
    product_id="UNKNOWN",
    item_product_id="UNKNOWN",
    product_name="未知商品",
    item_product_name="未知商品",
    category="其他",
    repair_price=True,
    keep_empty_orders=False,
    numbers_from_text=True,
    codes_to_states=True,
    keep_delivery_date=True,
)
PRESETS = {"live": LIVE, "documented": DOCUMENTED}


def state_name(code: Column) -> Column:
    """State name of a feed code, NULL when the code is unknown."""
    names = F.create_map(*[F.lit(x) for pair in STATE_CODES.items() for x in pair])
    return names[F.lower(code)]


def order_state(code: Column) -> Column:
    """State name of a feed code or name; anything else awaits payment."""
    return F.coalesce(state_name(code), F.when(code.isin(*ORDER_STATES), code), F.lit(AWAITING_PAYMENT))


def value_tier(amount: Column, bounds: tuple[int, int] = TIER_BOUNDS) -> Column:
    high, middle = bounds
    return F.when(amount >= high, TIER_HIGH).when(amount >= middle, TIER_MIDDLE).otherwise(TIER_LOW)
