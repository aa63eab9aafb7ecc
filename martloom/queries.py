"""Every operator as a query over a folder of source tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import json_fields as J
from martloom.functions import vocabulary as V
from martloom.functions.amounts import MONEY
from martloom.operators.keyed_merge import WHOLE_ORDER, append_groups, as_changes, judged_parts, merge_changes, upsert_metrics
from martloom.operators.order_join import defaulted_orphans, items_with_orders, with_product
from martloom.plans import detail, goods, maintained, metrics, page_views, quality, serving, summary
from martloom.session import scratch, tune
from martloom.sources import feeds, samples
from martloom.sources.catalog import TABLES, filled, refusal
from martloom.streaming import event_windows, live_totals

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2002, 1, 1)
TODAY = "2001-08-01"
YEAR = ("1996-01-01", "1996-12-31")


class Layers:
    """The layers of the warehouse over one source folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    # Feeds

    @cached_property
    def product_messages(self) -> DataFrame:
        return feeds.nonempty(samples.product_feed(self.spark, self.folder))

    @cached_property
    def order_messages(self) -> DataFrame:
        return feeds.nonempty(samples.order_feed(self.spark, self.folder))

    @cached_property
    def product_docs(self) -> DataFrame:
        return feeds.accepted(feeds.with_reject_reason(feeds.parse(self.product_messages)))

    @cached_property
    def order_parsed(self) -> DataFrame:
        """Parsed messages; an order's parts stand in no order but that of their names."""
        return feeds.parse(self.order_messages).withColumn("seq", J.raw_text(F.col("doc"), "part"))

    @cached_property
    def order_docs(self) -> DataFrame:
        return feeds.accepted(feeds.with_reject_reason(self.order_parsed))

    @cached_property
    def order_firsts(self) -> DataFrame:
        """The message of each order's first part and the items of all its parts: its header is decoded once."""
        d = F.col("doc")
        rows = self.order_docs.select(J.text(d, "order_id").alias("_order"), "seq", "doc", detail.item_count(d).alias("_n"))
        return rows.groupBy("_order").agg(F.min_by("doc", "seq").alias("doc"), F.sum("_n").cast("int").alias("_items"))

    # Detail

    @cached_property
    def items(self) -> DataFrame:
        return samples.items(self.spark, self.folder)

    @cached_property
    def orders(self) -> DataFrame:
        return samples.orders(self.spark, self.folder)

    @cached_property
    def lines(self) -> DataFrame:
        return samples.lines(self.spark, self.folder).drop("l_partkey")

    @cached_property
    def order_states(self) -> DataFrame:
        return samples.order_states(self.spark, self.folder)

    @cached_property
    def item_days(self) -> DataFrame:
        """Items with their order's state and day; no buyer."""
        return items_with_orders(self.items, self.order_states)

    @cached_property
    def item_orders(self) -> DataFrame:
        return items_with_orders(self.items, self.orders)

    @cached_property
    def goods(self) -> DataFrame:
        return samples.goods(self.spark, self.folder)

    # Summary

    @cached_property
    def wide(self) -> DataFrame:
        return summary.wide_rows(self.item_orders, tiebreak=samples.LINE_ORDER)

    @cached_property
    def product_days(self) -> DataFrame:
        return summary.product_sales(self.item_days)

    @cached_property
    def category_days(self) -> DataFrame:
        return summary.category_sales(self.item_days)

    @cached_property
    def user_days(self) -> DataFrame:
        return summary.user_orders(self.lines, self.orders)

    # Metrics

    @cached_property
    def revenue(self) -> DataFrame:
        return metrics.category_revenue(self.category_days)

    @cached_property
    def trend(self) -> DataFrame:
        return metrics.daily_trend(self.category_days)

    @cached_property
    def users(self) -> DataFrame:
        return metrics.user_value(self.user_days, samples.SAMPLE_TIERS)

    @cached_property
    def ranking(self) -> DataFrame:
        return metrics.product_ranking(self.product_days)

    @cached_property
    def regions(self) -> DataFrame:
        return metrics.regional_sales(self.wide)


def _query(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, folder: build(Layers(spark, folder))


# Feeds and decoding


def _by_order(rows: DataFrame, *added: str) -> DataFrame:
    """One row per order from those of its messages, folded as the ingest does; ``added`` columns are summed."""
    names = [c for c in rows.columns if c != "seq"]
    frozen = [c for c in names if c not in ("order_id", *added)]
    return merge_changes(as_changes(rows), ["order_id"], frozen, [], added=added).select(*names)


def _nonempty(x: Layers) -> DataFrame:
    def counted(name: str, messages: DataFrame) -> DataFrame:
        return messages.agg(F.lit(name).alias("feed"), F.count(F.lit(1)).alias("messages"))

    return counted("products", x.product_messages).unionByName(counted("orders", x.order_messages))


def _order_decode(x: Layers) -> DataFrame:
    events = feeds.decode_orders(x.order_docs)
    decoded = events.select(
        F.col("part").alias("seq"),
        "order_id",
        "order_status",
        F.array_size("items").alias("items"),
        F.aggregate("items", F.lit(0).cast("decimal(25,2)"), lambda a, i: (a + i.subtotal).cast("decimal(25,2)")).alias(
            "subtotal"
        ),
        "item_count",
        F.col("order_amount").cast("decimal(18,3)").alias("order_amount"),
        F.col("buyer.name").alias("buyer_name"),
        F.col("shipping_address.city").alias("city"),
        F.col("payment.method").alias("payment_method"),
        F.col("logistics.tracking_number").alias("tracking_number"),
        "created_at",
    )
    return _by_order(decoded, "items", "subtotal")


def _product_decode(x: Layers) -> DataFrame:
    d = F.col("doc")
    return x.product_docs.select(
        F.try_variant_get(d, "$.product_id", "string").alias("product_id"),
        F.try_variant_get(d, "$.name", "string").alias("name"),
        F.try_variant_get(d, "$.sub_category", "int").alias("sub_category"),
        F.schema_of_variant(F.try_variant_get(d, "$.is_variant", "variant")).alias("is_variant_type"),
        F.try_variant_get(d, "$.keywords[0]", "string").alias("first_keyword"),
        F.try_variant_get(d, "$.created_at", "string").alias("created_at"),
    )


def _dead_letter(x: Layers) -> DataFrame:
    def counted(name: str, messages: DataFrame, **rules) -> DataFrame:
        judged = feeds.with_reject_reason(feeds.parse(messages), **rules)
        return feeds.rejected(judged).groupBy("reason").agg(F.count(F.lit(1)).alias("messages")).select(
            F.lit(name).alias("feed"), "reason", "messages"
        )

    products = counted("products", x.product_messages, required=("name", "category"))
    return products.unionByName(counted("orders", x.order_messages, items=True))


# Cleaning


def _products(x: Layers, preset: V.Defaults) -> DataFrame:
    return detail.product_rows(x.product_docs, AS_OF, preset).drop("load_time")


def _orders(x: Layers, preset: V.Defaults = V.DOCUMENTED) -> DataFrame:
    return detail.order_rows(x.order_firsts, AS_OF, preset, items=F.col("_items")).drop("load_time")


def _items(x: Layers, preset: V.Defaults) -> DataFrame:
    """Item rows; their number within the message is left out, as every message counts from 1."""
    return detail.item_rows(x.order_docs, AS_OF, preset).drop("load_time", "item_no", "seq")


def _clean_strings(x: Layers) -> DataFrame:
    d, live, documented = F.col("doc"), V.LIVE, V.DOCUMENTED
    return x.product_docs.select(
        J.text(d, "product_id", live.product_id).alias("product_id"),
        J.text(d, "name", live.product_name).alias("name_live"),
        J.text(d, "name", documented.product_name).alias("name_documented"),
        J.text(d, "category", live.category).alias("category_live"),
        J.text(d, "category", documented.category).alias("category_documented"),
        J.text(d, "sub_category").alias("sub_category"),
        J.text(d, "description", "none").alias("description"),
    )


def _clean_money(x: Layers) -> DataFrame:
    d = F.col("doc")
    return x.product_docs.select(
        J.text(d, "product_id").alias("product_id"),
        J.money(d, "price").alias("price"),
        J.money(d, "price", from_text=True).alias("price_from_text"),
    )


def _clean_ints(x: Layers) -> DataFrame:
    return _items(x, V.LIVE).select("order_id", "product_id", "quantity", "sales_volume")


def _clean_timestamps(x: Layers) -> DataFrame:
    d, stamp = F.col("doc"), detail.load_time(AS_OF)
    return x.product_docs.select(
        J.text(d, "product_id").alias("product_id"),
        J.timestamp(d, "created_at", stamp).alias("created_live"),
        J.timestamp(d, "created_at", stamp, lenient=False).alias("created_documented"),
    )


def _order_state(x: Layers) -> DataFrame:
    d = F.col("doc")
    states = x.order_docs.select(
        "seq",
        J.text(d, "order_id").alias("order_id"), V.order_state(J.raw_text(d, "order_status")).alias("order_state"),
    )
    return _by_order(states)


def _nonempty_orders(x: Layers) -> DataFrame:
    judged = feeds.with_reject_reason(x.order_parsed, items=True)
    kept = detail.order_rows(feeds.accepted(judged), AS_OF).select("seq", "order_id", "order_status", "item_count")
    return _by_order(kept, "item_count")


# Keyed writes. Stored states and later batches are cut from the tables along a date or state column.


def _upsert_product(x: Layers) -> DataFrame:
    """Each line item reports its product's current price and seller; arrival is by ship date."""
    price = F.round(F.col("subtotal") / F.col("quantity"), 2).cast(MONEY)
    reports = x.items.select(
        "product_id",
        F.concat_ws(" ", "product_name", F.col("l_suppkey").cast("string")).alias("name"),
        price.alias("price"),
        F.concat_ws(" ", "category", F.col("l_suppkey").cast("string")).alias("category"),
        F.struct("l_shipdate", F.col("order_id").cast("bigint"), *samples.LINE_ORDER[:4]).alias("seq"),
    )
    return merge_changes(as_changes(reports), ["product_id"], ["category"], ["name", "price"])


def _upsert_order(x: Layers) -> DataFrame:
    """Every order arrives unpaid, and once more in its final state."""
    final = x.order_states.select("order_id", "payment_method", "order_amount", "order_status", "actual_amount")
    first = final.withColumns(
        {
            "payment_method": F.lit(None).cast("string"),
            "order_status": F.lit(V.AWAITING_PAYMENT),
            "actual_amount": F.col("order_amount"),
        }
    )
    changes = first.withColumn("seq", F.lit(1)).unionByName(final.withColumn("seq", F.lit(2)))
    return merge_changes(
        as_changes(changes), ["order_id"], ["payment_method", "order_amount"], ["order_status", "actual_amount"]
    )


def _judged_parts(x: Layers) -> DataFrame:
    """Orders come in parts by line number; those of finished orders are stored. Cancelled orders then come once more as a
    whole, and all parts again."""
    parts = x.lines.select("order_id", F.col("l_linenumber").cast("string").alias("part"), F.lit(1).alias("seq"))
    state = x.order_states.select("order_id", "order_status")
    stored = parts.join(state.filter(F.col("order_status") == V.COMPLETED), "order_id", "left_semi")
    cancelled = state.filter(F.col("order_status") == V.CANCELLED).select("order_id", F.lit(WHOLE_ORDER).alias("part"), F.lit(2).alias("seq"))
    whole = cancelled.join(parts.select("order_id"), "order_id", "left_semi")
    offered = parts.unionByName(whole).unionByName(parts.withColumn("seq", F.lit(3)))
    return judged_parts(offered, stored).drop("seq")


def _append_items(x: Layers) -> DataFrame:
    """Items of finished orders are stored; then the items of all orders arrive."""
    columns = ["order_id", "product_id", "quantity", "subtotal"]
    done = x.order_states.filter(F.col("order_status").isin(V.COMPLETED, V.CANCELLED)).select("order_id")
    state = x.lines.join(done, "order_id", "left_semi").select(*columns)
    added = append_groups(state, x.lines.select(*columns), "order_id")
    return state.withColumn("origin", F.lit("stored")).unionByName(added.withColumn("origin", F.lit("added")))


def _upsert_metrics(x: Layers) -> DataFrame:
    """Summaries of the days before 1999 are stored; then those of the days from 1998 on arrive."""
    state = summary.product_sales(x.item_days.filter(F.col("dt") < F.lit("1999-01-01").cast("date"))).withColumn(
        "product_name", F.concat(F.lit("stored "), F.col("product_name"))
    )
    new = summary.product_sales(x.item_days.filter(F.col("dt") >= F.lit("1998-01-01").cast("date")))
    spec = TABLES["dws_product_sales_1d"]
    return upsert_metrics(state, new, spec.key, spec.frozen, spec.live)


# Totals kept up to date: the days from 1998 on are first stored with finished orders only, and then reported in full.

SINCE = "1998-01-01"


def _early(rows: DataFrame) -> DataFrame:
    return rows.filter((F.col("dt") < F.lit(SINCE).cast("date")) | F.col("order_status").isin(V.COMPLETED, V.CANCELLED))


def _since(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("dt") >= F.lit(SINCE).cast("date"))


def _kept_up(early: DataFrame, now: DataFrame, spec: maintained.Totals) -> DataFrame:
    """Totals of what was stored early, moved by the rows that have changed."""
    return maintained.moved(maintained.totals(early, spec), _since(early), _since(now), spec)


def _kept_revenue(x: Layers) -> DataFrame:
    return metrics.category_revenue(_kept_up(summary.category_sales(_early(x.item_days)), x.category_days, maintained.CATEGORIES))


def _kept_ranking(x: Layers) -> DataFrame:
    return metrics.product_ranking(_kept_up(summary.product_sales(_early(x.item_days)), x.product_days, maintained.PRODUCTS))


def _kept_users(x: Layers) -> DataFrame:
    """Orders on their way were first stored a day late, so a buyer's last day may have to be taken back."""
    late = (F.col("order_status") == V.SHIPPED) & (F.to_date("created_at") >= F.lit(SINCE).cast("date"))
    day_later = F.when(late, F.col("created_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("created_at"))
    early = summary.user_orders(x.lines, x.orders.withColumn("created_at", day_later))
    rows = _kept_up(early, x.user_days, maintained.USERS)
    return metrics.user_value(maintained.settled(rows, x.user_days, maintained.USERS), samples.SAMPLE_TIERS)


def _kept_regions(x: Layers) -> DataFrame:
    early, spec = _early(x.wide), maintained.REGION_BUYERS
    state = maintained.totals(metrics.region_buyers(early), spec)
    old, new = metrics.region_buyers(_since(early)), metrics.region_buyers(_since(x.wide))
    return metrics.regional_rows(maintained.moved(state, old, new, spec))


def _streamed_totals(x: Layers) -> DataFrame:
    """Line items as a stream; its totals are kept in the state store and sent out as they change."""
    stored = samples.table(x.spark, x.folder, "lineitem")
    reader = x.spark.readStream.schema(stored.schema)
    # A stream reads folders; a table that is one file is picked from its folder by name.
    one_file = stored.inputFiles()[0].endswith("/lineitem.parquet")
    stream = reader.option("pathGlobFilter", "lineitem.parquet").parquet(x.folder) if one_file else reader.parquet(f"{x.folder}/lineitem.parquet")
    part = samples.table(x.spark, x.folder, "part").select("p_partkey", F.col("p_type").alias("category"))
    placed = samples.table(x.spark, x.folder, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("created_at"))
    items = stream.join(part, F.col("l_partkey") == F.col("p_partkey")).join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    measured = items.select("category", "created_at", F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").cast(MONEY).alias("subtotal"))
    root = scratch(x.spark, "live-totals")
    live = live_totals.start(live_totals.daily_totals(measured.withWatermark("created_at", "1 day")), f"{root}/totals", f"{root}/checkpoint")
    live.query.awaitTermination()
    live.stop()
    return live_totals.latest(x.spark, live.root)


# Catalog


def _ddl_rows(x: Layers) -> DataFrame:
    """Products written with few columns."""
    d = F.col("doc")
    given = x.product_docs.select(*[J.raw_text(d, c).alias(c) for c in ("product_id", "name", "brand", "category")])
    return filled(given, TABLES["dwd_product"], AS_OF)


def _ddl_defaults(x: Layers) -> DataFrame:
    rows = _ddl_rows(x).filter(refusal(TABLES["dwd_product"]).isNull())
    return rows.select("product_id", "name", "category", "price", "description", "created_at", "is_variant", "is_abnormal")


def _ddl_refusals(x: Layers) -> DataFrame:
    rows = _ddl_rows(x).withColumn("refused", refusal(TABLES["dwd_product"])).filter("refused is not null")
    return rows.groupBy("refused").agg(F.count(F.lit(1)).alias("rows"))


def _typed_rejects(x: Layers) -> DataFrame:
    judged = feeds.with_typed_reason(x.product_messages, feeds.PRODUCT_EVENT)
    return judged.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("messages"))


def _typed_products(x: Layers) -> DataFrame:
    judged = feeds.with_typed_reason(x.product_messages, feeds.PRODUCT_EVENT).filter("reason is null").select("event.*")
    return judged.select("product_id", "name", F.col("price").cast("decimal(18,3)").alias("price"), "sub_category", "is_variant", "created_at")


# Goods


def _goods_history(x: Layers) -> DataFrame:
    """Each line item reports its product's price band on its ship date."""
    reports = x.items.select(
        "product_id", F.col("product_name").alias("name"), "brand", "category", "sub_category",
        (F.floor(F.col("subtotal") / 10000) * 10000).cast(MONEY).alias("price"),
        F.lit("").alias("image_url"), F.lit("").alias("keywords"), F.col("l_shipdate").cast("timestamp").alias("created_at"),
        F.struct(F.col("order_id").cast("bigint"), *samples.LINE_ORDER[:4]).alias("seq"),
    )
    return goods.goods_history(reports, "created_at", "seq").select(
        "sku_id", "spu_name", "first_category_name", "price_min", "price_max", "sku_price", "price_delta", "start_date",
        "end_date", "is_active",
    )


PAGE_COLUMNS = ["sku_id", "spu_name", "sku_name", "brand_name", "first_category_name", "sku_price", "price_min", "price_max"]
CHOSEN = {"category": "PROMO", "keyword": "ring"}


def _page_sought(x: Layers) -> DataFrame:
    index = [(r.day, r.goods) for r in serving.goods_days(x.goods, **CHOSEN).collect()]
    return serving.goods_page_sought(x.goods, index, **CHOSEN, page=2, size=10).select(*PAGE_COLUMNS)


def _page_after(x: Layers) -> DataFrame:
    first = serving.goods_after(x.goods, **CHOSEN, size=10).collect()
    if len(first) < 10:
        return x.goods.limit(0).select(*PAGE_COLUMNS)
    return serving.goods_after(x.goods, first[-1].dw_create_time, first[-1].sku_id, **CHOSEN, size=10).select(*PAGE_COLUMNS)


# Joins


def _join_item_order(x: Layers) -> DataFrame:
    return items_with_orders(x.lines, x.orders).select(
        "order_id", "product_id", "quantity", "subtotal", "order_status", "buyer_phone", "actual_amount", "dt"
    )


def _join_product(x: Layers) -> DataFrame:
    known = _products(x, V.DOCUMENTED)
    return with_product(x.items, known).select(
        "order_id", "product_id", "product_name", "brand", "category", "sub_category", "quantity", "subtotal"
    )


def _orphans(x: Layers) -> DataFrame:
    arrived = x.orders.filter(F.col("order_status") != V.SHIPPED)
    joined = items_with_orders(x.lines, arrived, AS_OF)
    columns = ["order_status", "buyer_phone", "province", "order_amount", "actual_amount"]
    return defaulted_orphans(joined, columns).select("order_id", "product_id", "subtotal", *columns, "dt")


def _events(x: Layers) -> DataFrame:
    return event_windows.with_event_time(samples.table(x.spark, x.folder, "events"))


def _repeated_events(x: Layers) -> DataFrame:
    events = _events(x).select("event_id", "user_id", "event_type")
    return event_windows.without_repeats(events.unionByName(events), ["event_id"])


def _pairs_once(x: Layers) -> DataFrame:
    """A buyer's repeated events of one kind count once."""
    return event_windows.without_repeats(_events(x).select("user_id", "event_type", "ts"), ["user_id", "event_type"]).drop("ts")


FLAT_COLUMNS = [
    "order_id", "buyer_name", "buyer_phone", "buyer_email", "province", "city", "district", "address_detail",
    "postal_code", "recipient_name", "recipient_phone",
]
STATE_COLUMNS = [
    "order_id", "order_status", "payment_method", "payment_amount", "payment_time", "logistics_company",
    "tracking_number", "shipped_at", "estimated_delivery", "actual_amount",
]
REQUIRED = ["buyer_name", "province", "city", "category", "payment_method", "logistics_company"]

_BUILDS: dict[str, Callable[[Layers], DataFrame]] = {
    "ods_nonempty": _nonempty,
    "ods_order_decode": _order_decode,
    "ods_product_decode": _product_decode,
    "ods_dead_letter": _dead_letter,
    "ods_typed_rejects": _typed_rejects,
    "ods_typed_products": _typed_products,
    "ddl_defaults": _ddl_defaults,
    "ddl_refusals": _ddl_refusals,
    "clean_strings": _clean_strings,
    "clean_money": _clean_money,
    "clean_ints": _clean_ints,
    "clean_flags": lambda x: x.product_docs.select(
        J.text(F.col("doc"), "product_id").alias("product_id"), J.flag(F.col("doc"), "is_variant").alias("is_variant")
    ),
    "clean_keywords": lambda x: x.product_docs.select(
        J.text(F.col("doc"), "product_id").alias("product_id"),
        J.joined_list(F.col("doc"), "keywords").alias("keywords"),
    ),
    "clean_timestamps": _clean_timestamps,
    "clean_price_repair": lambda x: _products(x, V.DOCUMENTED).select("product_id", "price", "is_abnormal"),
    "order_flatten": lambda x: _orders(x).select(*FLAT_COLUMNS),
    "order_status_rules": lambda x: _orders(x).select(*STATE_COLUMNS),
    "order_item_count": lambda x: _orders(x).select("order_id", "item_count"),
    "order_status_map": _order_state,
    "dwd_product": lambda x: _products(x, V.DOCUMENTED),
    "dwd_product_live": lambda x: _products(x, V.LIVE),
    "dwd_order": lambda x: _orders(x),
    "dwd_order_live": lambda x: _orders(x, V.LIVE),
    "dwd_order_item": lambda x: _items(x, V.LIVE),
    "dwd_order_item_documented": lambda x: _items(x, V.DOCUMENTED),
    "dwd_order_nonempty": _nonempty_orders,
    "upsert_partial_product": _upsert_product,
    "upsert_partial_order": _upsert_order,
    "append_items_idempotent": _append_items,
    "append_parts_idempotent": _judged_parts,
    "upsert_metrics": _upsert_metrics,
    "join_item_order": _join_item_order,
    "join_wide_product": _join_product,
    "join_orphan_defaults": _orphans,
    "dws_order_wide": lambda x: x.wide,
    "dws_product_sales_1d": lambda x: x.product_days,
    "dws_category_sales_1d": lambda x: x.category_days,
    "dws_user_order_1d": lambda x: x.user_days,
    "dws_user_order_1d_order_grain": lambda x: summary.user_orders(x.lines, x.orders, order_grain=True),
    "ads_category_revenue": lambda x: x.revenue,
    "ads_category_revenue_exact": lambda x: metrics.category_revenue_exact(x.items),
    "ads_category_revenue_dense": lambda x: metrics.category_revenue(x.category_days, dense=True),
    "ads_daily_sales_trend": lambda x: x.trend,
    "ads_daily_sales_trend_exact": lambda x: metrics.daily_trend_exact(items_with_orders(x.lines, x.order_states)),
    "ads_daily_trend_change": lambda x: metrics.daily_trend_change(x.trend),
    "ads_user_value": lambda x: x.users,
    "ads_product_ranking": lambda x: x.ranking,
    "ads_regional_province": lambda x: metrics.regional_sales(x.wide, ("province",)),
    "ads_regional_city": lambda x: metrics.regional_sales(x.wide, ("city",)),
    "ads_regional_sales": lambda x: x.regions,
    "ads_regional_sales_order_grain": lambda x: metrics.regional_sales_order_grain(x.wide),
    "q_category_revenue": lambda x: serving.category_revenue(x.revenue),
    "q_daily_trend": lambda x: serving.daily_trend(x.trend, *YEAR),
    "q_daily_trend_all": lambda x: serving.daily_trend(x.trend),
    "q_user_value": lambda x: serving.user_value(x.users, V.TIER_MIDDLE),
    "q_tier_distribution": lambda x: serving.tier_distribution(x.users),
    "q_product_ranking": lambda x: serving.product_ranking(x.ranking, 20, "MEDIUM"),
    "q_regional_sales": lambda x: serving.regional_sales(x.regions, "city"),
    "q_dashboard_kpi": lambda x: serving.dashboard_kpi(x.trend, x.users, metrics.product_totals(x.product_days)),
    "q_goods_page": lambda x: serving.goods_page(x.goods, "PROMO", keyword="ring", page=2, size=10).select(
        "sku_id", "spu_name", "sku_name", "brand_name", "first_category_name", "sku_price", "price_min", "price_max"
    ),
    "q_goods_page_sought": _page_sought,
    "q_goods_page_after": _page_after,
    "q_goods_count": lambda x: serving.goods_count(x.goods, "PROMO", keyword="ring"),
    "q_goods_categories": lambda x: serving.goods_categories(x.goods),
    "q_goods_brands": lambda x: serving.goods_brands(x.goods),
    "v_recent_trend": lambda x: page_views.recent_trend(x.trend, TODAY, page_views.TREND_DAYS),
    "v_daily_top_users": lambda x: page_views.daily_top_users(x.users),
    "v_top_users_by_tier": lambda x: page_views.by_tier(page_views.daily_top_users(x.users)),
    "v_top_regions": lambda x: page_views.top_regions(x.regions, "city"),
    "v_top_high_value": lambda x: page_views.top_high_value(x.users),
    "v_goods_pages": lambda x: page_views.goods_pages(serving.goods_count(x.goods)),
    "v_user_recency": lambda x: page_views.user_recency(x.users, TODAY).select(
        "buyer_phone", "recency_days", "order_frequency", "total_monetary"
    ),
    "v_home_top5": lambda x: page_views.home_top(x.revenue, metrics.top_products(x.product_days, page_views.TOP_HOME)),
    "dq_wide_vs_items": lambda x: quality.wide_vs_items(x.wide, x.lines),
    "dq_ratios": lambda x: quality.ratios(x.product_days, x.trend),
    "dq_share_rank": lambda x: quality.share_and_rank(x.revenue),
    "dq_tiers": lambda x: quality.tiers(x.users, samples.SAMPLE_TIERS),
    "dq_required_fields": lambda x: quality.required_fields(x.wide, REQUIRED),
    "dq_region_rollup": lambda x: quality.region_rollup(x.regions),
    "dq_sku_count": lambda x: quality.sku_count(x.category_days, x.item_days),
    "dq_user_trace": lambda x: quality.user_trace(x.user_days, x.lines, x.orders),
    "dim_goods_info": lambda x: x.goods.withColumn("keywords", F.array_join("keywords", ",")),
    "event_daily_windows": lambda x: event_windows.daily_windows(_events(x), ["event_type"], "value"),
    "event_without_repeats": _repeated_events,
    "event_pairs_once": _pairs_once,
    "ads_category_revenue_kept": _kept_revenue,
    "ads_product_ranking_kept": _kept_ranking,
    "ads_user_value_kept": _kept_users,
    "ads_regional_sales_kept": _kept_regions,
    "stream_category_totals": _streamed_totals,
    "dim_goods_history": _goods_history,
}

QUERIES: dict[str, Query] = {name: _query(build) for name, build in _BUILDS.items()}
