"""Feed ingest: each micro-batch of messages becomes detail rows and rejects, published in one commit."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martloom.functions import json_fields as J
from martloom.functions.vocabulary import DOCUMENTED, Defaults
from martloom.operators.keyed_merge import WHOLE_ORDER, as_changes, judged_parts, merge_changes
from martloom.plans import detail
from martloom.session import LOOKUP_KEYS
from martloom.sources import feeds
from martloom.sources.catalog import TABLES
from martloom.sources.warehouse import DAY, ORDERS, PRODUCTS, Warehouse

Clock = Callable[[], datetime]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _judged(
    wh: Warehouse, messages: DataFrame, version: int, required: tuple[str, ...], items_required: bool = False
) -> tuple[DataFrame, str]:
    """The batch parsed once and kept aside for the tables made from it; messages without a required field are rejects.

    Reading it back with the warehouse's session also restores the adaptive plans a streaming session switches off.
    """
    placed = feeds.numbered(messages).withColumn("seq", feeds.arrival(version)).select("value", "seq")
    judged = feeds.with_reject_reason(feeds.parse(feeds.nonempty(placed)), required, items=items_required)
    return wh.stage(judged, "messages")


def _rejects(judged: DataFrame, as_of: Column) -> DataFrame:
    return feeds.rejected(judged).select("value", "reason", as_of.alias("load_time"))


def _folded(rows: DataFrame, table: str, extra: tuple[str, ...] = ()) -> DataFrame:
    spec = TABLES[table]
    return merge_changes(as_changes(rows), spec.key, [*spec.frozen, *extra], spec.live, keep_seq=True, added=spec.added)


def ingest_products(
    wh: Warehouse,
    messages: DataFrame,
    as_of: datetime,
    defaults: Defaults = DOCUMENTED,
    source: str | None = None,
    batch_id: int | None = None,
) -> int | None:
    """Publish one batch of product messages; None when this batch was published before."""
    change = wh.begin(PRODUCTS)
    if source is not None and change.seen(source, batch_id):
        return None
    stamp = detail.load_time(as_of)
    judged, parsed_stage = _judged(wh, messages, change.version, ("product_id",))
    rows = detail.product_rows(feeds.accepted(judged), stamp, defaults)
    change.append("dwd_product", _folded(rows, "dwd_product"))
    change.append("rejected_products", _rejects(judged, stamp))
    version = change.commit(source, batch_id)
    wh.drop_stage(parsed_stage)
    return version


def stored_days(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows of the table of order days that belong to ``orders`` (order_id).

    The ids of a small batch are pushed down to the files, where sort order and Bloom filters leave only the row groups that
    hold one; those of a large batch are joined.
    """
    ids = [r.order_id for r in orders.select("order_id").distinct().limit(LOOKUP_KEYS + 1).collect()]
    if len(ids) <= LOOKUP_KEYS:
        return rows.filter(F.col("order_id").isin(ids))
    return rows.join(orders.select("order_id").distinct(), "order_id", "left_semi")


def _days(headers: DataFrame, stored: DataFrame) -> DataFrame:
    """Per order of the batch, the day of its first message and whether it was known before.

    The first message decides the day for good, so all rows of an order share a folder and a refresh can prune by day.
    """
    here = headers.select("order_id", "seq", F.to_date("created_at").alias(DAY), F.lit(False).alias("known"))
    both = here.unionByName(stored.select("order_id", "seq", DAY, F.lit(True).alias("known")))
    return both.groupBy("order_id").agg(F.min_by(DAY, "seq").alias(DAY), F.min("seq").alias("seq"), F.bool_or("known").alias("known"))


def ingest_orders(
    wh: Warehouse,
    messages: DataFrame,
    as_of: datetime,
    defaults: Defaults = DOCUMENTED,
    source: str | None = None,
    batch_id: int | None = None,
) -> int | None:
    """Publish one batch of order messages: headers, items and rejects together.

    An order may come in several messages, told apart by their ``part``. Items are those of the first message of each
    part, so a replayed one adds none; the item count is the number of items kept. A message whose items are set aside, because
    its order came whole and it is a part, or the other way round, is also a reject.
    """
    change = wh.begin(ORDERS)
    if source is not None and change.seen(source, batch_id):
        return None
    stamp = detail.load_time(as_of)
    judged, parsed_stage = _judged(
        wh, messages, change.version, ("order_id",), items_required=not defaults.keep_empty_orders
    )
    part = F.coalesce(J.raw_text(F.col("doc"), "part"), F.lit(WHOLE_ORDER))
    docs = feeds.accepted(judged).withColumn("part", part)
    headers = detail.order_rows(docs, stamp, defaults)
    found = stored_days(change.read("order_days"), headers)
    days, days_stage = wh.stage(_days(headers, found), "days")
    # One row per calendar day, however many orders there are.
    busy = [str(r[DAY]) for r in days.select(DAY).distinct().collect()]
    stored = change.read("dwd_order_item", busy).join(days, "order_id", "left_semi")
    offered = headers.filter(F.col("item_count") > 0)
    parts, new_stage = wh.stage(judged_parts(offered, stored), "parts")
    new = parts.filter("fits and not known").select("order_id", "part", "seq")
    odd = parts.filter("not fits").select("seq")

    place = ["order_id", "part", "seq"]
    counted = headers.join(new.withColumn("taken", F.lit(True)), place, "left").withColumn(
        "item_count", F.when(F.col("taken"), F.col("item_count")).otherwise(0)
    )
    day_of = days.select("order_id", DAY)
    change.append("order_days", days.filter("not known"))
    change.append("dwd_order", _folded(counted.join(day_of, "order_id"), "dwd_order", (DAY,)))
    items = detail.item_rows(docs, stamp, defaults).join(new, place, "left_semi")
    change.append("dwd_order_item", items.join(day_of, "order_id"))
    mixed = judged.join(odd, "seq", "left_semi").select("value", F.lit("mixed_parts").alias("reason"), stamp.alias("load_time"))
    change.append("rejected_orders", _rejects(judged, stamp).unionByName(mixed))
    version = change.commit(source, batch_id)
    wh.drop_stage(new_stage)
    wh.drop_stage(days_stage)
    wh.drop_stage(parsed_stage)
    return version


def start(
    wh: Warehouse,
    feed: DataFrame,
    ingest: Callable[..., int | None],
    checkpoint: str,
    every: str | None = None,
    defaults: Defaults = DOCUMENTED,
    clock: Clock = _now,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Run ``ingest`` on every micro-batch of ``feed``; with ``every`` unset, until the feed is read up.

    The checkpoint names the source, so a restarted query repeats no batch. ``after`` gets each new version.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        version = ingest(wh, batch, clock(), defaults, checkpoint, batch_id)
        if version is not None and after is not None:
            after(version)

    writer = feed.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
