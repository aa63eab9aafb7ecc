"""Daily totals straight from the order feed, kept in the query's state store and sent out as they change."""

from __future__ import annotations

import time
from collections import defaultdict
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from martloom.functions import json_fields as J
from martloom.functions.amounts import count_sum, money_sum
from martloom.functions.vocabulary import DOCUMENTED, Defaults
from martloom.operators.keyed_merge import WHOLE_ORDER
from martloom.plans import detail
from martloom.sources import feeds

KEY = ["category", "dt"]
MEASURES = ["total_quantity", "total_amount"]


def item_feed(messages: DataFrame, as_of: datetime, delay: str, defaults: Defaults = DOCUMENTED) -> DataFrame:
    """Items of an order feed with their order's time; a part that comes again within ``delay`` adds none.

    Of messages of one part in one micro-batch any one is taken.
    """
    judged = feeds.with_reject_reason(feeds.parse(feeds.nonempty(messages)), ("order_id",), items=True)
    d, stamp = F.col("doc"), detail.load_time(as_of)
    docs = feeds.accepted(judged).select(
        "doc",
        J.text(d, "order_id").alias("order_id"),
        F.coalesce(J.raw_text(d, "part"), F.lit(WHOLE_ORDER)).alias("part"),
        J.timestamp(d, "created_at", stamp).alias("created_at"),
    )
    once = docs.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["order_id", "part"])
    return detail.item_rows(once.drop("order_id"), stamp, defaults)


def daily_totals(items: DataFrame, time_column: str = "created_at") -> DataFrame:
    """Running quantity and amount per category and day; a day leaves the state when the watermark has passed it."""
    return (
        items.groupBy("category", F.window(time_column, "1 day").alias("day"))
        .agg(count_sum(F.col("quantity")).alias("total_quantity"), money_sum(F.col("subtotal")).alias("total_amount"))
        .select("category", F.to_date("day.start").alias("dt"), *MEASURES)
    )


class LateRows(StreamingQueryListener):
    """Rows that a running query has dropped because they came after their window was closed."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = defaultdict(int)
        self.batches: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[str(progress.runId)] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        self.batches[str(progress.runId)] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@dataclass
class Live:
    """A running query that writes totals below ``root``."""

    spark: SparkSession
    query: StreamingQuery
    root: str
    listener: LateRows

    def late_rows(self, patience: float = 10) -> int:
        """Rows dropped so far; waits a moment for the report of the last batch."""
        run, last, until = str(self.query.runId), self.query.lastProgress, time.time() + patience
        while last and self.listener.batches.get(run, -1) < last["batchId"] and time.time() < until:
            time.sleep(0.05)
        return self.listener.dropped[run]

    def stop(self) -> None:
        self.query.stop()
        self.spark.streams.removeListener(self.listener)


def start(totals: DataFrame, root: str, checkpoint: str, every: str | None = None) -> Live:
    """Send out changed totals batch by batch; with ``every`` unset, until the feed is read up.

    A batch is a folder named by its number and is overwritten when it is repeated, so a restart writes nothing twice.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    listener = LateRows()
    totals.sparkSession.streams.addListener(listener)
    writer = totals.writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", checkpoint)
    query = writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()
    return Live(totals.sparkSession, query, root, listener)


def latest(spark: SparkSession, root: str, key: list[str] = KEY, measures: list[str] = MEASURES) -> DataFrame:
    """The last value sent out for every key."""
    rows = spark.read.parquet(root)
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*measures), "batch").alias("last"))
    return last.select(*key, *[f"last.{m}" for m in measures])
