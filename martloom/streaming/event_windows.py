"""Event-time operators, the same on a stream and on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_event_time(events: DataFrame, column: str = "ts") -> DataFrame:
    """Zone-less event times as instants of the session's zone, which a watermark needs."""
    return events.withColumn(column, F.col(column).cast("timestamp"))


def daily_windows(events: DataFrame, keys: list[str], value: str, time: str = "ts", delay: str = "1 day") -> DataFrame:
    """Count and sum per key and day. On a stream a day closes ``delay`` after its end and later rows are dropped."""
    w = F.window(time, "1 day")
    return (
        events.withWatermark(time, delay)
        .groupBy(w.alias("day"), *keys)
        .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col(value).cast("decimal(15,2)")).alias("total"))
        .select(F.to_date("day.start").alias("dt"), *keys, "events", F.col("total").cast("decimal(25,2)").alias("total"))
    )


def without_repeats(events: DataFrame, key: list[str], time: str = "ts", delay: str = "1 day") -> DataFrame:
    """One event per key. On a stream a key is remembered until the watermark passes it by ``delay``."""
    if events.isStreaming:
        return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)
    return events.dropDuplicates(key)


def running_distinct(events: DataFrame, keys: list[str], counted: str, time: str = "ts", delay: str = "1 day") -> DataFrame:
    """Approximate distinct count per key and day in one pass; exact counts come from recomputing touched days."""
    w = F.window(time, "1 day")
    return (
        events.withWatermark(time, delay)
        .groupBy(w.alias("day"), *keys)
        .agg(F.approx_count_distinct(counted, 0.01).alias("distinct_about"))
        .select(F.to_date("day.start").alias("dt"), *keys, "distinct_about")
    )
