"""Message feeds: one ``value STRING`` row per message, plus ``seq``, the message's place in arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions import json_fields as J

PRODUCT_TOPIC = "ods_products_data"
ORDER_TOPIC = "ods_orders_data"

PRODUCT_EVENT = """product_id string, name string, brand string, category string, sub_category string,
    price decimal(38,10), description string, image_url string, keywords array<string>, created_at string,
    is_variant boolean"""

ORDER_EVENT = """order_id string, part string, order_status string,
    items array<struct<product_id: string, product_name: string, brand: string, category: string,
        sub_category: string, original_price: decimal(38,10), price: decimal(38,10), quantity: int,
        sales_volume: int, subtotal: decimal(38,10)>>,
    item_count int, order_amount decimal(38,10), discount decimal(38,10), actual_amount decimal(38,10),
    buyer struct<name: string, phone: string, email: string>,
    shipping_address struct<province: string, city: string, district: string, detail: string, postal_code: string,
        recipient_name: string, recipient_phone: string>,
    payment struct<method: string, amount: decimal(38,10), paid_at: string>,
    logistics struct<company: string, tracking_number: string, shipped_at: string, estimated_delivery: string>,
    created_at string, remark string"""

BAD_RECORD = "_bad_record"

SEQ = "struct<batch: bigint, origin: string, position: bigint, row: bigint>"


def kafka_feed(
    spark: SparkSession, servers: str, topic: str, start: str = "earliest", **options: str
) -> DataFrame:
    """Streaming topic. ``start`` is ``earliest`` or ``latest`` and counts only until a checkpoint exists.

    Needs the Kafka connector on the class path; the partition and offset give the arrival order of a key.
    """
    if start not in ("earliest", "latest"):
        raise ValueError(f"unknown start position {start!r}")
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .options(**options)
        .load()
    )
    return raw.select(
        F.col("value").cast("string").alias("value"),
        F.concat_ws("-", "topic", "partition").alias("origin"),
        F.col("offset").alias("position"),
        F.lit(0).cast("bigint").alias("row"),
    )


def file_feed(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming folder of text files, one message per line; file names sort in arrival order."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _with_origin(reader.load(folder))


def file_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same folder read once."""
    return numbered(_with_origin(spark.read.text(folder)))


def _with_origin(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("origin"),
        F.col("_metadata.file_block_start").alias("position"),
    )


def numbered(messages: DataFrame) -> DataFrame:
    """Add ``row``, the order of the lines within a file block; a stream is numbered batch by batch."""
    return messages if "row" in messages.columns else messages.withColumn("row", F.monotonically_increasing_id())


def arrival(batch: int) -> Column:
    """Order of arrival over all batches, comparable as one struct."""
    return F.struct(F.lit(batch).cast("bigint").alias("batch"), "origin", "position", "row")


def nonempty(messages: DataFrame) -> DataFrame:
    """Drop null and empty payloads."""
    return messages.filter(F.col("value") != "")


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters reuse.

    A filter on a projected column is pushed below the projection together with the column's whole expression, which
    is then worked out twice. Filters on a generated column stay above it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse(messages: DataFrame) -> DataFrame:
    """Add ``doc``, the message as a VARIANT; NULL unless the text is one JSON object.

    Only the blanks in front are taken off to see how the text begins: those behind it would be looked for from its first
    character on.
    """
    is_object = F.ltrim("value", F.lit(" \t\r\n")).startswith("{")
    return computed_once(messages, "doc", F.when(is_object, F.try_parse_json("value")))


def with_reject_reason(parsed: DataFrame, required: tuple[str, ...] = (), items: bool = False) -> DataFrame:
    """Add ``reason``: why a message is set aside, NULL for a good one.

    ``required`` names fields that must not be blank; ``items`` also sets aside orders without items.
    """
    reason = F.when(F.col("doc").isNull(), "malformed_json")
    for name in required:
        reason = reason.when(J.raw_text(F.col("doc"), name).isNull(), f"missing_{name}")
    if items:
        count = J.list_size(F.col("doc"), "items")
        reason = reason.when(count <= 0, "no_items")
    return parsed.withColumn("reason", reason)


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).drop("reason")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull()).drop("doc")


def with_typed_reason(messages: DataFrame, event: str) -> DataFrame:
    """Add ``event``, the message read by a schema, and ``reason``: NULL, or why it does not fit.

    A field of a wrong type makes the whole message a reject; reading it as NULL would hide the mistake.
    """
    read = F.from_json("value", f"{event}, {BAD_RECORD} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD})
    is_object = F.btrim("value", F.lit(" \t\r\n")).startswith("{") & F.try_parse_json("value").isNotNull()
    reason = F.when(~F.coalesce(is_object, F.lit(False)), "malformed_json").when(F.col(f"event.{BAD_RECORD}").isNotNull(), "wrong_type")
    return computed_once(messages, "event", read).withColumn("reason", reason).withColumn("event", F.col("event").dropFields(BAD_RECORD))


def decode_products(messages: DataFrame) -> DataFrame:
    """Typed product events; unknown fields are ignored."""
    return messages.select(F.from_json("value", PRODUCT_EVENT).alias("event")).select("event.*")


def decode_orders(messages: DataFrame) -> DataFrame:
    """Typed nested order events; unknown fields are ignored."""
    return messages.select(F.from_json("value", ORDER_EVENT).alias("event")).select("event.*")
