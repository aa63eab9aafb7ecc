"""Versioned Parquet tables with one small commit file per version.

A commit file lists, per table and day, the folders that make up the table. Data is written first and the commit file
last, so all tables of a commit become visible together and a failed attempt leaves nothing visible. Each writer (the
product feed, the order feed, the refresh) has its own commit line and its own tables.

    <root>/tables/<table>/run=<version>/[dt=<day>/]part-*.parquet
    <root>/commits/<writer>/<version>.json
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martloom.operators.keyed_merge import FIRST, LAST, merge_changes
from martloom.sources import shared_files
from martloom.session import tune
from martloom.sources.catalog import INTERNAL, TABLES, enforced
from martloom.sources.feeds import SEQ

DAY = "dt"
WHOLE = ""

# Tables kept as appended changes and merged by key when read.
MERGED_ON_READ = ("dwd_product", "dwd_order")
PRODUCTS, ORDERS, REFRESH, GOODS = "products", "orders", "refresh", "goods"
WRITERS = {
    PRODUCTS: ("dwd_product", "rejected_products"),
    ORDERS: ("dwd_order", "dwd_order_item", "rejected_orders", "order_days"),
    GOODS: ("dim_goods_info",),
    REFRESH: (
        "dws_order_wide",
        "dws_product_sales_1d",
        "dws_category_sales_1d",
        "dws_user_order_1d",
        "ads_category_revenue",
        "ads_daily_sales_trend",
        "ads_user_value",
        "ads_product_ranking",
        "ads_regional_sales",
        "sum_category",
        "sum_user",
        "sum_product",
        "sum_region",
    ),
}
# Tables looked up by a key: sorted by it, in small row groups that carry a Bloom filter of it.
LOOKED_UP = {"order_days": "order_id"}
ROW_GROUP_BYTES = 1 << 20
OWNER = {table: writer for writer, tables in WRITERS.items() for table in tables}
DAILY = (
    "dwd_order",
    "dwd_order_item",
    "dws_order_wide",
    "dws_product_sales_1d",
    "dws_category_sales_1d",
    "dws_user_order_1d",
)
REJECTS = "value string, reason string, load_time timestamp"


def stored_schema(table: str) -> T.StructType:
    """Columns as stored: the table's own, its place in arrival order, and the day for tables split by day."""
    if table.startswith("rejected_"):
        return T.StructType.fromDDL(REJECTS)
    fields = [T.StructField(f.name, f.dataType) for f in (INTERNAL | TABLES)[table].schema]
    if table in MERGED_ON_READ:
        seq = T.StructType.fromDDL(f"seq {SEQ}")[0].dataType
        fields += [T.StructField(FIRST, seq), T.StructField(LAST, seq)]
    if table in DAILY and DAY not in TABLES[table].schema.names:
        fields.append(T.StructField(DAY, T.DateType()))
    return T.StructType(fields)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = tune(spark)
        self.root = root.rstrip("/")

    # Commits

    def _line(self, writer: str) -> str:
        return f"{self.root}/commits/{writer}"

    def versions(self, writer: str) -> list[int]:
        return [int(n[:-5]) for n in shared_files.names(self.spark, self._line(writer)) if n[0].isdigit()]

    def commit_at(self, writer: str, version: int) -> dict:
        return json.loads(shared_files.read_text(self.spark, f"{self._line(writer)}/{version:012d}.json"))

    def head(self, writer: str) -> dict:
        """The writer's latest commit, or an empty one."""
        found = self.versions(writer)
        if not found:
            return {"version": 0, "tables": {}, "batches": {}, "touched": {}}
        return self.commit_at(writer, found[-1])

    def begin(self, writer: str) -> Change:
        return Change(self, writer)

    def days_touched(self, writer: str, table: str, after: int, until: int | None = None) -> list[str]:
        """Days of ``table`` written by the commits later than version ``after``, up to version ``until``."""
        days: set[str] = set()
        for version in self.versions(writer):
            if version > after and (until is None or version <= until):
                days.update(self.commit_at(writer, version)["touched"].get(table, []))
        return sorted(days)

    # Reading

    def read(self, table: str, days: Sequence[str] | None = None, commit: dict | None = None) -> DataFrame:
        """The table's rows, of the given days or all, as of a commit of its writer or now."""
        commit = commit or self.head(OWNER[table])
        return self._read(table, commit["tables"].get(table, {}), days)

    def changes(self, table: str, days: Sequence[str] | None = None) -> DataFrame:
        """The stored change rows of a table that is merged on read."""
        return self._stored(table, self.head(OWNER[table])["tables"].get(table, {}), days)

    def _stored(self, table: str, parts: dict[str, list[str]], days: Sequence[str] | None) -> DataFrame:
        schema = stored_schema(table)
        chosen = parts if days is None or table not in DAILY else {d: parts[d] for d in days if d in parts}
        paths = sorted({f"{self.root}/{p}" for folders in chosen.values() for p in folders})
        if not paths:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/tables/{table}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    def _read(self, table: str, parts: dict[str, list[str]], days: Sequence[str] | None) -> DataFrame:
        rows = self._stored(table, parts, days)
        if table not in MERGED_ON_READ:
            return rows
        spec = TABLES[table]
        frozen = [*spec.frozen, *([DAY] if table in DAILY else [])]
        return merge_changes(rows, spec.key, frozen, spec.live, added=spec.added)

    # Scratch

    def stage(self, df: DataFrame, label: str) -> tuple[DataFrame, str]:
        """Write intermediate rows to the shared folder and read them back: computed once, safe from lost executors."""
        path = f"{self.root}/staging/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop_stage(self, path: str) -> None:
        if not path.startswith(f"{self.root}/staging/"):
            raise ValueError(f"{path} is no staging folder")
        shared_files.remove(self.spark, path)

    def prune(self, writer: str, keep: int = 10) -> int:
        """Remove the writer's commits before the last ``keep`` and the folders no kept commit lists.

        Commits the refresh has still to look at are kept as well. Returns the number of folders removed.
        """
        versions = self.versions(writer)
        last = self.head(REFRESH).get("order_version", 0) if writer == ORDERS else versions[-1] if versions else 0
        old = [v for v in versions[:-keep] if v <= last]
        kept = [self.commit_at(writer, v) for v in versions if v not in old]
        in_use = {
            folder.split(f"/{DAY}=")[0] for c in kept for parts in c["tables"].values() for fs in parts.values()
            for folder in fs
        }
        removed = 0
        newest = f"{versions[-1]:012d}" if versions else ""
        for table in WRITERS[writer]:
            for name in shared_files.names(self.spark, f"{self.root}/tables/{table}"):
                # A folder of a version not yet committed belongs to a running attempt.
                if name.removeprefix("run=").split("-")[0] <= newest and f"tables/{table}/{name}" not in in_use:
                    shared_files.remove(self.spark, f"{self.root}/tables/{table}/{name}")
                    removed += 1
        for v in old:
            shared_files.remove(self.spark, f"{self._line(writer)}/{v:012d}.json")
        return removed

    def compact(self, table: str) -> int:
        """Fold the change rows of a table that is merged on read, or the files of one looked up, into one set of files."""
        if table not in MERGED_ON_READ and table not in LOOKED_UP:
            raise ValueError(f"{table} is not kept as changes")
        change = self.begin(OWNER[table])
        if table in LOOKED_UP:
            change.replace(table, self.read(table))
            return change.commit(touch=False)
        spec = TABLES[table]
        frozen = [*spec.frozen, *([DAY] if table in DAILY else [])]
        folded = merge_changes(self.changes(table), spec.key, frozen, spec.live, keep_seq=True, added=spec.added)
        change.replace(table, folded)
        return change.commit(touch=False)


class Change:
    """The tables one commit will publish."""

    def __init__(self, warehouse: Warehouse, writer: str):
        self.wh = warehouse
        self.writer = writer
        self.base = warehouse.head(writer)
        self.version = self.base["version"] + 1
        self.attempt = f"{self.version:012d}-{uuid.uuid4().hex[:8]}"
        self.tables = {t: {d: list(f) for d, f in parts.items()} for t, parts in self.base["tables"].items()}
        self.touched: dict[str, list[str]] = {}

    def seen(self, source: str, batch_id: int) -> bool:
        """Whether this batch of this source has already been committed."""
        return self.base["batches"].get(source, -1) >= batch_id

    def _write(self, table: str, df: DataFrame) -> dict[str, str]:
        if OWNER[table] != self.writer:
            raise ValueError(f"{table} belongs to {OWNER[table]}, not {self.writer}")
        folder = f"tables/{table}/run={self.attempt}"
        target = f"{self.wh.root}/{folder}"
        rows = df.select(*stored_schema(table).names)
        if table in TABLES:
            rows = enforced(rows, TABLES[table])
        if table in LOOKED_UP:
            key = LOOKED_UP[table]
            writer = rows.orderBy(key).write.option("parquet.block.size", ROW_GROUP_BYTES)
            writer.option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(target)
            return {WHOLE: folder}
        if table not in DAILY:
            rows.write.parquet(target)
            return {WHOLE: folder}
        # Rows of a day are brought together to keep files few; the adaptive rebalance splits a busy day again.
        rows.hint("rebalance", DAY).write.partitionBy(DAY).parquet(target)
        found = [n.split("=", 1)[1] for n in shared_files.names(self.wh.spark, target) if n.startswith(f"{DAY}=")]
        return {day: f"{folder}/{DAY}={day}" for day in found}

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to the table."""
        for day, folder in self._write(table, df).items():
            self.tables.setdefault(table, {}).setdefault(day, []).append(folder)
            self.touched.setdefault(table, []).append(day)

    def replace(self, table: str, df: DataFrame, days: Sequence[str] | None = None) -> None:
        """Put ``df`` in place of the table's rows, or of the given days; days without new rows end up empty."""
        written = {day: [folder] for day, folder in self._write(table, df).items()}
        kept = {} if days is None else {d: f for d, f in self.tables.get(table, {}).items() if d not in set(days)}
        if days is not None and not set(written) <= set(days):
            raise ValueError(f"{table}: rows outside the days being replaced")
        self.touched.setdefault(table, []).extend(days if days is not None else written)
        self.tables[table] = {**kept, **written}

    def changes(self, table: str) -> DataFrame:
        """The stored change rows this commit builds on."""
        return self.wh._stored(table, self.base["tables"].get(table, {}), None)

    def read(self, table: str, days: Sequence[str] | None = None) -> DataFrame:
        """The table as this commit will publish it."""
        return self.wh._read(table, self.tables.get(table, {}), days)

    def commit(
        self, source: str | None = None, batch_id: int | None = None, touch: bool = True, **notes: int | str
    ) -> int:
        batches = dict(self.base["batches"])
        if source is not None:
            batches[source] = batch_id
        record = {
            "version": self.version,
            "tables": self.tables,
            "batches": batches,
            "touched": self.touched if touch else {},
            **{k: v for k, v in self.base.items() if k not in ("version", "tables", "batches", "touched")},
            **notes,
        }
        text = json.dumps(record, ensure_ascii=False, sort_keys=True)
        shared_files.publish_text(self.wh.spark, f"{self.wh._line(self.writer)}/{self.version:012d}.json", text)
        return self.version
