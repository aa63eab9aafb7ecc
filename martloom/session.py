"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Order-keyed joins are followed by windows and distinct counts that would reuse the join's partitioning. Without the
# "force" switch the optimizer keeps a hot order in one task to save that extra shuffle; with it the hot partition is
# split and only then re-shuffled, so unskewed data pays nothing.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lookups by a list of keys reach the files' statistics and Bloom filters up to this many keys.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}
LOOKUP_KEYS = int(RUNTIME_SETTINGS["spark.sql.parquet.pushdown.inFilterThreshold"])


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a session made elsewhere. Sizes and partition counts stay the caller's."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new path below `spark.checkpoint.dir`. Only a local session may lack that setting; it gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        root = tempfile.mkdtemp(prefix="martloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def local_session(cores: str = "8", name: str = "martloom", memory: str = "8g") -> SparkSession:
    """Session for tests and the bench on one machine; on a cluster the submitter supplies the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        # One-file sample tables are read by one task; a join that shuffles puts the other cores to work.
        .config("spark.sql.autoBroadcastJoinThreshold", "512KB")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
