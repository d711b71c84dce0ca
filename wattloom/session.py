"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings the operators count on. AQE coalesces small shuffle partitions, splits skewed
# join sides and turns a join into a broadcast once a side has been measured as small enough;
# the force flag lets the split happen even where it costs one more exchange above the join.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Compressed files count for four times their size when the planner looks for a side to broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}

# For sessions of our own: streaming state on local disk instead of the heap.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_workspace: str | None = None


def build_session(app: str = "wattloom", master: str | None = None, time_zone: str = "UTC", **conf: str) -> SparkSession:
    """A session with the runtime settings above and an explicit zone for calendar dates."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", time_zone)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for what runs inside the block: a stream with state switches it off in its session."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def workspace(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one named in spark.checkpoint.dir.

    Only a local master may do without the setting; executors of a cluster share no /tmp.
    """
    global _local_workspace
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_workspace is None:
        _local_workspace = tempfile.mkdtemp(prefix="wattloom-")
    return _local_workspace


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder below the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"
