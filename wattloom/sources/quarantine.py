"""What jobs set aside: the reason and the text of each reject."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.sources import runs
from wattloom.sources.folders import Folders
from wattloom.sources.tables import Table, read_log

QUARANTINE_COLUMNS = "reason string, original string"

# The rejects of streams: a log of micro-batches that is packed as others are.
STREAM_REJECTS = Table("quarantine", QUARANTINE_COLUMNS, ("reason", "original"), partition="reason", order=())


def quarantine_files(rejected: DataFrame, root: str) -> None:
    """Keep rejects (file, reason, original), a part for each file: files that are read again replace theirs only."""
    named = rejected.select("reason", "original", F.sha2("file", 256).alias("part"))
    writer = named.hint("rebalance", "part").write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    writer.partitionBy("part").parquet(f"{root.rstrip('/')}/quarantine")


def input_part(rows: DataFrame, *more: str) -> str:
    """A part named by the files that ``rows`` reads: the same files replace their rejects, others keep theirs."""
    return hashlib.sha256("\n".join([*sorted(rows.inputFiles()), *more]).encode()).hexdigest()[:32]


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Everything that jobs set aside: reason, original, part (of a run, a file or a micro-batch)."""
    schema, path = f"{QUARANTINE_COLUMNS}, part string", f"{root.rstrip('/')}/quarantine"
    found = runs.read(spark, root, runs.REJECTS).select("reason", "original", "part")
    streamed = read_log(spark, root, STREAM_REJECTS)
    found = found.unionByName(streamed.select("reason", "original", F.concat_ws("-", "run", "batch_id").alias("part")))
    if any(name.startswith("part=") for name in Folders(spark).names(path)):
        found = found.unionByName(spark.read.schema(schema).parquet(path).select("reason", "original", "part"))
    return found
