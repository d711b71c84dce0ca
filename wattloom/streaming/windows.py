"""Live mains power with event-time state, and late rows kept aside.

Two streams. The first adds up each micro-batch by window, without state, and parts the sums: those of windows that are
closed by then are late and go to a side table, the others to a folder of partial sums. What is closed follows from the
largest event time of the batches before, which is kept beside the checkpoint. The second stream reads the partial sums,
holds open windows as state under a watermark, and appends their new sums to a log. Its watermark is never ahead of
the first stream's, so it drops nothing: on time or late, each reading is in one of the two tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.sources.folders import Folders
from wattloom.sources.tables import Table, read_latest, read_log, run_of
from wattloom.streaming.power import TRIGGER, append_and_pack, each_batch

_COLUMNS = "window_start timestamp, house_id bigint, date string, zip string, watts_sum double"
_KEY = ("window_start", "house_id", "date", "zip")

# Sums of windows from readings that came in time, as of the last batch that changed them, and late ones.
WINDOW_POWER = Table("window_power", _COLUMNS, _KEY)
LATE_POWER = Table("late_power", _COLUMNS, _KEY)

_PARTIAL = f"{_COLUMNS}, window_end timestamp, last_ts bigint"


def _partials(root: str) -> str:
    return f"{root.rstrip('/')}/window_partials"


def start_parting(power: DataFrame, root: str, checkpoint: str, width: int, delay: int, trigger: str | None = TRIGGER) -> StreamingQuery:
    """Part the sums of mains power (house_id, date, ts, zip, power) of each micro-batch into partial and late ones.

    Windows are ``width`` seconds. One is closed when a reading of an earlier batch is ``delay`` seconds past its
    end. A batch that runs again finds the same mark and so parts its rows the same way; what it has published
    already stays.
    """
    spark = power.sparkSession
    run = run_of(spark, checkpoint)
    marks = f"{checkpoint.rstrip('/')}.marks"

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        session, folders = batch.sparkSession, Folders(batch.sparkSession)
        if folders.exists(f"{marks}/{batch_id}"):
            return
        before = folders.read_text(f"{marks}/{batch_id - 1}") if folders.exists(f"{marks}/{batch_id - 1}") else ""
        closed = F.unix_seconds("window.end") <= F.lit(int(before) - delay) if before else F.lit(False)
        timed = batch.withColumn("event_time", F.timestamp_seconds("ts"))
        sums = timed.groupBy(F.window("event_time", f"{width} seconds"), "house_id", "date", "zip").agg(F.sum("power").alias("watts_sum"), F.max("ts").alias("last_ts"))
        parted = sums.select(
            F.col("window.start").alias("window_start"), "house_id", "date", "zip", "watts_sum", F.col("window.end").alias("window_end"), "last_ts", closed.alias("late")
        )
        staged, target = f"{_partials(root)}/staged/{run}-{batch_id}", f"{_partials(root)}/ready/{run}-{batch_id:012d}"
        parted.hint("rebalance", "late").write.mode("overwrite").partitionBy("late").parquet(staged)
        found = session.read.schema(f"{_PARTIAL}, late boolean").parquet(staged)
        append_and_pack(found.where("late"), root, LATE_POWER, batch_id, run)
        top = found.agg(F.max("last_ts")).first()[0]
        if folders.exists(f"{staged}/late=false") and not folders.exists(target):
            folders.move(f"{staged}/late=false", target)
        known = [x for x in (top, int(before) if before else None) if x is not None]
        folders.create_text(f"{marks}/{batch_id}", str(max(known)) if known else "")
        folders.remove(staged)
        folders.remove(f"{marks}/{batch_id - 2}")

    return each_batch(power, checkpoint, trigger, hand_on)


def start_windows(spark: SparkSession, root: str, checkpoint: str, width: int, delay: int, trigger: str | None = TRIGGER) -> StreamingQuery:
    """Keep the sums of open windows as state and append those that a batch has changed.

    A window is at most ``width`` ahead of the latest reading, so with a watermark of ``delay + width`` behind the
    latest window's end no partial sum is ever late. State has the windows of that span only.
    """
    ready = f"{_partials(root)}/ready"
    Folders(spark).make(ready)
    run = run_of(spark, checkpoint)
    partial = spark.readStream.schema(_PARTIAL).parquet(f"{ready}/*")
    summed = (
        partial.withWatermark("window_end", f"{delay + width} seconds")
        .groupBy("window_end", "window_start", "house_id", "date", "zip")
        .agg(F.sum("watts_sum").alias("watts_sum"))
    )

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        append_and_pack(batch, root, WINDOW_POWER, batch_id, run)

    writer = summed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.foreachBatch(hand_on).start()


def read_windows(spark: SparkSession, root: str) -> DataFrame:
    """window_start, house_id, date, zip, watts_sum of readings in time, late_watts_sum of the others; null where none."""
    late = read_log(spark, root, LATE_POWER).groupBy(*_KEY).agg(F.sum("watts_sum").alias("late_watts_sum"))
    return read_latest(spark, root, WINDOW_POWER).join(late, list(_KEY), "full").select(*_KEY, "watts_sum", "late_watts_sum")
