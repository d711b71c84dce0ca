"""Live mains power per house and zip, and overshoot alerts.

No stream here keeps state: each micro-batch is a batch job whose partial sums or alerts are appended
under its run and number, so a batch that runs again replaces what it wrote, and a row is counted
however late it comes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.functions.days import ts_to_date
from wattloom.operators.alerts import overshoot_alerts
from wattloom.sources.quarantine import STREAM_REJECTS
from wattloom.sources.tables import (
    FAN_IN,
    METER_STATS,
    RT_POWER,
    ConcurrentCommit,
    Table,
    append_batch,
    fold_log,
    pack_log,
    read,
    read_log,
    run_of,
)

# Fixed value: how often the live power is handed on.
TRIGGER = "1 second"


def mains_power_windows(power: DataFrame, width: str = "1 minute") -> DataFrame:
    """Sum of watts per event-time window, house, date and zip."""
    timed = power.withColumn("event_time", F.timestamp_seconds("ts"))
    return (
        timed.groupBy(F.window("event_time", width), "house_id", "date", "zip")
        .agg(F.sum("power").alias("watts_sum"))
        .select(F.col("window.start").alias("window_start"), "house_id", "date", "zip", "watts_sum")
    )


def batch_power(power: DataFrame) -> DataFrame:
    """Sum of watts per house, date and zip of whatever rows are given, one micro-batch say."""
    return power.groupBy("house_id", "date", "zip").agg(F.sum("power").alias("watts_sum"))


def each_batch(
    stream: DataFrame, checkpoint: str, trigger: str | None, hand_on: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Run ``hand_on`` for every micro-batch; ``trigger=None`` takes what is there and stops."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.foreachBatch(hand_on).start()


def append_and_pack(rows: DataFrame, root: str, table: Table, batch_id: int, run: str) -> None:
    """Append a micro-batch, and now and then pack those before it."""
    append_batch(rows, root, table, batch_id, run)
    if batch_id % FAN_IN == FAN_IN - 1:
        try:
            pack_log(rows.sparkSession, root, table, {run: batch_id - 1})
        except ConcurrentCommit:  # a stream beside this one packs; the next turn will do
            pass


def start_mains_power(
    power: DataFrame, root: str, checkpoint: str, width: str = "1 minute", trigger: str | None = TRIGGER, merge: bool = False
) -> StreamingQuery:
    """Keep the live power table up to date from a stream of mains power (house_id, date, ts, zip, power).

    A micro-batch appends its partial sums per window, a write that reads nothing; ``tables.read_sums``
    adds them up and ``tables.fold_log`` folds them away from time to time. ``merge=True`` folds every
    batch at once into the keyed table, for long triggers.
    """
    run = run_of(power.sparkSession, checkpoint)

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        append_batch(mains_power_windows(batch, width), root, RT_POWER, batch_id, run)
        if merge:
            fold_log(batch.sparkSession, root, RT_POWER, {run: batch_id})

    return each_batch(power, checkpoint, trigger, hand_on)


BATCH_POWER = Table(
    "batch_power", "house_id bigint, date string, zip string, watts_sum double", ("house_id", "date", "zip")
)


def start_batch_power(power: DataFrame, root: str, checkpoint: str, trigger: str | None = TRIGGER) -> StreamingQuery:
    """Append one row per house, date and zip for each micro-batch, no matter its event times."""
    run = run_of(power.sparkSession, checkpoint)

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        append_and_pack(batch_power(batch), root, BATCH_POWER, batch_id, run)

    return each_batch(power, checkpoint, trigger, hand_on)


ALERTS = Table(
    "alerts",
    "ts bigint, house_id bigint, meter_id string, power double, p97 double, date string",
    ("house_id", "meter_id", "ts"),
)


def stored_stats(root: str) -> Callable[[SparkSession], DataFrame]:
    return lambda spark: read(spark, root, METER_STATS)


def start_alerts(
    readings: DataFrame,
    stats: Callable[[SparkSession], DataFrame],
    root: str,
    checkpoint: str,
    margin: float = 0.0,
    salts: int = 8,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Append readings above their meter's bound to the alerts log.

    ``stats`` is asked in every micro-batch, so statistics that a batch job publishes meanwhile count from the
    next one on; see :func:`stored_stats`.
    """
    run = run_of(readings.sparkSession, checkpoint)

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        found = overshoot_alerts(batch, stats(batch.sparkSession), margin, salts).withColumn("date", ts_to_date(F.col("ts")))
        append_and_pack(found, root, ALERTS, batch_id, run)

    return each_batch(readings, checkpoint, trigger, hand_on)


def start_quarantine(
    records: DataFrame, rejected: Callable[[DataFrame], DataFrame], root: str, checkpoint: str, trigger: str | None = TRIGGER
) -> StreamingQuery:
    """Set aside what ``rejected`` finds in each micro-batch of records, with its reason and text."""
    run = run_of(records.sparkSession, checkpoint)

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        bad = rejected(batch)
        text = F.to_json(F.struct(*[c for c in bad.columns if c != "reject_reason"])).alias("original")
        append_and_pack(bad.select(F.col("reject_reason").alias("reason"), text), root, STREAM_REJECTS, batch_id, run)

    return each_batch(records, checkpoint, trigger, hand_on)


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    return read_log(spark, root, ALERTS).select("ts", "house_id", "meter_id", "power", "p97")
