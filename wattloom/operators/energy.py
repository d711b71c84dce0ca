"""Daily energy: per meter, per label, per zip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.units import joules_to_kwh
from wattloom.operators.readings import MAINS, only_layer, with_layer

METER_DAY = ["house_id", "meter_id", "zip", "date"]
LABEL_DAY = ["house_id", "label", "zip", "date"]

# Fixed value: label of a meter-day that has too few readings to hold any energy.
NO_LABEL = "NONE"

# Fixed value: seconds of the longest day, so what the collapse leaves of a meter-day and label at most.
DAY_ROWS = 90_000


def collapse_ties(readings: DataFrame) -> DataFrame:
    """One row per meter-day, second and label, with the largest power and the number of readings.

    Among readings of one second only the last in (label, power) order can carry energy, so this
    loses nothing the energy needs. The combine runs before the shuffle and its key holds the
    second: copies shrink where they are read, and a busy house or meter spreads over all tasks.
    """
    return readings.groupBy(*METER_DAY, "ts", "label").agg(
        F.max("power").alias("power"), F.count(F.lit(1)).alias("n_readings")
    )


def meter_day_segments(readings: DataFrame, collapse: bool = True) -> DataFrame:
    """What a run of readings says of each (house, meter, zip, date): its two ends, the joules between, the count.

    Readings are taken in (ts, label, power) order and each holds until the next one of the same
    day; the last adds nothing. Segments of one meter-day that follow each other in time add up to the
    segment of all their readings, see :func:`merge_segments`. ``n_rows`` counts what the collapse left of the readings.

    After the collapse a window partition has at most one row per second of the day and label
    (90,000 on the longest day), whatever the input holds. ``collapse=False`` gives the same result
    and saves a shuffle; it is for readings whose meter-days are known to be of moderate size.
    """
    rows = collapse_ties(readings) if collapse else readings.withColumn("n_readings", F.lit(1).cast("bigint"))
    in_order = Window.partitionBy(*METER_DAY).orderBy("ts", "label", "power")
    following = F.lead("ts").over(in_order)
    # The first label is the same on every row of a meter-day, so it can be grouped by; that keeps
    # the aggregate a hash aggregate over numbers, on the distribution the window already has.
    return (
        rows.select(*METER_DAY, "ts", "label", "power", "n_readings")
        .withColumn("next_ts", following)
        .withColumn("first_label", F.first("label").over(in_order))
        .groupBy(*METER_DAY, "first_label")
        .agg(
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.max(F.when(F.col("next_ts").isNull(), F.col("power"))).alias("last_power"),
            F.coalesce(F.sum((F.col("next_ts") - F.col("ts")) * F.col("power")), F.lit(0.0)).alias("joules"),
            F.sum("n_readings").alias("n_readings"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def collapse_pays() -> Column:
    """Of a segment: whether its readings, read again, should be collapsed before they are put in order.

    That saves a shuffle of all of them where it leaves half or less, and it keeps a meter-day of any number of readings
    to ``DAY_ROWS``. Else it only adds a shuffle. Segments that don't say what it left are collapsed.
    """
    few = (F.col("n_readings") <= DAY_ROWS) & (F.col("n_readings") < 2 * F.col("n_rows"))
    return ~F.coalesce(few, F.lit(False))


def segment_energy(segments: DataFrame) -> DataFrame:
    """Energy of whole meter-days, one segment each; a day with one reading gives label 'NONE' and 0 J."""
    single = F.col("n_readings") <= 1
    return segments.select(
        *METER_DAY,
        F.when(single, F.lit(NO_LABEL)).otherwise(F.col("first_label")).alias("label"),
        F.when(single, F.lit(0.0)).otherwise(F.col("joules")).alias("joules"),
        "n_readings",
    )


def meter_day_energy(readings: DataFrame, collapse: bool = True) -> DataFrame:
    """Left Riemann sum of power over time for each (house, meter, zip, date), in joules.

    The label is that of the first reading. A day with one reading gives label 'NONE' and 0 J.
    """
    return segment_energy(meter_day_segments(readings, collapse))


def merge_segments(segments: DataFrame) -> DataFrame:
    """One segment for each meter-day, from segments of any number of runs; ``interleaved`` where that can't be told.

    Between two segments the last power of the first holds until the second begins. Where one begins before, or
    in the second in which, an earlier one ends, ends aren't enough and the readings are needed.
    """
    in_order = Window.partitionBy(*METER_DAY).orderBy("first_ts", "last_ts")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    bridge = (F.col("first_ts") - F.lag("last_ts").over(in_order)) * F.lag("last_power").over(in_order)
    latest = F.row_number().over(Window.partitionBy(*METER_DAY).orderBy(F.desc("first_ts"), F.desc("last_ts"))) == 1
    return (
        segments.withColumn("bridge", bridge)
        .withColumn("clash", F.col("first_ts") <= F.max("last_ts").over(before))
        .withColumn("label", F.first("first_label").over(in_order))
        .withColumn("latest", latest)
        .groupBy(*METER_DAY, F.col("label").alias("first_label"))
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.max(F.when(F.col("latest"), F.col("last_power"))).alias("last_power"),
            F.sum(F.col("joules") + F.coalesce("bridge", F.lit(0.0))).alias("joules"),
            F.sum("n_readings").alias("n_readings"),
            F.sum("n_rows").alias("n_rows"),
            F.coalesce(F.max("clash"), F.lit(False)).alias("interleaved"),
        )
    )


def label_day_energy(meter_days: DataFrame) -> DataFrame:
    """kWh per (layer, house, label, zip, date), summed over the meters of a label."""
    return (
        with_layer(meter_days)
        .groupBy("layer", *LABEL_DAY)
        .agg(F.sum("joules").alias("joules"))
        .select("layer", *LABEL_DAY, joules_to_kwh(F.col("joules")).alias("kwh"))
    )


def daily_energy(readings: DataFrame, layer: str, collapse: bool = True) -> DataFrame:
    """kWh per house, date, zip and label of one layer."""
    days = meter_day_energy(only_layer(readings, layer), collapse)
    return label_day_energy(days).select("house_id", "date", "zip", "label", "kwh")


def geo_energy(label_days: DataFrame) -> DataFrame:
    """Mains kWh per date and zip, summed over houses."""
    mains = label_days.where(F.col("layer") == MAINS) if "layer" in label_days.columns else label_days
    return mains.groupBy("date", "zip").agg(F.sum("kwh").alias("kwh"))
