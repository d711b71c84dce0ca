"""Cyclic replay of clean days into a calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.days import DAY
from wattloom.functions.draws import unit_draw
from wattloom.functions.units import two_decimals
from wattloom.operators.quality import readings_of_days

# Length of the calendar in days, and how far a channel factor strays from 1.
CALENDAR_DAYS = 30
CHANNEL_SPREAD = 0.05


def channel_factor(seed: int = 0) -> Column:
    """A repeatable factor in [0.95, 1.05) for each house and channel."""
    return (unit_draw(seed, F.col("house_id"), F.col("meter_id")) * 2.0 - 1.0) * F.lit(CHANNEL_SPREAD) + F.lit(1.0)


def replay_plan(clean: DataFrame, keys: Sequence[str] = ("house_id",), days: int = CALENDAR_DAYS) -> DataFrame:
    """Target days of each clean day: day k of the calendar takes clean day k mod n."""
    listed = clean.select(*keys, "day_start").distinct()
    house = Window.partitionBy(*keys)
    ordinal = F.row_number().over(house.orderBy("day_start")) - F.lit(1)
    slots = F.sequence(F.col("ordinal"), F.lit(days - 1), F.col("n_days"))
    return (
        listed.withColumn("ordinal", ordinal)
        .withColumn("n_days", F.count(F.lit(1)).over(house).cast("int"))
        .withColumn("origin", F.min("day_start").over(house))
        .where(F.col("ordinal") < F.lit(days))
        .select(*keys, "day_start", "origin", slots.alias("slots"))
    )


def replicate_days(
    readings: DataFrame,
    clean: DataFrame,
    keys: Sequence[str] = ("house_id",),
    days: int = CALENDAR_DAYS,
    factor: Column | None = None,
    shift: Column | int = 0,
) -> DataFrame:
    """Replay the clean days of each house over ``days`` days from its first clean day.

    Power is scaled by ``factor`` and rounded to two decimals; time moves to the target day plus
    ``shift`` seconds. Returns (keys, meter_id, day_no, ts, power). The fan-out of a reading is at
    most days / n + 1 and happens after the join, in the task that holds it.
    """
    scale = channel_factor() if factor is None else factor
    offset = F.lit(shift) if isinstance(shift, int) else shift
    moved = F.col("ts") - F.col("day_start") + F.col("origin") + F.col("day_no") * F.lit(DAY) + offset
    return (
        readings_of_days(readings, replay_plan(clean, keys, days), keys)
        # A reading is scaled once, however many days it goes to.
        .withColumn("power", two_decimals(F.col("power") * scale).cast("double"))
        .withColumn("day_no", F.explode("slots"))
        .select(
            *keys,
            "meter_id",
            F.col("day_no").cast("bigint").alias("day_no"),
            moved.cast("bigint").alias("ts"),
            "power",
        )
    )
