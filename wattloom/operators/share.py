"""Share of each appliance in the mains total of its house and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.units import share_percent
from wattloom.operators.readings import APPLIANCE, MAINS

HOUSE_DAY = ["house_id", "zip", "date"]
SHARE_COLUMNS = ["house_id", "date", "zip", "label", "percent"]


def appliance_share(label_days: DataFrame) -> DataFrame:
    """Percent per appliance label, from label-days of both layers; needs no join.

    The window runs over label-days, one row per label of a house and day, not over readings.
    """
    house_day = Window.partitionBy(*HOUSE_DAY)
    mains_kwh = F.sum(F.when(F.col("layer") == MAINS, F.col("kwh"))).over(house_day)
    return (
        label_days.withColumn("mains_kwh", mains_kwh)
        .where(F.col("layer") == APPLIANCE)
        .withColumn("percent", share_percent(F.col("kwh"), F.col("mains_kwh")))
        .select(*SHARE_COLUMNS)
    )


def appliance_share_joined(appliance: DataFrame, mains: DataFrame, strict: bool = False) -> DataFrame:
    """The same for layers stored apart, as a left join on (house, zip, date).

    ``strict=True`` joins every mains label instead of their total, so a house-day with several
    mains labels repeats each appliance once per label.
    """
    totals = mains.select(*HOUSE_DAY, F.col("kwh").alias("mains_kwh"))
    if not strict:
        totals = totals.groupBy(*HOUSE_DAY).agg(F.sum("mains_kwh").alias("mains_kwh"))
    return (
        appliance.join(totals, HOUSE_DAY, "left")
        .withColumn("percent", share_percent(F.col("kwh"), F.col("mains_kwh")))
        .select(*SHARE_COLUMNS)
    )
