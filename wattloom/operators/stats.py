"""High percentile of active power per meter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.units import EPSILON

# Fixed value: the percentile kept for each meter.
PERCENTILE = 0.97


def meter_p97(readings: DataFrame, percentile: float = PERCENTILE, accuracy: int = 10_000) -> DataFrame:
    """p97 of power above 1e-5 W for each house and meter, over all days and zips.

    Each task sends one sketch per meter, of a size set by ``accuracy``, so a meter with most of
    the rows costs the reducer no more than any other.
    """
    return (
        readings.where(F.col("power") > F.lit(EPSILON))
        .groupBy("house_id", "meter_id")
        .agg(F.percentile_approx("power", percentile, accuracy).alias("p97"))
    )


# Size of a stored sketch: it is exact up to about so many readings of a meter-day and then has ranks to 0.1 %.
SKETCH_K = 2_000


def power_sketches(readings: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """A mergeable quantile sketch (KLL) of the active power of each house, meter and date."""
    active = readings.where(F.col("power") > F.lit(EPSILON))
    return active.groupBy("house_id", "meter_id", "date").agg(F.call_function("kll_sketch_agg_double", F.col("power"), F.lit(k)).alias("sketch"))


def sketched_p97(sketches: DataFrame, percentile: float = PERCENTILE, k: int = SKETCH_K) -> DataFrame:
    """p97 for each house and meter from the sketches of all its days, however many runs they came by."""
    merged = sketches.groupBy("house_id", "meter_id").agg(F.call_function("kll_merge_agg_double", F.col("sketch"), F.lit(k)).alias("sketch"))
    return merged.select("house_id", "meter_id", F.call_function("kll_sketch_get_quantile_double", F.col("sketch"), F.lit(percentile)).alias("p97"))
