"""Data quality of channels: counts, gaps, day summaries, clean days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.days import DAY, bucket_floor, day_index

CHANNEL = ("house_id", "meter_id")

# Fixed value: seconds without a reading that spoil a day.
MAX_GAP = 1000


# Seconds of a day that day_quality combines into one row.
QUALITY_SLICE = 3_600


def channel_counts(readings: DataFrame, keys: Sequence[str] = CHANNEL) -> DataFrame:
    """Number of readings per channel."""
    return readings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_readings"))


def _as_column(anchor: Column | int) -> Column:
    return F.lit(anchor).cast("bigint") if isinstance(anchor, int) else anchor.cast("bigint")


def _slices(readings: DataFrame, keys: Sequence[str], anchor: Column | int, width: int) -> DataFrame:
    """First and last second and count per day and ``width``-second slice, from ``anchor`` on.

    This is what the shuffle carries: a day has at most 86400 / width + 1 slices, and any number
    of readings in a slice is one row after the map-side combine.
    """
    start = _as_column(anchor)
    return (
        readings.where(F.col("ts") >= start)
        .withColumn("day_start", bucket_floor(F.col("ts"), DAY, start))
        .withColumn("slice", F.floor((F.col("ts") - F.col("day_start")) / F.lit(width)))
        .groupBy(*keys, "day_start", "slice")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_readings"))
    )


def _with_gap(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    in_day = Window.partitionBy(*keys, "day_start").orderBy("slice")
    return slices.withColumn("prev_ts", F.lag("last_ts").over(in_day)).withColumn(
        "gap", F.col("first_ts") - F.col("prev_ts")
    )


def gap_detect(
    readings: DataFrame, keys: Sequence[str] = CHANNEL, anchor: Column | int = 0, max_gap: int = MAX_GAP
) -> DataFrame:
    """Every pair of neighbouring readings of a day more than ``max_gap`` seconds apart.

    Two readings of one ``max_gap``-second slice cannot be that far apart, so the ends of the
    slices are enough to find every gap exactly.
    """
    gaps = _with_gap(_slices(readings, keys, anchor, max_gap), keys)
    return gaps.where(F.col("gap") > F.lit(max_gap)).select(
        *keys, "day_start", "prev_ts", F.col("first_ts").alias("ts"), "gap"
    )


def day_quality(readings: DataFrame, keys: Sequence[str] = CHANNEL, anchor: Column | int = 0) -> DataFrame:
    """First and last second, exact longest gap and number of readings of each channel and day.

    The longest gap lies inside an hour or between two hours. An hour is combined to its distinct
    seconds, 3,600 at most, before the only shuffle of readings; a busy day is spread over its hours.
    """
    start = _as_column(anchor)
    slices = (
        readings.where(F.col("ts") >= start)
        .withColumn("day_start", bucket_floor(F.col("ts"), DAY, start))
        .withColumn("slice", F.floor((F.col("ts") - F.col("day_start")) / F.lit(QUALITY_SLICE)))
        .groupBy(*keys, "day_start", "slice")
        .agg(F.sort_array(F.collect_set("ts")).alias("seconds"), F.count(F.lit(1)).alias("n"))
    )
    later = F.slice("seconds", F.lit(2), F.size("seconds"))
    steps = F.zip_with(later, "seconds", lambda b, a: b - a)  # the last second has no later one: null
    ends = slices.select(
        *keys,
        "day_start",
        "slice",
        "n",
        F.get("seconds", F.lit(0)).alias("first_ts"),
        F.element_at("seconds", -1).alias("last_ts"),
        F.array_max(steps).alias("inner_gap"),
    )
    return (
        _with_gap(ends, keys)
        .groupBy(*keys, "day_start")
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.coalesce(F.greatest(F.max("gap"), F.max("inner_gap")), F.lit(0).cast("bigint")).alias("max_gap"),
            F.sum("n").alias("n_readings"),
        )
    )


def clean_days(
    readings: DataFrame,
    keys: Sequence[str] = CHANNEL,
    anchor: Column | int = 0,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """Days, counted from ``anchor``, without a hole: (keys, day_start).

    A day is clean if a later day has readings, its last reading is less than ``max_gap`` s before
    its end, no gap inside it is longer, and its first reading is at most ``max_gap`` s after its
    start. The first observed day is not held to the last condition.
    """
    days = (
        _with_gap(_slices(readings, keys, anchor, max_gap), keys)
        .groupBy(*keys, "day_start")
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap"),
        )
    )
    # One row per calendar day of a channel, so these partitions stay short.
    channel = Window.partitionBy(*keys)
    limit = F.lit(max_gap)
    closed = F.col("day_start") < F.max("day_start").over(channel)
    opening = F.col("day_start") == F.min("day_start").over(channel)
    starts_well = (F.col("first_ts") - F.col("day_start") <= limit) | F.col("is_first")
    ends_well = F.col("day_start") + F.lit(DAY) - F.col("last_ts") < limit
    return (
        days.withColumn("is_closed", closed)
        .withColumn("is_first", opening)
        .where(F.col("is_closed") & ends_well & (F.col("max_gap") <= limit) & starts_well)
        .select(*keys, "day_start")
    )


def common_days(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("house_id",)) -> DataFrame:
    """Days that are clean in both lists, in order."""
    columns = [*keys, "day_start"]
    return left.select(*columns).intersect(right.select(*columns)).orderBy(*columns)


def days_of_all(days: DataFrame, channels: DataFrame, keys: Sequence[str] = ("house_id",), anchor: Column | int = 0) -> DataFrame:
    """Days that are listed for every channel of a house: (keys, day_start), for any number of channels.

    ``days`` has (keys, meter_id, day_start), counted from ``anchor``; ``channels`` names the channels
    (keys, meter_id) that have to agree, those without any listed day too. The days of a channel become a bitmap, 4 KB for
    89 years, and the bitmaps of a house are combined by AND where they are, before a shuffle.
    """
    number = F.floor((F.col("day_start") - _as_column(anchor)) / F.lit(DAY)).cast("bigint") + F.lit(1)
    channel = [*keys, "meter_id"]
    numbered = days.select(*channel, number.alias("number")).withColumn("bucket", F.bitmap_bucket_number("number"))
    maps = numbered.groupBy(*channel, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("days"))
    common = maps.groupBy(*keys, "bucket").agg(F.bitmap_and_agg("days").alias("days"), F.count(F.lit(1)).alias("n"))
    wanted = channels.select(*channel).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_channels"))
    whole = common.join(wanted, list(keys)).where("n = n_channels")
    # Bytes of the bitmap, then the bits that are set in them.
    per_byte = whole.select(*keys, "bucket", F.posexplode(F.split(F.hex("days"), "(?<=\\G..)")).alias("at", "hex")).where("hex <> '00' AND hex <> ''")
    bits = per_byte.select(*keys, "bucket", "at", F.conv("hex", 16, 10).cast("int").alias("byte"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    found = bits.where("getbit(byte, bit) = 1")
    index = (F.col("bucket") - F.lit(1)) * F.lit(32_768) + F.col("at") * F.lit(8) + F.col("bit")
    return found.select(*keys, (_as_column(anchor) + index * F.lit(DAY)).alias("day_start"))


def readings_of_days(readings: DataFrame, days: DataFrame, keys: Sequence[str] = ("house_id",)) -> DataFrame:
    """Readings inside a listed day [day_start, day_start + 86400), with that day's columns.

    A listed day meets one or two UTC days; it is listed under each and joined by equality. AQE
    broadcasts the list if it proves small, and splits a busy house-day if it does not.
    """
    first = day_index(F.col("day_start"))
    last = day_index(F.col("day_start") + F.lit(DAY - 1))
    listed = days.withColumn("utc_day", F.explode(F.array_distinct(F.array(first, last))))
    inside = (F.col("ts") >= F.col("day_start")) & (F.col("ts") < F.col("day_start") + F.lit(DAY))
    return (
        readings.withColumn("utc_day", day_index(F.col("ts")))
        .join(listed, [*keys, "utc_day"])
        .where(inside)
        .drop("utc_day")
    )
