"""Label, house and zip dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.functions.draws import digest, unit_draw

# Source houses to draw from, and the spread of a house's scale around 1.
SOURCE_HOUSES = 5
SCALE_SPREAD = 0.2


# Hex digits of the digest that name an index bucket: 16 ** 3 = 4,096 buckets.
INDEX_DIGITS = 3


def lookup_labels(readings: DataFrame, labels: DataFrame, on: Sequence[str] = ("meter_id",)) -> DataFrame:
    """Attach ``label``; a meter the dimension does not know keeps a null label."""
    return readings.drop("label").join(labels.select(*on, "label"), list(on), "left")


def missing_labels(labelled: DataFrame, on: Sequence[str] = ("meter_id",)) -> DataFrame:
    """Number of readings per meter that found no label."""
    return labelled.where(F.col("label").isNull()).groupBy(*on).agg(F.count(F.lit(1)).alias("n_readings"))


def house_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    """House ids ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).select(F.col("id").alias("house_id"))


def balanced_index(rows: DataFrame, key: str, index: str = "idx") -> DataFrame:
    """Number the rows 0..n-1 by a unique ``key`` in digest order, without one global sort.

    Rows are numbered inside 4,096 hash buckets; the bucket sizes, at most 4,096 rows, are summed
    up on their own and added back. A hash of a unique key leaves no bucket heavier than the rest.
    """
    bucket = F.substring(digest(0, F.col(key)), 1, INDEX_DIGITS)
    bucketed = rows.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(key)
    return (
        bucketed.withColumn("_no", F.row_number().over(in_bucket) - F.lit(1))
        .join(F.broadcast(sizes), "_bucket")
        .withColumn(index, (F.col("_offset") + F.col("_no")).cast("bigint"))
        .drop("_bucket", "_no", "_offset")
    )


def assign_houses(houses: DataFrame, known: DataFrame, zips: DataFrame, seed: int = 0) -> DataFrame:
    """(house_id, source_house, zip, scale): the stored row of a known house, else drawn values.

    The draw is a function of house and seed: source house 1-5, scale 0.8-1.2, and a zip by its
    number in the zip dimension, which is unique by ``zip``.
    """
    stored = known.select(
        "house_id",
        F.col("source_house").alias("_source"),
        F.col("zip").alias("_zip"),
        F.col("scale").alias("_scale"),
        F.lit(True).alias("_known"),
    )
    house = F.col("house_id")
    n_zips = zips.select(F.count(F.lit(1))).scalar()
    drawn = houses.select("house_id").join(stored, "house_id", "left").withColumn(
        "idx", F.floor(unit_draw(seed + 2, house) * n_zips).cast("bigint")
    )
    indexed = balanced_index(zips.select(F.col("zip").alias("_new_zip")), "_new_zip")
    source = (F.floor(unit_draw(seed, house) * F.lit(SOURCE_HOUSES)) + F.lit(1)).cast("int")
    scale = (unit_draw(seed + 1, house) * 2.0 - 1.0) * F.lit(SCALE_SPREAD) + F.lit(1.0)

    def kept(stored_value: Column, new_value: Column) -> Column:
        return F.when(F.col("_known"), stored_value).otherwise(new_value)

    return drawn.join(indexed, "idx", "left").select(
        "house_id",
        kept(F.col("_source"), source).alias("source_house"),
        kept(F.col("_zip"), F.col("_new_zip")).alias("zip"),
        kept(F.col("_scale"), scale).alias("scale"),
    )


def scale_power(readings: DataFrame, houses: DataFrame) -> DataFrame:
    """Multiply power by the scale of its house (1 for an unknown house)."""
    scaled = readings.join(houses.select("house_id", "scale"), "house_id", "left")
    return scaled.withColumn("power", F.col("power") * F.coalesce("scale", F.lit(1.0))).drop("scale")


def zip_difference(full: DataFrame, used: DataFrame) -> DataFrame:
    """Zip codes of ``full`` that are not in ``used``, each once.

    ``used`` may be a column of readings: its copies are merged before they are shuffled.
    """
    return full.select("zip").subtract(used.select("zip").distinct())


def sample_zips(zips: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` zip codes without replacement, repeatable, sorted: those with the smallest digests.

    A histogram of the first digits of the digests says between which digests the n-th lies, a second one, of
    those alone, says it to one in 16 million. Everything below goes without a sort; what is left to sort by
    digest is a handful even of a billion.
    """
    if n <= 0:
        return zips.select("zip").limit(0)
    drawn = zips.select("zip", digest(seed, F.col("zip")).alias("_draw"))

    def border(rows: DataFrame, digits: int, already: Column) -> tuple[Column, Column]:
        """The digits among which the n-th digest is, and how many rows are below them; null if there are fewer rows."""
        counts = rows.groupBy(F.substring("_draw", 1, digits).alias("_head")).agg(F.count(F.lit(1)).alias("_n"))
        sofar = Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # 4,096 rows at most
        ends = counts.select("_head", "_n", (F.sum("_n").over(sofar) + already).alias("_end"))
        last = ends.where((F.col("_end") >= n) & (F.col("_end") - F.col("_n") < n))
        return last.select("_head").scalar(), last.select(F.col("_end") - F.col("_n")).scalar()

    head, below = border(drawn, INDEX_DIGITS, F.lit(0))
    fine, below = border(drawn.where(F.substring("_draw", 1, INDEX_DIGITS) == head), 2 * INDEX_DIGITS, below)
    place = F.substring("_draw", 1, 2 * INDEX_DIGITS)
    sure = drawn.where(F.coalesce(place < fine, F.lit(True)))
    at_border = drawn.where(place == fine).withColumn("_no", F.row_number().over(Window.orderBy("_draw", "zip"))).where(F.col("_no") <= F.lit(n) - below)
    return sure.select("zip").unionByName(at_border.select("zip")).orderBy("zip")


def refresh_zips(full: DataFrame, used: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """The full rows of ``n`` sampled zip codes that are not in use yet."""
    chosen = sample_zips(zip_difference(full, used), n, seed)
    return full.join(chosen, "zip")
