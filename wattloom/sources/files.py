"""Space-separated text files of the data preparation chain, and the zip table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.parsing import parse_power, parse_seconds
from wattloom.functions.units import two_decimals
from wattloom.schema import ZIPS, ZIPS_INDEXED

# Where the files of a house and a channel are kept, by hand or by our writers.
CHANNEL_PATH = r"house_(?:id=)?(\d+)/(?:channel_(\d+)\.dat|meter_id=(\d+)/)"
HOUSE_PATH = r"house_(?:id=)?(\d+)/"


def _fields(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    reader = spark.read.schema("value string").option("recursiveFileLookup", True)
    lines = reader.text(list(paths)).where(F.length(F.trim("value")) > 0)
    return lines.select(F.split(F.trim("value"), r"\s+").alias("f"), F.col("_metadata.file_path").alias("file"), "value")


def read_channels(spark: SparkSession, *paths: str) -> DataFrame:
    """``house_<h>/channel_<c>.dat`` files: (house_id, meter_id, ts, power); bad lines are null."""
    return _fields(spark, paths).select(
        F.regexp_extract("file", CHANNEL_PATH, 1).try_cast("bigint").alias("house_id"),
        F.concat(*[F.regexp_extract("file", CHANNEL_PATH, group) for group in (2, 3)]).alias("meter_id"),
        parse_seconds(F.get("f", F.lit(0))).alias("ts"),
        parse_power(F.get("f", F.lit(1))).alias("power"),
    )


def rejected_channels(spark: SparkSession, *paths: str) -> DataFrame:
    """file, reason, original (file and line as JSON): the lines of ``read_channels`` that lack a value."""
    read = _fields(spark, paths).select(
        "file",
        F.regexp_extract("file", CHANNEL_PATH, 0).alias("place"),
        parse_seconds(F.get("f", F.lit(0))).alias("ts"),
        parse_power(F.get("f", F.lit(1))).alias("power"),
        F.to_json(F.struct("file", F.col("value").alias("line"))).alias("original"),
    )
    reason = F.when(F.col("place") == "", "path").when(F.col("ts").isNull(), "timestamp").when(F.col("power").isNull(), "power")
    return read.select("file", reason.alias("reason"), "original").where("reason IS NOT NULL")


def read_labels(spark: SparkSession, *paths: str) -> DataFrame:
    """``house_<h>/labels.dat`` files: (source_house, meter_id, label)."""
    return _fields(spark, paths).select(
        F.regexp_extract("file", HOUSE_PATH, 1).try_cast("int").alias("source_house"),
        F.get("f", F.lit(0)).alias("meter_id"),
        F.get("f", F.lit(1)).alias("label"),
    )


def read_houses(spark: SparkSession, *paths: str) -> DataFrame:
    """House dimension: house, source house, zip, scale."""
    return _fields(spark, paths).select(
        F.get("f", F.lit(0)).try_cast("bigint").alias("house_id"),
        F.get("f", F.lit(1)).try_cast("int").alias("source_house"),
        F.get("f", F.lit(2)).alias("zip"),
        F.get("f", F.lit(3)).try_cast("double").alias("scale"),
    )


def read_clean_days(spark: SparkSession, *paths: str) -> DataFrame:
    """``house_<h>/common.dat`` files: (house_id, day_start)."""
    return _fields(spark, paths).select(
        F.regexp_extract("file", HOUSE_PATH, 1).try_cast("bigint").alias("house_id"),
        parse_seconds(F.get("f", F.lit(0))).alias("day_start"),
    )


def read_zips(spark: SparkSession, *paths: str, indexed: bool = True) -> DataFrame:
    """Zip table, CSV with a header; ``indexed`` says whether an unnamed index column leads."""
    schema = ZIPS_INDEXED if indexed else ZIPS
    # The index column has no name in the header, so names come from the schema, by position.
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(list(paths))


def _write_lines(df: DataFrame, path: str, partitions: list[str], columns: list) -> None:
    text = df.select(*partitions, F.concat_ws(" ", *columns).alias("value"))
    text.write.mode("overwrite").partitionBy(*partitions).text(path)


def write_channels(readings: DataFrame, path: str) -> None:
    """``ts power`` lines, two decimals, below house_id= and meter_id= folders, in time order.

    A busy channel is split into several files by time. Like the other per-house text files these
    are for the few source houses; the data of many houses goes to Parquet.
    """
    ordered = readings.repartitionByRange("house_id", "meter_id", "ts").sortWithinPartitions("house_id", "meter_id", "ts")
    columns = [F.col("ts").cast("string"), two_decimals(F.col("power"))]
    _write_lines(ordered, path, ["house_id", "meter_id"], columns)


def write_clean_days(days: DataFrame, path: str) -> None:
    """One day start per line, below house_id= folders."""
    ordered = days.repartitionByRange("house_id", "day_start").sortWithinPartitions("house_id", "day_start")
    _write_lines(ordered, path, ["house_id"], [F.col("day_start").cast("string")])


def write_labels(labels: DataFrame, path: str) -> None:
    """``meter label`` lines of (house_id, meter_id, label) below house_id= folders."""
    _write_lines(labels.repartition("house_id").sortWithinPartitions("house_id", "meter_id"), path, ["house_id"], ["meter_id", "label"])


def write_houses(houses: DataFrame, path: str) -> None:
    """``house source zip scale`` lines."""
    columns = [F.col(c).cast("string") for c in ("house_id", "source_house", "zip", "scale")]
    houses.select(F.concat_ws(" ", *columns).alias("value")).write.mode("overwrite").text(path)


def write_zips(zips: DataFrame, path: str) -> None:
    """Zip table as CSV with a header, the index column first if it is there."""
    zips.write.mode("overwrite").option("header", True).csv(path)
