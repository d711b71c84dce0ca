"""The ``events`` and ``customer`` tables read as meter data.

A user is mapped to a house, an event type to a meter, a value to a power reading. Customers
stand in for the zip table and for the houses that are already known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.operators.readings import LAST_MAINS_CHANNEL
from wattloom.schema import READING_COLUMNS
from wattloom.sources.folders import Folders

# How the given tables are read as meter data.
HOUSES = 25
ZIP_GROUPS = 10
METERS = {"view": "1", "click": "2", "purchase": "3", "error": "4", "signup": "5"}

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events_as_readings(events: DataFrame) -> DataFrame:
    """Flat readings; works on a batch or a streaming frame."""
    house = F.col("user_id") % F.lit(HOUSES)
    meter = F.lit(None).cast("string")
    for event_type, channel in METERS.items():
        meter = F.when(F.col("event_type") == event_type, channel).otherwise(meter)
    at = F.col("ts").cast("timestamp")
    flat = events.select(
        house.alias("house_id"),
        F.date_format(at, "yyyy-MM-dd").alias("date"),
        F.unix_seconds(at).alias("ts"),
        F.lpad((house % F.lit(ZIP_GROUPS)).cast("string"), 5, "0").alias("zip"),
        "event_type",
        meter.alias("meter_id"),
        F.col("value").alias("power"),
    )
    is_mains = F.col("meter_id").cast("int") <= LAST_MAINS_CHANNEL
    return flat.withColumn("label", F.when(is_mains, "mains").otherwise(F.col("event_type"))).select(*READING_COLUMNS)


def read_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_readings(spark.read.parquet(f"{sf_dir}/events.parquet"))


def stream_readings(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """The same as a file stream over the events table."""
    reader, place = spark.readStream.schema(EVENT_SCHEMA).options(**options), f"{sf_dir}/events.parquet"
    if Folders(spark).is_folder(place):
        return events_as_readings(reader.parquet(place))
    return events_as_readings(reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir))


def read_zip_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zip table with one row per customer, zip codes of five digits or more."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.select(
        F.format_string("%05d", "c_custkey").alias("zip"),
        F.col("c_name").alias("primary_city"),
        F.col("c_mktsegment").alias("type"),
    )


def read_known_houses(spark: SparkSession, sf_dir: str, segment: str | None = "HOUSEHOLD") -> DataFrame:
    """House dimension with one row per customer of a segment, or of all of them."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    if segment:
        customer = customer.where(F.col("c_mktsegment") == segment)
    return customer.select(
        F.col("c_custkey").alias("house_id"),
        (F.col("c_nationkey") % 5 + 1).cast("int").alias("source_house"),
        F.format_string("%05d", "c_custkey").alias("zip"),
        (F.lit(1.0) + F.col("c_nationkey") / F.lit(100.0)).alias("scale"),
    )


def read_source_houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """House dimension of a replay: a house for each supplier, in the zip of its nation."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return supplier.select(
        F.col("s_suppkey").alias("house_id"),
        (F.col("s_nationkey") % 5 + 1).cast("int").alias("source_house"),
        F.format_string("%05d", "s_nationkey").alias("zip"),
        F.lit(1.0).alias("scale"),
    )
