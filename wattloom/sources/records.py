"""Compact JSON records: files, hourly topic folders, streams, and publishing."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.parsing import parse_seconds
from wattloom.schema import COMPACT_WITH_CORRUPT, CORRUPT_COLUMN
from wattloom.sources.folders import Folders
from wattloom.sources.tables import stage

HOUR_COLUMNS = ["year", "month", "day", "hour"]
# Fixed value: the folder that Spark gives rows without a partition value.
NO_HOUR = "__HIVE_DEFAULT_PARTITION__"


def read_records(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON lines with the fixed schema; a bad line keeps its text in ``_corrupt_record``."""
    return spark.read.schema(COMPACT_WITH_CORRUPT).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(list(paths))


def _as_type(variant_schema: str) -> str:
    """The type of a variant's schema, in DDL; a member that is always null is text."""
    return re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", variant_schema))


def infer_records(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON lines with an inferred schema, read once.

    Lines become variants, which are written to the working folder; their schemas are merged over all lines, and the
    variants, not the texts, are taken apart by it. Members that differ in kind stay variants. Lines that are no
    JSON objects keep their text in ``_corrupt_record``, a column that is there if there are any.
    """
    lines = spark.read.text(list(paths)).where(F.length(F.trim("value")) > 0)
    parsed = F.try_parse_json("value")
    kind = F.schema_of_variant(parsed)
    is_object = F.coalesce(kind.startswith("OBJECT<"), F.lit(False))
    read = lines.select(F.when(is_object, parsed).alias("record"), F.when(~is_object, F.col("value")).alias(CORRUPT_COLUMN))
    records = stage(read, "variant-records")
    found = records.agg(F.schema_of_variant_agg("record").alias("schema"), F.count(CORRUPT_COLUMN).alias("n_corrupt")).first()
    rest = [CORRUPT_COLUMN] if found["n_corrupt"] else []
    if not found["schema"].startswith("OBJECT<"):
        return records.select(*rest)
    return records.select(F.variant_get("record", "$", _as_type(found["schema"])).alias("r"), *rest).select("r.*", *rest)


def topic_glob(
    root: str, topic: str, year: int, month: int | None = None, day: int | None = None, hour: int | None = None
) -> str:
    """Path pattern of a topic's plain ``hourly/YYYY/MM/DD/HH`` folders."""
    parts = [f"{year:04d}"] + ["*" if part is None else f"{part:02d}" for part in (month, day, hour)]
    return "/".join([root.rstrip("/"), topic, "hourly", *parts])


def read_topic(
    spark: SparkSession,
    root: str,
    topic: str,
    year: int,
    month: int | None = None,
    day: int | None = None,
    hour: int | None = None,
) -> DataFrame:
    """Records of a plain hourly layout; only the folders that match are listed."""
    records = read_records(spark, topic_glob(root, topic, year, month, day, hour))
    return records.withColumn("source_file", F.col("_metadata.file_path"))


def write_topic(records: DataFrame, root: str, topic: str) -> None:
    """JSON lines in a topic's plain ``hourly/YYYY/MM/DD/HH`` folders, as ``read_topic`` reads them.

    Hours are written beside and renamed one by one, a folder each. An hour that is there already, and
    records whose time can't be read, fail the job before anything is moved.
    """
    spark = records.sparkSession
    # Beside the topic: a rename does not leave a store.
    base = f"{root.rstrip('/')}/{topic}/hourly"
    folders, staged = Folders(spark), f"{root.rstrip('/')}/{topic}/_staged-{uuid.uuid4().hex}"
    write_hourly(records, staged)
    hours = _hour_folders(spark, staged, "0000", "9999-99-99-99")
    plain = {place: f"{base}/{'/'.join(part.split('=')[1] for part in place.split('/')[-4:])}" for place in hours}
    if folders.exists("/".join([staged, *(f"{c}={NO_HOUR}" for c in HOUR_COLUMNS)])):
        raise ValueError("records without a readable time")
    taken = [target for target in plain.values() if folders.exists(target)]
    if taken:
        raise FileExistsError(taken[0])
    for place, target in plain.items():
        folders.move(place, target)
    folders.remove(staged)


def with_hour(records: DataFrame) -> DataFrame:
    """Add the year, month, day and hour (text, session zone) of the record's timestamp."""
    at = F.timestamp_seconds(parse_seconds(F.col("timestamp")))
    formats = dict(zip(HOUR_COLUMNS, ("yyyy", "MM", "dd", "HH")))
    return records.withColumns({name: F.date_format(at, pattern) for name, pattern in formats.items()})


def write_hourly(records: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines below ``year=/month=/day=/hour=``.

    The rebalance puts the rows of an hour together, splits an hour that is too big for one file
    and merges small ones, so that the number of files follows the data and not the tasks.
    """
    columns = ["timestamp", "houseId", "zip", "readings", *([CORRUPT_COLUMN] if CORRUPT_COLUMN in records.columns else [])]
    partitioned = with_hour(records).select(*columns, *HOUR_COLUMNS).hint("rebalance", *HOUR_COLUMNS)
    partitioned.write.mode(mode).partitionBy(*HOUR_COLUMNS).json(path)


def _hour_folders(spark: SparkSession, path: str, first_hour: str, last_hour: str) -> list[str]:
    """The hour folders of a range, found level by level: only years, months and days of the range are listed."""
    folders, found = Folders(spark), [(path.rstrip("/"), "")]
    for column in HOUR_COLUMNS:
        deeper = []
        for place, so_far in found:
            for name in folders.names(place):
                at = f"{so_far}-{name.split('=')[1]}".lstrip("-") if name.startswith(f"{column}=") else ""
                if at and first_hour[: len(at)] <= at <= last_hour[: len(at)]:
                    deeper.append((f"{place}/{name}", at))
        found = deeper
    return [place for place, _ in found]


def read_hourly(spark: SparkSession, path: str, first_hour: str, last_hour: str, undated: bool = False) -> DataFrame:
    """Records from 'yyyy-MM-dd-HH' to 'yyyy-MM-dd-HH', both included; other folders are not listed.

    ``undated`` adds the records whose time could not be read; their text is in ``_corrupt_record``.
    """
    schema = f"{COMPACT_WITH_CORRUPT}, " + ", ".join(f"{c} string" for c in HOUR_COLUMNS)
    places = _hour_folders(spark, path, first_hour, last_hour)
    nowhere = "/".join([path.rstrip("/"), *(f"{c}={NO_HOUR}" for c in HOUR_COLUMNS)])
    if undated and Folders(spark).exists(nowhere):
        places.append(nowhere)
    if not places:
        return spark.createDataFrame([], f"{schema}, source_file string")
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("basePath", path)
    return reader.json(places).withColumn("source_file", F.col("_metadata.file_path"))


def stream_values(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """A stream with a ``value`` text column: Kafka where deployed, a folder of JSON lines elsewhere.

    For Kafka pass ``subscribe`` and ``kafka.bootstrap.servers`` as options; for ``text`` a path.
    """
    reader = spark.readStream.format(fmt).options(**options)
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))


def publish(messages: DataFrame, fmt: str = "kafka", path: str | None = None, **options: str) -> None:
    """Write (topic, key, value) rows with a Kafka writer, or below ``topic=`` folders of ``path``."""
    if path:
        messages.select("topic", "value").write.mode("append").partitionBy("topic").format(fmt).options(**options).save(path)
    else:
        messages.write.format(fmt).options(**options).save()
