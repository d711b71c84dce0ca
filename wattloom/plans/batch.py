"""The daily batch job: compact records in, five serving tables and a quarantine out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.operators.energy import (
    METER_DAY,
    collapse_pays,
    geo_energy,
    label_day_energy,
    merge_segments,
    meter_day_segments,
    segment_energy,
)
from wattloom.operators.readings import APPLIANCE, MAINS, route_records
from wattloom.operators.share import appliance_share
from wattloom.operators.stats import power_sketches, sketched_p97
from wattloom.session import fresh_dir
from wattloom.sources import runs, tables
from wattloom.sources.folders import Folders
from wattloom.sources.quarantine import input_part
from wattloom.sources.records import read_records

ENERGY_COLUMNS = ["house_id", "date", "zip", "label", "kwh"]


def run_batch(records: DataFrame, root: str, part: str | None = None, files: DataFrame | None = None) -> None:
    """Take ``records`` in and bring mains_energy, appliance_energy, appliance_share, geo_energy and meter_stats up to date.

    Records are parsed once and written by outcome, readings and rejects, into the run's folder. From the readings come
    a segment and a sketch of each meter-day. Then one manifest makes the run count, and the tables of the dates
    it has are made from the segments of all runs: a day that comes in pieces, in any order, has the energy of all its
    readings, and a percentile is that of all days of its meter.

    A run replaces an earlier one with the same ``part``. By default that is named by the files and the plan of
    ``records``, so that runs on other records add to what is there. With ``files``, the run has consumed these for good
    and bears no part; see :func:`ingest`.
    """
    spark, run = records.sparkSession, uuid.uuid4().hex
    if files is None:
        part = part or input_part(records, str(records.semanticHash()))
    store = runs.current(spark, root)
    take_in(records, root, run, part, files)
    replaced = [r for r in store.runs if part is not None and r.part == part]
    touched = {d for r in [*(r.id for r in replaced), run] for d in runs.dates_of(spark, root, r)}
    dirty = sorted({*store.dirty, *touched, *([runs.EVERY_METER] if replaced else [])})
    store = runs.commit(spark, root, store, (*(r for r in store.runs if r not in replaced), runs.Run(run, part)), tuple(dirty))
    refresh(spark, root, store)


def take_in(records: DataFrame, root: str, run: str, part: str | None, files: DataFrame | None) -> None:
    """Write what a run has, without making it count."""
    spark = records.sparkSession
    named = F.lit(part or run).alias("part")
    routed = route_records(records).select("*", named)
    routed.write.partitionBy("outcome").parquet(f"{runs.run_path(root, run)}/rows")
    # A run may have no readings, and then no such folder.
    schema, _ = runs.KINDS[runs.READINGS]
    place = runs.kind_path(root, run, runs.READINGS)
    readings = spark.read.schema(schema).parquet(place) if Folders(spark).exists(place) else spark.createDataFrame([], schema)
    # A run of many dates would else leave a file for each task and date.
    segments = meter_day_segments(readings).select("*", named).hint("rebalance", "date")
    segments.write.partitionBy("date").parquet(runs.kind_path(root, run, runs.SEGMENTS))
    power_sketches(readings).select("*", named).write.parquet(runs.kind_path(root, run, runs.SKETCHES))
    if files is not None:
        files.select("*", named).write.parquet(runs.kind_path(root, run, runs.FILES))


def meter_days_of(spark: SparkSession, root: str, store: runs.Store, dates: list[str], place: str) -> DataFrame:
    """Energy of the meter-days of some dates from the segments of all runs.

    Readings are read again only for meter-days in which those of several runs interleave, from runs that have
    these dates. The segments say which of these are so few and so seldom of one second that they need no collapse.
    """
    merge_segments(runs.read(spark, root, runs.SEGMENTS, store, dates)).write.parquet(f"{place}/merged")
    merged = spark.read.parquet(f"{place}/merged")
    interleaved = merged.where("interleaved").select(*METER_DAY, collapse_pays().alias("collapse"))
    whole = merged.where("NOT interleaved").drop("interleaved")
    mixed = interleaved.select("date", "collapse").distinct().collect()  # some of ``dates``, twice at most
    for collapse in sorted({r["collapse"] for r in mixed}):
        readings = runs.read(spark, root, runs.READINGS, store, [r["date"] for r in mixed if r["collapse"] == collapse]).drop("part")
        of_these = interleaved.where(F.col("collapse") == collapse).select(*METER_DAY)
        again = readings.join(of_these, METER_DAY, "left_semi")
        if not collapse:
            # Readings come in the order of their records and so shuffle to few bytes. With a number of tasks of its own,
            # adaptive execution does not make fewer and larger tasks of these.
            again = again.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *METER_DAY)
        anew = meter_day_segments(again, collapse)
        anew.write.parquet(f"{place}/anew-{collapse}")
        whole = whole.unionByName(spark.read.parquet(f"{place}/anew-{collapse}"))
    return segment_energy(whole)


def refresh(spark: SparkSession, root: str, store: runs.Store) -> None:
    """Make the serving tables of the store's dirty dates anew, then take the dates off the list."""
    if not store.dirty:
        return
    places = [fresh_dir(spark, name) for name in ("meter-days", "label-days")]
    dates = [d for d in store.dirty if d != runs.EVERY_METER]
    covers = [f"date={d}" for d in dates]

    sketches = runs.read(spark, root, runs.SKETCHES, store)
    if runs.EVERY_METER in store.dirty:
        shards = list(tables.current(spark, tables.table_path(root, tables.METER_STATS)).partitions)
        tables.overwrite(sketched_p97(sketches), root, tables.METER_STATS, covers=shards)
    else:
        met = sketches.where(F.col("date").isin(dates)).select("house_id", "meter_id").distinct()
        tables.upsert(sketched_p97(sketches.join(met, ["house_id", "meter_id"], "left_semi")), root, tables.METER_STATS, unique=True)

    meter_days = meter_days_of(spark, root, store, dates, places[0])
    label_day_energy(meter_days).write.parquet(places[1])
    label_days = spark.read.parquet(places[1])
    mains, appliances = (label_days.where(label_days["layer"] == layer) for layer in (MAINS, APPLIANCE))
    tables.overwrite(mains.select(*ENERGY_COLUMNS), root, tables.MAINS_ENERGY, covers)
    tables.overwrite(appliances.select(*ENERGY_COLUMNS), root, tables.APPLIANCE_ENERGY, covers)
    tables.overwrite(geo_energy(label_days), root, tables.GEO_ENERGY, covers)
    tables.overwrite(appliance_share(label_days), root, tables.APPLIANCE_SHARE, covers)

    runs.commit(spark, root, store, store.runs, ())
    for place in places:
        Folders(spark).remove(place)


def ingest(spark: SparkSession, root: str, *paths: str) -> int:
    """Run the batch job on the files below ``paths`` that no run has consumed; returns how many there were.

    Files are told by path, and one that was consumed must not change. What an earlier job left unrefreshed is
    finished first. Many small runs are packed into larger ones.
    """
    refresh(spark, root, runs.current(spark, root))
    files = runs.new_files(spark, root, runs.listing(spark, *paths)).collect()  # Spark lists these on the driver too
    if files:
        listed = spark.createDataFrame(files, runs.KINDS[runs.FILES][0])
        run_batch(read_records(spark, *[f["path"] for f in files]), root, files=listed)
        runs.pack(spark, root)
    return len(files)
