"""What the batch job has taken in: a folder for each run, and small manifests that make runs visible.

A run's folder has its rows (readings and rejects, written by one pass over the records), the segments and sketches of
its meter-days, and the input files it has consumed. One manifest names the runs that count and the
dates whose serving tables still have to be refreshed. So files are consumed, and what came of them counts, by the same
commit; a job that dies before it leaves an unnamed folder, one that dies after it leaves dates to refresh.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.schema import struct_of
from wattloom.sources import tables
from wattloom.sources.folders import Folders
from wattloom.sources.tables import ConcurrentCommit

# Runs that are packed into a larger one.
FAN_IN = 16
KEPT_MANIFESTS = 3

_METER_DAY = "house_id bigint, meter_id string, zip string, date string"

# What a run has, with its columns and the column its folders are named by.
READINGS, REJECTS, SEGMENTS, SKETCHES, FILES = "outcome=accepted", "outcome=rejected", "segments", "sketches", "files"
KINDS = {
    READINGS: ("house_id bigint, date string, ts bigint, zip string, label string, meter_id string, power double", None),
    REJECTS: ("reason string, original string", None),
    SEGMENTS: (
        f"{_METER_DAY}, first_label string, first_ts bigint, last_ts bigint, last_power double, joules double, n_readings bigint, n_rows bigint",
        "date",
    ),
    SKETCHES: ("house_id bigint, meter_id string, date string, sketch binary", None),
    FILES: ("path string, length bigint, modified timestamp", None),
}

# Marks that the percentiles of all meters, not only of those met on the dates, have to be made anew.
EVERY_METER = "*"


@dataclass(frozen=True)
class Run:
    """``part`` is the name of what the run covers: a run with the same part replaces it. Packed runs have none."""

    id: str
    part: str | None
    level: int = 0


@dataclass(frozen=True)
class Store:
    """The runs that count, the dates to refresh, and replaced runs with the time at which they went."""

    number: int
    runs: tuple[Run, ...]
    dirty: tuple[str, ...]
    gone: tuple[tuple[str, float], ...] = ()


_NOTHING = Store(-1, (), ())


def _base(root: str) -> str:
    return f"{root.rstrip('/')}/ingest"


def run_path(root: str, run_id: str) -> str:
    return f"{_base(root)}/runs/{run_id}"


def kind_path(root: str, run_id: str, kind: str) -> str:
    return f"{run_path(root, run_id)}/{'rows/' if kind.startswith('outcome=') else ''}{kind}"


def current(spark: SparkSession, root: str) -> Store:
    folders, place = Folders(spark), f"{_base(root)}/manifests"
    for name in sorted(folders.names(place), reverse=True):
        try:
            body = json.loads(folders.read_text(f"{place}/{name}"))
        except ValueError:  # its writer died
            continue
        return Store(int(name.split(".")[0]), tuple(Run(**r) for r in body["runs"]), tuple(body["dirty"]), tuple(map(tuple, body["gone"])))
    return _NOTHING


def commit(spark: SparkSession, root: str, before: Store, runs: tuple[Run, ...], dirty: tuple[str, ...]) -> Store:
    """Publish the next state; fails if another job has published since ``before``.

    Runs that no longer count stay for ``tables.RETAINED_SECONDS``, so that their readers can end.
    """
    folders, place = Folders(spark), f"{_base(root)}/manifests"
    if current(spark, root).number != before.number:
        raise ConcurrentCommit(f"{root} was changed by another batch job")
    now, ids = time.time(), {r.id for r in runs}
    gone = before.gone + tuple((r.id, now) for r in before.runs if r.id not in ids)
    expired = {run_id for run_id, at in gone if at <= now - tables.RETAINED_SECONDS}
    numbers = [int(n.split(".")[0]) for n in folders.names(place)]
    after = Store(max([before.number, *numbers]) + 1, runs, dirty, tuple(g for g in gone if g[0] not in expired))
    body = {"runs": [vars(r) for r in runs], "dirty": list(dirty), "gone": [list(g) for g in after.gone]}
    try:
        folders.create_text(f"{place}/{after.number:012d}.json", json.dumps(body))
    except FileExistsError as error:
        raise ConcurrentCommit(f"{root} was changed by another batch job") from error
    for run_id in expired:
        folders.remove(run_path(root, run_id))
    for number in sorted(numbers)[:-KEPT_MANIFESTS]:
        folders.remove(f"{place}/{number:012d}.json")
    return after


def dates_of(spark: SparkSession, root: str, run_id: str) -> list[str]:
    """The dates a run has readings of, by the names of its folders."""
    return [n.split("=")[1] for n in Folders(spark).names(kind_path(root, run_id, SEGMENTS)) if n.startswith("date=")]


def read(spark: SparkSession, root: str, kind: str, store: Store | None = None, dates: list[str] | None = None) -> DataFrame:
    """All rows of one kind, with the ``part`` they came by; of the given dates only, where the kind has dates.

    Runs without any of the dates aren't opened, nor are the other dates' folders of segments.
    """
    store = current(spark, root) if store is None else store
    schema, by = KINDS[kind]
    folders, paths = Folders(spark), []
    for run in store.runs:
        place = kind_path(root, run.id, kind)
        if by or dates is not None:
            found = [d for d in dates_of(spark, root, run.id) if dates is None or d in dates]
            if by:
                paths += [f"{place}/{by}={d}" for d in found]
                continue
            if not found:
                continue
        if folders.names(place):
            paths.append(place)
    if not paths:
        return spark.createDataFrame([], f"{schema}, part string")
    rows = spark.read.schema(f"{schema}, part string").parquet(*paths)
    if by:  # its value is in the name of the folder
        rows = rows.withColumn(by, F.regexp_extract(F.col("_metadata.file_path"), f"/{by}=([^/]+)/", 1))
    elif dates is not None:
        rows = rows.where(F.col("date").isin(list(dates)))
    return rows.select(*[f.name for f in struct_of(schema)], "part")


def listing(spark: SparkSession, *paths: str) -> DataFrame:
    """path, length, modified of the files below ``paths``; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def new_files(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Those of ``files`` that no run has consumed. One that was consumed and has changed since fails the job."""
    known = read(spark, root, FILES).select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    joined = files.join(known.dropDuplicates(["path"]), "path", "left")
    changed = joined.where("_length IS NOT NULL AND (length <> _length OR modified <> _modified)").select("path").limit(5).collect()
    if changed:
        raise ValueError(f"consumed files have changed: {', '.join(r['path'] for r in changed)}; give them a part of their own")
    return joined.where("_length IS NULL").select("path", "length", "modified")


def pack(spark: SparkSession, root: str, fan_in: int = FAN_IN) -> None:
    """Put ``fan_in`` runs of one size into one folder, so that many small runs leave few files.

    Runs that a part names stay by themselves, as they may be replaced.
    """
    store = current(spark, root)
    runs, level = store.runs, 0
    while level <= max((r.level for r in runs), default=0):
        members = [r for r in runs if r.level == level and r.part is None]
        if len(members) >= fan_in:
            made = Run(uuid.uuid4().hex, None, level + 1)
            only = replace(store, runs=tuple(members))
            for kind, (_, by) in KINDS.items():
                rows = read(spark, root, kind, only)
                if by:
                    rows.hint("rebalance", by).write.partitionBy(by).parquet(kind_path(root, made.id, kind))
                else:
                    rows.hint("rebalance").write.parquet(kind_path(root, made.id, kind))
            runs = tuple(r for r in runs if r not in members) + (made,)
        level += 1
    if runs != store.runs:
        commit(spark, root, store, runs, store.dirty)
