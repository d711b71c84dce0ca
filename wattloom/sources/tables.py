"""Serving tables on versioned, partitioned Parquet: keyed upsert, append of micro-batches, reads.

A table is a folder with ``data/version=<commit>/<partition>=<value>`` and small manifests that name the
version of each partition. A commit writes its partitions as a new version and then publishes one
manifest. Readers take the newest complete manifest, so a commit that dies half-way changes nothing,
and a reader goes on with the files it has resolved while later commits are published: what a commit replaces
stays for ``RETAINED_SECONDS``, and for as long as a lease names it.

Logs of micro-batches that have no sum are packed by size: so many batches make a pack, so many packs of a
level one of the next, so the number of folders grows with the logarithm of the number of batches.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.schema import struct_of
from wattloom.session import adaptive, fresh_dir
from wattloom.sources.folders import Folders

# Partitions of the meter statistics, which have no date to go by.
HOUSE_SHARDS = 64

# Manifests that are kept at least, and how long the others stay; what only older ones name is removed.
KEPT_MANIFESTS = 3
RETAINED_SECONDS = 3_600

# Batches that make a pack of a log, and packs that make a larger one.
FAN_IN = 16

# Bits of the Bloom filter that the index has for each file, and bits set for a value.
INDEX_BITS, INDEX_HASHES = 32_768, 4


@dataclass(frozen=True)
class Table:
    """A serving table: its columns, its key, the partition column and the order inside files."""

    name: str
    columns: str
    key: tuple[str, ...]
    partition: str = "date"
    order: tuple[str, ...] = ("house_id",)
    shard_of: str | None = None
    # The column by which the files of the table are indexed.
    indexed: str | None = None

    @property
    def value_columns(self) -> list[str]:
        names = [field.name for field in struct_of(self.columns)]
        return [name for name in names if name not in self.key]

    @property
    def all_columns(self) -> list[str]:
        return [field.name for field in struct_of(self.columns)]

    def with_partition(self, rows: DataFrame) -> DataFrame:
        if self.shard_of is None:
            return rows
        shard = F.pmod(F.col(self.shard_of), F.lit(HOUSE_SHARDS)).cast("int")
        return rows.withColumn(self.partition, shard)

    @property
    def schema(self) -> str:
        return self.columns if self.shard_of is None else f"{self.columns}, {self.partition} int"


_LABEL_KEY = ("house_id", "date", "zip", "label")
_ENERGY = "house_id bigint, date string, zip string, label string, kwh double"

MAINS_ENERGY = Table("mains_energy", _ENERGY, _LABEL_KEY, indexed="house_id")
APPLIANCE_ENERGY = Table("appliance_energy", _ENERGY, _LABEL_KEY)
APPLIANCE_SHARE = Table(
    "appliance_share", "house_id bigint, date string, zip string, label string, percent double", _LABEL_KEY
)
GEO_ENERGY = Table("geo_energy", "date string, zip string, kwh double", ("date", "zip"), order=("zip",))
METER_STATS = Table(
    "meter_stats",
    "house_id bigint, meter_id string, p97 double",
    ("house_id", "meter_id"),
    partition="house_shard",
    shard_of="house_id",
)
RT_POWER = Table(
    "rt_power",
    "window_start timestamp, house_id bigint, date string, zip string, watts_sum double",
    ("window_start", "house_id", "date", "zip"),
)


def table_path(root: str, table: Table) -> str:
    return f"{root.rstrip('/')}/{table.name}"


class ConcurrentCommit(RuntimeError):
    """Another writer has published in the meantime."""


@dataclass(frozen=True)
class Manifest:
    """The version of each partition folder, the micro-batches that are folded into them or packed, and the packs."""

    number: int
    partitions: dict[str, str]
    folded: dict[str, int]
    packs: dict[str, int]
    at: float = 0.0


_NOTHING = Manifest(-1, {}, {}, {})


def _manifest(folders: Folders, path: str, name: str) -> Manifest | None:
    """A manifest, or None if its writer died."""
    try:
        body = json.loads(folders.read_text(f"{path}/manifests/{name}"))
    except ValueError:
        return None
    return Manifest(int(name.split(".")[0]), body["partitions"], body["folded"], body.get("packs", {}), body.get("at", 0.0))


def _manifests(folders: Folders, path: str, above: int = -1) -> Iterator[Manifest]:
    """The complete manifests numbered ``above`` so much, the newest first; each is read when it is asked for."""
    for name in sorted(folders.names(f"{path}/manifests"), reverse=True):
        if int(name.split(".")[0]) <= above:
            return
        found = _manifest(folders, path, name)
        if found:
            yield found


def current(spark: SparkSession, path: str) -> Manifest:
    return next(_manifests(Folders(spark), path), _NOTHING)


def _publish(
    spark: SparkSession, path: str, before: Manifest, partitions: dict[str, str], folded: dict[str, int], packs: dict[str, int] | None = None
) -> None:
    """Make a commit visible; fails if another writer has published since ``before``."""
    folders = Folders(spark)
    names = folders.names(f"{path}/manifests")
    if next(_manifests(folders, path, before.number), None):
        raise ConcurrentCommit(f"{path} was changed by another writer")
    number = max([before.number, *(int(n.split(".")[0]) for n in names)]) + 1
    body = {"partitions": partitions, "folded": folded, "packs": before.packs if packs is None else packs, "at": time.time()}
    try:
        folders.create_text(f"{path}/manifests/{number:012d}.json", json.dumps(body))
    except FileExistsError as error:
        raise ConcurrentCommit(f"{path} was changed by another writer") from error
    _expire(folders, path)


def _leased_from(folders: Folders, path: str) -> float:
    """The oldest manifest that a lease still names; leases that have run out are removed."""
    oldest = float("inf")
    for name in folders.names(f"{path}/leases"):
        number, until = name.split("-")[:2]
        if int(until) < time.time():
            folders.remove(f"{path}/leases/{name}")
        else:
            oldest = min(oldest, int(number))
    return oldest


def _expire(folders: Folders, path: str) -> None:
    """Remove the oldest manifests up to the first that is young or leased, and what only they name.

    What a manifest has and the next one hasn't never comes back, so only those that go, and the first that
    stays, are read.
    """
    names, leased = folders.names(f"{path}/manifests"), _leased_from(folders, path)
    first_kept, older = int(names[-KEPT_MANIFESTS:][0].split(".")[0]), None
    for name in names:
        newer = _manifest(folders, path, name)
        if newer is None:
            continue
        if older is not None:
            # A version may be read until the one that replaced it is old enough.
            if older.number >= min(first_kept, leased) or newer.at > time.time() - RETAINED_SECONDS:
                break
            for partition, version in older.partitions.items():
                if newer.partitions.get(partition) != version:
                    folders.remove(f"{path}/data/version={version}/{partition}")
            for version in set(older.partitions.values()) - set(newer.partitions.values()):
                folders.remove(f"{path}/index/version={version}")
            for pack in older.packs.keys() - newer.packs.keys():
                folders.remove(f"{path}_packs/{pack}")
            folders.remove(f"{path}/manifests/{older.number:012d}.json")
        older = newer
    if older and older.at <= time.time() - RETAINED_SECONDS:
        _drop_batches(folders, path, older.folded)


def _drop_batches(folders: Folders, path: str, folded: dict[str, int]) -> None:
    """Remove the loose batches that the oldest manifest has folded away."""
    for run, batch_id in folded.items():
        for name in folders.names(f"{path}_log/run={run}"):
            if name.startswith("batch_id=") and int(name.split("=")[1]) <= batch_id:
                folders.remove(f"{path}_log/run={run}/{name}")


@contextmanager
def leased(spark: SparkSession, root: str, table: Table, seconds: int = 86_400) -> Iterator[DataFrame]:
    """The table as of now, whose files stay until the block ends or the time is up, whatever is committed."""
    path, folders = table_path(root, table), Folders(spark)
    while True:
        found = current(spark, path)
        place = f"{path}/leases/{max(found.number, 0):012d}-{int(time.time()) + seconds}-{uuid.uuid4().hex}"
        folders.create_text(place, "")
        # The manifest may have gone before the lease was there.
        if found.number < 0 or folders.exists(f"{path}/manifests/{found.number:012d}.json"):
            break
        folders.remove(place)
    try:
        yield _read_partitions(spark, path, table, found.partitions).select(*table.all_columns)
    finally:
        folders.remove(place)


def _read_partitions(spark: SparkSession, path: str, table: Table, partitions: dict[str, str]) -> DataFrame:
    if not partitions:
        return spark.createDataFrame([], table.schema)
    paths = [f"{path}/data/version={version}/{name}" for name, version in sorted(partitions.items())]
    return spark.read.schema(table.schema).option("basePath", f"{path}/data").parquet(*paths).drop("version")


def _write_partitions(rows: DataFrame, table: Table, path: str) -> list[str]:
    """Write ``rows`` by partition and return the names of the folders that came of it.

    Range distribution on (partition, order) splits a big partition over several files with
    disjoint key ranges, so a reader of one house or zip skips most of them by their statistics.
    """
    order = [table.partition, *table.order]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(table.partition).parquet(path)
    return [name for name in Folders(rows.sparkSession).names(path) if "=" in name]


def _bits_of(value: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(n)), F.lit(INDEX_BITS)) for n in range(INDEX_HASHES)]


def _write_version(rows: DataFrame, table: Table, path: str, commit: str) -> list[str]:
    """Write ``rows`` as a version of ``path`` and index its files: smallest and largest value and a Bloom filter each."""
    spark, place = rows.sparkSession, f"{path}/data/version={commit}"
    written = _write_partitions(rows, table, place)
    if table.indexed and written:
        value = F.col(table.indexed)
        values = spark.read.schema(table.schema).parquet(place).select(F.col("_metadata.file_path").alias("file"), value.alias("value")).distinct()
        bits = values.select("file", "value", F.explode(F.array(*_bits_of(F.col("value")))).alias("bit"))
        files = bits.groupBy("file").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.bitmap_construct_agg("bit").alias("bloom"))
        files.coalesce(1).write.mode("overwrite").parquet(f"{path}/index/version={commit}")  # a row for each file
    return written


def files_with(spark: SparkSession, root: str, table: Table, value: int | str) -> list[str]:
    """The files of a table that may hold a value of its indexed column: the others needn't be opened.

    The Bloom filter has room for some 5,000 values a file; beyond that the range alone decides.
    """
    path = table_path(root, table)
    live = current(spark, path).partitions
    versions = [f"{path}/index/version={v}" for v in sorted(set(live.values()))]
    if not versions:
        return []
    kind = next(f.dataType for f in struct_of(table.columns) if f.name == table.indexed)
    wanted = F.lit(value).cast(kind)

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bloom", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1

    may = (wanted >= F.col("low")) & (wanted <= F.col("high"))
    for bit in _bits_of(wanted):
        may = may & is_set(bit)
    index = spark.read.schema(f"file string, low {kind.simpleString()}, high {kind.simpleString()}, bloom binary").parquet(*versions)
    found = []
    for row in index.where(may).select("file").collect():  # as many as are to be read
        version, partition, name = unquote(row["file"]).split("/")[-3:]
        if live.get(partition) == version.split("=")[1]:
            found.append(f"{path}/data/{version}/{partition}/{name}")
    return sorted(found)


def read_value(spark: SparkSession, root: str, table: Table, value: int | str) -> DataFrame:
    """The rows of one value of the indexed column, from the files that may hold it alone."""
    files = files_with(spark, root, table, value)
    if not files:
        return spark.createDataFrame([], table.schema).select(*table.all_columns)
    rows = spark.read.schema(table.schema).option("basePath", f"{table_path(root, table)}/data").parquet(*files)
    return rows.where(F.col(table.indexed) == F.lit(value)).select(*table.all_columns)


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` to the working folder and read them back.

    This cuts the lineage and, before a join, tells the planner the size of a derived list: a small
    one is broadcast and the big side is not shuffled at all, a big one is joined by a shuffle.
    """
    path = fresh_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def upsert(rows: DataFrame, root: str, table: Table, unique: bool = False, folded: dict[str, int] | None = None) -> None:
    """Insert ``rows``; a stored row with the same key is replaced.

    Rows of one key inside ``rows`` are settled by the largest values; ``unique=True`` says that there
    are none, which saves the shuffle. Only the stored partitions that ``rows`` has rows for are read and
    written anew. Running it again after a failure gives the same table.
    """
    spark = rows.sparkSession
    path, values = table_path(root, table), table.value_columns
    settled = rows.select(*table.all_columns)
    if not unique:
        merged = settled.groupBy(*table.key).agg(F.max(F.struct(*values)).alias("v"))
        settled = merged.select(*[F.col(f"v.{c}").alias(c) if c in values else F.col(c) for c in table.all_columns])
    before = current(spark, path)
    commit = uuid.uuid4().hex
    if not before.partitions:
        touched = _write_version(table.with_partition(settled), table, path, commit)
    else:
        fresh_path = fresh_dir(spark, f"{table.name}-new")
        named = _write_partitions(table.with_partition(settled), table, fresh_path)
        if not named:
            Folders(spark).remove(fresh_path)
            return
        fresh = spark.read.schema(table.schema).parquet(fresh_path)
        old = _read_partitions(spark, path, table, {n: before.partitions[n] for n in named if n in before.partitions})
        kept = old.select(*fresh.columns).join(fresh.select(*table.key), list(table.key), "left_anti")
        touched = _write_version(kept.unionByName(fresh), table, path, commit)
        Folders(spark).remove(fresh_path)
    partitions = {**before.partitions, **dict.fromkeys(touched, commit)}
    _publish(spark, path, before, partitions, before.folded if folded is None else folded)


def overwrite(rows: DataFrame, root: str, table: Table, covers: list[str] | None = None) -> None:
    """Replace whole partitions, for a run that covers them completely.

    ``covers`` names partition folders that the run covers beside those it has rows for: they become empty.
    """
    spark, path, commit = rows.sparkSession, table_path(root, table), uuid.uuid4().hex
    before = current(spark, path)
    written = _write_version(table.with_partition(rows.select(*table.all_columns)), table, path, commit)
    rest = {name: version for name, version in before.partitions.items() if name not in (covers or [])}
    _publish(spark, path, before, {**rest, **dict.fromkeys(written, commit)}, before.folded)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that a streaming checkpoint stands for, kept in a file beside it.

    A new checkpoint starts counting batches from 0 again; its run keeps them apart from earlier ones. Names
    sort by the time of the first start.
    """
    folders, place = Folders(spark), f"{checkpoint.rstrip('/')}.run"
    if not folders.exists(place):
        stamp = spark.sql("SELECT date_format(now(), 'yyyyMMddHHmmssSSS')").first()[0]
        folders.create_text(place, f"{stamp}-{uuid.uuid4().hex[:8]}")
    return folders.read_text(place)


def append_batch(rows: DataFrame, root: str, table: Table, batch_id: int, run: str = "0") -> None:
    """Add the rows of one micro-batch as their own (run, batch_id, date) folders; one without rows leaves nothing.

    A batch that is run again replaces its own folders, so nothing is counted twice. The rebalance
    keeps a small batch from leaving one small file per task and date; without adaptive execution it would do nothing.
    """
    place = f"{table_path(root, table)}_log/run={run}/batch_id={batch_id}"
    rows = table.with_partition(rows.select(*table.all_columns))
    with adaptive(rows.sparkSession):
        rows.hint("rebalance", table.partition).write.mode("overwrite").partitionBy(table.partition).parquet(place)
    folders = Folders(rows.sparkSession)
    if not any("=" in name for name in folders.names(place)):
        folders.remove(place)


def _loose(folders: Folders, path: str, folded: dict[str, int]) -> dict[str, list[int]]:
    """The batches of each run that are neither folded nor packed."""
    found = {}
    for run in (name.split("=")[1] for name in folders.names(f"{path}_log") if name.startswith("run=")):
        numbers = (int(name.split("=")[1]) for name in folders.names(f"{path}_log/run={run}") if name.startswith("batch_id="))
        found[run] = sorted(n for n in numbers if n > folded.get(run, -1))
    return found


def _log_rows(spark: SparkSession, path: str, table: Table, loose: dict[str, list[int]], packs: list[str]) -> DataFrame:
    schema = f"{table.schema}, run string, batch_id bigint"
    parts = []
    batches = [f"{path}_log/run={run}/batch_id={n}" for run, numbers in loose.items() for n in numbers]
    if batches:
        parts.append(spark.read.schema(schema).option("basePath", f"{path}_log").parquet(*batches))
    if packs:
        parts.append(spark.read.schema(f"{schema}, pack string").option("basePath", f"{path}_packs").parquet(*[f"{path}_packs/{p}" for p in packs]).drop("pack"))
    if not parts:
        return spark.createDataFrame([], schema)
    columns = [f.name for f in struct_of(schema)]
    rows = parts[0].select(*columns)
    return rows if len(parts) == 1 else rows.unionByName(parts[1].select(*columns))


def read_log(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Every row that micro-batches appended and that is not folded yet, with its ``run`` and ``batch_id``."""
    path = table_path(root, table)
    found = current(spark, path)
    return _log_rows(spark, path, table, _loose(Folders(spark), path, found.folded), sorted(found.packs))


def pack_log(spark: SparkSession, root: str, table: Table, through: dict[str, int] | None = None, fan_in: int = FAN_IN) -> None:
    """Pack the loose batches of a log, and packs of one level, where there are ``fan_in`` of them.

    ``through`` names the last complete batch of each run. Without it the last batch of each run is left, since it may
    still be written. Packs hold the same rows with their run and batch; one manifest takes batches off the log and adds
    the pack. Each row is rewritten once a level.
    """
    path, folders = table_path(root, table), Folders(spark)
    before = current(spark, path)
    loose = _loose(folders, path, before.folded)
    if through is None:
        done = {run: numbers[:-1] for run, numbers in loose.items()}
    else:
        done = {run: [n for n in numbers if n <= through.get(run, -1)] for run, numbers in loose.items()}
    packs, folded = dict(before.packs), dict(before.folded)

    def pack(batches: dict[str, list[int]], members: list[str], level: int) -> None:
        name = f"pack={uuid.uuid4().hex}"
        rows = _log_rows(spark, path, table, batches, members)
        rows.hint("rebalance", table.partition).write.partitionBy(table.partition).parquet(f"{path}_packs/{name}")
        for member in members:
            del packs[member]
        packs[name] = level

    if sum(map(len, done.values())) >= fan_in:
        pack(done, [], 1)
        folded.update({run: numbers[-1] for run, numbers in done.items() if numbers})
    level = 1
    while level <= max(packs.values(), default=0):
        members = sorted(name for name, at in packs.items() if at == level)
        if len(members) >= fan_in:
            pack({}, members, level + 1)
        level += 1
    if packs != before.packs:
        _publish(spark, path, before, before.partitions, folded, packs)


def read_latest(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The last appended value of each key: that of the last batch of the last run."""
    values = table.value_columns
    latest = (
        read_log(spark, root, table)
        .groupBy(*table.key)
        .agg(F.max(F.struct("run", "batch_id", *values)).alias("v"))
    )
    return latest.select(*[F.col(f"v.{c}").alias(c) if c in values else F.col(c) for c in table.all_columns])


def _summed(rows: DataFrame, table: Table) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in table.value_columns]
    return rows.groupBy(*table.key).agg(*sums).select(*table.all_columns)


def read_sums(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The sum of each key over the folded table and all batches appended since."""
    log = read_log(spark, root, table).select(*table.all_columns)
    return _summed(read(spark, root, table).unionByName(log), table)


def fold_log(spark: SparkSession, root: str, table: Table, through: dict[str, int] | None = None) -> None:
    """Add appended batches into the keyed table and take them off the log.

    ``through`` names the last complete batch of each run. Without it the last batch of each run is left,
    since it may still be written. The sums and the fact that batches are folded are published by one
    manifest; batches are removed when no reader can need them any more.
    """
    path = table_path(root, table)
    before = current(spark, path)
    log = read_log(spark, root, table)
    if through is None:
        last = log.groupBy("run").agg(F.max("batch_id").alias("b")).collect()  # a row for each run
        through = {r["run"]: r["b"] - 1 for r in last}
    done = F.lit(False)
    for run, batch_id in through.items():
        done = done | ((F.col("run") == run) & (F.col("batch_id") <= batch_id))
    fresh = log.where(done).select(*table.all_columns)
    days = fresh.select(table.partition).distinct()
    stored = read(spark, root, table).join(days, table.partition, "left_semi")
    folded = {**before.folded, **{r: max(b, before.folded.get(r, -1)) for r, b in through.items()}}
    upsert(stage(_summed(stored.unionByName(fresh), table), f"{table.name}-sums"), root, table, unique=True, folded=folded)


def read(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The table as of now; one that was never written has no rows."""
    path = table_path(root, table)
    return _read_partitions(spark, path, table, current(spark, path).partitions).select(*table.all_columns)


def export(rows: DataFrame, table: Table, fmt: str, mode: str = "append", **options: str) -> None:
    """Hand the rows of a table to another store through its Spark connector."""
    rows.select(*table.all_columns).write.format(fmt).options(**options).mode(mode).save()


def geo_on_date(geo: DataFrame, date: str | Column) -> DataFrame:
    """Energy of every zip on one date; reads that date's folder only."""
    return geo.where(F.col("date") == date)


def house_history(mains: DataFrame, house_id: int) -> DataFrame:
    """Mains energy of one house over all dates, in order; files of other houses are skipped."""
    return mains.where(F.col("house_id") == house_id).orderBy("date", "zip", "label")


def appliance_breakdown(appliance: DataFrame, house_id: int, date: str) -> DataFrame:
    """Energy per appliance of one house on one date."""
    return appliance.where((F.col("date") == date) & (F.col("house_id") == house_id))
