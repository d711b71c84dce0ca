"""Compact records and flat readings: parse, expand, layer, pack, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.days import DATE_FORMAT, bucket_floor, ts_to_date
from wattloom.functions.parsing import parse_power, parse_seconds
from wattloom.schema import COMPACT_WITH_CORRUPT, CORRUPT_COLUMN, HOUSES_COLUMN, READING_COLUMNS

MAINS = "mains"
APPLIANCE = "appliance"

# Fixed value: channels up to this number are mains, the others are appliances.
LAST_MAINS_CHANNEL = 2

# Records of one house and step are built in blocks of this many, so that no array and no task
# outgrows it.
COPY_BLOCK = 10_000


def layer_of(meter_id: Column) -> Column:
    channel = meter_id.try_cast("int")
    return F.when(channel <= LAST_MAINS_CHANNEL, F.lit(MAINS)).otherwise(F.lit(APPLIANCE))


def with_layer(readings: DataFrame) -> DataFrame:
    """Add ``layer``: 'mains' for channels 1 and 2, else 'appliance'."""
    if "layer" in readings.columns:
        return readings
    return readings.withColumn("layer", layer_of(F.col("meter_id")))


def only_layer(readings: DataFrame, layer: str) -> DataFrame:
    return with_layer(readings).where(F.col("layer") == layer)


def parse_json(values: DataFrame, column: str = "value") -> DataFrame:
    """JSON text (a topic value or a line) to compact records; other columns are kept.

    The one-element ``inline`` keeps a later filter above the parse. As a plain projection the
    filter would be pushed below it and parse every text a second time.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = F.from_json(F.col(column).cast("string"), COMPACT_WITH_CORRUPT, options)
    rest = [c for c in values.columns if c != column]
    return values.select(*rest, F.inline(F.array(parsed)))


def flag_records(records: DataFrame) -> DataFrame:
    """Add ``reject_reason``: null for a usable record, else the first thing wrong with it."""
    malformed = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in records.columns else F.lit(False)
    reason = (
        F.when(malformed, "malformed")
        .when(parse_seconds(F.col("timestamp")).isNull(), "timestamp")
        .when(F.col("houseId").isNull(), "house")
        .when(F.col("readings").isNull(), "readings")
    )
    return records.withColumn("reject_reason", reason)


def rejected_records(records: DataFrame) -> DataFrame:
    return flag_records(records).where(F.col("reject_reason").isNotNull())


def _exploded(records: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    usable = flag_records(records).where(F.col("reject_reason").isNull())
    ts = parse_seconds(F.col("timestamp"))
    return usable.select(
        F.col("houseId").alias("house_id"),
        ts_to_date(ts, date_format).alias("date"),
        ts.alias("ts"),
        "zip",
        *[c for c in records.columns if c == HOUSES_COLUMN],
        F.explode("readings").alias("reading"),
    ).select(
        "house_id",
        "date",
        "ts",
        "zip",
        *[c for c in records.columns if c == HOUSES_COLUMN],
        F.col("reading.label").alias("label"),
        F.col("reading.meterId").alias("meter_id"),
        F.col("reading.power").alias("power_text"),
        parse_power(F.col("reading.power")).alias("power"),
    )


def _usable_reading() -> Column:
    return F.col("power").isNotNull() & F.col("meter_id").try_cast("int").isNotNull()


def expand_readings(records: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    """One row per reading; house, zip and time repeated. An empty record gives no row.

    Records may be shared (see :func:`record_of_each_house`): what is the same for their houses is then worked out
    once, and the row of each house is a copy of it.
    """
    if HOUSES_COLUMN not in records.columns:
        return _exploded(records, date_format).where(_usable_reading()).select(*READING_COLUMNS)
    own = {"houseId": F.lit(0).cast("bigint"), "zip": F.lit(None).cast("string")}
    once = _exploded(records.withColumns(own), date_format).where(_usable_reading()).drop("house_id", "zip")
    each = once.select("*", F.inline(HOUSES_COLUMN)).where(F.col("houseId").isNotNull())
    return each.withColumnRenamed("houseId", "house_id").select(*READING_COLUMNS)


def record_of_each_house(shared: DataFrame) -> DataFrame:
    """Shared records, which list the (houseId, zip) they hold for, as a record for each of these."""
    own = [c for c in shared.columns if c != HOUSES_COLUMN]
    return shared.select(*own, F.inline(HOUSES_COLUMN))


def rejected_readings(records: DataFrame) -> DataFrame:
    """Readings of usable records whose power is no finite number or whose meter is no channel number."""
    reason = F.when(F.col("power").isNull(), "power").otherwise("meter")
    return _exploded(records).where(~_usable_reading()).withColumn("reject_reason", reason).drop("power")


def route_records(records: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    """Everything that is in ``records``, each piece once: readings, and rejects with reason and original.

    ``outcome`` is 'accepted' for a usable reading of a usable record, else 'rejected'. One pass over the
    records makes both, so a single write by outcome parses each text once.
    """
    flagged, ts = flag_records(records), parse_seconds(F.col("timestamp"))
    whole, usable = F.col("reject_reason").isNotNull(), F.col("reject_reason").isNull()
    fields = {"house_id": F.col("houseId").cast("bigint"), "date": ts_to_date(ts, date_format), "ts": ts, "zip": F.col("zip").cast("string")}
    broken = F.to_json(F.struct(*[F.col(c) for c in records.columns]))
    # What readings share is worked out once a record, below the explode, which then carries no array along. A
    # rejected record has one piece, a null reading.
    shared = flagged.select(
        *[F.when(usable, value).alias(name) for name, value in fields.items()],
        "reject_reason",
        F.when(whole, broken).alias("broken"),
        "readings",
    )
    each = F.when(whole, F.array(F.get("readings", F.lit(-1)))).otherwise(F.col("readings"))
    pieces = shared.select(*fields, "reject_reason", "broken", F.explode(each).alias("reading"))
    reading = F.col("reading")
    parsed = pieces.select(
        *fields,
        reading["label"].cast("string").alias("label"),
        reading["meterId"].cast("string").alias("meter_id"),
        parse_power(reading["power"]).alias("power"),
        reading["power"].alias("power_text"),
        "reject_reason",
        "broken",
    )
    reason = F.when(whole, F.col("reject_reason")).when(F.col("power").isNull(), "power").when(F.col("meter_id").try_cast("int").isNull(), "meter")
    wrong = F.to_json(F.struct(*fields, "label", "meter_id", "power_text"))
    routed = parsed.withColumn("reason", reason)
    return routed.select(
        *fields,
        "label",
        "meter_id",
        "power",
        "reason",
        F.when(whole, F.col("broken")).when(F.col("reason").isNotNull(), wrong).alias("original"),
        F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("outcome"),
    )


def rejected_input(records: DataFrame) -> DataFrame:
    """Rejected records and the rejected readings of others, each with the columns of its kind, else null."""
    return rejected_records(records).unionByName(rejected_readings(records), allowMissingColumns=True)


def _stepped(readings: DataFrame, step: int) -> DataFrame:
    return with_layer(readings).withColumn("step_start", bucket_floor(F.col("ts"), step))


def _numbered(readings: DataFrame, step: int, unit: list[str]) -> DataFrame:
    """Readings with the number, from 1, of the record they go to, and the block it lies in."""
    # Layer and step follow from what is counted, so they are worked out after each shuffle and are in none.
    own = [c for c in ("house_id", "zip", "layer", "meter_id", "ts", "label", "power") if c in readings.columns]
    at = [bucket_floor(F.col("ts"), step), "house_id", "zip"]
    layer = F.col("layer") if "layer" in own else layer_of(F.col("meter_id"))
    counted = readings.groupBy(*own).agg(F.count(F.lit(1)).alias("copies")).repartition(*at, "meter_id")
    in_order = Window.partitionBy(*unit, "meter_id").orderBy("ts", "label", "power")
    last = F.sum("copies").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def block_of(number: Column) -> Column:
        return F.floor((number - F.lit(1)) / F.lit(COPY_BLOCK))

    from_no = F.greatest(F.col("last_no") - F.col("copies"), F.col("block") * F.lit(COPY_BLOCK)) + F.lit(1)
    to_no = F.least(F.col("last_no"), (F.col("block") + F.lit(1)) * F.lit(COPY_BLOCK))
    blocks = F.sequence(block_of(F.col("last_no") - F.col("copies") + F.lit(1)), block_of(F.col("last_no")))
    # The shuffle has counts, so its size says little of the records to build. With a number of tasks of its
    # own, adaptive execution does not merge the blocks into a few tasks.
    tasks = int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_blocks = (
        _stepped(counted, step)
        .withColumn("last_no", last)
        .withColumn("block", F.explode(blocks))
        .select(*own, "copies", "last_no", "block")
        .repartition(tasks, *at, layer, "block")
    )
    return _stepped(in_blocks, step).withColumn("record_no", F.explode(F.sequence(from_no, to_no)))


def pack_readings(readings: DataFrame, step: int = 1, one_per_meter: bool = False) -> DataFrame:
    """Flat readings to compact records, the inverse of :func:`expand_readings`.

    A record holds one layer of one house and time step, with at most one reading per meter; the
    n-th reading of each meter inside the step goes to the n-th record, whose timestamp is that of
    its first channel. With ``step=1`` expanding the records gives back exactly the readings.

    Equal readings are counted before the shuffle and numbered by a running sum, so a pile of
    copies crosses the network once; its records are then built block by block, each block in a
    task of its own. ``one_per_meter=True`` skips all that, for readings known to have one row per
    meter and step, and needs a single shuffle; a second reading fails the job.
    """
    # Sorts compare the first column by itself and the others row against row, so the one with most values leads.
    unit = ["step_start", "house_id", "zip", "layer"]
    if one_per_meter:
        numbered, record = _stepped(readings, step).withColumn("record_no", F.lit(1).cast("bigint")), unit
    else:
        numbered, record = _numbered(readings, step, unit), [*unit, "block"]
    entry = F.struct(F.col("meter_id").try_cast("int").alias("channel"), "meter_id", "power", "label", "ts")
    packed = numbered.groupBy(*record, "record_no").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    timestamp = F.get("entries", F.lit(0))["ts"].cast("string")
    if one_per_meter:
        meters = F.transform("entries", lambda e: e["meter_id"])
        repeated = F.size(F.array_distinct(meters)) < F.size(meters)
        timestamp = F.when(repeated, F.raise_error(F.lit("a meter has two readings in one step"))).otherwise(timestamp)
    return packed.select(
        timestamp.alias("timestamp"),
        F.col("house_id").alias("houseId"),
        "zip",
        F.transform(
            "entries",
            lambda e: F.struct(
                e["meter_id"].alias("meterId"), e["power"].cast("string").alias("power"), e["label"].alias("label")
            ),
        ).alias("readings"),
        "layer",
        "step_start",
        "record_no",
    )


def to_messages(records: DataFrame, mains_topic: str, appliance_topic: str, key: Column | None = None) -> DataFrame:
    """Records as (topic, key, value), the columns a Kafka writer takes. Routed by layer."""
    value = F.to_json(F.struct("timestamp", "zip", "houseId", "readings"))
    return records.select(
        F.when(F.col("layer") == MAINS, mains_topic).otherwise(appliance_topic).alias("topic"),
        (F.col("houseId").cast("string") if key is None else key.cast("string")).alias("key"),
        value.alias("value"),
    )


def _record_watts() -> tuple[Column, Column]:
    first, second = (parse_power(F.get(F.col("readings"), F.lit(i))["power"]) for i in (0, 1))
    return first, second


def record_mains_power(records: DataFrame) -> DataFrame:
    """Watts of a mains record: the sum of its first two readings. Works on streams too."""
    first, second = _record_watts()
    ts = parse_seconds(F.col("timestamp"))
    usable = flag_records(records).where(F.col("reject_reason").isNull() & first.isNotNull() & second.isNotNull())
    return usable.select(
        F.col("houseId").alias("house_id"),
        ts_to_date(ts).alias("date"),
        ts.alias("ts"),
        "zip",
        (first + second).alias("power"),
    )


def rejected_mains_records(records: DataFrame) -> DataFrame:
    """Mains records that have not got two numeric readings, or are unusable altogether."""
    first, second = _record_watts()
    flagged = flag_records(records)
    reason = F.coalesce(F.col("reject_reason"), F.when(first.isNull() | second.isNull(), F.lit("mains pair")))
    return flagged.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())
