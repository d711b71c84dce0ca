"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.days import day_floor, parse_anchor, ts_to_date, SHORT_DATE_FORMAT
from wattloom.operators.alerts import overshoot_alerts
from wattloom.operators.dimensions import (
    assign_houses,
    house_range,
    lookup_labels,
    refresh_zips,
    sample_zips,
    zip_difference,
)
from wattloom.operators.energy import daily_energy, geo_energy, label_day_energy, meter_day_energy
from wattloom.operators.quality import (
    channel_counts,
    clean_days,
    common_days,
    day_quality,
    gap_detect,
    readings_of_days,
)
from wattloom.operators.readings import (
    APPLIANCE,
    MAINS,
    expand_readings,
    flag_records,
    only_layer,
    pack_readings,
    parse_json,
    record_mains_power,
    to_messages,
    with_layer,
)
from wattloom.operators.replicate import replicate_days
from wattloom.operators.share import appliance_share, appliance_share_joined
from wattloom.operators.stats import meter_p97
from wattloom.plans.batch import ingest, run_batch
from wattloom.plans.prep import clean_days_of, clean_days_of_all, replay_records
from wattloom.schema import READING_COLUMNS, ZIP_COLUMNS
from wattloom.session import fresh_dir, tune
from wattloom.sources import files, runs, tables
from wattloom.sources.events import events_as_readings, read_known_houses, read_readings, read_source_houses, read_zip_table, stream_readings
from wattloom.sources.quarantine import read_quarantine
from wattloom.sources.records import infer_records, read_hourly, read_topic, stream_values, write_hourly, write_topic
from wattloom.streaming.power import (
    BATCH_POWER,
    mains_power_windows,
    read_alerts,
    start_alerts,
    start_batch_power,
    start_mains_power,
    stored_stats,
)
from wattloom.streaming.windows import read_windows, start_parting, start_windows

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the SQL of the check states the same values.
ANCHOR = "01/01/2024:00:00:00"
HOUSE_GAP = 18_000
LAYER_GAP = 28_800
HOUR_STEP = 3_600
WINDOW = "10 minutes"
MARGIN = 0.05
FIRST_HOUR, LAST_HOUR = "2024-01-10-06", "2024-01-12-17"
ONE_DATE, ONE_HOUSE = "2024-01-15", 7
NEW_ZIPS, ZIP_SEED, HOUSE_SEED = 50, 7, 11
HOUSE = ("house_id",)
ALL_GAP, CHAIN_GAP = 64_800, 43_200
WINDOW_SECONDS, LATE_SECONDS = 600, 86_400
MANY_ZIPS = 1_000
CHAIN_DAYS = 10
# Events come in batches of so many days of the month; every tenth comes one batch later.
BATCH_DAYS, LATER = 11, 10


# Float sums depend on the order of addition in their last bits, so reports are rounded. Energy
# keeps ten decimals: hundredths of a watt over whole seconds, in kWh, either end within ten or
# never end, so that no value lies half-way between two rounded ones.
DECIMALS = {"kwh": 10}


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DECIMALS.get(c, 6)) for c in columns})


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_readings(tune(spark), sf_dir)


def q_ts_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return _readings(spark, sf_dir).select(
        "ts", ts_to_date(ts).alias("date"), ts_to_date(ts, SHORT_DATE_FORMAT).alias("short_date")
    )


def q_day_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir).select("ts", day_floor(F.col("ts")).alias("day_start"))


def q_layer_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_layer(_readings(spark, sf_dir)).select("house_id", "ts", "meter_id", "layer", "power")


def q_pack_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.transform("readings", lambda r: F.concat_ws(":", r["meterId"], r["power"], r["label"]))
    return pack_readings(_readings(spark, sf_dir)).select(
        "timestamp",
        F.col("houseId").alias("house_id"),
        "zip",
        "layer",
        "record_no",
        F.array_join(payload, ",").alias("payload"),
    )


def q_pack_readings_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest reading of each meter and second, packed with a single shuffle after that."""
    unit = ["house_id", "zip", "meter_id", "ts"]
    best = _readings(spark, sf_dir).groupBy(*unit).agg(F.max(F.struct("power", "label")).alias("best"))
    flat = best.select(*unit, "best.power", "best.label", ts_to_date(F.col("ts")).alias("date"))
    payload = F.transform("readings", lambda r: F.concat_ws(":", r["meterId"], r["power"], r["label"]))
    packed = pack_readings(flat, one_per_meter=True)
    return packed.select("timestamp", F.col("houseId").alias("house_id"), "zip", "layer", F.array_join(payload, ",").alias("payload"))


def q_expand_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_readings(pack_readings(_readings(spark, sf_dir)))


def q_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_messages(pack_readings(_readings(spark, sf_dir)), "meters_hf", "meters_lf")
    return expand_readings(parse_json(messages.select("topic", "value"))).select(
        "house_id", "ts", "zip", "label", "meter_id", "power"
    )


def q_json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good messages mixed with JSON of another kind and with plain prose, counted by what is wrong."""
    messages = to_messages(pack_readings(_readings(spark, sf_dir)), "meters_hf", "meters_lf").select("value")
    other = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("props").alias("value"))
    prose = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text").alias("value"))
    flagged = flag_records(parse_json(messages.unionByName(other).unionByName(prose)))
    reason = F.coalesce("reject_reason", F.lit("accepted")).alias("reason")
    return flagged.groupBy(reason).agg(F.count(F.lit(1)).alias("n_records"))


def q_hourly_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "hourly")
    write_hourly(pack_readings(_readings(spark, sf_dir)), path)
    return expand_readings(read_hourly(spark, path, FIRST_HOUR, LAST_HOUR))


def q_meter_day_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(meter_day_energy(_readings(spark, sf_dir)), "joules")


def q_daily_energy_appliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily_energy(_readings(spark, sf_dir), APPLIANCE), "kwh")


def q_daily_energy_mains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily_energy(_readings(spark, sf_dir), MAINS), "kwh")


def _label_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_day_energy(meter_day_energy(_readings(spark, sf_dir)))


def q_appliance_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(appliance_share(_label_days(spark, sf_dir)), "percent")


def q_appliance_share_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _readings(spark, sf_dir)
    layers = (daily_energy(readings, layer) for layer in (APPLIANCE, MAINS))
    return rounded(appliance_share_joined(*layers, strict=True), "percent")


def q_appliance_share_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _readings(spark, sf_dir)
    layers = (daily_energy(readings, layer) for layer in (APPLIANCE, MAINS))
    return rounded(appliance_share_joined(*layers), "percent")


def q_geo_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(geo_energy(daily_energy(_readings(spark, sf_dir), MAINS)), "kwh")


def q_meter_p97(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meter_p97(_readings(spark, sf_dir))


def q_mains_record_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = pack_readings(only_layer(_readings(spark, sf_dir), MAINS), HOUR_STEP)
    return rounded(record_mains_power(records), "power")


def _epoch_windows(windows: DataFrame) -> DataFrame:
    return rounded(windows.withColumn("window_start", F.unix_seconds("window_start")), "watts_sum")


def q_rt_mains_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _epoch_windows(mains_power_windows(only_layer(_readings(spark, sf_dir), MAINS).drop("layer"), WINDOW))


def _finish(query) -> None:
    query.awaitTermination()


def q_rt_mains_power_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    mains = only_layer(stream_readings(tune(spark), sf_dir), MAINS)
    root = fresh_dir(spark, "live")
    _finish(start_mains_power(mains, root, f"{root}/checkpoint", WINDOW, trigger=None))
    return _epoch_windows(tables.read_sums(spark, root, tables.RT_POWER))


def q_rt_record_power_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records in several micro-batches, the first of them folded away."""
    mains = only_layer(_readings(spark, sf_dir), MAINS)
    messages = to_messages(pack_readings(mains, HOUR_STEP), "meters_hf", "meters_lf").select("value")
    root = fresh_dir(spark, "live")
    messages.repartition(4, "value").write.text(f"{root}/records")
    values = stream_values(spark, "text", f"{root}/records", maxFilesPerTrigger="1")
    _finish(start_mains_power(record_mains_power(parse_json(values)), root, f"{root}/checkpoint", WINDOW, trigger=None))
    tables.fold_log(spark, root, tables.RT_POWER)
    return _epoch_windows(tables.read_sums(spark, root, tables.RT_POWER))


def q_rt_mains_power_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    mains = only_layer(stream_readings(tune(spark), sf_dir), MAINS)
    root = fresh_dir(spark, "live")
    _finish(start_mains_power(mains, root, f"{root}/checkpoint", WINDOW, trigger=None, merge=True))
    return _epoch_windows(tables.read(spark, root, tables.RT_POWER))


def q_rt_batch_power_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    mains = only_layer(stream_readings(tune(spark), sf_dir), MAINS)
    root = fresh_dir(spark, "live")
    _finish(start_batch_power(mains, root, f"{root}/checkpoint", trigger=None))
    log = tables.read_log(spark, root, BATCH_POWER)
    total = log.groupBy("house_id", "date", "zip").agg(F.sum("watts_sum").alias("watts_sum"))
    return rounded(total, "watts_sum")


def q_overshoot_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _readings(spark, sf_dir)
    return overshoot_alerts(readings, tables.stage(meter_p97(readings), "stats"), MARGIN)


def q_overshoot_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(tune(spark), "alerts")
    tables.upsert(meter_p97(read_readings(spark, sf_dir)), root, tables.METER_STATS)
    stream = stream_readings(spark, sf_dir)
    _finish(start_alerts(stream, stored_stats(root), root, f"{root}/checkpoint", MARGIN, trigger=None))
    return read_alerts(spark, root)


def _anchor() -> Column:
    return parse_anchor(ANCHOR)


def q_channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channel_counts(_readings(spark, sf_dir))


def q_gap_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap_detect(_readings(spark, sf_dir), HOUSE, _anchor(), HOUSE_GAP)


def q_day_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_quality(_readings(spark, sf_dir), anchor=_anchor())


def _clean_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_days(_readings(spark, sf_dir), HOUSE, _anchor(), HOUSE_GAP)


def q_clean_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_days(spark, sf_dir)


def q_clean_days_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _readings(spark, sf_dir)
    layers = (only_layer(readings, layer) for layer in (MAINS, APPLIANCE))
    return common_days(*(clean_days(rows, HOUSE, _anchor(), LAYER_GAP) for rows in layers))


def q_clean_day_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = tables.stage(_clean_days(spark, sf_dir), "clean-days")
    kept = readings_of_days(_readings(spark, sf_dir), clean)
    return kept.select("house_id", "meter_id", "ts", "power", "day_start")


def q_replicate_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.pmod(F.col("house_id") * 7 + F.col("meter_id").cast("bigint") * 3, F.lit(11))
    factor = F.lit(0.95) + F.lit(0.01) * step
    clean = tables.stage(_clean_days(spark, sf_dir), "clean-days")
    return replicate_days(_readings(spark, sf_dir), clean, factor=factor, shift=-HOUR_STEP)


def q_label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _readings(spark, sf_dir)
    keys = ("house_id", "meter_id")
    labels = readings.groupBy(*keys).agg(F.min("label").alias("label"))
    return lookup_labels(readings, tables.stage(labels, "labels"), keys).select("house_id", "ts", "meter_id", "label", "power")


def q_house_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tune(spark).read.parquet(f"{sf_dir}/events.parquet")
    houses = events.select(F.col("user_id").alias("house_id")).distinct()
    zips = read_zip_table(spark, sf_dir)
    return rounded(assign_houses(houses, read_known_houses(spark, sf_dir), zips, HOUSE_SEED), "scale")


def q_zip_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_difference(read_zip_table(spark, sf_dir), _readings(spark, sf_dir))


def q_zip_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh_zips(read_zip_table(spark, sf_dir), _readings(spark, sf_dir), NEW_ZIPS, ZIP_SEED)


def q_channel_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "channels")
    files.write_channels(_readings(spark, sf_dir), path)
    return files.read_channels(spark, path)


def q_clean_day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "clean-day-files")
    files.write_clean_days(_clean_days(spark, sf_dir), path)
    return files.read_clean_days(spark, path)


def q_label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(tune(spark), "labels")
    labels = _readings(spark, sf_dir).groupBy("house_id", "meter_id").agg(F.min("label").alias("label"))
    files.write_labels(labels, path)
    return files.read_labels(spark, path)


def q_zip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(tune(spark), "zips")
    known = read_zip_table(spark, sf_dir)
    columns = [F.col(n) if n in known.columns else F.lit(None).cast(kind).alias(n) for n, kind in ZIP_COLUMNS[1:]]
    files.write_zips(known.select(*columns), path)
    return files.read_zips(spark, path, indexed=False).select("zip", "primary_city", "type")


def q_house_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(tune(spark), "houses")
    files.write_houses(read_known_houses(spark, sf_dir, segment=None), path)
    return files.read_houses(spark, path)


def q_batch_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs of the batch job on one root set aside: messages mixed with JSON of another kind, then prose."""
    messages = to_messages(pack_readings(_readings(spark, sf_dir)), "meters_hf", "meters_lf").select("value")
    other = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("props").alias("value"))
    prose = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text").alias("value"))
    root = fresh_dir(spark, "quarantine")
    for values in (messages.unionByName(other), prose):
        run_batch(parse_json(values), root)
    return read_quarantine(spark, root).groupBy("reason").agg(F.count(F.lit(1)).alias("n_records"))


def q_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run that knows one mains meter; later ones know both, each for half of the houses of every date."""
    mains = only_layer(_readings(spark, sf_dir), MAINS)
    root = fresh_dir(spark, "upsert")
    whole = daily_energy(mains, MAINS)
    tables.upsert(daily_energy(mains.where(F.col("meter_id") == "1"), MAINS), root, tables.MAINS_ENERGY)
    for half in (0, 1):
        tables.upsert(whole.where(F.col("house_id") % 2 == half), root, tables.MAINS_ENERGY, unique=True)
    return rounded(tables.read(spark, root, tables.MAINS_ENERGY), "kwh")


def _event_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Mains readings as they would come in: some of each stretch of days together with the next."""
    events = tune(spark).read.parquet(f"{sf_dir}/events.parquet")
    number = F.floor((F.dayofmonth("ts") - 1) / F.lit(BATCH_DAYS)) + F.when(F.col("event_id") % LATER == 0, 1).otherwise(0)
    return [only_layer(events_as_readings(events.where(number == k)), MAINS) for k in range(31 // BATCH_DAYS + 2)]


def _feed(spark: SparkSession, sf_dir: str, folder: str, step: Callable[[DataFrame], None]) -> None:
    """Write the batches one after the other, and let ``step`` take what is new of their stream after each."""
    for batch in _event_batches(spark, sf_dir):
        batch.select(*READING_COLUMNS).write.mode("append").parquet(folder)
        step(spark.readStream.schema(batch.select(*READING_COLUMNS).schema).parquet(folder))


def q_rt_late_power_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows with state over several micro-batches, readings of closed ones from the side table."""
    root = fresh_dir(tune(spark), "late")

    def step(mains: DataFrame) -> None:
        _finish(start_parting(mains, root, f"{root}/parting", WINDOW_SECONDS, LATE_SECONDS, trigger=None))
        _finish(start_windows(spark, root, f"{root}/windows", WINDOW_SECONDS, LATE_SECONDS, trigger=None))

    _feed(spark, sf_dir, f"{root}/readings", step)
    return rounded(_epoch_windows(read_windows(spark, root)), "late_watts_sum")


def q_rt_power_merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed live table after several micro-batches, each merged as it comes."""
    root = fresh_dir(tune(spark), "live")
    _feed(spark, sf_dir, f"{root}/readings", lambda mains: _finish(start_mains_power(mains, root, f"{root}/checkpoint", WINDOW, trigger=None, merge=True)))
    return _epoch_windows(tables.read(spark, root, tables.RT_POWER))


def q_rt_batch_power_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of several micro-batches that is packed meanwhile."""
    root = fresh_dir(tune(spark), "live")

    def step(mains: DataFrame) -> None:
        _finish(start_batch_power(mains, root, f"{root}/checkpoint", trigger=None))
        tables.pack_log(spark, root, BATCH_POWER, fan_in=2)

    _feed(spark, sf_dir, f"{root}/readings", step)
    log = tables.read_log(spark, root, BATCH_POWER)
    return rounded(log.groupBy("house_id", "date", "zip").agg(F.sum("watts_sum").alias("watts_sum")), "watts_sum")


_split: dict[tuple[str, str], str] = {}


def _split_root(spark: SparkSession, sf_dir: str) -> str:
    """Tables that three runs have filled: the mornings, the afternoons, and readings strewn over both."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _split:
        root, ts = fresh_dir(tune(spark), "runs"), F.col("ts")
        strewn, morning = ts % 7 == 0, ts % 86_400 < 43_200
        for part, condition in (("afternoon", ~strewn & ~morning), ("strewn", strewn), ("morning", ~strewn & morning)):
            run_batch(pack_readings(_readings(spark, sf_dir).where(condition)), root, part)
        _split[key] = root
    return _split[key]


def q_batch_runs_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy of days that came in several runs."""
    root = _split_root(spark, sf_dir)
    both = tables.read(spark, root, tables.MAINS_ENERGY).unionByName(tables.read(spark, root, tables.APPLIANCE_ENERGY))
    return rounded(both, "kwh")


def q_batch_runs_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tables.read(spark, _split_root(spark, sf_dir), tables.APPLIANCE_SHARE), "percent")


def q_batch_runs_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles over all days and runs of a meter, from its stored sketches."""
    return tables.read(spark, _split_root(spark, sf_dir), tables.METER_STATS)


def q_batch_file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three runs over a growing folder have taken in: good files first, then files of another kind, then nothing new."""
    root = fresh_dir(tune(spark), "ledger")
    messages = to_messages(pack_readings(_readings(spark, sf_dir)), "meters_hf", "meters_lf").select("value")
    other = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("props").alias("value"))
    for name, lines in (("good", messages), ("other", other), (None, None)):
        if name:
            lines.write.text(f"{root}/in/{name}")
        ingest(spark, root, f"{root}/in")
    taken = runs.read(spark, root, runs.READINGS).select(F.lit("accepted").alias("outcome"))
    aside = read_quarantine(spark, root).select(F.col("reason").alias("outcome"))
    return taken.unionByName(aside).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def q_json_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose schema comes from their own lines."""
    path = fresh_dir(tune(spark), "json-lines")
    to_messages(pack_readings(_readings(spark, sf_dir)), "meters_hf", "meters_lf").select("value").write.text(path)
    payload = F.array_join(F.transform("readings", lambda r: F.concat_ws(":", r["meterId"], r["power"], r["label"])), ",")
    return infer_records(spark, path).select("timestamp", F.col("houseId").alias("house_id"), "zip", payload.alias("payload"))


def q_topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of a topic in plain hour folders."""
    root = fresh_dir(tune(spark), "topics")
    write_topic(pack_readings(_readings(spark, sf_dir)), root, "meters")
    year, month, day = map(int, ONE_DATE.split("-"))
    return expand_readings(read_topic(spark, root, "meters", year, month, day))


def q_clean_days_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that are clean on every channel of a house."""
    return clean_days_of_all(_readings(spark, sf_dir), _anchor(), ALL_GAP)


def q_replicate_days_drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replay with each channel's drawn factor."""
    clean = tables.stage(_clean_days(spark, sf_dir), "clean-days")
    return replicate_days(_readings(spark, sf_dir), clean)


def q_house_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of every house number from the first to the last user, known or drawn."""
    events = tune(spark).read.parquet(f"{sf_dir}/events.parquet")
    first, last = events.agg(F.min("user_id"), F.max("user_id")).first()
    houses = house_range(spark, first, last)
    return rounded(assign_houses(houses, read_known_houses(spark, sf_dir), read_zip_table(spark, sf_dir), HOUSE_SEED), "scale")


def q_zip_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_zips(read_zip_table(tune(spark), sf_dir), MANY_ZIPS, ZIP_SEED)


def q_replay_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel files to clean days to the records of other houses that replay them, and these expanded."""
    readings, work = _readings(spark, sf_dir), fresh_dir(spark, "chain")
    files.write_channels(readings, f"{work}/channels")
    channels = files.read_channels(spark, f"{work}/channels")
    files.write_clean_days(clean_days_of(channels, _anchor(), CHAIN_GAP), f"{work}/days")
    files.write_labels(readings.groupBy("house_id", "meter_id").agg(F.min("label").alias("label")), f"{work}/labels")
    clean, labels = files.read_clean_days(spark, f"{work}/days"), files.read_labels(spark, f"{work}/labels")
    records = replay_records(channels, tables.stage(clean, "clean-days"), tables.stage(labels, "labels"), read_source_houses(spark, sf_dir), days=CHAIN_DAYS, shared=True)
    return expand_readings(records).select("house_id", "ts", "zip", "label", "meter_id", "power")


_served: dict[tuple[str, str], str] = {}


def _serving_root(spark: SparkSession, sf_dir: str) -> str:
    """The batch job's tables for ``sf_dir``, filled once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _served:
        root = fresh_dir(spark, "serving")
        run_batch(pack_readings(_readings(spark, sf_dir)), root)
        _served[key] = root
    return _served[key]


def _served_table(spark: SparkSession, sf_dir: str, table: tables.Table) -> DataFrame:
    return tables.read(tune(spark), _serving_root(spark, sf_dir), table)


def q_batch_appliance_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_served_table(spark, sf_dir, tables.APPLIANCE_SHARE), "percent")


def q_batch_meter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served_table(spark, sf_dir, tables.METER_STATS)


def q_geo_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tables.geo_on_date(_served_table(spark, sf_dir, tables.GEO_ENERGY), ONE_DATE), "kwh")


def q_house_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tables.house_history(_served_table(spark, sf_dir, tables.MAINS_ENERGY), ONE_HOUSE), "kwh")


def q_house_history_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the files that may have the house, by the table's index."""
    rows = tables.read_value(tune(spark), _serving_root(spark, sf_dir), tables.MAINS_ENERGY, ONE_HOUSE)
    return rounded(rows.orderBy("date", "zip", "label"), "kwh")


def q_appliance_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    appliance = _served_table(spark, sf_dir, tables.APPLIANCE_ENERGY)
    return rounded(tables.appliance_breakdown(appliance, ONE_HOUSE, ONE_DATE), "kwh")


def all_queries() -> dict[str, Query]:
    found = {name[2:]: value for name, value in globals().items() if name.startswith("q_")}
    return dict(found)
