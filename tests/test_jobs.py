"""Whole jobs, plans and the registered queries."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry
from tests.conftest import rows_of
from tests.oracle import compare, connect
from wattloom.operators.energy import label_day_energy, meter_day_energy
from wattloom.operators.readings import expand_readings, pack_readings, parse_json, to_messages
from wattloom.operators.replicate import replicate_days
from wattloom.operators.share import appliance_share
from wattloom.operators.stats import meter_p97
from wattloom.plans import batch, prep
from wattloom.plans.batch import run_batch
from wattloom.plans.oracles import all_oracles as oracle_sql
from wattloom.plans.prep import clean_days_of, replay_records
from wattloom.plans.queries import all_queries as queries
from wattloom.sources import tables
from wattloom.sources.quarantine import read_quarantine

SF_DIR = "/root/testdata/sf0.01"
START = 1_303_171_200
DAY = 86_400


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def final_plan(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


ROWS_ONLY = {"hourly_scan", "table_upsert", "rt_mains_power_stream", "rt_mains_power_merge", "rt_batch_power_stream",
             "overshoot_alerts_stream", "batch_appliance_share", "batch_meter_stats", "rt_record_power_stream", "batch_quarantine",
             "rt_late_power_stream", "rt_power_merge_batches", "rt_batch_power_packed", "batch_runs_energy", "batch_runs_share", "batch_runs_stats",
             "batch_file_ledger", "topic_scan", "house_history_indexed"}


@pytest.mark.parametrize("name", sorted(set(queries()) - ROWS_ONLY))
def test_no_python_and_no_cross_join_in_plans(spark, name):
    plan = final_plan(queries()[name](spark, SF_DIR))
    assert not re.search(r"EvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("name, exchanges", [
    ("geo_energy", 4), ("meter_day_energy", 2), ("appliance_share", 4), ("meter_p97", 1), ("channel_counts", 1),
    ("pack_readings", 3), ("pack_readings_unique", 2), ("rt_mains_power", 1), ("layer_split", 0),
    # Small stored lists are broadcast; the readings stay where they are.
    ("overshoot_alerts", 0), ("label_lookup", 0), ("clean_day_readings", 0), ("replicate_days", 2),
])
def test_number_of_exchanges(spark, name, exchanges):
    plan = final_plan(queries()[name](spark, SF_DIR))
    assert len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)", plan)) == exchanges


def test_scan_reads_only_what_it_needs(spark):
    schema = re.search(r"ReadSchema: (\S+)", final_plan(queries()["channel_counts"](spark, SF_DIR))).group(1)
    assert "value" not in schema and "ts" not in schema


def random_readings(spark, n=4000):
    h = F.xxhash64("id")
    meter = F.pmod(h, F.lit(5)) + 1
    return spark.range(n).select(
        F.pmod(F.shiftright(h, 8), F.lit(6)).alias("house_id"),
        (F.lit(START) + F.pmod(F.shiftright(h, 16), F.lit(3 * DAY))).alias("ts"),
        F.format_string("%05d", F.pmod(F.shiftright(h, 24), F.lit(2))).alias("zip"),
        F.when(meter <= 2, "mains").otherwise(F.concat(F.lit("app"), meter.cast("string"))).alias("label"),
        meter.cast("string").alias("meter_id"),
        (F.pmod(F.shiftright(h, 32), F.lit(1000)) / 4).alias("power"),
    ).withColumn("date", F.from_unixtime("ts", "yyyy-MM-dd"))


def test_batch_job_from_json(spark, tmp_path):
    readings = random_readings(spark)
    lines, root = f"{tmp_path}/lines", f"{tmp_path}/tables"
    to_messages(pack_readings(readings), "hf", "lf").select("value").write.text(lines)
    run_batch(parse_json(spark.read.text(lines)), root)
    days = label_day_energy(meter_day_energy(readings))
    columns = ["house_id", "date", "zip", "label", F.round("kwh", 9)]
    for table, layer in ((tables.MAINS_ENERGY, "mains"), (tables.APPLIANCE_ENERGY, "appliance")):
        assert rows_of(tables.read(spark, root, table), *columns) == rows_of(days.where(F.col("layer") == layer), *columns)
    share = ["house_id", "date", "zip", "label", F.round("percent", 6)]
    assert rows_of(tables.read(spark, root, tables.APPLIANCE_SHARE), *share) == rows_of(appliance_share(days), *share)
    assert rows_of(tables.read(spark, root, tables.METER_STATS)) == rows_of(meter_p97(readings))
    geo = tables.read(spark, root, tables.GEO_ENERGY).agg(F.sum("kwh")).first()[0]
    assert geo == pytest.approx(days.where("layer = 'mains'").agg(F.sum("kwh")).first()[0])


def test_batch_job_sets_rejects_aside(spark, tmp_path):
    good = '{"timestamp": "1303171200", "houseId": 1, "zip": "z", "readings": [%s]}'
    reading = '{"meterId": %s, "power": "%s", "label": "mains"}'
    lines = [good % ", ".join([reading % ('"1"', "5"), reading % ('"2"', "x"), reading % ("null", "7"), reading % ('"m"', "7")]), "{broken", '{"timestamp": "soon"}']
    records = parse_json(spark.createDataFrame([(x,) for x in lines], "value string"))
    for _ in range(2):
        run_batch(records, str(tmp_path))
        found = read_quarantine(spark, str(tmp_path))
        assert rows_of(found, "reason") == [("malformed",), ("meter",), ("meter",), ("power",), ("timestamp",)]
        assert found.where("original LIKE '%{broken%' AND reason = 'malformed'").count() == 1
    assert tables.read(spark, str(tmp_path), tables.MAINS_ENERGY).count() == 1


def test_batch_job_leaves_no_working_folders(spark, tmp_path, monkeypatch):
    made = []

    def fresh(session, name):
        made.append(tmp_path / f"work-{len(made)}-{name}")
        return str(made[-1])

    for module in (batch, tables):
        monkeypatch.setattr(module, "fresh_dir", fresh)
    for _ in range(2):
        run_batch(pack_readings(random_readings(spark, 200)), str(tmp_path / "tables"))
    assert made and not any(path.exists() for path in made)


def test_prep_job(spark):
    seconds = F.explode(F.sequence(F.lit(0), F.lit(4 * DAY - 1), F.lit(600))).alias("s")
    channels = (
        spark.createDataFrame([(h, m) for h in (1, 2) for m in ("1", "2", "3")], "house_id bigint, meter_id string")
        .select("house_id", "meter_id", seconds)
        # House 2 has a hole in channel 3 on its second day.
        .where(~((F.col("house_id") == 2) & (F.col("meter_id") == "3") & F.col("s").between(DAY + 9000, DAY + 15000)))
        .select("house_id", "meter_id", (F.lit(START) + F.col("s")).alias("ts"), F.lit(8.0).alias("power"))
    )
    clean = clean_days_of(channels, START)
    assert rows_of(clean) == [(1, START), (1, START + DAY), (1, START + 2 * DAY), (2, START), (2, START + 2 * DAY)]
    labels = spark.createDataFrame(
        [(h, m, "mains" if m < "3" else "oven") for h in (1, 2) for m in ("1", "2", "3")],
        "source_house int, meter_id string, label string",
    )
    houses = spark.createDataFrame([(70, 1, "02366", 0.5), (71, 2, "00001", 1.0), (72, 2, "00001", 1.0)],
                                   "house_id bigint, source_house int, zip string, scale double")
    records = replay_records(channels, clean, labels, houses, days=6, scaled=True)
    rows = expand_readings(records)
    per_house = {r.house_id: r for r in rows.groupBy("house_id").agg(
        F.count("*").alias("n"), F.max("power").alias("top"), F.countDistinct("label").alias("labels")).collect()}
    # Six days of 144 seconds and three channels; only whole days of house 2 are replayed.
    assert {h: r.n for h, r in per_house.items()} == {70: 6 * 144 * 3, 71: 6 * 144 * 3, 72: 6 * 144 * 3}
    assert per_house[70].top <= 8 * 1.05 * 0.5 and per_house[71].labels == 2


def test_houses_of_one_source_share_their_records(spark):
    """Records are packed once for each set of sources, and houses that repeat or are null have all that they replay."""
    channels = spark.createDataFrame(
        [(h, m, START + s, 8.0 + s) for h in (1, 2) for m in ("1", "3") for s in (0, 0, 600, 1200)],
        "house_id bigint, meter_id string, ts bigint, power double",
    )
    clean = spark.createDataFrame([(1, START), (2, START)], "house_id bigint, day_start bigint")
    labels = spark.createDataFrame([(1, "1", "mains"), (1, "3", "oven")], "source_house int, meter_id string, label string")
    given = [(70, 1, "02366", 2.0), (71, 1, "02366", 2.0), (71, 1, "02366", 2.0), (71, 2, "02366", 1.0), (72, 2, "00001", None),
             (None, 1, None, 2.0), (None, 2, "00001", 1.0), (73, None, "00001", 1.0), (74, 9, "00001", 1.0), (75, 1, "00002", 3.0)]
    houses = spark.createDataFrame(given, "house_id bigint, source_house int, zip string, scale double")
    for scaled in (False, True):
        records = replay_records(channels, clean, labels, houses, days=2, scaled=scaled)
        flat = replicate_days(channels, clean, days=2).withColumnRenamed("house_id", "source_house")
        flat = flat.join(labels, ["source_house", "meter_id"], "left").join(houses, "source_house")
        power = F.col("power") * F.col("scale") if scaled else F.col("power")
        plain = pack_readings(flat.select("house_id", "ts", "zip", "label", "meter_id", power.alias("power")))
        text = [F.to_json(F.struct(*plain.columns)).alias("record")]
        assert records.schema.simpleString() == plain.schema.simpleString()
        assert rows_of(records.select(text)) == rows_of(plain.select(text))
        # The houses come in above the packing, so nothing is packed or shuffled house by house.
        above_packing = records._jdf.queryExecution().optimizedPlan().toString().split("collect_list(struct(channel")[0]
        assert "Join" in above_packing


def test_shared_records_expand_to_the_readings_of_every_house(spark, monkeypatch):
    """Lists of houses, however long, give each house the readings of its own records; a null house gives none."""
    monkeypatch.setattr(prep, "HOUSE_BLOCK", 3)
    channels = spark.createDataFrame(
        [(h, m, START + s, 8.0 + s) for h in (1, 2) for m in ("1", "3") for s in (0, 0, 600)] + [(1, "x", START, 4.0), (1, "1", START, None)],
        "house_id bigint, meter_id string, ts bigint, power double",
    )
    clean = spark.createDataFrame([(1, START), (2, START)], "house_id bigint, day_start bigint")
    labels = spark.createDataFrame([(1, "1", "mains"), (1, "3", "oven")], "source_house int, meter_id string, label string")
    given = [(h, h % 3, f"{h % 4:05d}", 1.0) for h in range(70, 90)] + [(70, 1, "00002", 1.0), (71, 1, None, 1.0), (None, 1, "00001", 1.0), (None, 2, None, 1.0)]
    houses = spark.createDataFrame(given, "house_id bigint, source_house int, zip string, scale double")
    of_each, shared = (replay_records(channels, clean, labels, houses, days=2, shared=shared) for shared in (False, True))
    assert shared.count() < of_each.count()
    assert expand_readings(shared).schema.simpleString() == expand_readings(of_each).schema.simpleString()
    rows = rows_of(expand_readings(shared))
    assert rows == rows_of(expand_readings(of_each))
    assert {r[0] for r in rows} == {h for h in range(70, 90) if h % 3} and {r[5] for r in rows} == {"1", "3"}
    # Where neither side is broadcast, few bytes go to as many tasks: what comes of them is their product.
    with_merge = spark.newSession()
    with_merge.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    channels, clean, labels, houses = (with_merge.createDataFrame(f.collect(), f.schema) for f in (channels, clean, labels, houses))
    merged = expand_readings(replay_records(channels, clean, labels, houses, days=2, shared=True))
    assert rows_of(merged) == rows and merged._jdf.queryExecution().toRdd().getNumPartitions() == 4 * prep.RECIPE_PARTS


def test_replay_reads_the_text_of_a_record_once_for_all_its_houses(spark, tmp_path):
    """Above the place where houses come in, the registered query parses nothing: its rows are copies there."""
    spark.sql("SELECT id AS event_id, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 3600) AS ts, 1 + id % 2 AS user_id, "
              "'view' AS event_type, 1.5D AS value, '' AS props FROM range(100)").write.parquet(str(tmp_path / "events.parquet"))
    spark.sql("SELECT id AS s_suppkey, CAST(id % 25 AS int) AS s_nationkey FROM range(100)").write.parquet(str(tmp_path / "supplier.parquet"))
    plan = queries()["replay_chain"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    above_houses, found, below = plan.partition("Generate inline(")
    assert found and "RLIKE" not in above_houses and "try_cast" not in above_houses
    assert "RLIKE" in below.split("Join")[0]


def test_a_run_of_copies_is_written_by_many_tasks(spark, readings_of, tmp_path):
    few = readings_of(*[(house, "1", START + 100 * step, "mains", 5.0) for house in range(4) for step in range(10)])
    copied = few.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("copy")
    batch.take_in(pack_readings(copied), str(tmp_path), "one", None, None)
    rows = spark.read.parquet(f"{tmp_path}/ingest/runs/one/rows/outcome=accepted")
    files = [r.n for r in rows.groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(files) == 2_000 and max(files) < 1_000


def test_a_hot_meter_and_second_stay_exact(spark):
    """A third of all readings in one second of one meter: the collapse must carry the count."""
    cold = random_readings(spark)
    hot = spark.range(2000).select(
        F.lit(1).cast("bigint").alias("house_id"), F.lit(START + 50).cast("bigint").alias("ts"), F.lit("00000").alias("zip"),
        F.lit("mains").alias("label"), F.lit("1").alias("meter_id"), (F.col("id") % 97).cast("double").alias("power"),
    ).withColumn("date", F.from_unixtime("ts", "yyyy-MM-dd"))
    both = cold.unionByName(hot)
    one = F.col("house_id").eqNullSafe(1) & (F.col("meter_id") == "1") & (F.col("zip") == "00000") & (F.col("date") == "2011-04-19")
    collapsed = meter_day_energy(both).where(one).first()
    plain = meter_day_energy(both, collapse=False).where(one).first()
    assert collapsed.n_readings == plain.n_readings > 2000
    assert collapsed.joules == pytest.approx(plain.joules)
