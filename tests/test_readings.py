import json
import re

import pytest

from tests.conftest import rows_of
from wattloom.functions.days import day_floor, day_index, parse_anchor, ts_to_date, SHORT_DATE_FORMAT
from wattloom.functions.parsing import parse_power, parse_seconds
from wattloom.functions.units import joules_to_kwh, two_decimals
from wattloom.operators import readings as R
from pyspark.sql import functions as F

TS = 1_306_006_763


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_dates(spark):
    assert one(spark, ts_to_date(F.lit(TS)), ts_to_date(F.lit(TS), SHORT_DATE_FORMAT)) == ("2011-05-21", "05/21/11")


def test_dates_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, ts_to_date(F.lit(1306029600)), parse_anchor("04/19/2011:00:00:00")) == ("2011-05-21", 1303185600)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_functions(spark):
    assert one(spark, day_floor(F.lit(TS)), day_index(F.lit(TS), 1_305_936_000), day_index(F.lit(-1))) == (
        1_305_936_000,
        0,
        -1,
    )
    assert one(spark, parse_anchor("not a date")) == (None,)


def test_kwh(spark):
    assert one(spark, joules_to_kwh(F.lit(3_600_000.0))) == (1.0,)


def test_two_decimals_rounds_like_printf(spark):
    values = [9.975, 0.125, 0.375, 0.285, 1234567.891, 0.0, 2.5, -0.005, -3.14159]
    got = [one(spark, two_decimals(F.lit(v)))[0] for v in values]
    assert got == ["%.2f" % v for v in values]


def test_number_parsing(spark):
    texts = ["1.5", " 12 ", "1e3", ".5", "5.", "1d", "NaN", "Infinity", "abc", "", "1e999", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_power(F.col("t")), parse_seconds(F.col("t")))
    assert [r[0] for r in frame.collect()] == [1.5, 12.0, 1000.0, 0.5, 5.0] + [None] * 7
    assert [r[1] for r in frame.collect()] == [None, 12] + [None] * 10


def record(ts=TS, house=1, readings=(("1", "10.5", "mains"), ("2", "20.0", "mains")), **other):
    packed = None if readings is None else [dict(meterId=m, power=p, label=l) for m, p, l in readings]
    return json.dumps({"timestamp": str(ts), "houseId": house, "zip": "02366", "readings": packed, **other})


def parsed(spark, *lines):
    return R.parse_json(spark.createDataFrame([(line,) for line in lines], "value string"))


def test_expand(spark):
    rows = rows_of(R.expand_readings(parsed(spark, record())))
    assert rows == [
        (1, "2011-05-21", TS, "02366", "mains", "1", 10.5),
        (1, "2011-05-21", TS, "02366", "mains", "2", 20.0),
    ]


def test_numbers_are_taken_as_text(spark):
    line = '{"timestamp": 1306006763, "houseId": 1, "zip": 12345, "readings": [{"meterId": 1, "power": 10.5, "label": "mains"}]}'
    assert rows_of(R.expand_readings(parsed(spark, line)), "ts", "zip", "meter_id", "power") == [(TS, "12345", "1", 10.5)]


def test_bad_records_are_set_aside(spark):
    frame = parsed(
        spark, record(readings=()), record(readings=None), "{broken", record(ts="soon"), record(house=None), record()
    )
    assert R.expand_readings(frame).count() == 2
    assert [r[0] for r in rows_of(R.rejected_records(frame), "reject_reason")] == ["house", "malformed", "readings", "timestamp"]


def test_bad_readings_are_set_aside(spark):
    frame = parsed(spark, record(readings=(("1", "x", "mains"), ("2", "NaN", "mains"), ("3", "7", "oven"))))
    assert rows_of(R.expand_readings(frame), "meter_id", "power") == [("3", 7.0)]
    assert rows_of(R.rejected_readings(frame), "meter_id", "power_text") == [("1", "x"), ("2", "NaN")]


def test_layers(readings_of):
    frame = readings_of(*[(1, str(m), TS, "x", 1) for m in (1, 2, 3, 10)])
    assert rows_of(R.with_layer(frame), "meter_id", "layer") == [
        ("1", "mains"), ("10", "appliance"), ("2", "mains"), ("3", "appliance"),
    ]


def test_record_power(spark):
    frame = parsed(spark, record(), record(readings=(("1", "5", "mains"),)), record(readings=(("1", "5", "m"), ("2", "x", "m"))))
    assert rows_of(R.record_mains_power(frame), "house_id", "zip", "power") == [(1, "02366", 30.5)]
    assert R.rejected_mains_records(frame).count() == 2


def test_pack_then_expand_is_the_identity(readings_of):
    rows = [(h, str(m), TS + s, f"l{m}", m * 1.25, "02366") for h in (1, 2) for m in (1, 2, 3, 4, 11) for s in (0, 1, 5)]
    rows += [rows[0]] * 3 + [(1, "3", TS, "other", 9.0, "02366")]
    frame = readings_of(*rows)
    assert rows_of(R.expand_readings(R.pack_readings(frame))) == rows_of(frame)


def test_pack_puts_one_reading_per_meter_in_a_record(readings_of):
    frame = readings_of((1, "10", TS, "a", 1), (1, "3", TS, "b", 2), (1, "3", TS, "b", 2), (1, "3", TS, "b", 5))
    packed = R.pack_readings(frame).orderBy("record_no").collect()
    assert [[(r.meterId, r.power) for r in row.readings] for row in packed] == [
        [("3", "2.0"), ("10", "1.0")], [("3", "2.0")], [("3", "5.0")],
    ]


def test_many_copies_survive_packing(readings_of, monkeypatch):
    monkeypatch.setattr(R, "COPY_BLOCK", 7)
    frame = readings_of(*[(1, "1", TS, "mains", 4)] * 50, *[(1, "2", TS, "mains", 6)] * 23)
    packed = R.pack_readings(frame)
    assert packed.count() == 50
    assert rows_of(R.expand_readings(packed)) == rows_of(frame)


def test_one_per_meter_gives_the_same_records(readings_of):
    rows = [(h, str(m), TS + s, f"l{m}", m * 1.25) for h in (1, 2) for m in (1, 2, 3, 11) for s in range(5)]
    quick = R.pack_readings(readings_of(*rows), one_per_meter=True)
    assert rows_of(quick.select(F.to_json(F.struct("*")))) == rows_of(
        R.pack_readings(readings_of(*rows)).select(*quick.columns).select(F.to_json(F.struct("*")))
    )
    assert quick._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_step_takes_the_time_of_the_first_channel(readings_of):
    base = TS - TS % 60
    frame = readings_of((1, "2", base + 3, "mains", 7), (1, "1", base + 9, "mains", 8), (1, "1", base + 30, "mains", 1))
    packed = R.pack_readings(frame, 60).orderBy("record_no").collect()
    assert [(row.timestamp, len(row.readings)) for row in packed] == [(str(base + 9), 2), (str(base + 30), 1)]


def test_messages_are_routed_by_layer(readings_of):
    packed = R.pack_readings(readings_of((7, "1", TS, "mains", 1), (7, "3", TS, "oven", 2)))
    messages = {m.topic: (m.key, json.loads(m.value)) for m in R.to_messages(packed, "hf", "lf").collect()}
    assert messages["hf"][0] == "7"
    assert messages["lf"][1] == {
        "timestamp": str(TS), "zip": "00001", "houseId": 7,
        "readings": [{"meterId": "3", "power": "2.0", "label": "oven"}],
    }


def test_a_second_reading_of_a_meter_fails_the_short_way(spark, readings_of):
    frame = readings_of((1, "3", 5, "x", 1), (1, "3", 5, "x", 2))
    with pytest.raises(Exception, match="two readings in one step"):
        R.pack_readings(frame, one_per_meter=True).collect()
    assert R.pack_readings(frame).count() == 2


def test_records_of_copies_are_built_by_many_tasks(readings_of):
    """Copies are counted before the shuffle, so its few bytes must not merge the building of records into one task."""
    few = readings_of(*[(house, "1", 100 * step, "mains", 5.0) for house in range(4) for step in range(10)])
    packed = R.pack_readings(few.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("copy"))
    built = packed.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in built) == 2_000
    assert len(built) > 1 and max(r.n for r in built) < 1_000


def test_counting_shuffles_what_readings_have(spark, readings_of):
    """Layer and step follow from meter and time, so they are in no row that is counted; a given layer is kept."""
    few = readings_of((1, "1", TS, "mains", 5), (1, "3", TS + 1, "oven", 2))
    plan = R.pack_readings(few, 60)._jdf.queryExecution().optimizedPlan().toString()
    counted = plan.split("Aggregate [")[-1].split("]")[0]
    assert "meter_id" in counted and "layer" not in counted and "step_start" not in counted
    given = R.pack_readings(few.withColumn("layer", F.lit("other")), 60)
    assert rows_of(given, "layer", "step_start", "record_no") == [("other", TS - TS % 60, 1)]


def test_no_shuffle_of_packing_has_layer_or_step(spark, readings_of):
    few = readings_of((1, "1", TS, "mains", 5), (1, "3", TS + 1, "oven", 2))
    plan = spark._jvm.PythonSQLUtils.explainString(R.pack_readings(few, 60)._jdf.queryExecution(), "formatted")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\n", plan)
    assert len(shuffled) == 3 and all("meter_id" in columns for columns in shuffled)
    assert not any(name in columns for columns in shuffled for name in ("layer", "step_start"))


@pytest.mark.parametrize("step", [1, 60])
def test_null_and_repeated_readings_are_packed(spark, monkeypatch, step):
    """Each null counts as a value of its own; blocks of two readings put the third into another task."""
    monkeypatch.setattr(R, "COPY_BLOCK", 2)
    base = TS - TS % 60
    rows = [(1, base, "z", "a", "3", 5.0)] * 3 + [(None, base, "z", "a", "3", 5.0)] * 2 + [
        (1, None, "z", "a", "3", 5.0), (1, base, None, "a", "3", 5.0), (1, base, "z", None, "3", 5.0), (1, base, "z", "a", None, 5.0), (1, base, "z", "a", "3", None),
    ]
    frame = spark.createDataFrame(rows, "house_id bigint, ts bigint, zip string, label string, meter_id string, power double")
    packed = R.pack_readings(frame, step)
    entries = F.to_json("readings", {"ignoreNullFields": "false"})
    got = rows_of(packed, "houseId", "zip", "layer", "step_start", "record_no", entries)

    def entry(label="a", meter="3", power="5.0"):
        return json.dumps([{"meterId": meter, "power": power, "label": label}], separators=(",", ":"))

    both = [(1, "z", "appliance", base, n, e) for n, e in enumerate([entry(label=None), entry(power=None), entry(), entry(), entry()], 1)]
    first = both[0]
    with_null_meter = json.dumps([json.loads(e)[0] for e in (entry(meter=None), first[-1])], separators=(",", ":"))
    expected = [(*first[:-1], with_null_meter), *both[1:], *[(None, "z", "appliance", base, n, entry()) for n in (1, 2)], (1, None, "appliance", base, 1, entry()), (1, "z", "appliance", None, 1, entry())]
    assert got == sorted(expected, key=lambda t: tuple((v is not None, v) for v in t))
