from tests.conftest import rows_of
from wattloom.operators.alerts import overshoot_alerts
from wattloom.operators.share import appliance_share, appliance_share_joined
from wattloom.operators.stats import meter_p97

DAYS = "layer string, house_id bigint, label string, zip string, date string, kwh double"


def label_days(spark, *rows):
    return spark.createDataFrame([(layer, 1, label, "02366", "2011-05-21", kwh) for layer, label, kwh in rows], DAYS)


def both_forms(spark, *rows):
    frame = label_days(spark, *rows)
    window = rows_of(appliance_share(frame), "label", "percent")
    mains, appliance = (frame.where(f"layer = '{layer}'").drop("layer") for layer in ("mains", "appliance"))
    assert rows_of(appliance_share_joined(appliance, mains), "label", "percent") == window
    return window, rows_of(appliance_share_joined(appliance, mains, strict=True), "label", "percent")


def test_share(spark):
    assert both_forms(spark, ("appliance", "oven", 2.0), ("mains", "mains", 8.0))[0] == [("oven", 25.0)]


def test_tiny_mains_give_zero(spark):
    assert both_forms(spark, ("appliance", "oven", 2.0), ("mains", "mains", 0.000009))[0] == [("oven", 0.0)]


def test_missing_mains_give_zero(spark):
    window, strict = both_forms(spark, ("appliance", "oven", 2.0))
    assert window == strict == [("oven", 0.0)]


def test_two_mains_labels(spark):
    window, strict = both_forms(spark, ("appliance", "oven", 2.0), ("mains", "mains", 8.0), ("mains", "NONE", 0.0))
    assert window == [("oven", 25.0)]
    assert strict == [("oven", 0.0), ("oven", 25.0)]


def test_p97_takes_active_power_only(readings_of):
    rows = [(1, "3", i, "x", p) for i, p in enumerate((0, 0.00001, 5, 6))]
    assert rows_of(meter_p97(readings_of(*rows))) == [(1, "3", 6.0)]


def test_p97_spans_zips_and_days(readings_of):
    rows = [(1, "3", i * 90_000, "x", i + 1, f"0000{i % 3}") for i in range(100)]
    assert rows_of(meter_p97(readings_of(*rows))) == [(1, "3", 97.0)]


def test_alerts(spark, readings_of):
    stats = spark.createDataFrame([(1, "3", 100.0)], "house_id bigint, meter_id string, p97 double")
    frame = readings_of((1, "3", 1, "x", 100), (1, "3", 2, "x", 101), (1, "3", 3, "x", 120), (1, "4", 4, "x", 999))
    assert rows_of(overshoot_alerts(frame, stats), "ts", "power", "p97") == [(2, 101.0, 100.0), (3, 120.0, 100.0)]
    assert rows_of(overshoot_alerts(frame, stats, margin=0.1), "ts") == [(3,)]
    assert rows_of(overshoot_alerts(frame, stats, salts=4)) == rows_of(overshoot_alerts(frame, stats))
