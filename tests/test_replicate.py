from pyspark.sql import functions as F

from tests.conftest import rows_of
from wattloom.operators.replicate import channel_factor, replay_plan, replicate_days

DAY = 86_400
START = 1_303_171_200


def days(spark, *numbers):
    return spark.createDataFrame([(1, START + n * DAY) for n in numbers], "house_id bigint, day_start bigint")


def test_plan_is_cyclic(spark):
    plan = {row.day_start: row.slots for row in replay_plan(days(spark, 0, 3)).collect()}
    assert plan == {START: list(range(0, 30, 2)), START + 3 * DAY: list(range(1, 30, 2))}


def test_more_clean_days_than_the_calendar(spark):
    plan = rows_of(replay_plan(days(spark, *range(40))).select("day_start", F.size("slots")))
    assert plan == [(START + n * DAY, 1) for n in range(30)]


def test_factor_one_gives_back_the_days(spark, readings_of):
    frame = readings_of(*[(1, "3", START + d * DAY + s, "x", d * 10 + s / 4) for d in range(4) for s in (0, 7, 99)])
    replayed = replicate_days(frame, days(spark, 1, 2), factor=F.lit(1.0))
    assert replayed.count() == 90
    back = rows_of(replayed.where("day_no < 2"), "ts", "power")
    assert back == rows_of(frame.where(f"ts >= {START + DAY} and ts < {START + 3 * DAY}"), "ts", "power")


def test_scale_shift_and_round(spark, readings_of):
    frame = readings_of((1, "3", START + 5, "x", 10.5))
    replayed = replicate_days(frame, days(spark, 0), days=2, factor=F.lit(0.95), shift=-100)
    assert rows_of(replayed) == [
        (1, "3", 0, START + 5 - 100, float("%.2f" % (10.5 * 0.95))),
        (1, "3", 1, START + DAY + 5 - 100, float("%.2f" % (10.5 * 0.95))),
    ]


def test_channel_factor_is_repeatable_and_close_to_one(spark):
    channels = spark.range(500).select((F.col("id") % 50).alias("house_id"), (F.col("id") % 7).cast("string").alias("meter_id"))
    first, second, other = (rows_of(channels.select("house_id", "meter_id", channel_factor(s))) for s in (1, 1, 2))
    assert first == second != other
    assert all(0.95 <= row[2] < 1.05 for row in first)
    assert len({row[2] for row in first}) > 300
