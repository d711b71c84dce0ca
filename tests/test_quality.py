import random

import pytest

from tests.conftest import rows_of
from wattloom.operators.quality import channel_counts, clean_days, common_days, day_quality, days_of_all, gap_detect, readings_of_days

DAY = 86_400
START = 1_303_171_200  # a UTC midnight


def steady(start, end, step=500):
    return list(range(start, end, step))


def days_of(readings_of, seconds, anchor=START, **kw):
    frame = readings_of(*[(1, "1", ts, "mains", 1) for ts in seconds])
    return [(row[0] - anchor) // DAY for row in rows_of(clean_days(frame, ("house_id",), anchor, **kw), "day_start")]


def full_days(n):
    return steady(START, START + n * DAY)


def test_last_day_is_never_clean(readings_of):
    assert days_of(readings_of, full_days(3)) == [0, 1]


@pytest.mark.parametrize("before_end, clean", [(999, [0]), (1000, [])])
def test_end_of_day(readings_of, before_end, clean):
    day = [ts for ts in full_days(1) if ts < START + DAY - before_end] + [START + DAY - before_end]
    assert days_of(readings_of, day + [START + DAY]) == clean


@pytest.mark.parametrize("gap, clean", [(1000, [0]), (1001, [])])
def test_gap_inside_a_day(readings_of, gap, clean):
    day = [START + 100, START + 100 + gap] + steady(START + 100 + gap, START + DAY)
    assert days_of(readings_of, day + [START + DAY]) == clean


@pytest.mark.parametrize("late, clean", [(1000, [0, 1]), (1001, [0])])
def test_start_of_a_later_day(readings_of, late, clean):
    second = steady(START + DAY + late, START + 2 * DAY)
    assert days_of(readings_of, full_days(1) + second + [START + 2 * DAY]) == clean


def test_first_day_may_start_late(readings_of):
    assert days_of(readings_of, steady(START + 5000, START + DAY) + [START + DAY]) == [0]


def test_first_observed_day_may_be_any_day(readings_of):
    assert days_of(readings_of, steady(START + 2 * DAY + 9000, START + 3 * DAY) + [START + 3 * DAY + 7]) == [2]


def test_readings_before_the_anchor_do_not_count(readings_of):
    assert days_of(readings_of, steady(START - 3 * DAY, START + 2 * DAY)) == [0]


def test_empty_days_are_skipped(readings_of):
    later = [ts + 4 * DAY for ts in full_days(2)]
    assert days_of(readings_of, full_days(1) + later) == [0, 4]


def scan(seconds, anchor, limit):
    """Clean days by walking the readings in time order."""
    by_day = {}
    for ts in sorted(s for s in seconds if s >= anchor):
        by_day.setdefault((ts - anchor) // DAY, []).append(ts)
    observed = sorted(by_day)
    clean = []
    for day in observed[:-1]:
        times, begin = by_day[day], anchor + day * DAY
        gaps = [b - a for a, b in zip(times, times[1:])]
        starts = day == observed[0] or times[0] - begin <= limit
        if begin + DAY - times[-1] < limit and max(gaps, default=0) <= limit and starts:
            clean.append(day)
    return clean


@pytest.mark.parametrize("seed", range(4))
def test_against_a_walk(readings_of, seed):
    rng = random.Random(seed)
    seconds = [START - 4000 + rng.randrange(8 * DAY) for _ in range(900)]
    anchor = START + seed * 1234
    assert days_of(readings_of, seconds, anchor, max_gap=4000) == scan(seconds, anchor, 4000)


@pytest.mark.parametrize("limit", [50, 700])
def test_gaps_against_a_walk(readings_of, limit):
    rng = random.Random(limit)
    seconds = sorted(START + rng.randrange(2 * DAY) for _ in range(700))
    expected = [(a, b, b - a) for a, b in zip(seconds, seconds[1:]) if b - a > limit and a // DAY == b // DAY]
    frame = readings_of(*[(1, "1", ts, "mains", 1) for ts in seconds])
    assert rows_of(gap_detect(frame, max_gap=limit), "prev_ts", "ts", "gap") == expected


def test_day_quality(readings_of):
    frame = readings_of(*[(1, "1", START + s, "mains", 1) for s in (5, 5, 65, 300)], (1, "1", START + DAY, "mains", 1))
    assert rows_of(day_quality(frame, anchor=START)) == [
        (1, "1", START, START + 5, START + 300, 235, 4),
        (1, "1", START + DAY, START + DAY, START + DAY, 0, 1),
    ]


def test_channel_counts(readings_of):
    frame = readings_of((1, "1", 1, "m", 1), (1, "1", 2, "m", 1), (2, "3", 1, "x", 1))
    assert rows_of(channel_counts(frame)) == [(1, "1", 2), (2, "3", 1)]


def test_common_days(spark):
    left, right = (
        spark.createDataFrame(rows, "house_id bigint, day_start bigint")
        for rows in ([(1, 10), (1, 20), (2, 10)], [(1, 20), (2, 10), (2, 30)])
    )
    assert [tuple(r) for r in common_days(left, right).collect()] == [(1, 20), (2, 10)]


def test_readings_of_days_with_shifted_days(spark, readings_of):
    first = START + 3600
    days = spark.createDataFrame([(1, first), (1, first + 3 * DAY)], "house_id bigint, day_start bigint")
    seconds = [first - 1, first, START + DAY, first + DAY - 1, first + DAY, first + 3 * DAY + 5]
    frame = readings_of(*[(1, "1", ts, "mains", 1) for ts in seconds], (2, "1", first, "mains", 1))
    assert rows_of(readings_of_days(frame, days), "ts", "day_start") == [
        (first, first), (START + DAY, first), (first + DAY - 1, first), (first + 3 * DAY + 5, first + 3 * DAY),
    ]


def test_days_of_all_channels_of_a_house(spark):
    draw = random.Random(4)
    channels = {h: [str(m) for m in range(1, 2 + h)] for h in range(5)}
    listed = [(h, m, START + d * DAY) for h, ms in channels.items() for m in ms for d in range(60) if draw.random() < 0.9]
    listed += [(3, m, START + 40_000 * DAY) for m in channels[3]]  # beyond one bitmap
    listed = [r for r in listed if r[:2] != (4, "2")]  # a channel without any listed day
    known = spark.createDataFrame([(h, m) for h, ms in channels.items() for m in ms] * 2, "house_id bigint, meter_id string")
    days = spark.createDataFrame(listed + listed[:9], "house_id bigint, meter_id string, day_start bigint")
    expected = sorted((h, d) for h, ms in channels.items() for d in {r[2] for r in listed} if all((h, m, d) in set(listed) for m in ms))
    assert rows_of(days_of_all(days, known, anchor=START)) == expected and len(expected) > 20
    assert days_of_all(days.where("false"), known, anchor=START).count() == 0
