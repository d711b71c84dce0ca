import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows_of
from wattloom.operators.energy import (
    collapse_ties,
    daily_energy,
    geo_energy,
    label_day_energy,
    meter_day_energy,
)

DAY = 1_700_006_400  # midnight UTC


def energy_of(frame, **kw):
    return rows_of(meter_day_energy(frame, **kw), "house_id", "meter_id", "label", "joules", "n_readings")


def test_worked_example(readings_of):
    frame = readings_of((1, "3", DAY + 1, "4", 3), (1, "3", DAY + 5, "2", 7), (1, "3", DAY + 3, "5", 9))
    assert energy_of(frame) == [(1, "3", "4", 24.0, 3)]
    assert energy_of(frame, collapse=False) == [(1, "3", "4", 24.0, 3)]


def test_single_reading_is_none(readings_of):
    frame = readings_of((1, "3", DAY, "a", 5), (2, "3", DAY, "a", 5), (2, "3", DAY + 1, "a", 5))
    assert energy_of(frame) == [(1, "3", "NONE", 0.0, 1), (2, "3", "a", 5.0, 2)]


def test_ties_let_the_last_reading_count(readings_of):
    frame = readings_of((1, "1", DAY + 10, "mains", 100), (1, "1", DAY + 10, "mains", 300), (1, "1", DAY + 20, "mains", 50))
    assert energy_of(frame) == [(1, "1", "mains", 3000.0, 3)]


def test_ties_over_labels_and_first_label(readings_of):
    frame = readings_of(
        (1, "3", DAY, "b", 1), (1, "3", DAY, "a", 1000), (1, "3", DAY, "b", 2), (1, "3", DAY + 10, "c", 7)
    )
    assert energy_of(frame) == [(1, "3", "a", 20.0, 4)]


def test_only_ties_have_a_label_but_no_energy(readings_of):
    frame = readings_of((1, "3", DAY, "b", 1), (1, "3", DAY, "a", 9))
    assert energy_of(frame) == [(1, "3", "a", 0.0, 2)]


def test_midnight_cuts_the_day(readings_of):
    frame = readings_of((1, "1", DAY - 10, "mains", 100), (1, "1", DAY + 10, "mains", 100))
    assert energy_of(frame) == [(1, "1", "NONE", 0.0, 1)] * 2


def test_zip_is_part_of_the_key(readings_of):
    rows = [(1, "1", DAY + i, "mains", 10, "02366" if i < 2 else "00002") for i in range(4)]
    assert rows_of(meter_day_energy(readings_of(*rows)), "zip", "joules") == [("00002", 10.0), ("02366", 10.0)]


def test_collapse_keeps_one_row_per_second_and_label(readings_of):
    rows = [(1, "1", DAY, "mains", i % 7) for i in range(500)] + [(1, "1", DAY + 5, "mains", 1)]
    assert rows_of(collapse_ties(readings_of(*rows)), "ts", "power", "n_readings") == [(DAY, 6.0, 500), (DAY + 5, 1.0, 1)]


def test_label_day_sums_meters_and_converts(readings_of):
    rows = [(1, m, DAY + s, "mains", p) for m, p in (("1", 1000.0), ("2", 2000.0)) for s in (0, 3600)]
    assert rows_of(daily_energy(readings_of(*rows), "mains"), "label", "kwh") == [("mains", 3.0)]


def test_geo_equals_mains_total(spark, readings_of):
    rng = random.Random(3)
    rows = [
        (rng.randrange(4), str(rng.randrange(1, 5)), DAY + rng.randrange(2 * 86400), "x", rng.randrange(500), f"0000{rng.randrange(3)}")
        for _ in range(400)
    ]
    days = label_day_energy(meter_day_energy(readings_of(*rows)))
    geo = sum(r[0] for r in rows_of(geo_energy(days), "kwh"))
    mains = sum(r[1] for r in rows_of(days, "layer", "kwh") if r[0] == "mains")
    assert geo == pytest.approx(mains, rel=1e-12)


def riemann(rows):
    """The definition, one meter-day at a time."""
    groups = {}
    for house, meter, ts, label, power, *zip_code in rows:
        groups.setdefault((house, meter, ts // 86400), []).append((ts, label, float(power)))
    result = []
    for (house, meter, _), readings in groups.items():
        ordered = sorted(readings)
        joules = sum((b[0] - a[0]) * a[2] for a, b in zip(ordered, ordered[1:]))
        label = ordered[0][1] if len(ordered) > 1 else "NONE"
        result.append((house, meter, label, float(joules), len(ordered)))
    return sorted(result)


reading = st.tuples(
    st.integers(1, 2),
    st.sampled_from(["1", "3"]),
    st.integers(0, 12).map(lambda s: DAY - 6 + s),
    st.sampled_from(["a", "b"]),
    st.integers(0, 5),
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(reading, min_size=1, max_size=40))
def test_energy_is_the_riemann_sum_in_any_order(readings_of, rows):
    assert energy_of(readings_of(*rows)) == energy_of(readings_of(*rows), collapse=False) == riemann(rows)
