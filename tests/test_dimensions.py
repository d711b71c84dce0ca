import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wattloom.functions.draws import digest
from wattloom.operators import dimensions as D
from wattloom.operators.dimensions import sample_zips

HOUSES = "house_id bigint, source_house int, zip string, scale double"


def zips(spark, *codes):
    return spark.createDataFrame([(c, f"city {c}") for c in codes], "zip string, primary_city string")


def codes(n):
    return [f"{i:05d}" for i in range(n)]


def test_label_lookup(spark, readings_of):
    labels = spark.createDataFrame([("1", "mains"), ("3", "oven")], "meter_id string, label string")
    frame = readings_of((1, "1", 1, None, 1), (1, "3", 1, None, 1), (1, "9", 1, None, 1), (2, "9", 1, None, 1))
    found = D.lookup_labels(frame, labels)
    assert rows_of(found, "meter_id", "label") == [("1", "mains"), ("3", "oven"), ("9", None), ("9", None)]
    assert rows_of(D.missing_labels(found)) == [("9", 2)]


def test_balanced_index_numbers_every_row_once(spark):
    indexed = D.balanced_index(zips(spark, *codes(3000)), "zip")
    assert sorted(r.idx for r in indexed.collect()) == list(range(3000))
    assert rows_of(D.balanced_index(zips(spark, *codes(3000)).repartition(5), "zip")) == rows_of(indexed)


def test_known_houses_keep_their_row(spark):
    known = spark.createDataFrame([(2, 4, "02366", 1.1), (99, 1, "x", 1.0)], HOUSES)
    assigned = D.assign_houses(D.house_range(spark, 0, 9), known, zips(spark, *codes(40)), seed=5)
    rows = {r.house_id: r for r in assigned.collect()}
    assert sorted(rows) == list(range(10))
    assert tuple(rows[2]) == (2, 4, "02366", 1.1)
    for house, row in rows.items():
        assert 1 <= row.source_house <= 5 and 0.8 <= row.scale <= 1.2
        assert house == 2 or row.zip in codes(40)


def test_draws_are_repeatable_and_spread(spark):
    none = spark.createDataFrame([], HOUSES)
    first, again, other = (
        rows_of(D.assign_houses(D.house_range(spark, 0, 199), none, zips(spark, *codes(40)), seed)) for seed in (1, 1, 2)
    )
    assert first == again != other
    assert {row[1] for row in first} == {1, 2, 3, 4, 5}
    assert len({row[2] for row in first}) > 30


def test_scale_power(spark, readings_of):
    houses = spark.createDataFrame([(1, 1, "z", 0.5)], HOUSES)
    frame = readings_of((1, "1", 1, "m", 10), (2, "1", 1, "m", 10))
    assert rows_of(D.scale_power(frame, houses), "house_id", "power") == [(1, 5.0), (2, 10.0)]


def test_zip_difference_and_refresh(spark):
    full, used = zips(spark, *codes(30)), zips(spark, "00003", "00003", "99999")
    assert [r[0] for r in rows_of(D.zip_difference(full, used))] == [c for c in codes(30) if c != "00003"]
    fresh = rows_of(D.refresh_zips(full, used, 7, seed=3))
    assert len(fresh) == 7 and all(city == f"city {code}" for code, city in fresh)
    assert fresh == rows_of(D.refresh_zips(full.repartition(4), used, 7, seed=3))
    assert fresh != rows_of(D.refresh_zips(full, used, 7, seed=4))
    assert "00003" not in {code for code, _ in fresh}


def test_sample_is_sorted(spark):
    sample = [r.zip for r in D.sample_zips(zips(spark, *codes(500)), 20).collect()]
    assert sample == sorted(sample) and len(set(sample)) == 20


@pytest.mark.parametrize("n", [0, 1, 7, 4_000, 4_999, 5_000, 9_000])
def test_a_sample_equals_the_sorted_one(spark, n):
    zips = spark.range(5_000).select(F.format_string("%05d", "id").alias("zip")).repartition(8)
    found = sample_zips(zips, n, 3)
    expected = zips.orderBy(digest(3, F.col("zip")), "zip").limit(n)
    assert [r.zip for r in found.collect()] == sorted(r.zip for r in expected.collect())


def test_no_task_of_a_sample_sees_all_rows(spark):
    """What goes to one task are histograms and the few rows at the border."""
    found = sample_zips(spark.range(50_000).select(F.format_string("%05d", "id").alias("zip")), 20_000)
    assert found.count() == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan
    sizes = spark.range(50_000).select(F.substring(digest(0, F.format_string("%05d", "id")), 1, 6).alias("head")).groupBy("head").count()
    assert sizes.agg(F.max("count")).first()[0] <= 3
