import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from wattloom.sources import files, records

ZIP_LINES = '''
,zip,type,primary_city,acceptable_cities,unacceptable_cities,state,county,timezone,area_codes,latitude,longitude,world_region,country,decommissioned,estimated_population,notes
0,00501,UNIQUE,Somewhere,,"Here, There",NY,Some County,America/New_York,"631,516",40.81,-73.04,,US,0,384,
1,90210,STANDARD,Elsewhere,,,CA,Other County,America/Los_Angeles,310,34.1,-118.4,,US,0,21741,
'''.lstrip()


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_channels(spark, tmp_path):
    put(tmp_path / "house_3" / "channel_12.dat", "1303132964 222.20\n1303132965\t 225.1 \n\nbroken line\n")
    put(tmp_path / "house_4" / "channel_1.dat", "1303132964 7\n")
    assert rows_of(files.read_channels(spark, f"{tmp_path}/house_*/channel_*.dat")) == [
        (3, "12", None, None), (3, "12", 1303132964, 222.2), (3, "12", 1303132965, 225.1), (4, "1", 1303132964, 7.0),
    ]


def test_labels_houses_and_clean_days(spark, tmp_path):
    put(tmp_path / "house_1" / "labels.dat", "1 mains\n3 oven\n")
    put(tmp_path / "house_1" / "common.dat", "1303171200\n1303257600\n")
    put(tmp_path / "houses", "0 5 02366 1.05\n7 1 90210 0.9\n")
    assert rows_of(files.read_labels(spark, f"{tmp_path}/house_*/labels.dat")) == [(1, "1", "mains"), (1, "3", "oven")]
    assert rows_of(files.read_clean_days(spark, f"{tmp_path}/house_*/common.dat")) == [(1, 1303171200), (1, 1303257600)]
    houses = files.read_houses(spark, f"{tmp_path}/houses")
    assert rows_of(houses) == [(0, 5, "02366", 1.05), (7, 1, "90210", 0.9)]
    files.write_houses(houses, f"{tmp_path}/houses.new")
    assert rows_of(files.read_houses(spark, f"{tmp_path}/houses.new")) == rows_of(houses)


def test_zip_table(spark, tmp_path):
    put(tmp_path / "zips.csv", ZIP_LINES)
    table = files.read_zips(spark, f"{tmp_path}/zips.csv")
    assert rows_of(table, "_idx", "zip", "unacceptable_cities", "area_codes", "latitude", "estimated_population") == [
        (0, "00501", "Here, There", "631,516", 40.81, 384), (1, "90210", None, "310", 34.1, 21741),
    ]
    files.write_zips(table, f"{tmp_path}/copy")
    assert rows_of(files.read_zips(spark, f"{tmp_path}/copy")) == rows_of(table)
    files.write_zips(table.drop("_idx"), f"{tmp_path}/plain")
    assert rows_of(files.read_zips(spark, f"{tmp_path}/plain", indexed=False)) == rows_of(table.drop("_idx"))


def test_channel_writer_uses_two_decimals_and_time_order(spark, tmp_path, readings_of):
    frame = readings_of((1, "3", 30, "x", 0.125), (1, "3", 10, "x", 7), (1, "3", 20, "x", 9.975), (2, "1", 5, "x", 1))
    files.write_channels(frame, f"{tmp_path}/out")
    lines = [line for p in sorted((tmp_path / "out" / "house_id=1" / "meter_id=3").glob("part*")) for line in p.read_text().split("\n")]
    assert [line for line in lines if line] == ["10 7.00", "20 9.97", "30 0.12"]
    files.write_clean_days(spark.createDataFrame([(1, 20), (1, 10)], "house_id bigint, day_start bigint"), f"{tmp_path}/days")
    assert [r.value for r in spark.read.text(f"{tmp_path}/days/house_id=1").collect()] == ["10", "20"]


LINE = '{"timestamp": "%d", "houseId": 1, "zip": "02366", "readings": [{"meterId": "1", "power": "5", "label": "m"}]}\n'


def test_topic_folders(spark, tmp_path):
    for folder, ts in (("2016/02/01/05", 100), ("2016/02/28/23", 200), ("2016/03/01/00", 300)):
        put(tmp_path / "hf" / "hourly" / folder / "part.json", LINE % ts)
    month = records.read_topic(spark, str(tmp_path), "hf", 2016, 2)
    assert rows_of(month, "timestamp") == [("100",), ("200",)]
    assert all("/2016/02/" in row[0] for row in rows_of(month, "source_file"))
    assert rows_of(records.read_topic(spark, str(tmp_path), "hf", 2016, 2, 28, 23), "timestamp") == [("200",)]
    assert rows_of(records.infer_records(spark, f"{tmp_path}/hf/hourly/2016/03/*/*"), "houseId") == [(1,)]


def test_hourly_round_trip_prunes_folders(spark, tmp_path):
    put(tmp_path / "in.json", LINE % 0 + LINE % 3600 + LINE % 7200 + LINE % 90_000)
    records.write_hourly(records.read_records(spark, f"{tmp_path}/in.json"), f"{tmp_path}/hourly")
    found = records.read_hourly(spark, f"{tmp_path}/hourly", "1970-01-01-01", "1970-01-01-02")
    assert rows_of(found, "timestamp") == [("3600",), ("7200",)]
    # No other folder is so much as listed.
    folders = records._hour_folders(spark, f"{tmp_path}/hourly", "1970-01-01-01", "1970-01-01-02")
    assert [f.rsplit("/", 1)[1] for f in folders] == ["hour=01", "hour=02"]
    assert len(found.inputFiles()) == 2
    assert records.read_hourly(spark, f"{tmp_path}/hourly", "1980-01-01-01", "1980-01-01-02").count() == 0


def test_undated_records_can_be_read(spark, tmp_path):
    put(tmp_path / "in.json", LINE % 0 + "{broken\n")
    records.write_hourly(records.read_records(spark, f"{tmp_path}/in.json"), f"{tmp_path}/hourly")
    hours = ("1970-01-01-00", "1970-01-01-05")
    assert records.read_hourly(spark, f"{tmp_path}/hourly", *hours).count() == 1
    both = records.read_hourly(spark, f"{tmp_path}/hourly", *hours, undated=True)
    assert rows_of(both, "timestamp", "hour") == [(None, None), ("0", "00")]
    kept = [p.read_text() for p in (tmp_path / "hourly").rglob("*") if "HIVE_DEFAULT" in str(p) and p.suffix == ".json"]
    assert len(kept) == 1 and "{broken" in kept[0]


def test_malformed_line_keeps_its_text(spark, tmp_path):
    put(tmp_path / "in.json", LINE % 1 + "{broken\n")
    kept = records.read_records(spark, f"{tmp_path}/in.json").select("timestamp", "_corrupt_record")
    assert rows_of(kept) == [(None, "{broken"), ("1", None)]


def test_publish_to_files(spark, tmp_path):
    messages = spark.createDataFrame([("hf", "1", "a"), ("lf", "1", "b")], "topic string, key string, value string")
    records.publish(messages, "text", f"{tmp_path}/topics")
    assert rows_of(spark.read.text(f"{tmp_path}/topics/topic=lf")) == [("b",)]
    assert rows_of(messages.select(F.col("value"))) == [("a",), ("b",)]


def test_inferred_records(spark, tmp_path):
    lines = ['{"a": 1, "b": {"c": "x"}, "d": [{"e": 1.5}], "n": null}', '{"a": 2, "d": [{"e": 2, "f": true}, {}], "b": {"c": "y", "odd name": 3}}', "{broken", "[1]", "7", "", "{}"]
    put(tmp_path / "in.json", "\n".join(lines) + "\n")
    found = records.infer_records(spark, f"{tmp_path}/in.json")
    assert sorted(found.columns) == ["_corrupt_record", "a", "b", "d", "n"]
    assert rows_of(found.where("a IS NOT NULL"), "a", "b.c", "b.`odd name`", "d.f") == [(1, "x", None, [None]), (2, "y", 3, [True, None])]
    assert rows_of(found.where("_corrupt_record IS NOT NULL"), "_corrupt_record") == [("7",), ("[1]",), ("{broken",)]
    assert found.count() == 6
    put(tmp_path / "mixed.json", '{"a": 1}\n{"a": "x"}\n')
    mixed = records.infer_records(spark, f"{tmp_path}/mixed.json")
    assert rows_of(mixed.select(F.to_json(F.struct("a")))) == [('{"a":"x"}',), ('{"a":1}',)]
    put(tmp_path / "none.json", "\n")
    assert records.infer_records(spark, f"{tmp_path}/none.json").count() == 0


def test_written_topic_folders(spark, tmp_path):
    put(tmp_path / "in.json", LINE % 0 + LINE % 3600 + LINE % 90_000)
    found = records.read_records(spark, f"{tmp_path}/in.json")
    records.write_topic(found, str(tmp_path), "hf")
    assert sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / "hf").glob("hourly/*/*/*/*")) == [f"hf/hourly/1970/01/{h}" for h in ("01/00", "01/01", "02/01")]
    assert rows_of(records.read_topic(spark, str(tmp_path), "hf", 1970, 1, 1), "timestamp") == [("0",), ("3600",)]
    with pytest.raises(FileExistsError):
        records.write_topic(found.where("timestamp = '0'"), str(tmp_path), "hf")
    put(tmp_path / "bad.json", "{broken\n")
    with pytest.raises(ValueError):
        records.write_topic(records.read_records(spark, f"{tmp_path}/bad.json"), str(tmp_path), "lf")
