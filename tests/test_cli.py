"""The spark-submit jobs, chained: channel files to replayed records to tables, live power, alerts."""

from tests.conftest import rows_of
from wattloom.plans import jobs
from wattloom.sources import tables
from wattloom.sources.quarantine import read_quarantine
from wattloom.streaming.power import read_alerts

START = 1_303_171_200  # 04/19/2011 UTC
DAY = 86_400


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_chain_of_jobs(spark, tmp_path):
    raw, work = tmp_path / "raw", tmp_path / "work"
    for channel in (1, 2, 3):
        # A spike every fifty readings, rarer than the 3 % above p97.
        lines = [f"{START + s} {channel * 100 + 50 * (s % 30_000 == 0)}" for s in range(0, 2 * DAY + 600, 600)]
        put(raw / "house_1" / f"channel_{channel}.dat", "\n".join(lines))
    put(raw / "house_1" / "labels.dat", "1 mains\n2 mains\n3 oven\n")
    put(tmp_path / "houses", "7 1 02366 1.0\n8 1 90210 0.5\n")
    channels = f"{raw}/house_*/channel_*.dat"

    jobs.main(["clean-days", "--anchor", "04/19/2011:00:00:00", "--channels", channels, "--out", f"{work}/days"])
    days = [line for p in (work / "days").rglob("part*") for line in p.read_text().split()]
    assert days == [str(START), str(START + DAY)]

    jobs.main([
        "replay", "--channels", channels, "--clean-days", f"{work}/days", "--labels", f"{raw}/house_*/labels.dat",
        "--houses", f"{tmp_path}/houses", "--days", "3", "--format", "text", "--path", f"{work}/topics", "--scaled",
    ])
    topics = [f"{work}/topics/topic=meters_{layer}" for layer in ("hf", "lf")]

    jobs.main(["batch", "--records", *topics, "--root", f"{work}/tables"])
    mains = rows_of(tables.read(spark, f"{work}/tables", tables.MAINS_ENERGY), "house_id", "date", "zip", "label")
    assert mains == [(h, f"2011-04-{d}", z, "mains") for h, z in ((7, "02366"), (8, "90210")) for d in (19, 20, 21)]
    shares = rows_of(tables.read(spark, f"{work}/tables", tables.APPLIANCE_SHARE), "label", "percent")
    assert len(shares) == 6 and all(label == "oven" and 85 < percent < 115 for label, percent in shares)

    stream = ["--root", f"{work}/tables", "--format", "text", "--path", topics[0], "--once"]
    jobs.main(["live", "--checkpoint", f"{work}/live", "--window", "1 day", *stream])
    live = tables.read_sums(spark, f"{work}/tables", tables.RT_POWER)
    assert live.count() == 6

    jobs.main(["alerts", "--checkpoint", f"{work}/alert-progress", "--margin", "0.001", "--salts", "2", *stream])
    alerts = read_alerts(spark, f"{work}/tables")
    # Two houses, two channels, three days; three spikes on either clean day.
    assert alerts.count() == 2 * 2 * 3 * 3 and alerts.where("power <= p97").count() == 0


def test_jobs_lose_no_rejects(spark, tmp_path):
    reading = '{"meterId": "1", "power": "%s", "label": "mains"}'
    good = '{"timestamp": "1303171200", "houseId": 1, "zip": "z", "readings": [' + reading % 5 + ", " + reading % "x" + "]}"
    put(tmp_path / "in" / "day1", "{one\n" + good)
    put(tmp_path / "in" / "day2", "{two\n" + good)
    root = f"{tmp_path}/tables"
    for day in ("day1", "day2", "day2"):
        jobs.main(["batch", "--records", f"{tmp_path}/in/{day}", "--root", root])
    assert rows_of(read_quarantine(spark, root), "reason") == [("malformed",)] * 2 + [("power",)] * 2

    stream = ["--format", "text", "--path", f"{tmp_path}/in", "--once"]
    jobs.main(["alerts", "--root", f"{tmp_path}/live", "--checkpoint", f"{tmp_path}/progress", *stream])
    found = read_quarantine(spark, f"{tmp_path}/live")
    assert rows_of(found, "reason") == [("malformed",)] * 2 + [("power",)] * 2
    assert found.where("""reason = 'power' AND original LIKE '%"power_text":"x"%'""").count() == 2

    put(tmp_path / "raw" / "house_1" / "channel_1.dat", f"{START} 5\nsoon 5\n{START + 6} x\n{START + 12}\n")
    put(tmp_path / "raw" / "house_1" / "odd.dat", f"{START} 5\n")
    put(tmp_path / "raw" / "labels" / "house_1" / "labels.dat", "1 mains\n")
    put(tmp_path / "houses", "7 1 02366 1.0\n")
    channels = f"{tmp_path}/raw/house_1/*.dat"
    expected = [("path",), ("power",), ("power",), ("timestamp",)]
    jobs.main(["clean-days", "--anchor", "04/19/2011:00:00:00", "--channels", channels, "--out", f"{tmp_path}/days"])
    assert rows_of(read_quarantine(spark, f"{tmp_path}/days-rejects"), "reason") == expected
    jobs.main([
        "replay", "--channels", channels, "--clean-days", f"{tmp_path}/houses", "--labels", f"{tmp_path}/raw/labels", "--houses",
        f"{tmp_path}/houses", "--format", "text", "--path", f"{tmp_path}/topics", "--root", f"{tmp_path}/aside",
    ])
    assert rows_of(read_quarantine(spark, f"{tmp_path}/aside"), "reason") == expected
