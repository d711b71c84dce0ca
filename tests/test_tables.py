import pytest

from tests.conftest import rows_of
from wattloom import session
from wattloom.sources import tables as T

ENERGY = "house_id bigint, date string, zip string, label string, kwh double"


def energy(spark, *rows):
    return spark.createDataFrame([(h, d, "02366", label, float(k)) for h, d, label, k in rows], ENERGY)


def stored(spark, root, table=T.MAINS_ENERGY):
    return rows_of(T.read(spark, root, table))


def test_upsert_replaces_by_key_and_keeps_the_rest(spark, tmp_path):
    root = str(tmp_path)
    first = energy(spark, (1, "2011-05-21", "mains", 1), (2, "2011-05-21", "mains", 2), (1, "2011-05-22", "mains", 3))
    T.upsert(first, root, T.MAINS_ENERGY)
    again = energy(spark, (1, "2011-05-21", "mains", 9), (3, "2011-05-21", "NONE", 0), (1, "2011-05-23", "mains", 4))
    expected = [
        (1, "2011-05-21", "02366", "mains", 9.0),
        (1, "2011-05-22", "02366", "mains", 3.0),
        (1, "2011-05-23", "02366", "mains", 4.0),
        (2, "2011-05-21", "02366", "mains", 2.0),
        (3, "2011-05-21", "02366", "NONE", 0.0),
    ]
    for _ in range(2):
        T.upsert(again, root, T.MAINS_ENERGY)
        assert stored(spark, root) == expected


def test_untouched_partitions_keep_their_version(spark, tmp_path):
    root = str(tmp_path)
    T.upsert(energy(spark, (1, "2011-05-21", "m", 1), (1, "2011-05-22", "m", 1)), root, T.MAINS_ENERGY)
    before = T.current(spark, f"{root}/mains_energy").partitions
    T.upsert(energy(spark, (1, "2011-05-22", "m", 2)), root, T.MAINS_ENERGY)
    after = T.current(spark, f"{root}/mains_energy").partitions
    assert after["date=2011-05-21"] == before["date=2011-05-21"] and after["date=2011-05-22"] != before["date=2011-05-22"]


def test_a_commit_that_dies_changes_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    T.upsert(energy(spark, (1, "2011-05-21", "m", 1), (2, "2011-05-21", "m", 2)), root, T.MAINS_ENERGY)
    again = energy(spark, (1, "2011-05-21", "m", 9))

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(T, "_publish", die)
        with pytest.raises(OSError):
            T.upsert(again, root, T.MAINS_ENERGY)
    assert [row[-1] for row in stored(spark, root)] == [1.0, 2.0]
    # A manifest that was cut off while it was written does not count.
    (tmp_path / "mains_energy" / "manifests" / "000000000001.json").write_text('{"partitions": {')
    assert [row[-1] for row in stored(spark, root)] == [1.0, 2.0]
    T.upsert(again, root, T.MAINS_ENERGY)
    assert [row[-1] for row in stored(spark, root)] == [9.0, 2.0]


def test_readers_live_through_commits_and_old_versions_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "RETAINED_SECONDS", 0)
    root = str(tmp_path)
    T.upsert(energy(spark, (1, "2011-05-21", "m", 0)), root, T.MAINS_ENERGY)
    for k in range(1, 6):
        reader = T.read(spark, root, T.MAINS_ENERGY)
        T.upsert(energy(spark, (1, "2011-05-21", "m", k)), root, T.MAINS_ENERGY)
        assert rows_of(reader, "kwh") == [(k - 1.0,)]
    folders = tmp_path / "mains_energy"
    assert len(list((folders / "manifests").glob("*.json"))) == T.KEPT_MANIFESTS
    assert len(list((folders / "data").glob("version=*/date=*"))) == T.KEPT_MANIFESTS


def test_a_reader_lives_through_a_hundred_commits(spark, tmp_path, monkeypatch):
    """By age, as any reader does; then by a lease alone, after whose end the old files go."""
    root, table, manifests = str(tmp_path), T.GEO_ENERGY, tmp_path / "geo_energy" / "manifests"

    def commit(*rows):
        frame = spark.createDataFrame([(f"2011-05-{d}", "02366", float(k)) for d, k in rows], "date string, zip string, kwh double")
        T.overwrite(frame.coalesce(1), root, table)

    commit((21, 0), (22, 0))
    reader = T.read(spark, root, table)
    for k in range(1, 51):
        commit((21, k))
    assert rows_of(reader, "kwh") == [(0.0,), (0.0,)]
    with T.leased(spark, root, table) as rows:
        monkeypatch.setattr(T, "RETAINED_SECONDS", 0)
        for k in range(51, 101):
            commit((21, k))
        assert rows_of(rows, "kwh") == [(0.0,), (50.0,)]
        # What came before the lease is gone, what came after it is not.
        assert len(list(manifests.glob("*.json"))) == 51
    commit((21, 101))
    assert len(list(manifests.glob("*.json"))) == T.KEPT_MANIFESTS
    assert not list((tmp_path / "geo_energy").glob("leases/0*"))
    # The date that no commit has touched is still there.
    assert rows_of(T.read(spark, root, table), "date", "kwh") == [("2011-05-21", 101.0), ("2011-05-22", 0.0)]


def test_a_lease_that_has_run_out_holds_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "RETAINED_SECONDS", 0)
    with T.leased(spark, str(tmp_path), T.MAINS_ENERGY, seconds=-1) as rows:
        assert rows.count() == 0
        for k in range(6):
            T.overwrite(energy(spark, (1, "2011-05-21", "m", k)), str(tmp_path), T.MAINS_ENERGY)
    assert len(list((tmp_path / "mains_energy" / "manifests").glob("*.json"))) == T.KEPT_MANIFESTS


def test_a_log_of_many_batches_is_packed_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "RETAINED_SECONDS", 0)
    root, n = str(tmp_path), 100
    for k in range(n):
        if k % 7:  # every seventh batch is empty
            T.append_batch(energy(spark, (k, "2011-05-21", "m", k)).coalesce(1), root, T.MAINS_ENERGY, k, "a")
        if k % 4 == 3:
            T.pack_log(spark, root, T.MAINS_ENERGY, {"a": k}, fan_in=4)
    T.append_batch(energy(spark, (0, "2011-05-21", "m", 5)), root, T.MAINS_ENERGY, 0, "b")
    T.pack_log(spark, root, T.MAINS_ENERGY, fan_in=4)
    expected = [("a", k, k, float(k)) for k in range(n) if k % 7] + [("b", 0, 0, 5.0)]
    assert rows_of(T.read_log(spark, root, T.MAINS_ENERGY), "run", "batch_id", "house_id", "kwh") == expected
    folders = [p for kind in ("log", "packs") for p in (tmp_path / f"mains_energy_{kind}").rglob("date=*")]
    # At most 3 packs on each of log4(100) levels, and some that the kept manifests still name.
    assert len(folders) <= 3 * 4 + 4 * T.KEPT_MANIFESTS + 4
    # A batch that is packed and comes again is not there twice.
    T.append_batch(energy(spark, (8, "2011-05-21", "m", 8)), root, T.MAINS_ENERGY, 8, "a")
    assert T.read_log(spark, root, T.MAINS_ENERGY).count() == len(expected)


def test_two_writers_do_not_pack_twice(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for k in range(4):
        T.append_batch(energy(spark, (k, "2011-05-21", "m", k)), root, T.MAINS_ENERGY, k)
    early = T.current(spark, f"{root}/mains_energy")
    T.pack_log(spark, root, T.MAINS_ENERGY, {"0": 3}, fan_in=2)
    with monkeypatch.context() as patched:
        patched.setattr(T, "current", lambda *_: early)
        with pytest.raises(T.ConcurrentCommit):
            T.pack_log(spark, root, T.MAINS_ENERGY, {"0": 3}, fan_in=2)
    assert rows_of(T.read_log(spark, root, T.MAINS_ENERGY), "kwh") == [(float(k),) for k in range(4)]


def test_one_house_is_read_from_the_files_that_may_have_it(spark, tmp_path):
    root = str(tmp_path)
    rows = [(h, f"2011-05-{d}", "m", h * d) for h in range(0, 4000, 2) for d in (20, 21, 22)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        T.upsert(energy(spark, *rows), root, T.MAINS_ENERGY)
        T.upsert(energy(spark, (8, "2011-05-21", "m", 1), (9, "2011-05-23", "m", 2)), root, T.MAINS_ENERGY)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    everything = T.read(spark, root, T.MAINS_ENERGY)
    for house in (8, 9, 3998, 1500):
        files = T.files_with(spark, root, T.MAINS_ENERGY, house)
        found = T.read_value(spark, root, T.MAINS_ENERGY, house)
        assert rows_of(found) == rows_of(everything.where(f"house_id = {house}"))
        dates = everything.where(f"house_id = {house}").select("date").distinct().count()
        assert len(files) == dates == len(found.inputFiles())
    # In the range of a file, but not in its Bloom filter: hardly any file is opened.
    assert sum(len(T.files_with(spark, root, T.MAINS_ENERGY, house)) for house in range(101, 201, 2)) <= 5
    assert len(everything.inputFiles()) >= 8
    assert T.read_value(spark, root, T.MAINS_ENERGY, 10**9).count() == 0
    assert T.read_value(spark, str(tmp_path / "none"), T.MAINS_ENERGY, 1).count() == 0


def test_two_writers_do_not_lose_lose_each_others_rows(spark, tmp_path):
    root = str(tmp_path)
    T.upsert(energy(spark, (1, "2011-05-21", "m", 0)), root, T.MAINS_ENERGY)
    path = f"{root}/mains_energy"
    early = T.current(spark, path)
    T.upsert(energy(spark, (2, "2011-05-21", "m", 0)), root, T.MAINS_ENERGY)
    with pytest.raises(RuntimeError):
        T._publish(spark, path, early, early.partitions, {})


def test_rows_of_one_key_settle_on_the_largest(spark, tmp_path):
    rows = energy(spark, (1, "2011-05-21", "m", 0), (1, "2011-05-21", "m", 25), (1, "2011-05-21", "m", 7))
    T.upsert(rows, str(tmp_path), T.MAINS_ENERGY)
    assert [row[-1] for row in stored(spark, str(tmp_path))] == [25.0]


def test_stats_without_a_date(spark, tmp_path):
    root, ddl = str(tmp_path), "house_id bigint, meter_id string, p97 double"
    T.upsert(spark.createDataFrame([(h, "1", float(h)) for h in range(200)], ddl), root, T.METER_STATS)
    T.upsert(spark.createDataFrame([(5, "1", 0.5), (999, "2", 9.0)], ddl), root, T.METER_STATS)
    rows = {(h, m): p for h, m, p in stored(spark, root, T.METER_STATS)}
    assert len(rows) == 201 and rows[(5, "1")] == 0.5 and rows[(6, "1")] == 6.0 and rows[(999, "2")] == 9.0


def test_overwrite_replaces_whole_dates(spark, tmp_path):
    root = str(tmp_path)
    T.upsert(energy(spark, (1, "2011-05-21", "m", 1), (2, "2011-05-21", "m", 1), (1, "2011-05-22", "m", 1)), root, T.MAINS_ENERGY)
    T.overwrite(energy(spark, (1, "2011-05-21", "m", 5)), root, T.MAINS_ENERGY)
    assert [(r[0], r[1], r[4]) for r in stored(spark, root)] == [(1, "2011-05-21", 5.0), (1, "2011-05-22", 1.0)]


def test_batches_are_idempotent_and_the_last_wins(spark, tmp_path):
    root, ddl = str(tmp_path), "house_id bigint, date string, zip string, label string, kwh double"
    one, two = (spark.createDataFrame([(1, "2011-05-21", "z", "m", k)], ddl) for k in (1.0, 2.0))
    for batch, number in ((one, 0), (two, 1), (two, 1)):
        T.append_batch(batch, root, T.MAINS_ENERGY, number)
    assert rows_of(T.read_log(spark, root, T.MAINS_ENERGY), "kwh", "batch_id") == [(1.0, 0), (2.0, 1)]
    assert rows_of(T.read_latest(spark, root, T.MAINS_ENERGY), "kwh") == [(2.0,)]
    # A later run counts its batches from 0 again and still comes last.
    T.append_batch(one, root, T.MAINS_ENERGY, 0, "1")
    assert rows_of(T.read_latest(spark, root, T.MAINS_ENERGY), "kwh") == [(1.0,)]


def test_folding_the_log_keeps_the_sums(spark, tmp_path):
    root = str(tmp_path)
    for run, number, house in (("a", 0, 1), ("a", 1, 1), ("b", 0, 1), ("a", 2, 2)):
        T.append_batch(energy(spark, (house, "2011-05-21", "m", 1)), root, T.MAINS_ENERGY, number, run)
    sums = rows_of(T.read_sums(spark, root, T.MAINS_ENERGY), "house_id", "kwh")
    assert sums == [(1, 3.0), (2, 1.0)]
    T.fold_log(spark, root, T.MAINS_ENERGY)
    assert rows_of(T.read_log(spark, root, T.MAINS_ENERGY), "run", "batch_id") == [("a", 2), ("b", 0)]
    assert rows_of(T.read_sums(spark, root, T.MAINS_ENERGY), "house_id", "kwh") == sums
    # A batch that is folded and comes again is not counted twice.
    T.append_batch(energy(spark, (1, "2011-05-21", "m", 1)), root, T.MAINS_ENERGY, 1, "a")
    T.fold_log(spark, root, T.MAINS_ENERGY, {"a": 2, "b": 0})
    assert rows_of(T.read_sums(spark, root, T.MAINS_ENERGY), "house_id", "kwh") == sums


def test_serving_reads(spark, tmp_path):
    root = str(tmp_path)
    rows = [(h, f"2011-05-{d}", label, h * d) for h in range(3) for d in (20, 21, 22) for label in ("a", "b")]
    T.upsert(energy(spark, *rows), root, T.MAINS_ENERGY)
    table = T.read(spark, root, T.MAINS_ENERGY)
    assert [r.date for r in T.house_history(table.where("label = 'a'"), 1).collect()] == ["2011-05-20", "2011-05-21", "2011-05-22"]
    one = T.appliance_breakdown(table, 2, "2011-05-21")
    assert rows_of(one, "label", "kwh") == [("a", 42.0), ("b", 42.0)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "EqualTo(house_id,2)" in plan


class FakeSession:
    """What the workspace looks at: one setting and the master."""

    def __init__(self, master, **settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master})


def test_workspace_is_the_configured_folder():
    fake = FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.workspace(fake) == "hdfs:///shared"
    assert session.fresh_dir(fake, "x").startswith("hdfs:///shared/x-")


def test_only_a_local_master_may_do_without():
    with pytest.raises(ValueError):
        session.workspace(FakeSession("yarn"))
    assert session.workspace(FakeSession("local[2]")) == session.workspace(FakeSession("local[2]"))


def test_empty_input_is_no_error(spark, tmp_path):
    root = str(tmp_path)
    nothing = energy(spark, (1, "2011-05-21", "m", 1)).where("false")
    T.upsert(nothing, root, T.MAINS_ENERGY)
    assert stored(spark, root) == []
    T.upsert(energy(spark, (1, "2011-05-21", "m", 1)), root, T.MAINS_ENERGY)
    T.upsert(nothing, root, T.MAINS_ENERGY)
    T.append_batch(nothing, root, T.MAINS_ENERGY, 0)
    assert len(stored(spark, root)) == 1
    assert T.read_latest(spark, root, T.MAINS_ENERGY).count() == 0


def test_export_by_format(spark, tmp_path):
    rows = energy(spark, (1, "2011-05-21", "m", 1))
    T.export(rows, T.MAINS_ENERGY, "json", path=f"{tmp_path}/json")
    assert rows_of(spark.read.schema(ENERGY).json(f"{tmp_path}/json")) == rows_of(rows)
