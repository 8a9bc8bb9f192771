"""Packed layers: increments, versions, failures between any two steps, concurrent writers, upkeep."""

from __future__ import annotations

import logging
import shutil
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from frames import at, dicts, hours_of, telemetry
from gustmill.operators.dedup import THREE_COLUMN_KEYS
from gustmill.operators.rollups import farm_kpis, hourly_energy
from gustmill.operators.telemetry import clean_telemetry, to_bronze
from gustmill.plans import packed
from gustmill.plans.packed import TABLES, PackedLake, packed_bins
from gustmill.sources import versions
from gustmill.sources.versions import Change, ConcurrentChange, VersionLog

DT = 1800


@pytest.fixture
def lake(spark, tmp_path):
    return PackedLake(spark, str(tmp_path / "lake"))


def run_all(lake, **options):
    lake.run_silver(**options)
    lake.run_hourly_energy(DT, **options)
    lake.run_farm_kpis(DT, **options)


def rows(df):
    return sorted(map(str, df.collect()))


def hours(lake):
    return [r.hour_key[11:13] for r in lake.farm_kpis().orderBy("hour").collect()]


def hour_list(spark, *keys):
    return spark.createDataFrame([("SIM-A", "F001", k) for k in keys], "sim_run_id string, farm_id string, hour_key string")


def numbers(lake):
    return {name: lake.logs[name].latest().number for name in TABLES}


# Increments


def test_batches_of_one_date_add_up(spark, lake):
    first, second = hours_of(spark, 0, 2), hours_of(spark, 3, 5)
    lake.write_bronze(first)
    run_all(lake)
    assert hours(lake) == ["00", "01", "02"]
    lake.write_bronze(second)
    run_all(lake)
    assert hours(lake) == ["00", "01", "02", "03", "04", "05"]
    clean = clean_telemetry(to_bronze(first.union(second)))
    assert rows(lake.silver().select(*clean.columns)) == rows(clean)
    assert rows(lake.hourly_energy()) == rows(hourly_energy(clean, DT))
    assert rows(lake.farm_kpis()) == rows(farm_kpis(clean, DT))


def test_rerun_changes_nothing(spark, lake, tmp_path):
    lake.write_bronze(hours_of(spark, 0, 1))
    run_all(lake)
    before = sorted(tmp_path.rglob("*"))
    run_all(lake)
    assert sorted(tmp_path.rglob("*")) == before


def test_late_row_for_closed_hour_is_ignored_and_looked_at_once(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    run_all(lake)
    lake.write_bronze(telemetry(spark, {"event_time": at(0, 45), "power_kw": 5000.0}))
    run_all(lake)
    after = numbers(lake)
    run_all(lake)
    assert numbers(lake) == after
    lake.write_bronze(hours_of(spark, 1, 1))
    run_all(lake)
    assert (lake.bronze().count(), lake.silver().count()) == (9, 8)
    assert [r.total_rows for r in lake.farm_kpis().orderBy("hour").collect()] == [4, 4]


def test_reopened_hour_alone_is_replaced(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 2))
    lake.write_bronze(hours_of(spark, 24, 25))
    run_all(lake)
    before = {r.hour_key: r for r in lake.farm_kpis().collect()}
    other = lake.logs["silver"].latest().rows["2026-01-06"]
    lake.write_bronze(telemetry(spark, {"event_time": at(1, 45), "power_kw": 5000.0}))
    hour = hour_list(spark, "2026-01-05T01:00:00Z")
    for name in ("silver", "hourly_energy", "farm_kpis"):
        lake.reopen(name, hour)
    assert lake.ledger_items("silver").count() == 4
    run_all(lake)
    after = {r.hour_key: r for r in lake.farm_kpis().collect()}
    assert [k for k in before if before[k] != after[k]] == ["2026-01-05T01:00:00Z"]
    assert after["2026-01-05T01:00:00Z"].total_rows == 5
    assert lake.silver().count() == 21 and lake.ledger_items("silver").count() == 5
    assert lake.logs["silver"].latest().rows["2026-01-06"] == other  # not written again


def test_hour_that_loses_all_rows_leaves_silver(spark, lake):
    lake.write_bronze(telemetry(spark, {"sim_run_id": "SIM-A"}, {"sim_run_id": "SIM-B"}))
    lake.run_silver()
    assert lake.silver().count() == 2
    lake.reopen("silver", lake.closed("silver"))
    lake.run_silver(keys=THREE_COLUMN_KEYS)
    assert lake.silver().count() == 1 and lake.closed("silver").count() == 2


def test_hour_without_any_turbine_runs_again_beside_others(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0).union(telemetry(spark, {"turbine_id": None, "event_time": at(1)})))
    run_all(lake)
    assert lake.hourly_energy().count() == 2 and lake.closed("hourly_energy").count() == 2
    lake.reopen("hourly_energy", hour_list(spark, "2026-01-05T01:00:00Z"))
    lake.run_hourly_energy(DT)
    assert lake.hourly_energy().count() == 2 and lake.closed("hourly_energy").count() == 2


def test_gold_takes_hours_that_silver_has_closed(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 1))
    lake.run_silver()
    lake.reopen("silver", hour_list(spark, "2026-01-05T01:00:00Z"))
    lake.run_farm_kpis(DT)
    assert hours(lake) == ["00"]
    lake.run_silver()
    lake.run_farm_kpis(DT)
    assert hours(lake) == ["00", "01"] and lake.silver().count() == 8


def test_dates_narrow_a_run(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 1).union(hours_of(spark, 24, 25)))
    run_all(lake, dates=["2026-01-06"])
    assert {r.date for r in lake.silver().collect()} == {"2026-01-06"}
    run_all(lake, dates=["2030-01-01"])
    assert lake.farm_kpis().count() == 2
    run_all(lake)
    assert lake.farm_kpis().count() == 4
    assert lake.farm_kpis(dates=["2026-01-05"]).count() == 2 and lake.silver(dates=["2030-01-01"]).count() == 0


def test_runs_farms_and_odd_ids_are_tracked_apart(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    run_all(lake)
    lake.write_bronze(hours_of(spark, 0, 0, sim_run_id="007"))
    lake.write_bronze(hours_of(spark, 0, 0, farm_id="00/1 é="))
    run_all(lake)
    found = {(r.sim_run_id, r.farm_id, r.total_rows) for r in lake.farm_kpis().collect()}
    assert found == {("SIM-A", "F001", 4), ("007", "F001", 4), ("SIM-A", "00/1 é=", 4)}


def test_rows_without_key_parts_are_quarantined(spark, lake):
    bad = telemetry(spark, {"farm_id": None}, {"sim_run_id": None}, {"event_time": None})
    lake.write_bronze(bad)
    assert lake.quarantine().count() == 3 and lake.arrived().count() == 0
    lake.run_silver()
    lake.write_bronze(hours_of(spark, 0, 0).union(telemetry(spark, {"turbine_id": None})).union(bad))
    run_all(lake)
    assert (lake.bronze().count(), lake.quarantine().count(), lake.silver().count()) == (11, 6, 5)
    assert sum(r["rows"] for r in dicts(lake.hourly_energy())) == 4
    assert lake.farm_kpis().first().total_rows == 5


def test_guards(spark, lake):
    for job in (lake.run_silver, lambda: lake.run_hourly_energy(DT), lambda: lake.run_farm_kpis(DT), lake.bronze):
        with pytest.raises(FileNotFoundError):
            job()
    usual = hours_of(spark, 0, 0)
    with pytest.raises(ValueError, match="no rows"):
        lake.write_bronze(usual.limit(0))
    assert lake.logs["bronze"].latest().number == 0
    with pytest.raises(ValueError, match=r"\['farm_id', 'ingest_time'\]"):
        lake.write_bronze(usual.drop("ingest_time", "farm_id"))
    with pytest.raises(KeyError, match="yaw_deg"):
        lake.write_bronze(usual.drop("yaw_deg"))
    with pytest.raises(ValueError):
        lake.run_hourly_energy(0)


def test_run_presence(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    lake.assert_runs_present("bronze", ["SIM-A"])
    with pytest.raises(RuntimeError, match=r"\['SIM-B'\].*\['SIM-A'\]"):
        lake.assert_runs_present("bronze", ["SIM-A", "SIM-B"])
    run_all(lake)
    lake.assert_runs_present("hourly_energy", ["SIM-A"])


# Discovery


def test_pending_days_are_found_and_read_without_the_others(spark, lake, tmp_path):
    """Files of closed days may even be gone: nothing lists or reads them."""
    for day in range(4):
        lake.write_bronze(hours_of(spark, 24 * day, 24 * day + 1))
    run_all(lake)
    for table in TABLES.values():
        for top in ("rows", "hours"):
            for folder in (tmp_path / "lake" / table.folder / top).rglob("day=2026-01-0[5-7]"):
                shutil.rmtree(folder)
    lake.write_bronze(hours_of(spark, 75, 75).union(hours_of(spark, 96, 96)))
    run_all(lake)
    days = ["2026-01-08", "2026-01-09"]
    assert sorted(r.hour_key[8:13] for r in lake.farm_kpis(days).collect()) == ["08T00", "08T01", "08T03", "09T00"]


def test_open_hours_come_from_the_manifest(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 1))
    lake.write_bronze(hours_of(spark, 1, 2))
    assert [(r.hour_key[11:13], r.n_rows) for r in lake.arrived().orderBy("hour_key").collect()] == [("00", 4), ("01", 8), ("02", 4)]
    assert lake.arrived(["2026-01-06"]).count() == 0


def test_filter_on_hours_reaches_the_scan(spark, lake, monkeypatch):
    lake.write_bronze(hours_of(spark, 0, 5))
    plans = []
    derive = packed.clean_telemetry
    monkeypatch.setattr(packed, "clean_telemetry", lambda rows, *a, **k: plans.append(rows) or derive(rows, *a, **k))
    lake.run_silver()
    lake.write_bronze(hours_of(spark, 6, 6))
    lake.run_silver()
    text = plans[1]._jdf.queryExecution().toString()
    assert "EqualTo(hour,2026-01-05T06:00:00Z)" in text or "In(hour, [2026-01-05T06:00:00Z])" in text
    assert len(plans[1].inputFiles()) == 2 + 1  # the day's two bronze files, and the open hours


# Versions


def steps(monkeypatch, stop_at):
    """Have the ``stop_at``-th write, or publication, of a run fail; count them."""
    done = []

    def counted(cls, method):
        usual = getattr(cls, method)

        def step(self, *a, **k):
            done.append(method)
            if len(done) == stop_at:
                raise OSError("lost")
            return usual(self, *a, **k)

        monkeypatch.setattr(cls, method, step)

    for method in ("_write_rows", "_save_hours", "_by_day"):
        counted(PackedLake, method)
    counted(versions.Storage, "publish")
    return done


@pytest.mark.parametrize("stop_at", range(1, 6))
@pytest.mark.parametrize("job", ["bronze", "silver", "farm_kpis"])
def test_a_kill_between_any_two_steps_shows_old_or_new(spark, tmp_path, monkeypatch, job, stop_at):
    lake = PackedLake(spark, str(tmp_path / "lake"))
    lake.write_bronze(hours_of(spark, 0, 1))
    run_all(lake)
    lake.reopen("silver", hour_list(spark, "2026-01-05T00:00:00Z"))
    lake.reopen("farm_kpis", hour_list(spark, "2026-01-05T00:00:00Z"))
    new = hours_of(spark, 2, 3)
    jobs = {"bronze": lambda: lake.write_bronze(new), "silver": lake.run_silver, "farm_kpis": lambda: lake.run_farm_kpis(DT)}
    if job != "bronze":
        lake.write_bronze(new)
    if job == "farm_kpis":
        lake.run_silver()

    def state():
        return {n: (rows(lake._stored(n, None)), rows(lake._entries(n, lake.logs[n].latest()).drop("version"))) for n in TABLES}

    old = state()
    with monkeypatch.context() as patch:
        done = steps(patch, stop_at)
        with pytest.raises(OSError):
            jobs[job]()
    assert len(done) == stop_at and state() == old
    # One more run of everything ends as if nothing had failed.
    if job == "bronze":
        lake.write_bronze(new)
    run_all(lake)
    clean = clean_telemetry(to_bronze(hours_of(spark, 0, 3)))
    assert rows(lake.silver().select(*clean.columns)) == rows(clean)
    assert rows(lake.farm_kpis()) == rows(farm_kpis(clean, DT))
    assert lake.ledger_items("farm_kpis").count() == 4


def test_concurrent_appends_lose_nothing(spark, lake):
    def append(n):
        lake.write_bronze(hours_of(spark, n, n, source=str(n)))

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(append, range(6)))
    assert lake.bronze().count() == 24
    assert sorted({r.source for r in lake.bronze().collect()}) == [str(n) for n in range(6)]
    assert lake.logs["bronze"].latest().number == 6 and lake.arrived().count() == 6
    run_all(lake)
    assert hours(lake) == [f"0{n}" for n in range(6)]


def test_of_two_runs_over_the_same_hours_one_is_refused(spark, lake, monkeypatch):
    lake.write_bronze(hours_of(spark, 0, 1))
    write = PackedLake._write_rows

    def overtaken(self, name, new):
        monkeypatch.setattr(PackedLake, "_write_rows", write)
        PackedLake(spark, lake.root).run_silver()
        return write(self, name, new)

    monkeypatch.setattr(PackedLake, "_write_rows", overtaken)
    with pytest.raises(ConcurrentChange):
        lake.run_silver()
    assert lake.silver().count() == 8 and lake.closed("silver").count() == 2


def test_a_reader_keeps_its_version(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    lake.run_silver()
    before = lake.silver()
    lake.reopen("silver", lake.closed("silver"))
    lake.write_bronze(telemetry(spark, {"event_time": at(0, 45)}))
    lake.run_silver()
    lake.compact("silver")
    assert (before.count(), lake.silver().count()) == (4, 5)


def test_a_name_is_published_once(spark, tmp_path):
    storage = versions.Storage(spark, str(tmp_path))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: storage.publish("log/1.json", f"text {n}"), range(8)))
    assert won.count(True) == 1 and storage.read("log/1.json") == f"text {won.index(True)}"
    assert storage.publish("log/1.json", "é", replace=True) and storage.read("log/1.json") == "é"
    assert storage.names("log") == ["1.json"] and storage.names("none") == [] and storage.names("_staged") == []
    with pytest.raises(FileNotFoundError):
        storage.read("log/2.json")


def test_log_and_ledger_stay_small_after_many_runs(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path), retention_seconds=0)
    for n in range(100):
        change = Change(add_rows={"d": [f"rows/{n}"]}, remove_rows={"d": [f"rows/{n - 1}"]} if n else {}, seen={"d": n})
        log.commit(change)
    version = log.latest()
    assert (version.number, version.rows, version.seen) == (100, {"d": ["rows/99"]}, {"d": 99})
    assert len(list((tmp_path / "log").glob("*.json"))) <= 2 * versions.SNAPSHOT_EVERY + 3
    assert len(version.gone) <= versions.SNAPSHOT_EVERY


def test_ledger_folders_are_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packed, "MOST_HOUR_FOLDERS", 3)
    lake = PackedLake(spark, str(tmp_path / "lake"), retention_seconds=0)
    for n in range(12):
        lake.write_bronze(hours_of(spark, n % 4, n % 4))
        if n == 5:
            lake.run_silver()
            lake.reopen("silver", hour_list(spark, "2026-01-05T01:00:00Z"))
    assert len(lake.logs["bronze"].latest().hours["2026-01-05"]) <= 4
    assert [(r.hour_key[11:13], r.n_rows) for r in lake.arrived().orderBy("hour_key").collect()] == [(f"0{h}", 12) for h in range(4)]
    # Entries keep their order through a fold.
    for _ in range(4):
        lake.reopen("silver", hour_list(spark, "2026-01-05T02:00:00Z"))
    assert sorted(r.hour_key[11:13] for r in lake.closed("silver").collect()) == ["00", "03"]


def test_reading_goes_on_while_versions_come(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path), retention_seconds=0)

    def write(_):
        for n in range(60):
            log.commit(Change(seen={"d": n}))

    def read(_):
        found = [VersionLog(spark, str(tmp_path)).latest().number for _ in range(60)]
        return found == sorted(found)

    with ThreadPoolExecutor(3) as pool:
        reads = [pool.submit(read, n) for n in range(2)]
        pool.submit(write, 0).result()
        assert all(r.result() for r in reads)


# Upkeep


def test_bins_are_full_but_not_beyond_the_target():
    sizes = {"a": 70, "b": 60, "c": 40, "d": 30, "e": 200, "f": 5}
    assert packed_bins(sizes, 100) == [["e"], ["a", "d"], ["b", "c"], ["f"]]
    assert packed_bins({}, 10) == []


def test_compaction_keeps_rows_and_bounds_files(spark, lake, tmp_path):
    for n in range(8):
        lake.write_bronze(hours_of(spark, n, n).union(hours_of(spark, 24 + n, 24 + n)))
        lake.run_silver()
    before, old = rows(lake.silver()), lake.silver()
    entries = rows(lake.closed("silver"))
    assert len(lake.silver().inputFiles()) == 16
    assert lake.compact("silver", dates=["2026-01-05"]) == 8
    assert len(lake.silver().inputFiles()) == 9
    assert lake.compact("silver") == 8 and lake.compact("silver") == 0
    assert len(lake.silver().inputFiles()) == 2
    assert rows(lake.silver()) == before == rows(old) and rows(lake.closed("silver")) == entries
    after = numbers(lake)
    lake.run_silver()
    assert numbers(lake)["silver"] == after["silver"]  # not taken for a change
    lake.run_farm_kpis(DT)
    assert lake.farm_kpis().count() == 16
    size = lake.logs["bronze"].storage.size(lake.logs["bronze"].latest().rows["2026-01-05"][0])
    lake.compact("bronze", target_bytes=int(2.5 * size))
    assert len(lake.bronze().inputFiles()) == 8 and lake.bronze().count() == 64


def test_compaction_gives_way_to_a_replaced_day(spark, lake, monkeypatch):
    for n in range(2):
        lake.write_bronze(hours_of(spark, n, n))
        lake.run_silver()
    lake.reopen("silver", lake.closed("silver"))
    bins = packed.packed_bins

    def overtaken(*a):
        monkeypatch.setattr(packed, "packed_bins", bins)
        PackedLake(spark, lake.root).run_silver()
        return bins(*a)

    monkeypatch.setattr(packed, "packed_bins", overtaken)
    assert lake.compact("silver") == 0
    assert lake.silver().count() == 8


def test_vacuum_removes_what_failed_jobs_left(spark, lake, tmp_path, monkeypatch):
    lake.write_bronze(hours_of(spark, 0, 0))
    with monkeypatch.context() as patch:
        steps(patch, 5)
        with pytest.raises(OSError):
            lake.run_silver()
    assert lake.vacuum() == []  # too young
    assert len(lake.vacuum(older_than_seconds=-1)) == 2  # rows and hours
    run_all(lake)
    assert lake.vacuum(older_than_seconds=-1) == []
    assert lake.silver().count() == lake.bronze().count()


def test_counts_of_the_write_pass_are_logged(spark, lake, caplog):
    faulty = telemetry(spark, {"power_kw": 99_999.0}, {"farm_id": None})
    with caplog.at_level(logging.INFO, "gustmill"):
        lake.write_bronze(faulty)
        lake.run_silver()
    text = caplog.text
    assert "'rows': 2, 'unaddressable': 1" in text and "'rows': 1, 'flagged': 1" in text and "'hours': 1" in text


def test_jobs_need_no_counting_jobs_of_their_own(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    source = (Path(packed.__file__)).read_text()
    assert "isEmpty" not in source and ".count()" not in source and "checkpoint" not in source
