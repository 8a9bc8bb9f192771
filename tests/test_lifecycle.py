"""Bronze to gold on disk: increments, retries, late rows, reprocessing, guards."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frames import at, dicts, hours_of, telemetry
from gustmill import Lake
from gustmill.operators.dedup import THREE_COLUMN_KEYS
from gustmill.operators.rollups import farm_kpis, hourly_energy
from gustmill.operators.telemetry import clean_telemetry, to_bronze

DT = 1800


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def run_all(lake, **options):
    lake.run_silver(**options)
    lake.run_hourly_energy(DT, **options)
    lake.run_farm_kpis(DT, **options)


def rows(df):
    return sorted(map(str, df.collect()))


def hours(lake):
    return [r.hour_key[11:13] for r in lake.farm_kpis().orderBy("hour").collect()]


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
    files = sorted(tmp_path.rglob("*.parquet"))
    run_all(lake)
    assert sorted(f for f in tmp_path.rglob("*.parquet") if "checkpoints" not in str(f)) == files


@pytest.mark.parametrize("dataset", ["silver", "hourly_energy", "farm_kpis"])
def test_failure_between_data_and_ledger_is_repaired(spark, lake, monkeypatch, dataset):
    lake.write_bronze(hours_of(spark, 0, 2))
    close = lake.ledger.close

    def fail(name, done):
        if name == dataset:
            raise OSError("lost")
        close(name, done)

    monkeypatch.setattr(lake.ledger, "close", fail)
    with pytest.raises(OSError):
        run_all(lake)
    monkeypatch.undo()
    run_all(lake)
    assert lake.silver().count() == 12
    assert lake.hourly_energy().count() == 6
    assert hours(lake) == ["00", "01", "02"]


def test_gold_waits_until_silver_has_closed_the_hour(spark, lake, monkeypatch):
    lake.write_bronze(hours_of(spark, 0, 0))
    run_all(lake)
    lake.write_bronze(hours_of(spark, 1, 1))
    with monkeypatch.context() as patch:
        patch.setattr(lake.ledger, "close", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.run_silver()
    lake.run_farm_kpis(DT)
    assert hours(lake) == ["00"]
    lake.write_bronze(telemetry(spark, {"event_time": at(1, 45)}))
    run_all(lake)
    assert [r.total_rows for r in lake.farm_kpis().orderBy("hour").collect()] == [4, 5]


def test_gold_leaves_out_hours_of_an_open_day_that_silver_has_not_closed(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 1))
    lake.run_silver()
    second = lake.ledger.closed("silver").filter("hour_key LIKE '%T01:%'")
    lake.reopen("silver", second)
    lake.run_farm_kpis(DT)
    assert hours(lake) == ["00"]
    lake.run_silver()
    lake.run_farm_kpis(DT)
    assert hours(lake) == ["00", "01"]


def test_hour_that_loses_all_rows_leaves_silver(spark, lake):
    pair = telemetry(spark, {"sim_run_id": "SIM-A"}, {"sim_run_id": "SIM-B"})
    lake.write_bronze(pair)
    lake.run_silver()
    assert lake.silver().count() == 2
    lake.reopen("silver", lake.ledger.closed("silver"))
    lake.run_silver(keys=THREE_COLUMN_KEYS)
    assert lake.silver().count() == 1


def test_ledger_follows_sequence_not_clock(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    lake.run_silver()
    closed = lake.ledger.closed("silver")
    ledger = lake.ledger
    n = closed.count()
    path = ledger._folder("silver")
    early = closed.withColumns(
        {
            "closed": F.lit(False),
            "sequence": F.lit(2).cast("long"),
            "recorded_at": F.lit("2000-01-01").cast("timestamp"),
            "date": F.substring("hour_key", 1, 10),
        }
    )
    early.write.mode("append").partitionBy("date").parquet(path)
    assert n and ledger.closed("silver").count() == 0


def test_silver_without_a_ledger_is_taken_whole(spark, lake):
    clean = clean_telemetry(to_bronze(hours_of(spark, 0, 1)))
    keyed = clean.withColumns(
        {"date": F.lit("2026-01-05"), "hour_key": F.date_format("event_time", "yyyy-MM-dd'T'HH:00:00'Z'")}
    )
    keyed.write.partitionBy("sim_run_id", "farm_id", "date", "hour_key").parquet(lake.path("silver"))
    lake.run_farm_kpis(DT)
    assert hours(lake) == ["00", "01"]


def test_late_row_for_closed_hour_is_ignored(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    run_all(lake)
    late = telemetry(spark, {"event_time": at(0, 45), "power_kw": 5000.0})
    lake.write_bronze(late.union(hours_of(spark, 1, 1)))
    run_all(lake)
    assert lake.bronze().count() == 9
    assert lake.silver().count() == 8
    assert [r.total_rows for r in lake.farm_kpis().orderBy("hour").collect()] == [4, 4]


def test_reopened_hour_alone_is_replaced(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 2))
    run_all(lake)
    before = {r.hour_key: r for r in lake.farm_kpis().collect()}
    untouched = lake.silver().filter("hour_key NOT LIKE '%T01:%'").withColumn("f", F.input_file_name())
    files_before = rows(untouched)
    lake.write_bronze(telemetry(spark, {"event_time": at(1, 45), "power_kw": 5000.0}))
    hour = spark.createDataFrame(
        [("SIM-A", "F001", "2026-01-05T01:00:00Z")], "sim_run_id string, farm_id string, hour_key string"
    )
    for dataset in ("silver", "hourly_energy", "farm_kpis"):
        lake.reopen(dataset, hour)
    assert lake.ledger.items("silver").count() == 2
    run_all(lake)
    after = {r.hour_key: r for r in lake.farm_kpis().collect()}
    changed = [k for k in before if before[k] != after[k]]
    assert changed == ["2026-01-05T01:00:00Z"]
    assert after[changed[0]].total_rows == 5
    again = lake.silver().filter("hour_key NOT LIKE '%T01:%'").withColumn("f", F.input_file_name())
    assert rows(again) == files_before


def test_dates_narrow_a_run(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 1).union(hours_of(spark, 24, 25)))
    run_all(lake, dates=["2026-01-06"])
    assert {r.date for r in lake.silver().collect()} == {"2026-01-06"}
    assert hours(lake) == ["00", "01"]
    run_all(lake, dates=["2030-01-01"])
    assert lake.farm_kpis().count() == 2
    run_all(lake, dates=["2026-01-05", "2026-01-06"])
    assert lake.farm_kpis().count() == 4
    assert lake.farm_kpis(dates=["2026-01-05"]).count() == 2


def test_runs_and_farms_are_tracked_apart(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    run_all(lake)
    lake.write_bronze(hours_of(spark, 0, 0, sim_run_id="SIM-B"))
    lake.write_bronze(hours_of(spark, 0, 0, farm_id="F002"))
    run_all(lake)
    found = {(r.sim_run_id, r.farm_id, r.total_rows) for r in lake.farm_kpis().collect()}
    assert found == {("SIM-A", "F001", 4), ("SIM-B", "F001", 4), ("SIM-A", "F002", 4)}


def test_ids_like_numbers_stay_strings(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0, sim_run_id="007", farm_id="001"))
    run_all(lake)
    row = lake.hourly_energy().first()
    assert (row.sim_run_id, row.farm_id, row.date) == ("007", "001", "2026-01-05")
    assert row.process_key == "007|001|2026-01-05T00:00:00Z"


def test_rows_without_key_parts_are_quarantined(spark, lake):
    good = hours_of(spark, 0, 0)
    bad = telemetry(spark, {"farm_id": None}, {"sim_run_id": None}, {"event_time": None})
    lake.write_bronze(good.union(bad))
    run_all(lake)
    assert lake.bronze().count() == 7
    assert lake.quarantine().count() == 3
    assert lake.silver().count() == 4


def test_row_without_turbine_counts_for_the_farm_only(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0).union(telemetry(spark, {"turbine_id": None})))
    run_all(lake)
    assert sum(r["rows"] for r in dicts(lake.hourly_energy())) == 4
    assert lake.farm_kpis().first().total_rows == 5


def test_layout_on_disk(spark, lake, tmp_path):
    lake.write_bronze(hours_of(spark, 0, 1))
    run_all(lake)

    def folders(layer):
        found = {p.relative_to(tmp_path / "lake" / layer).parent for p in (tmp_path / "lake" / layer).rglob("*.parquet")}
        return sorted(map(str, found))

    day = "sim_run_id=SIM-A/farm_id=F001/date=2026-01-05"
    assert folders("bronze") == [f"{day}/hour=2026-01-05T0{h}%3A00%3A00Z" for h in (0, 1)]
    assert folders("silver") == [f"{day}/hour_key=2026-01-05T0{h}%3A00%3A00Z" for h in (0, 1)]
    assert folders("gold/hourly_energy") == [day]
    assert folders("gold/farm_kpis") == [day]
    # One file per partition: rows were brought together before the write.
    assert len(list((tmp_path / "lake" / "silver").rglob("*.parquet"))) == 2


def test_guards(spark, lake):
    with pytest.raises(FileNotFoundError):
        lake.run_silver()
    with pytest.raises(FileNotFoundError):
        lake.run_hourly_energy(DT)
    with pytest.raises(FileNotFoundError):
        lake.run_farm_kpis(DT)
    usual = hours_of(spark, 0, 0)
    with pytest.raises(ValueError, match="No rows"):
        lake.write_bronze(usual.limit(0))
    with pytest.raises(ValueError, match=r"\['farm_id', 'ingest_time'\]"):
        lake.write_bronze(usual.drop("ingest_time", "farm_id"))
    with pytest.raises(KeyError):
        lake.write_bronze(usual.drop("yaw_deg"))
    for step in (0, -1, 7200):
        with pytest.raises(ValueError):
            lake.run_hourly_energy(step)
        with pytest.raises(ValueError):
            farm_kpis(usual, step)


def test_empty_layers(spark, lake, tmp_path):
    (tmp_path / "lake" / "bronze").mkdir(parents=True)
    with pytest.raises(ValueError, match="No data"):
        lake.run_silver()
    (tmp_path / "lake" / "silver").mkdir()
    assert lake.run_hourly_energy(DT) == lake.path("gold/hourly_energy")


def test_run_presence(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 0))
    lake.assert_runs_present("bronze", ["SIM-A"])
    with pytest.raises(RuntimeError, match=r"\['SIM-B'\].*\['SIM-A'\]"):
        lake.assert_runs_present("bronze", ["SIM-A", "SIM-B"])
    lake.write_bronze(hours_of(spark, 0, 0, sim_run_id="SIM-B"))
    run_all(lake)
    lake.assert_runs_present("gold/hourly_energy", ["SIM-A", "SIM-B"])


def test_ledger_items_are_sorted_labels(spark, lake):
    lake.write_bronze(hours_of(spark, 0, 1).union(hours_of(spark, 0, 0, farm_id="F000")))
    lake.run_silver()
    assert [r.process_key for r in lake.ledger.items("silver").collect()] == [
        "SIM-A|F000|2026-01-05T00:00:00Z",
        "SIM-A|F001|2026-01-05T00:00:00Z",
        "SIM-A|F001|2026-01-05T01:00:00Z",
    ]
    assert lake.ledger.items("hourly_energy").count() == 0


def test_session_must_be_utc(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Oslo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            Lake(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_and_zoned_times_are_read_as_utc(spark, lake):
    text = hours_of(spark, 0, 0).withColumns(
        {"event_time": F.lit("2026-01-05 03:59:59.1239"), "ingest_time": F.lit("2026-01-05T05:00:00+01:00")}
    )
    lake.write_bronze(text)
    row = lake.bronze().first()
    assert row.hour == "2026-01-05T03:00:00Z"
    assert lake.bronze().select(F.date_format("event_time", "HH:mm:ss.SSSSSS")).first()[0] == "03:59:59.123000"
    assert lake.bronze().select(F.date_format("ingest_time", "HH:mm")).first()[0] == "04:00"
