"""Hand-made rows for the places where Spark's defaults would give another answer."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from frames import at, dicts, telemetry
from gustmill.functions.quality import add_range_flags
from gustmill.operators.dedup import THREE_COLUMN_KEYS, flag_duplicates, keep_first
from gustmill.operators.increments import HOUR, closed_hours, latest_entries, ledger_entries
from gustmill.operators.rollups import farm_kpis, hourly_energy, row_energy
from gustmill.operators.telemetry import clean_telemetry, to_bronze
from gustmill.plans.increment import open_increment

NAN = float("nan")


def test_range_flags(spark):
    cases = {
        "null": ({"wind_speed_mps": None}, "wind_speed_mps"),
        "nan": ({"wind_speed_mps": NAN}, "wind_speed_mps"),
        "bounds": ({"wind_dir_deg": 360.0, "power_kw": 10000.0, "wind_speed_mps": 0.0}, ""),
        "two": ({"wind_speed_mps": -5.0, "power_kw": 99999.0}, "wind_speed_mps,power_kw"),
        "order": (
            {"power_kw": -1.0, "yaw_deg": 361.0, "rotor_speed_rpm": 31.0, "wind_dir_deg": -1.0},
            "wind_dir_deg,rotor_speed_rpm,yaw_deg,power_kw",
        ),
        "free wind is not checked": ({"wind_speed_free_mps": -9.0}, ""),
    }
    rows = telemetry(spark, *[{**row, "source": name} for name, (row, _) in cases.items()])
    for found in (add_range_flags(rows), add_range_flags(to_bronze(rows))):
        for row in dicts(found):
            expected = cases[row["source"]][1]
            assert row["range_violation_fields"] == expected
            assert row["has_range_violation"] is (expected != "")


def test_ranges_are_parameters(spark):
    rows = telemetry(spark, {"power_kw": 99999.0, "yaw_deg": 0.5})
    ranges = (("yaw_deg", 1.0, 2.0), ("power_kw", 0.0, float("inf")))
    assert add_range_flags(rows, ranges).first().range_violation_fields == "yaw_deg"


def test_absent_column_is_skipped(spark):
    rows = telemetry(spark, {"power_kw": 99999.0, "yaw_deg": 400.0})
    flagged = add_range_flags(rows.drop("power_kw")).first()
    assert flagged.range_violation_fields == "yaw_deg"
    none = add_range_flags(rows.select("source")).first()
    assert (none.has_range_violation, none.range_violation_fields) == (False, "")


def test_nan_is_null_after_ingest(spark):
    row = to_bronze(telemetry(spark, {"power_kw": NAN})).first()
    assert row.power_kw is None


def test_times_and_keys(spark):
    row = to_bronze(telemetry(spark, {"event_time": at(27.5)})).first()
    assert (row.date, row.hour) == ("2026-01-06", "2026-01-06T03:00:00Z")


def test_null_and_nan_readings_in_rollups(spark):
    rows = telemetry(spark, {"power_kw": None, "wind_speed_mps": NAN}, {"power_kw": NAN, "source": "t"})
    flagged = add_range_flags(rows)
    row = hourly_energy(flagged, 60).first()
    assert (row.energy_kwh, row.power_kw_avg, row["rows"]) == (0.0, None, 2)
    assert row.wind_speed_mps_avg == 8.0
    kpi = farm_kpis(flagged, 60).first()
    assert (kpi.farm_energy_kwh, kpi.farm_power_kw_avg, kpi.bad_rows) == (0.0, None, 2)


def test_energy_uses_the_exact_step(spark):
    rows = telemetry(spark, {"power_kw": 600.0})
    assert row_energy(rows, 60).first().energy_kwh == 600.0 * (60 / 3600.0)


def test_null_status_is_downtime(spark):
    flagged = add_range_flags(telemetry(spark, {"status": None}, {"status": "STOPPED"}, {}))
    assert hourly_energy(flagged, 60).first().downtime_minutes == 2.0
    kpi = farm_kpis(flagged, 60).first()
    assert (kpi.running_rows, kpi.total_rows) == (1, 3)
    assert kpi.availability == pytest.approx(1 / 3)


def test_null_group_keys(spark):
    flagged = add_range_flags(telemetry(spark, {"turbine_id": None}, {"farm_id": None}, {"event_time": None}, {}))
    assert hourly_energy(flagged, 60).first()["rows"] == 1
    assert [r.total_rows for r in farm_kpis(flagged, 60).collect()] == [2]


def test_wake_loss_is_a_difference_of_averages(spark):
    rows = telemetry(
        spark,
        {"wind_speed_free_mps": 10.0, "wind_speed_mps": None},
        {"wind_speed_free_mps": 6.0, "wind_speed_mps": 5.0},
    )
    assert farm_kpis(add_range_flags(rows), 60).first().avg_wake_loss_mps == 3.0


@pytest.mark.parametrize("rows, estimate", [(1, 0), (3, 2), (5, 2), (7, 4)])
def test_turbine_estimate_rounds_half_to_even(spark, rows, estimate):
    frame = telemetry(spark, *[{"source": str(n)} for n in range(rows)])
    row = farm_kpis(add_range_flags(frame), 1800, 2000.0).first()
    assert row.n_turbines_est == estimate
    energy = rows * 600.0 * 0.5
    assert row.capacity_factor == (None if estimate == 0 else energy / (estimate * 2000.0))


def test_spikes_stay_in_the_sums(spark):
    rows = clean_telemetry(to_bronze(telemetry(spark, {"power_kw": 99999.0})))
    assert hourly_energy(rows, 3600).first().energy_kwh == 99999.0


def test_same_key_in_two_runs(spark):
    rows = telemetry(spark, {}, {"sim_run_id": "SIM-B", "ingest_time": at(1)})
    assert keep_first(rows).count() == 2
    assert [r.sim_run_id for r in keep_first(rows, THREE_COLUMN_KEYS).collect()] == ["SIM-A"]


def test_first_is_earliest_ingest_then_source_then_content(spark):
    copies = [
        {"ingest_time": at(1), "source": "a", "power_kw": 1.0},
        {"ingest_time": at(0), "source": "c", "power_kw": 2.0},
        {"ingest_time": at(0), "source": "b", "power_kw": 4.0},
        {"ingest_time": at(0), "source": "b", "power_kw": 3.0},
    ]
    for order in (copies, copies[::-1]):
        rows = telemetry(spark, *order)
        for frame in (rows, rows.repartition(4, "power_kw")):
            assert [r.power_kw for r in keep_first(frame).collect()] == [3.0]
            flags = {r.power_kw: r.is_duplicate for r in flag_duplicates(frame).collect()}
            assert flags == {1.0: True, 2.0: True, 3.0: False, 4.0: True}


def test_null_key_parts_compare_equal(spark):
    rows = telemetry(spark, {"turbine_id": None}, {"turbine_id": None, "ingest_time": at(1)})
    assert keep_first(rows).count() == 1


def test_exact_copies_leave_one_unflagged(spark):
    rows = telemetry(spark, *[{}] * 40).repartition(8)
    flags = [r.is_duplicate for r in flag_duplicates(rows).collect()]
    assert (len(flags), flags.count(False)) == (40, 1)


def test_silver_keeps_the_duplicate_column_false(spark):
    rows = clean_telemetry(to_bronze(telemetry(spark, {}, {})))
    assert [r.is_duplicate for r in rows.collect()] == [False]


def test_ledger_joins(spark):
    shut = spark.createDataFrame([("SIM-A", "F001", "2026-01-05T00:00:00Z")], ", ".join(f"{n} string" for n in HOUR))
    rows = telemetry(
        spark, {"event_time": at(0, 59)}, {"event_time": at(1)}, {"farm_id": "F002"}, {"farm_id": None}, {"event_time": None}
    )
    layer = to_bronze(rows).withColumnRenamed("hour", "hour_key")
    found = open_increment(layer, shut)
    assert (found.n_hours, found.n_present) == (2, 3)
    left = {(r.farm_id, r.event_time) for r in found.restrict(layer, ["farm_id", "hour_key"]).collect()}
    assert left == {("F001", at(1)), ("F002", at(0))}
    assert open_increment(layer, found.hours.limit(0)).restrict(layer, ["farm_id", "hour_key"]).count() == 3


def test_latest_entry_counts(spark):
    keys = ", ".join(f"{n} string" for n in HOUR)
    one = spark.createDataFrame([("SIM-A", "F001", "2026-01-05T00:00:00Z")], keys)
    two = one.unionByName(spark.createDataFrame([("SIM-A", "F001", "2026-01-05T01:00:00Z")], keys))
    entries = ledger_entries(two.union(two), True, 2).unionByName(ledger_entries(one, False, 3))
    assert [r.hour_key[11:13] for r in closed_hours(entries).collect()] == ["01"]
    old = entries.withColumn("sequence", F.lit(None).cast("long")).withColumn("closed", ~F.col("closed"))
    assert sorted((r.hour_key[11:13], r.closed, r.sequence) for r in latest_entries(entries.unionByName(old)).collect()) == [
        ("00", False, 3),
        ("01", True, 2),
    ]
    assert closed_hours(entries.limit(0)).count() == 0


def test_flags_of_empty_input(spark):
    empty = telemetry(spark, {}).limit(0)
    assert hourly_energy(clean_telemetry(to_bronze(empty)), 60).count() == 0
    assert flag_duplicates(empty).count() == 0
    assert farm_kpis(add_range_flags(empty), 60).count() == 0
