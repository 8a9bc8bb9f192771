"""Properties that hold for any telemetry."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from frames import at, telemetry
from gustmill.operators.dedup import flag_duplicates, keep_first
from gustmill.operators.rollups import farm_kpis, hourly_energy
from gustmill.operators.telemetry import clean_telemetry, to_bronze

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

readings = st.lists(
    st.fixed_dictionaries(
        {
            "event_time": st.integers(0, 130).map(lambda m: at(0, m)),
            "turbine_id": st.sampled_from(["T001", "T002", None]),
            "sim_run_id": st.sampled_from(["SIM-A", "SIM-B"]),
            "ingest_time": st.integers(0, 3).map(lambda m: at(5, m)),
            "power_kw": st.sampled_from([None, 0.0, 250.0, 99999.0, float("nan")]),
            "wind_speed_mps": st.sampled_from([None, -5.0, 4.0, 12.0]),
            "status": st.sampled_from([None, "RUNNING", "STOPPED", "CUT_OUT"]),
        }
    ),
    min_size=1,
    max_size=40,
)


def rows(df):
    return sorted(map(repr, df.collect()))


@few
@given(readings)
def test_dedup_ignores_order_and_partitions_and_is_idempotent(spark, batch):
    frame = to_bronze(telemetry(spark, *batch))
    once = rows(keep_first(frame))
    assert rows(keep_first(keep_first(frame))) == once
    assert rows(keep_first(frame.repartition(5))) == once
    assert rows(keep_first(to_bronze(telemetry(spark, *batch[::-1])))) == once
    flagged = flag_duplicates(frame.repartition(5))
    assert flagged.count() == len(batch)
    assert rows(flagged.filter("NOT is_duplicate").drop("is_duplicate")) == once


@few
@given(readings)
def test_rollups_add_up(spark, batch):
    clean = clean_telemetry(to_bronze(telemetry(spark, *batch)))
    kpis = farm_kpis(clean, 600).collect()
    named = farm_kpis(clean.filter("turbine_id IS NOT NULL"), 600).collect()
    parts: dict[tuple, float] = {}
    downtime: dict[tuple, float] = {}
    for r in hourly_energy(clean, 600).collect():
        key = (r.sim_run_id, r.farm_id, r.hour)
        parts[key] = parts.get(key, 0.0) + r.energy_kwh
        downtime[key] = downtime.get(key, 0.0) + r.downtime_minutes
    for r in named:
        key = (r.sim_run_id, r.farm_id, r.hour)
        assert abs(parts[key] - r.farm_energy_kwh) < 1e-6
        assert abs(downtime[key] - (r.total_rows - r.running_rows) * 10.0) < 1e-9
    for r in kpis:
        assert 0 <= r.availability <= 1 and 0 <= r.bad_row_rate <= 1
        assert r.running_rows <= r.total_rows
    assert sum(r.total_rows for r in kpis) == clean.count()
