"""Layout, power curve, rotor and wake against a plain evaluation of their formulas."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from frames import dicts, telemetry
from gustmill.functions.physics import PowerCurve, curve_power_kw, rotor_rpm, turbine_status
from gustmill.operators import sizing
from gustmill.operators.layout import turbine_layout
from gustmill.operators.runs import missing_runs, scenario_compare
from gustmill.operators.whatif import (
    expected_power,
    under_scenarios,
    wake_effective_speed,
    what_if_energy,
    what_if_telemetry,
    what_if_turbine_energy,
)
from gustmill.schemas import FARMS, TURBINES
from gustmill.sources.parameters import (
    SCENARIO_WAKE,
    FarmShape,
    WakeParameters,
    farm_table,
    scenario_table,
)


def farm(spark, *specs):
    return turbine_layout(spark.createDataFrame(list(specs), FARMS))


def scenarios(spark, **strengths):
    wakes = {run.replace("_", "-"): SCENARIO_WAKE._replace(wake_strength=s) for run, s in strengths.items()}
    return scenario_table(spark, wakes)


def plain_wake(free, direction, own, places, strength, decay, sigma):
    ux, uy = math.cos(math.radians(direction)), math.sin(math.radians(direction))
    factor = 1.0
    for x, y in places:
        dx, dy = own[0] - x, own[1] - y
        downwind = dx * ux + dy * uy
        if downwind > 0:
            crosswind = abs(dy * ux - dx * uy)
            near = math.exp(-downwind / decay) * math.exp(-(crosswind**2) / (2 * sigma**2))
            factor *= 1 - strength * near
    return max(0.0, free * factor)


def test_layout(spark):
    turbines = dicts(farm(spark, ("F001", 3, 4, 600.0, 2000.0), ("F002", 1, 1, 5.0, 9.0), ("F003", 0, 4, 1.0, 1.0)))
    first = {t["turbine_id"]: (t["x_m"], t["y_m"]) for t in turbines if t["farm_id"] == "F001"}
    assert len(first) == 12
    assert first["T001"] == (0.0, 0.0)
    assert first["T004"] == (1800.0, 0.0)
    assert first["T005"] == (0.0, 600.0)
    assert first["T012"] == (1800.0, 1200.0)
    assert [t["rated_power_kw"] for t in turbines if t["farm_id"] == "F002"] == [9.0]


def test_layout_beyond_three_digits(spark):
    ids = {t["turbine_id"] for t in dicts(farm(spark, ("F001", 30, 40, 1.0, 1.0)))}
    assert len(ids) == 1200 and {"T999", "T1000", "T1200"} <= ids


@pytest.mark.parametrize(
    "speed, power, status, rotor",
    [
        (2.99, 0.0, "STOPPED", 0.0),
        (3.0, 0.0, "RUNNING", 6.0),
        (7.5, 250.0, "RUNNING", 12.0),
        (12.0, 2000.0, "RUNNING", 18.0),
        (24.99, 2000.0, "RUNNING", 18.0),
        (25.0, 0.0, "CUT_OUT", 0.0),
        (-5.0, 0.0, "STOPPED", 0.0),
        (None, None, None, None),
        (float("nan"), None, None, None),
    ],
)
def test_power_curve(spark, speed, power, status, rotor):
    frame = spark.createDataFrame([(speed, 2000.0)], "v double, rated double")
    v, rated = F.col("v"), F.col("rated")
    row = frame.select(curve_power_kw(v, rated), turbine_status(v), rotor_rpm(v, turbine_status(v))).first()
    assert tuple(row) == (power, status, rotor)


def test_power_curve_thresholds_are_parameters(spark):
    curve = PowerCurve(4.0, 10.0, 20.0)
    frame = spark.createDataFrame([(3.5,), (7.0,), (10.0,), (20.0,)], "v double")
    found = [tuple(r) for r in frame.select(curve_power_kw(F.col("v"), F.lit(800.0), curve), turbine_status(F.col("v"), curve)).collect()]
    assert found == [(0.0, "STOPPED"), (100.0, "RUNNING"), (800.0, "RUNNING"), (0.0, "CUT_OUT")]


def test_expected_power_keeps_rows_of_unknown_turbines(spark):
    rows = telemetry(spark, {"wind_speed_mps": 12.0, "power_kw": 1500.0}, {"turbine_id": "T999"})
    found = {r["turbine_id"]: r for r in dicts(expected_power(rows, farm(spark, ("F001", 1, 2, 600.0, 2000.0))))}
    assert (found["T001"]["expected_power_kw"], found["T001"]["power_gap_kw"]) == (2000.0, -500.0)
    assert found["T999"]["expected_power_kw"] is None


def test_two_turbines_in_line(spark):
    turbines = farm(spark, ("F001", 1, 2, 600.0, 2000.0))
    wind = {"wind_speed_free_mps": 8.0, "wind_dir_deg": 0.0}
    rows = telemetry(spark, {**wind, "turbine_id": "T001"}, {**wind, "turbine_id": "T002"})
    found = {r["turbine_id"]: r["wind_speed_eff_mps"] for r in dicts(wake_effective_speed(rows, turbines, scenarios(spark, SIM_A=0.12)))}
    assert found["T001"] == 8.0
    assert found["T002"] == pytest.approx(8 * (1 - 0.12 * math.exp(-600 / 900)), rel=1e-12)


def _wake_case(spark):
    rng = random.Random(7)
    shapes = {"F001": (3, 4), "F002": (2, 5)}
    turbines = farm(spark, *[(f, *shape, 600.0, 2000.0) for f, shape in shapes.items()])
    rows = [
        {
            "farm_id": f,
            "turbine_id": f"T{n + 1:03d}",
            "sim_run_id": run,
            "wind_dir_deg": float(rng.choice([0, 45, 90, 180, 225, 270, 315, 360, rng.randint(0, 359)])),
            "wind_speed_free_mps": float(rng.randint(0, 30)),
            "source": f"{f}{n}{run}",
        }
        for f, (n_rows, n_cols) in shapes.items()
        for n in range(n_rows * n_cols)
        for run in ("SIM-A", "SIM-B")
    ]
    unknown = [
        {"turbine_id": "T999", "source": "no turbine"},
        {"farm_id": "F999", "source": "no farm"},
        {"sim_run_id": "SIM-Z", "source": "no parameters"},
        {"wind_dir_deg": None, "source": "no direction"},
        {"wind_speed_free_mps": None, "source": "no wind"},
    ]
    # The direction repeats, with other wind and as an exact copy.
    again = [{**rows[0], "wind_speed_free_mps": 3.0, "source": "again"}, rows[1]]
    return turbines, telemetry(spark, *rows, *unknown, *again)


@pytest.mark.parametrize("block", [500, 3])
@pytest.mark.parametrize("broadcast", [True, False])
def test_wake_matches_the_formula(spark, monkeypatch, block, broadcast):
    if not broadcast:
        monkeypatch.setattr(sizing, "MAX_BROADCAST_BYTES", -1)
    turbines, rows = _wake_case(spark)
    places: dict[str, dict] = {}
    for t in dicts(turbines):
        places.setdefault(t["farm_id"], {})[t["turbine_id"]] = (t["x_m"], t["y_m"])
    strength = {"SIM-A": 0.12, "SIM-B": 0.25}
    found = dicts(wake_effective_speed(rows, turbines, scenarios(spark, SIM_A=0.12, SIM_B=0.25), block))
    assert len(found) == rows.count()
    for r in found:
        if r["source"].startswith("no "):
            assert r["wind_speed_eff_mps"] is None
        else:
            farm_places = places[r["farm_id"]]
            expected = plain_wake(
                r["wind_speed_free_mps"], r["wind_dir_deg"], farm_places[r["turbine_id"]],
                [p for t, p in farm_places.items() if t != r["turbine_id"]],
                strength[r["sim_run_id"]], 900.0, 250.0,
            )
            assert r["wind_speed_eff_mps"] == pytest.approx(expected, rel=1e-12, abs=1e-12)


def test_wake_bounds_and_strength(spark):
    turbines, rows = _wake_case(spark)
    base = rows.filter("sim_run_id = 'SIM-A' AND source NOT LIKE 'no %'")
    runs = {"W00": 0.0, "W03": 0.3, "W07": 0.7, "W10": 1.0}
    found = wake_effective_speed(under_scenarios(base, "SIM-A", list(runs)), turbines, scenarios(spark, **runs))
    by_reading: dict[tuple, list] = {}
    for r in sorted(dicts(found), key=lambda r: r["sim_run_id"]):
        by_reading.setdefault((r["source"], r["wind_speed_free_mps"]), []).append(r)
    for readings in by_reading.values():
        speeds = [r["wind_speed_eff_mps"] for r in readings]
        assert speeds == sorted(speeds, reverse=True)
        assert speeds[0] == readings[0]["wind_speed_free_mps"]
        assert min(speeds) >= 0


def test_negative_wind_stops_at_zero(spark):
    rows = telemetry(spark, {"wind_speed_free_mps": -4.0})
    found = wake_effective_speed(rows, farm(spark, ("F001", 1, 1, 1.0, 1.0)), scenarios(spark, SIM_A=0.1))
    assert found.first().wind_speed_eff_mps == 0.0


def test_what_if_recomputes_the_turbine(spark):
    turbines, params = farm(spark, ("F001", 1, 2, 600.0, 2000.0)), scenarios(spark, SIM_A=0.12)
    rows = telemetry(
        spark,
        {"turbine_id": "T002", "wind_dir_deg": 0.0, "wind_speed_free_mps": 10.0, "power_kw": 99999.0, "yaw_deg": 7.0},
        {"sim_run_id": "SIM-Z"},
    )
    (row,) = dicts(what_if_telemetry(rows, turbines, params))
    speed = plain_wake(10.0, 0.0, (600.0, 0.0), [(0.0, 0.0)], 0.12, 900.0, 250.0)
    assert row["wind_speed_mps"] == pytest.approx(speed)
    assert row["power_kw"] == pytest.approx(2000 * ((speed - 3) / 9) ** 3)
    assert row["rotor_speed_rpm"] == pytest.approx(6 + (speed - 3) * 12 / 9)
    assert (row["status"], row["yaw_deg"], row["has_range_violation"]) == ("RUNNING", 0.0, False)


def test_turbine_energies_add_up_to_the_farm(spark):
    turbines, rows = _wake_case(spark)
    params = scenarios(spark, SIM_A=0.12, SIM_B=0.25)
    known = rows.filter("source NOT LIKE 'no %'")
    per_farm = what_if_energy(known, turbines, params, 600)
    total = per_farm.agg(F.sum("farm_energy_kwh")).first()[0]
    parts = what_if_turbine_energy(known, turbines, params, 600).agg(F.sum("energy_kwh")).first()[0]
    assert parts == pytest.approx(total) and total > 0
    assert per_farm.filter("availability < 0 OR availability > 1").count() == 0


def test_scenario_compare(spark):
    schema = (
        "sim_run_id string, farm_id string, hour string, farm_energy_kwh double, "
        "capacity_factor double, availability double, avg_wake_loss_mps double"
    )
    rows = [
        ("A", "F1", "h1", 10.0, 0.5, 1.0, None),
        ("B", "F1", "h1", 7.0, 0.25, 0.5, 1.0),
        ("A", "F1", "h2", 1.0, 0.1, 1.0, 0.0),
        ("B", "F2", "h1", 1.0, 0.1, 1.0, 0.0),
        ("C", "F1", "h1", 1.0, 0.1, 1.0, 0.0),
    ]
    (row,) = dicts(scenario_compare(spark.createDataFrame(rows, schema), "A", "B"))
    assert (row["farm_id"], row["hour"]) == ("F1", "h1")
    assert (row["farm_energy_kwh_delta"], row["capacity_factor_delta"]) == (-3.0, -0.25)
    assert (row["avg_wake_loss_mps_a"], row["avg_wake_loss_mps_delta"]) == (None, None)


def test_missing_runs(spark):
    rows = telemetry(spark, {}, {"sim_run_id": "SIM-B"})
    assert missing_runs(rows, ["SIM-A", "SIM-B"]).count() == 0
    assert [r.sim_run_id for r in missing_runs(rows, ["SIM-C", "SIM-A"]).collect()] == ["SIM-C"]


def test_turbine_contract(spark):
    found = farm(spark, ("F001", 1, 1, 1.0, 1.0)).schema
    assert found.simpleString() == TURBINES.simpleString()


def test_parameter_tables(spark):
    turbines = turbine_layout(farm_table(spark, {"F001": FarmShape(), "F002": FarmShape(n_rows=1)}))
    assert turbines.count() == 16
    rows = dicts(scenario_table(spark, {"W": WakeParameters(), "S": SCENARIO_WAKE}))
    assert [tuple(r.values()) for r in rows] == [("W", 0.15, 800.0, 200.0), ("S", 0.18, 900.0, 250.0)]
