"""What-if operators: expected power, wake, and energy under other wake parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustmill.functions.physics import (
    PowerCurve,
    curve_power_kw,
    farm_places,
    farm_wake_factor,
    rotor_rpm,
    turbine_status,
    wake_factor,
)
from gustmill.functions.quality import add_range_flags, measure
from gustmill.operators.rollups import farm_kpis, hourly_energy
from gustmill.operators.sizing import fits, join_side, measured_side, table_bytes

# Turbines held in one array where coordinates are too many to send to every executor.
MAX_BLOCK_TURBINES = 500


def expected_power(
    telemetry: DataFrame, turbines: DataFrame, curve: PowerCurve = PowerCurve()
) -> DataFrame:
    """Add the power curve's answer to the recorded wind, and the gap to the recorded power."""
    speed = F.col("wind_speed_mps")
    rated = turbines.select("farm_id", "turbine_id", F.col("rated_power_kw").alias("_rated_kw"))
    joined = telemetry.join(measured_side(turbines)(rated), ["farm_id", "turbine_id"], "left")
    return (
        joined.withColumns(
            {
                "expected_power_kw": curve_power_kw(speed, F.col("_rated_kw"), curve),
                "expected_status": turbine_status(speed, curve),
            }
        )
        .withColumns(
            {
                "expected_rotor_rpm": rotor_rpm(speed, F.col("expected_status")),
                "power_gap_kw": measure(F.col("power_kw")) - F.col("expected_power_kw"),
            }
        )
        .select(
            *telemetry.columns,
            "expected_power_kw",
            "expected_status",
            "expected_rotor_rpm",
            "power_gap_kw",
        )
    )


def _places(turbines: DataFrame) -> DataFrame:
    return turbines.select(
        "farm_id",
        "turbine_id",
        F.col("x_m").alias("_x"),
        F.col("y_m").alias("_y"),
        F.col("rated_power_kw").alias("_rated_kw"),
    )


def _params(scenarios: DataFrame) -> DataFrame:
    sigma = F.col("crosswind_sigma_m")
    return scenarios.select(
        "sim_run_id",
        F.col("wake_strength").alias("_strength"),
        (1.0 / F.col("decay_length_m")).alias("_per_decay"),
        (1.0 / (2.0 * sigma * sigma)).alias("_per_width"),
    )


def _with_wind(rows: DataFrame) -> DataFrame:
    """Unit vector of the direction, computed once per row ahead of the fold."""
    angle = F.radians(measure(F.col("wind_dir_deg")))
    return rows.withColumns({"_ux": F.cos(angle), "_uy": F.sin(angle)})


def _located(turbines: DataFrame) -> DataFrame:
    """A turbine without coordinates shelters nobody; its own rows have no factor."""
    return turbines.dropna(subset=["farm_id", "x_m", "y_m"])


def _sent(turbines: DataFrame) -> Broadcast:
    """Coordinates of all farms for every executor, in id order. Only for tables that fit."""
    rows = _located(turbines).orderBy("farm_id", "turbine_id").select("farm_id", "x_m", "y_m")
    return turbines.sparkSession.sparkContext.broadcast(farm_places(rows.toArrow()))


def _blocks(turbines: DataFrame, max_turbines: int) -> DataFrame:
    """Each farm's coordinates as two lists in id order, in rows of up to ``max_turbines``."""
    place = F.row_number().over(Window.partitionBy("farm_id").orderBy("turbine_id"))
    members = F.sort_array(F.collect_list(F.struct("turbine_id", "x_m", "y_m")))
    return (
        _located(turbines)
        .withColumn("_block", F.floor((place - 1) / max_turbines))
        .groupBy("farm_id", "_block")
        .agg(members.alias("_members"))
        .selectExpr("farm_id", "_members.x_m AS _source_x", "_members.y_m AS _source_y")
    )


_POSE = ("_x", "_y", "_ux", "_uy")
_WAKE = ("_strength", "_per_decay", "_per_width")


def _sheltered(
    telemetry: DataFrame,
    turbines: DataFrame,
    scenarios: DataFrame,
    max_block_turbines: int = MAX_BLOCK_TURBINES,
    named_only: bool = False,
) -> DataFrame:
    """Telemetry with ``wake_factor``, ``wind_speed_eff_mps`` and ``_rated_kw``."""
    n_bytes = table_bytes(turbines)
    places = join_side(n_bytes)(_places(turbines))
    params = measured_side(scenarios)(_params(scenarios))
    turbine, run = ["farm_id", "turbine_id"], ["sim_run_id"]
    rows = telemetry.join(params, run, "left_semi") if named_only else telemetry
    if fits(n_bytes):
        placed = _with_wind(rows.join(places, turbine, "left").join(params, run, "left"))
        factor = farm_wake_factor(_sent(turbines), "farm_id", *_POSE, *_WAKE)
        waked = placed.withColumn("wake_factor", factor)
    else:
        pose = ["sim_run_id", "farm_id", "turbine_id", "wind_dir_deg"]
        poses = rows.select(*pose).dropna().distinct().join(places, turbine).join(params, run)
        factor = wake_factor(*_POSE, "_source_x", "_source_y", *_WAKE)
        factors = (
            _with_wind(poses.join(_blocks(turbines, max_block_turbines), "farm_id"))
            .withColumn("_part", factor)
            .groupBy(*pose)
            .agg(F.product("_part").alias("wake_factor"))
        )
        waked = rows.join(factors, pose, "left").join(places, turbine, "left")
    slowed = measure(F.col("wind_speed_free_mps")) * F.col("wake_factor")
    return waked.withColumn(
        "wind_speed_eff_mps", F.when(slowed.isNotNull(), F.greatest(F.lit(0.0), slowed))
    ).select(*telemetry.columns, "wake_factor", "wind_speed_eff_mps", "_rated_kw")


def wake_effective_speed(
    telemetry: DataFrame,
    turbines: DataFrame,
    scenarios: DataFrame,
    max_block_turbines: int = MAX_BLOCK_TURBINES,
) -> DataFrame:
    """Add ``wake_factor`` and ``wind_speed_eff_mps``: free wind behind the farm's other turbines.

    The turbines are measured first. Below the broadcast bound every executor gets all coordinates
    once, and rows are neither shuffled nor given lists, whatever the size of a farm. Beyond it each
    distinct (run, farm, turbine, direction) meets its farm's coordinates in lists of up to
    ``max_block_turbines``; the factors are multiplied, and the product is joined back.
    """
    return _sheltered(telemetry, turbines, scenarios, max_block_turbines).drop("_rated_kw")


def under_scenarios(telemetry: DataFrame, base_run: str, runs: Sequence[str]) -> DataFrame:
    """The wind recorded in ``base_run``, once for each run id in ``runs``."""
    copies = F.explode(F.array(*[F.lit(run) for run in runs]))
    base = telemetry.filter(F.col("sim_run_id") == base_run).drop("sim_run_id")
    return base.withColumn("sim_run_id", copies).select(*telemetry.columns)


def what_if_telemetry(
    telemetry: DataFrame,
    turbines: DataFrame,
    scenarios: DataFrame,
    curve: PowerCurve = PowerCurve(),
    max_block_turbines: int = MAX_BLOCK_TURBINES,
) -> DataFrame:
    """Telemetry as the scenarios' wake and the power curve would make it from the free wind.

    Rows of runs that ``scenarios`` does not name are left out.
    """
    speed = F.col("wind_speed_eff_mps")
    rows = _sheltered(telemetry, turbines, scenarios, max_block_turbines, named_only=True)
    replaced = (
        rows.withColumns(
            {
                "wind_speed_mps": speed,
                "power_kw": curve_power_kw(speed, F.col("_rated_kw"), curve),
                "status": turbine_status(speed, curve),
                "yaw_deg": F.col("wind_dir_deg"),
            }
        )
        .withColumn("rotor_speed_rpm", rotor_rpm(speed, F.col("status")))
        .select(*telemetry.columns)
    )
    return add_range_flags(replaced)


def what_if_energy(
    telemetry: DataFrame,
    turbines: DataFrame,
    scenarios: DataFrame,
    dt_seconds: float,
    rated_power_kw: float = 2000.0,
    curve: PowerCurve = PowerCurve(),
    max_block_turbines: int = MAX_BLOCK_TURBINES,
) -> DataFrame:
    """Farm KPIs per scenario, from recorded free wind."""
    rows = what_if_telemetry(telemetry, turbines, scenarios, curve, max_block_turbines)
    return farm_kpis(rows, dt_seconds, rated_power_kw)


def what_if_turbine_energy(
    telemetry: DataFrame,
    turbines: DataFrame,
    scenarios: DataFrame,
    dt_seconds: float,
    curve: PowerCurve = PowerCurve(),
    max_block_turbines: int = MAX_BLOCK_TURBINES,
) -> DataFrame:
    """Hourly turbine energy per scenario, from recorded free wind."""
    rows = what_if_telemetry(telemetry, turbines, scenarios, curve, max_block_turbines)
    return hourly_energy(rows, dt_seconds)
