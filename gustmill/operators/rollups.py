"""Hourly rollups of clean telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustmill.functions.quality import measure
from gustmill.functions.timekeys import date_key, floor_hour, hour_key, process_key
from gustmill.schemas import FARM_KPIS, HOURLY_ENERGY, conform


def check_step(dt_seconds: float) -> None:
    if not 0 < dt_seconds <= 3600:
        raise ValueError(f"dt_seconds must be above 0 and at most 3600, not {dt_seconds}")


def row_energy(telemetry: DataFrame, dt_seconds: float) -> DataFrame:
    """Add ``hour``, ``energy_kwh`` (power held for one step) and ``is_running``."""
    check_step(dt_seconds)
    return telemetry.withColumns(
        {
            "hour": floor_hour(F.col("event_time")),
            "energy_kwh": measure(F.col("power_kw")) * F.lit(dt_seconds / 3600.0),
            "is_running": F.col("status").eqNullSafe("RUNNING"),
        }
    )


def _mean(column: str):
    return F.avg(measure(F.col(column)))


def _energy():
    return F.coalesce(F.sum("energy_kwh"), F.lit(0.0))


def _with_hour_keys(rollup: DataFrame) -> DataFrame:
    keyed = rollup.withColumns(
        {"date": date_key(F.col("hour")), "hour_key": hour_key(F.col("hour"))}
    )
    return keyed.withColumn(
        "process_key", process_key(F.col("sim_run_id"), F.col("farm_id"), F.col("hour_key"))
    )


def hourly_energy(telemetry: DataFrame, dt_seconds: float) -> DataFrame:
    """Turbine by hour. Rows with a NULL group key are left out."""
    keys = ["sim_run_id", "farm_id", "turbine_id", "hour"]
    rollup = (
        row_energy(telemetry, dt_seconds)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            _mean("wind_speed_mps").alias("wind_speed_mps_avg"),
            _mean("power_kw").alias("power_kw_avg"),
            _energy().alias("energy_kwh"),
            (F.count_if(~F.col("is_running")) * F.lit(dt_seconds / 60.0)).alias("downtime_minutes"),
            F.count_if("has_range_violation").alias("bad_rows"),
            F.count("event_time").alias("rows"),
        )
    )
    return conform(_with_hour_keys(rollup), HOURLY_ENERGY)


def farm_kpis(
    telemetry: DataFrame, dt_seconds: float, rated_power_kw: float = 2000.0
) -> DataFrame:
    """Farm by hour. Rows without ``turbine_id`` count here."""
    keys = ["sim_run_id", "farm_id", "hour"]
    totals = (
        row_energy(telemetry, dt_seconds)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            _mean("power_kw").alias("farm_power_kw_avg"),
            _energy().alias("farm_energy_kwh"),
            F.count_if("is_running").alias("running_rows"),
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if("has_range_violation").alias("bad_rows"),
            _mean("wind_speed_free_mps").alias("avg_free_wind"),
            _mean("wind_speed_mps").alias("avg_effective_wind"),
        )
    )
    rows_per_turbine = F.lit(int(3600 / dt_seconds))
    rates = totals.withColumns(
        {
            "availability": F.try_divide("running_rows", "total_rows"),
            "avg_wake_loss_mps": F.col("avg_free_wind") - F.col("avg_effective_wind"),
            "bad_row_rate": F.try_divide("bad_rows", "total_rows"),
            # Half-even rounding.
            "n_turbines_est": F.bround(F.try_divide(F.col("total_rows"), rows_per_turbine), 0).cast(
                "long"
            ),
        }
    )
    capacity = F.col("n_turbines_est") * F.lit(float(rated_power_kw))
    return conform(
        _with_hour_keys(
            rates.withColumn("capacity_factor", F.try_divide(F.col("farm_energy_kwh"), capacity))
        ),
        FARM_KPIS,
    )
