"""Telemetry derived from an ``events(event_id, ts, user_id, event_type, value, ...)`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustmill.schemas import FARMS, TELEMETRY, conform
from gustmill.sources.parameters import SCENARIO_WAKE, FarmShape, scenario_table

# Wake strength per run.
RUN_STRENGTH = {"SIM-A": 0.12, "SIM-B": 0.25}


def _label(letter: str, number: Column) -> Column:
    """Letter and three digits, for numbers below 1000."""
    return F.concat(F.lit(letter), F.lpad(number.cast("string"), 3, "0"))


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """One reading per event, every 500th twice, with faults at fixed strides of ``event_id``."""
    number, value, user = F.col("event_id"), F.col("value"), F.col("user_id")

    def every(stride: int):
        return number % stride == 0

    wind = (
        F.when(every(53), None)
        .when(every(97), F.lit(-5.0))
        .otherwise(value / 12)
    )
    status = (
        F.when(every(211), None)
        .when(F.col("event_type") == "error", "STOPPED")
        .when(value > 250, "CUT_OUT")
        .otherwise("RUNNING")
    )
    copies = F.when(every(500), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.select("event_id", "ts", "user_id", "event_type", "value", F.explode(copies))
    return conform(
        rows.select(
            F.when(every(2), "SIM-A").otherwise("SIM-B").alias("sim_run_id"),
            _label("F", F.floor(user / 12) % 3 + 1).alias("farm_id"),
            _label("T", user % 12 + 1).alias("turbine_id"),
            F.date_trunc("MINUTE", "ts").alias("event_time"),
            F.col("ts").alias("ingest_time"),
            (value / 10).alias("wind_speed_free_mps"),
            wind.alias("wind_speed_mps"),
            (number % 367).alias("wind_dir_deg"),
            F.when(every(101), F.lit(99999.0)).otherwise(value * 4).alias("power_kw"),
            (number % 32).alias("rotor_speed_rpm"),
            (number % 360).alias("yaw_deg"),
            status.alias("status"),
            number.cast("string").alias("source"),
        ),
        TELEMETRY,
    )


def farms_of(telemetry: DataFrame) -> DataFrame:
    """Every farm the telemetry names, all of the default shape."""
    shape = {name: F.lit(value) for name, value in FarmShape()._asdict().items()}
    return conform(telemetry.select("farm_id").dropna().distinct().withColumns(shape), FARMS)


def wake_scenarios(spark: SparkSession) -> DataFrame:
    """Wake parameters of the two runs."""
    wakes = {run: SCENARIO_WAKE._replace(wake_strength=s) for run, s in RUN_STRENGTH.items()}
    return scenario_table(spark, wakes)
