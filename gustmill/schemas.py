"""Storage contracts of the layers, the ledger and the dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _F, _D, _L, _B, _TS = (
    T.StringType(),
    T.FloatType(),
    T.DoubleType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)

MEASUREMENTS = (
    "wind_speed_free_mps",
    "wind_speed_mps",
    "wind_dir_deg",
    "power_kw",
    "rotor_speed_rpm",
    "yaw_deg",
)

TELEMETRY = _schema(
    ("event_time", _TS),
    ("farm_id", _S),
    ("turbine_id", _S),
    *((name, _F) for name in MEASUREMENTS),
    ("status", _S),
    ("sim_run_id", _S),
    ("ingest_time", _TS),
    ("source", _S),
)

BRONZE_PARTITIONS = ("sim_run_id", "farm_id", "date", "hour")
BRONZE = T.StructType(TELEMETRY.fields + _schema(("date", _S), ("hour", _S)).fields)

CLEAN_TELEMETRY = T.StructType(
    TELEMETRY.fields
    + _schema(
        ("is_duplicate", _B), ("has_range_violation", _B), ("range_violation_fields", _S)
    ).fields
)

SILVER_PARTITIONS = ("sim_run_id", "farm_id", "date", "hour_key")
SILVER = T.StructType(CLEAN_TELEMETRY.fields + _schema(("date", _S), ("hour_key", _S)).fields)

GOLD_PARTITIONS = ("sim_run_id", "farm_id", "date")

HOURLY_ENERGY = _schema(
    ("sim_run_id", _S),
    ("farm_id", _S),
    ("turbine_id", _S),
    ("hour", _TS),
    ("wind_speed_mps_avg", _D),
    ("power_kw_avg", _D),
    ("energy_kwh", _D),
    ("downtime_minutes", _D),
    ("bad_rows", _L),
    ("rows", _L),
    ("date", _S),
    ("hour_key", _S),
    ("process_key", _S),
)

FARM_KPIS = _schema(
    ("sim_run_id", _S),
    ("farm_id", _S),
    ("hour", _TS),
    ("farm_power_kw_avg", _D),
    ("farm_energy_kwh", _D),
    ("running_rows", _L),
    ("total_rows", _L),
    ("bad_rows", _L),
    ("avg_free_wind", _D),
    ("avg_effective_wind", _D),
    ("date", _S),
    ("availability", _D),
    ("avg_wake_loss_mps", _D),
    ("bad_row_rate", _D),
    ("n_turbines_est", _L),
    ("capacity_factor", _D),
    ("hour_key", _S),
    ("process_key", _S),
)

# A row closes or reopens one hour; the latest row for a key counts. One folder per dataset.
LEDGER_PARTITIONS = ("date",)
LEDGER = _schema(
    ("sim_run_id", _S),
    ("farm_id", _S),
    ("hour_key", _S),
    ("closed", _B),
    ("sequence", T.LongType()),
    ("recorded_at", _TS),
    ("date", _S),
)

# Hours of a packed table: those that came (``closed`` is null), were closed or reopened. ``version``
# is set where entries of several versions share a file; ``again`` marks hours taken before.
HOURS = _schema(
    ("sim_run_id", _S),
    ("farm_id", _S),
    ("hour_key", _S),
    ("date", _S),
    ("closed", _B),
    ("version", _L),
    ("n_rows", _L),
    ("again", _B),
)

FARMS = _schema(
    ("farm_id", _S),
    ("n_rows", T.IntegerType()),
    ("n_cols", T.IntegerType()),
    ("spacing_m", _D),
    ("rated_power_kw", _D),
)

TURBINES = _schema(
    ("farm_id", _S),
    ("turbine_id", _S),
    ("x_m", _D),
    ("y_m", _D),
    ("rated_power_kw", _D),
)

SCENARIOS = _schema(
    ("sim_run_id", _S),
    ("wake_strength", _D),
    ("decay_length_m", _D),
    ("crosswind_sigma_m", _D),
)


def conform(df: DataFrame, schema: T.StructType, also: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` to the columns and types of ``schema``, then the columns ``also``."""
    casts = [f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    return df.selectExpr(*casts, *also)
