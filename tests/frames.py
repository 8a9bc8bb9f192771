"""Hand-made telemetry."""

from __future__ import annotations

from datetime import datetime, timedelta

from gustmill.schemas import TELEMETRY

START = datetime(2026, 1, 5)

USUAL = {
    "event_time": START,
    "farm_id": "F001",
    "turbine_id": "T001",
    "wind_speed_free_mps": 9.0,
    "wind_speed_mps": 8.0,
    "wind_dir_deg": 220.0,
    "power_kw": 600.0,
    "rotor_speed_rpm": 12.0,
    "yaw_deg": 220.0,
    "status": "RUNNING",
    "sim_run_id": "SIM-A",
    "ingest_time": START,
    "source": "s",
}


def at(hours: float = 0, minutes: float = 0) -> datetime:
    return START + timedelta(hours=hours, minutes=minutes)


def telemetry(spark, *rows: dict):
    """A frame of usual rows with the given fields changed."""
    full = [{**USUAL, **row} for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in TELEMETRY.names) for r in full], TELEMETRY)


def hours_of(spark, first: int, last: int, **fields):
    """Two turbines, two readings each, for every hour from ``first`` to ``last``."""
    return telemetry(
        spark,
        *[
            {"event_time": at(h, m), "ingest_time": at(h, m + 1), "turbine_id": t, **fields}
            for h in range(first, last + 1)
            for m in (0, 30)
            for t in ("T001", "T002")
        ],
    )


def dicts(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]
