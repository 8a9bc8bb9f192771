"""Raw telemetry to bronze rows, bronze rows to clean rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustmill.functions.quality import RANGES, add_range_flags
from gustmill.functions.timekeys import date_key, floor_millis, hour_key, process_key
from gustmill.operators.dedup import DEDUP_KEYS, keep_first
from gustmill.schemas import BRONZE, CLEAN_TELEMETRY, TELEMETRY, conform

LEDGER_PARTS = ("sim_run_id", "farm_id", "event_time")


def to_bronze(df: DataFrame) -> DataFrame:
    """Floor times to milliseconds, turn NaN into NULL, cast to the contract, add ``date``, ``hour``."""
    times = {n: floor_millis(F.col(n)) for n in ("event_time", "ingest_time")}
    readings = {
        f.name: F.when(~F.isnan(F.col(f.name).cast(f.dataType)), F.col(f.name))
        for f in TELEMETRY
        if isinstance(f.dataType, T.FloatType)
    }
    rows = conform(df.withColumns({**times, **readings}), TELEMETRY)
    return conform(
        rows.withColumns({"date": date_key(F.col("event_time")), "hour": hour_key(F.col("event_time"))}),
        BRONZE,
    )


def bronze_keys(bronze: DataFrame) -> DataFrame:
    """Bronze rows with ``hour_key`` (for ``hour``) and the display label ``process_key``."""
    return bronze.withColumnRenamed("hour", "hour_key").withColumn(
        "process_key", process_key(F.col("sim_run_id"), F.col("farm_id"), F.col("hour_key"))
    )


def unaddressable() -> Column:
    """Rows no ledger entry can name; kept in bronze, left out of silver."""
    tests = [F.col(name).isNull() for name in LEDGER_PARTS]
    return tests[0] | tests[1] | tests[2]


def clean_telemetry(
    bronze: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    ranges: Sequence[tuple[str, float, float]] = RANGES,
    also: Sequence[str] = (),
) -> DataFrame:
    """Silver rows: addressable, one per key, flagged. ``also`` names extra columns to carry."""
    first = keep_first(bronze.filter(~unaddressable()), keys)
    flagged = add_range_flags(first, ranges).withColumn("is_duplicate", F.lit(False))
    return conform(flagged, CLEAN_TELEMETRY, also)
