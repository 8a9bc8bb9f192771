"""Which hours are open: hours of a layer, entries of a ledger, and the latest word on each hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOUR = ("sim_run_id", "farm_id", "hour_key")


def hours_present(layer: DataFrame) -> DataFrame:
    """Distinct hours of a layer; of a stored one, from its partition columns alone."""
    keys = ["sim_run_id", "farm_id", "date", "hour_key"]
    return layer.select(*keys).dropna().distinct()


def ledger_entries(hours: DataFrame, closed: bool, sequence: int) -> DataFrame:
    """Entries that close or reopen ``hours``. A later entry has a larger ``sequence``."""
    return hours.select(*HOUR).distinct().withColumns(
        {
            "closed": F.lit(closed),
            "sequence": F.lit(sequence).cast("long"),
            "recorded_at": F.current_timestamp(),
            "date": F.substring("hour_key", 1, 10),
        }
    )


def latest_entries(entries: DataFrame) -> DataFrame:
    """The last entry of each hour, whatever the clocks say; entries of old files have no sequence."""
    order = F.struct(F.coalesce("sequence", F.lit(0)).alias("sequence"), "recorded_at")
    last = entries.groupBy(*HOUR).agg(F.max_by(F.struct("closed", "sequence"), order).alias("last"))
    return last.select(*HOUR, "last.*")


def closed_hours(entries: DataFrame) -> DataFrame:
    return latest_entries(entries).filter("closed").select(*HOUR)
