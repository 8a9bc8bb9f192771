"""Time and process keys. All of them assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_millis(time: Column) -> Column:
    return F.date_trunc("MILLISECOND", time.cast("timestamp"))


def floor_hour(time: Column) -> Column:
    return F.date_trunc("HOUR", time)


def date_key(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def hour_key(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:00:00'Z'")


def process_key(run: Column, farm: Column, hour: Column) -> Column:
    """``run|farm|hour`` label. For display only: joins use the three columns."""
    return F.concat_ws("|", run, farm, hour)
