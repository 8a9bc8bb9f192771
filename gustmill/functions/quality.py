"""Row-level quality expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inclusive bounds, in the order violations are listed.
RANGES = (
    ("wind_speed_mps", 0.0, 60.0),
    ("wind_dir_deg", 0.0, 360.0),
    ("rotor_speed_rpm", 0.0, 30.0),
    ("yaw_deg", 0.0, 360.0),
    ("power_kw", 0.0, 10000.0),
)


def measure(value: Column) -> Column:
    """A reading as double, with NaN turned into NULL."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def out_of_range(column: str, lo: float, hi: float) -> str:
    """SQL for: the reading is missing, NaN or outside ``[lo, hi]``. Never NULL."""
    c, low, high = f"`{column}`", f"double('{float(lo)}')", f"double('{float(hi)}')"
    return f"({c} IS NULL OR isnan({c}) OR {c} < {low} OR {c} > {high})"


def add_range_flags(
    df: DataFrame, ranges: Sequence[tuple[str, float, float]] = RANGES
) -> DataFrame:
    """Add ``has_range_violation`` and ``range_violation_fields``; absent columns are skipped.

    The two do not build on each other, so a rollup that only counts bad rows builds no lists.
    """
    bad = {name: out_of_range(name, lo, hi) for name, lo, hi in ranges if name in df.columns}
    if not bad:
        return df.withColumns(
            {"has_range_violation": F.lit(False), "range_violation_fields": F.lit("")}
        )
    names = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in bad.items())
    return df.withColumns(
        {
            "has_range_violation": F.expr(" OR ".join(bad.values())),
            "range_violation_fields": F.expr(f"concat_ws(',', {names})"),
        }
    )
