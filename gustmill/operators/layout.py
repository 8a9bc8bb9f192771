"""Farm specifications to turbines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustmill.schemas import TURBINES, conform


def turbine_layout(farms: DataFrame) -> DataFrame:
    """Row-major grid per farm: ids T001, T002, ...; x grows by column, y by row."""
    count = F.col("n_rows") * F.col("n_cols")
    slots = farms.filter(count > 0).select(
        "*", F.explode(F.sequence(F.lit(0), count - 1)).alias("_slot")
    )
    turbines = slots.withColumns(
        {
            "turbine_id": F.format_string("T%03d", F.col("_slot") + 1),
            "x_m": (F.col("_slot") % F.col("n_cols")) * F.col("spacing_m"),
            "y_m": F.floor(F.col("_slot") / F.col("n_cols")) * F.col("spacing_m"),
        }
    )
    return conform(turbines, TURBINES)
