"""Farm and scenario tables from Python values."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from gustmill.schemas import FARMS, SCENARIOS


# The defaults of a grid farm, of a wake and of a scenario's wake.
class FarmShape(NamedTuple):
    n_rows: int = 3
    n_cols: int = 4
    spacing_m: float = 600.0
    rated_power_kw: float = 2000.0


class WakeParameters(NamedTuple):
    wake_strength: float = 0.15
    decay_length_m: float = 800.0
    crosswind_sigma_m: float = 200.0


SCENARIO_WAKE = WakeParameters(0.18, 900.0, 250.0)


def farm_table(spark: SparkSession, shapes: Mapping[str, FarmShape]) -> DataFrame:
    """One row per farm id, for ``turbine_layout``."""
    return spark.createDataFrame([(farm, *shape) for farm, shape in shapes.items()], FARMS)


def scenario_table(spark: SparkSession, wakes: Mapping[str, WakeParameters]) -> DataFrame:
    """One row per run id, for the what-if operators."""
    return spark.createDataFrame([(run, *wake) for run, wake in wakes.items()], SCENARIOS)
