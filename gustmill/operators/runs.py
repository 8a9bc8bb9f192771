"""Run presence and run-against-run comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPARED = ("farm_energy_kwh", "capacity_factor", "availability", "avg_wake_loss_mps")


def runs_present(layer: DataFrame) -> DataFrame:
    return layer.select("sim_run_id").distinct().orderBy("sim_run_id")


def missing_runs(layer: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected run ids that the layer has no row of."""
    wanted = layer.sparkSession.createDataFrame([(r,) for r in expected], "sim_run_id string")
    return wanted.join(layer.select("sim_run_id").distinct(), "sim_run_id", "left_anti")


def scenario_compare(kpis: DataFrame, run_a: str, run_b: str) -> DataFrame:
    """``run_b`` minus ``run_a`` per farm and hour, for hours that both have.

    ``kpis`` has one row per run, farm and hour, so picking each run's value inside one
    aggregate replaces the self-join and reads the input once.
    """
    run = F.col("sim_run_id")
    sides = {"a": run_a, "b": run_b}
    picks = [
        F.max(F.when(run == run_id, F.col(name))).alias(f"{name}_{side}")
        for name in COMPARED
        for side, run_id in sides.items()
    ]
    seen = [F.count_if(run == run_id).alias(f"_{side}") for side, run_id in sides.items()]
    paired = (
        kpis.filter(run.isin(run_a, run_b))
        .groupBy("farm_id", "hour")
        .agg(*picks, *seen)
        .filter((F.col("_a") > 0) & (F.col("_b") > 0))
        .drop("_a", "_b")
    )
    return paired.withColumns(
        {f"{name}_delta": F.col(f"{name}_b") - F.col(f"{name}_a") for name in COMPARED}
    )
