"""Flagging of repeats: only rows that may be repeated are moved."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frames import START, telemetry
from gustmill.operators.dedup import DEDUP_KEYS, FILTER_BITS, flag_duplicates
from gustmill.schemas import TELEMETRY, conform

N = 20_000


@pytest.fixture(scope="module")
def readings(spark):
    """One in 500 readings comes twice, one a hundred times; some without turbine or time."""
    n = F.col("id")
    times = F.when(n == 7, F.lit(100)).when(n % 500 == 0, F.lit(2)).otherwise(F.lit(1))
    rows = spark.range(0, N, 1, 8).select("id", F.explode(F.sequence(F.lit(1), times)).alias("copy"))
    return conform(
        rows.select(
            F.when(n % 1000 != 500, F.lit(START).cast("timestamp") + n * F.expr("INTERVAL 1 SECOND")).alias("event_time"),
            F.lit("F001").alias("farm_id"),
            F.when(n % 999 != 0, F.concat(F.lit("T"), n % 12)).alias("turbine_id"),
            *[F.lit(5.0).alias(c) for c in ("wind_speed_free_mps", "wind_speed_mps", "wind_dir_deg", "rotor_speed_rpm", "yaw_deg")],
            F.col("copy").cast("double").alias("power_kw"),
            F.lit("RUNNING").alias("status"),
            F.lit("SIM-A").alias("sim_run_id"),
            F.lit(START).cast("timestamp").alias("ingest_time"),
            F.concat_ws("-", n, "copy").alias("source"),
        ),
        TELEMETRY,
    )


def wanted(df):
    first = Window.partitionBy(*DEDUP_KEYS).orderBy(F.col("ingest_time").asc_nulls_first(), F.col("source").asc_nulls_first())
    return df.withColumn("is_duplicate", F.row_number().over(first) > 1)


def flags(df):
    return sorted((r.source, r.is_duplicate) for r in df.select("source", "is_duplicate").collect())


@pytest.mark.parametrize("bits", [FILTER_BITS, 1 << 16, 1 << 10, 64])
def test_any_filter_gives_the_same_flags(readings, bits):
    assert flags(flag_duplicates(readings, filter_bits=bits)) == flags(wanted(readings))


def moved(df) -> list[tuple[int, int]]:
    """Columns and rows of every shuffle of an executed plan."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.finalPhysicalPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            found.append((node.output().size(), node.metrics().apply("shuffleRecordsWritten").value()))
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(execution.executedPlan())
    return found


def test_single_rows_cross_no_exchange(spark, readings):
    flagged = flag_duplicates(readings)
    # Hashes and words of the filter have two columns. Some 180 rows have a repeated key.
    whole = [n for columns, n in moved(flagged) if columns > 2]
    assert len(whole) == 2 and max(whole) < 0.02 * N


def test_nothing_repeated_moves_no_row(spark):
    rows = telemetry(spark, *[{"turbine_id": f"T{n}", "source": str(n)} for n in range(50)])
    flagged = flag_duplicates(rows)
    assert not any(n for columns, n in moved(flagged) if columns > 2)
    assert flagged.columns == [*rows.columns, "is_duplicate"] and flagged.filter("is_duplicate").count() == 0
