"""A third of all rows in one key, in one hour, or in one group of copies."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from frames import START
from gustmill import Lake
from gustmill.operators.dedup import flag_duplicates, keep_first
from gustmill.operators.rollups import farm_kpis
from gustmill.operators.telemetry import clean_telemetry, to_bronze
from gustmill.schemas import TELEMETRY, conform

N = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third exact copies of one reading, a third one key with other readings, a third spread."""
    n = F.col("id")
    third = n % 3
    step = F.when(third == 2, n).otherwise(F.lit(0)) * F.expr("INTERVAL 1 SECOND")
    rows = spark.range(0, N, 1, 16).select(
        (F.lit(START).cast("timestamp") + step).alias("event_time"),
        F.lit("F001").alias("farm_id"),
        F.when(third == 0, "COPIES").when(third == 1, "HOT").otherwise("T001").alias("turbine_id"),
        *[F.lit(5.0).alias(c) for c in ("wind_speed_free_mps", "wind_speed_mps", "wind_dir_deg")],
        F.when(third == 1, n.cast("double")).otherwise(F.lit(1.0)).alias("power_kw"),
        F.lit(5.0).alias("rotor_speed_rpm"),
        F.lit(5.0).alias("yaw_deg"),
        F.lit("RUNNING").alias("status"),
        F.lit("SIM-A").alias("sim_run_id"),
        F.lit(START).cast("timestamp").alias("ingest_time"),
        F.lit("s").alias("source"),
    )
    return conform(rows, TELEMETRY)


def test_hot_keys_keep_one_row(skewed):
    kept = Counter(r.turbine_id for r in keep_first(skewed).select("turbine_id").collect())
    assert kept == {"COPIES": 1, "HOT": 1, "T001": N // 3}
    assert keep_first(skewed).filter("turbine_id = 'HOT'").first().power_kw == 1.0


def test_hot_keys_are_flagged_in_full(skewed):
    flags = flag_duplicates(skewed).groupBy("turbine_id", "is_duplicate").count().collect()
    assert {(r.turbine_id, r.is_duplicate): r["count"] for r in flags} == {
        ("COPIES", False): 1,
        ("COPIES", True): N // 3 - 1,
        ("HOT", False): 1,
        ("HOT", True): N // 3 - 1,
        ("T001", False): N // 3,
    }


def test_no_flagging_task_holds_a_whole_hot_key(skewed):
    # Rows of one key after the last shuffle, by task: many tasks, none with more than a share.
    tasks = (
        flag_duplicates(skewed)
        .filter("turbine_id = 'COPIES'")
        .groupBy(F.spark_partition_id().alias("task"))
        .count()
        .collect()
    )
    assert len(tasks) >= 4
    assert max(r["count"] for r in tasks) < N // 3


def test_hot_hour_is_written_by_several_tasks(spark, skewed, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        lake.write_bronze(skewed)
    finally:
        spark.conf.set(size, usual)
    hot = list((tmp_path / "lake" / "bronze").rglob("hour=2026-01-05T00*/*.parquet"))
    cool = list((tmp_path / "lake" / "bronze").rglob("hour=2026-01-05T09*/*.parquet"))
    assert len(hot) > 1 and len(cool) == 1
    assert lake.bronze().count() == N
    lake.run_silver()
    lake.run_farm_kpis(1)
    stored = {r.hour_key: r.total_rows for r in lake.farm_kpis().collect()}
    direct = farm_kpis(clean_telemetry(to_bronze(skewed)), 1).collect()
    assert stored == {r.hour_key: r.total_rows for r in direct}
    assert sum(stored.values()) == N // 3 + 2
