"""The physical plans the library counts on."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from frames import hours_of, telemetry
from gustmill import Lake
from gustmill.functions.quality import add_range_flags
from gustmill.operators import sizing
from gustmill.operators.dedup import keep_first
from gustmill.operators.increments import hours_present
from gustmill.operators.rollups import farm_kpis, hourly_energy
from gustmill.operators.runs import runs_present
from gustmill.operators.whatif import expected_power, wake_effective_speed
from gustmill.plans import increment as increments
from gustmill.plans.increment import open_increment
from gustmill.sources.events import wake_scenarios

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("plans") / "lake"))
    for run in ("SIM-A", "SIM-B"):
        for first in (0, 24, 48):
            lake.write_bronze(hours_of(spark, first, first + 1, sim_run_id=run))
    lake.run_silver(dates=["2026-01-05", "2026-01-06"])
    return lake


def test_every_query_stays_in_the_jvm_and_joins_on_keys(spark):
    for name, query in driver.queries().items():
        # Of the corpus queries only these two promise to do without Python.
        if (name == "pipeline" or name.startswith("op")) and not name.startswith(("op2_", "op8_")):
            continue
        text = plan(query(spark, SF))
        assert "BatchEvalPython" not in text and "InPandas" not in text, name
        # The wake alone is vectorised Python.
        waked = name.startswith(("wake", "what_if"))
        assert text.count("ArrowEvalPython") == int(waked), name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_dedup_shrinks_keys_before_its_only_shuffle(spark):
    text = plan(keep_first(telemetry(spark, {})))
    assert exchanges(text) == 1
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:shuffle] and "WindowGroupLimit" in text[shuffle:]


@pytest.mark.parametrize("rollup", [hourly_energy, farm_kpis])
def test_rollups_aggregate_before_their_only_shuffle(spark, rollup):
    text = plan(rollup(add_range_flags(telemetry(spark, {})), 60))
    assert exchanges(text) == 1
    assert "partial_sum" in text[text.index("Exchange hashpartitioning") :]


def test_rollups_read_only_their_columns(lake):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(hourly_energy(lake.silver(), 60))).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "event_time",
        "turbine_id",
        "wind_speed_mps",
        "power_kw",
        "status",
        "has_range_violation",
    }


def test_run_presence_reads_no_column(lake):
    text = plan(runs_present(lake.bronze()))
    assert "ReadSchema: struct<>" in text


def test_increment_prunes_folders(lake):
    layer = lake.bronze().withColumnRenamed("hour", "hour_key")
    found = open_increment(layer, lake.ledger.closed("silver"))
    assert (found.n_hours, found.n_present) == (4, 12)
    rows = found.restrict(layer, ["sim_run_id", "farm_id", "date", "hour_key"])
    text = plan(rows)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "date" in filters and "2026-01-07" in filters and "2026-01-05" not in filters
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert rows.count() == 16


def test_increment_without_literals_or_broadcast_is_the_same(lake, monkeypatch):
    monkeypatch.setattr(increments, "MAX_LITERALS", 0)
    monkeypatch.setattr(increments, "MAX_BROADCAST_ROWS", 0)
    layer = lake.bronze().withColumnRenamed("hour", "hour_key")
    found = open_increment(layer, lake.ledger.closed("silver"))
    assert found.restrict(layer, ["sim_run_id", "farm_id", "date", "hour_key"]).count() == 16


def test_first_run_joins_nothing(lake):
    layer = lake.bronze().withColumnRenamed("hour", "hour_key")
    found = open_increment(layer, lake.ledger.closed("never run"))
    assert found.n_hours == found.n_present == 12
    assert "Join" not in plan(found.restrict(layer, ["sim_run_id", "farm_id", "date", "hour_key"]))


def test_dates_list_only_their_folders(lake):
    files = lake.bronze(dates=["2026-01-06"]).inputFiles()
    assert files and all("date=2026-01-06" in f for f in files)


def test_closed_hours_go_before_the_aggregate(spark, lake):
    layer = lake.bronze().withColumnRenamed("hour", "hour_key")
    shut = hours_present(layer).filter("hour_key < '2026-01-06'")
    rows = open_increment(layer, shut).restrict(layer, ["sim_run_id", "farm_id", "date", "hour_key"])
    text = plan(hourly_energy(add_range_flags(rows), 60))
    assert text.index("LeftSemi") > text.index("partial_")


def test_a_large_farm_shuffles_no_rows(spark):
    grid = spark.range(600).selectExpr(
        "IF(id < 590, 'BIG', 'F001') AS farm_id", "concat('T', lpad(id, 3, '0')) AS turbine_id",
        "id * 10.0D AS x_m", "0.0D AS y_m", "2000.0D AS rated_power_kw",
    )
    text = plan(wake_effective_speed(telemetry(spark, {}), grid, wake_scenarios(spark), max_block_turbines=500))
    assert exchanges(text) == 0 and "SortMergeJoin" not in text


def test_dimension_beyond_the_bound_is_shuffled(spark, monkeypatch):
    turbines = spark.createDataFrame(
        [("F001", "T001", 0.0, 0.0, 2000.0)],
        "farm_id string, turbine_id string, x_m double, y_m double, rated_power_kw double",
    )
    rows = telemetry(spark, {"wind_speed_mps": 12.0})
    assert "BroadcastHashJoin" in plan(expected_power(rows, turbines))
    monkeypatch.setattr(sizing, "MAX_BROADCAST_BYTES", 10)
    text = plan(expected_power(rows, turbines))
    assert "BroadcastHashJoin" not in text
    assert expected_power(rows, turbines).first().expected_power_kw == 2000.0
