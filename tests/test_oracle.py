"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.01"


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    columns = []
    for name in frame.columns:
        values = frame[name]
        if str(values.dtype).startswith("datetime"):
            values = values.astype("datetime64[us]")
        columns.append([None if pd.isna(v) else v for v in values.tolist()])
    return sorted(zip(*columns), key=repr)


def _kind(dtype) -> str:
    return "datetime" if str(dtype).startswith("datetime") else str(dtype)


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def test_every_telemetry_query_has_sql():
    without = driver.queries().keys() - driver.oracle_sql().keys()
    assert all(name == "pipeline" or name.startswith("op") for name in without)
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", driver.oracle_sql())
def test_query_matches_sql(spark, connection, name):
    ours = driver.queries()[name](spark, SF_DIR).toPandas()
    theirs = connection.execute(driver.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert ours.dtypes.sort_index().map(_kind).equals(theirs.dtypes.sort_index().map(_kind))
    assert _canonical(ours) == _canonical(theirs)
