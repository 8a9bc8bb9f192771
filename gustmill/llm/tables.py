"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gustmill.session import ensure_checkpoint_dir

#: A side is broadcast only when its counted rows times its row width stay below this.
BROADCAST_BYTES = 32 << 20

#: ASCII letters: the only ones that the word definitions fold.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def importable_in_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did, if it isn't installed there."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable_in_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is.

    ``lower`` is many times faster than ``translate`` and equal to it wherever the text
    has no capital or title-case letter outside ASCII, which a scan tells.
    """
    others = text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(others, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def scratch_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the checkpoint folder, or one below the warehouse."""
    ensure_checkpoint_dir(spark, f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return spark.sparkContext.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder, so that lost executors cost no recomputing."""
    scratch_folder(df.sparkSession)
    return df.checkpoint()


def free_finished_shuffles(df: DataFrame) -> None:
    """Let Spark delete shuffle files that no live DataFrame needs.

    Its cleaner acts on what the driver's garbage collector finds, which in a driver with a roomy
    heap may be long after a loop of many rounds has filled the executors' disks.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def small_enough(df: DataFrame, row_bytes: int) -> bool:
    """Whether all of ``df`` (saved before, so that counting is cheap) may be broadcast."""
    return df.count() * row_bytes <= BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if small_enough(df, row_bytes) else df


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it.

    Inside a lambda a plain column expression would be evaluated again for every element.
    """
    return F.transform(F.array(value), use)[0]


def total(values: Column, kind: str = "bigint") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda a, x: a + x.cast(kind))


def numbers(low: Column, high: Column) -> Column:
    """The integers from ``low`` to ``high``; none if ``high`` is smaller."""
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def measured_broadcast(df: DataFrame) -> DataFrame:
    """``df`` (saved before) with a broadcast hint if its rows, as JSON, fit the bound."""
    size = df.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df
