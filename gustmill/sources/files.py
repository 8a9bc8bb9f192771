"""Partitioned Parquet directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(hadoop)


def read_partitioned(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    above_date: Sequence[str],
    dates: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``schema`` below ``path``.

    The schema names the partition columns too, so ``001`` stays a string. With ``dates``, only
    these dates' folders are listed: ``above_date`` gives the folder patterns over ``date=``.
    """
    source = path
    if dates is not None:
        wanted = dates[0] if len(dates) == 1 else "{%s}" % ",".join(dates)
        source = "/".join([path, *above_date, f"date={wanted}"])
    try:
        rows = spark.read.schema(schema).option("basePath", path).parquet(source)
    except AnalysisException as error:
        if dates is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.select(*schema.names)


def _rebalanced(df: DataFrame, partitions: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Rows of one partition together, sorted; AQE splits large ones and merges small ones."""
    return df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *within)


def append(df: DataFrame, path: str, partitions: Sequence[str], within: Sequence[str] = ()) -> None:
    rows = _rebalanced(df, partitions, within)
    rows.write.mode("append").partitionBy(*partitions).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], within: Sequence[str] = ()
) -> None:
    """Replace exactly the partitions ``df`` has rows for."""
    (
        _rebalanced(df, partitions, within)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def folder_name(value: str) -> str:
    """A partition value as Spark writes it in a folder's name."""
    unsafe = set('"#%\'*/:=?\\\x7f{[]^')
    return "".join(f"%{ord(c):02X}" if c in unsafe or ord(c) < 32 else c for c in value)


def remove_partitions(spark: SparkSession, path: str, folders: Sequence[str]) -> None:
    """Delete partition folders, named relative to ``path``."""
    for folder in folders:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
