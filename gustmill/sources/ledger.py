"""Which hours each dataset has closed: an append-only Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustmill.functions.timekeys import process_key
from gustmill.operators.increments import HOUR, closed_hours, ledger_entries
from gustmill.schemas import LEDGER, LEDGER_PARTITIONS, conform
from gustmill.sources import files


class Ledger:
    """A key counts as its latest row says, so no stored row is ever rewritten.

    Each dataset is a folder of its own, so jobs on different datasets can run side by side.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _folder(self, dataset: str) -> str:
        return f"{self.path}/dataset={dataset}"

    def has(self, dataset: str) -> bool:
        return files.path_exists(self.spark, self._folder(dataset))

    def closed(self, dataset: str, dates: Sequence[str] | None = None) -> DataFrame:
        """Closed hours of ``dataset``; empty if nothing was ever recorded."""
        if self.has(dataset):
            rows = files.read_partitioned(self.spark, self._folder(dataset), LEDGER, [], dates)
        else:
            rows = self.spark.createDataFrame([], LEDGER)
        return closed_hours(rows)

    def items(self, dataset: str) -> DataFrame:
        """Sorted ``run|farm|hour`` labels."""
        label = process_key(*[F.col(name) for name in HOUR]).alias("process_key")
        return self.closed(dataset).select(label).orderBy("process_key")

    def close(self, dataset: str, hours: DataFrame) -> None:
        self._record(dataset, hours, True)

    def reopen(self, dataset: str, hours: DataFrame) -> None:
        """Have the next run process ``hours`` again."""
        self._record(dataset, hours, False)

    def _record(self, dataset: str, hours: DataFrame, closed: bool) -> None:
        last = 0
        if self.has(dataset):
            rows = files.read_partitioned(self.spark, self._folder(dataset), LEDGER, [])
            last = rows.agg(F.max("sequence")).first()[0] or 0
        entries = ledger_entries(hours, closed, last + 1)
        files.append(conform(entries, LEDGER), self._folder(dataset), LEDGER_PARTITIONS)
