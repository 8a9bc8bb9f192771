"""Bronze, silver and gold tables under one root, and the jobs between them."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from gustmill import schemas
from gustmill.functions.quality import RANGES
from gustmill.operators.increments import HOUR
from gustmill.operators.dedup import DEDUP_KEYS
from gustmill.operators.rollups import check_step, farm_kpis, hourly_energy
from gustmill.operators.runs import missing_runs, runs_present
from gustmill.operators.telemetry import clean_telemetry, to_bronze
from gustmill.plans.increment import open_increment
from gustmill.session import ensure_checkpoint_dir, require_utc
from gustmill.sources import files
from gustmill.sources.ledger import Ledger

log = logging.getLogger("gustmill")

REQUIRED = ("event_time", "farm_id", "sim_run_id", "ingest_time")
RUN_AND_FARM = ("sim_run_id=*", "farm_id=*")
#: Runs named in the message of a failed presence check.
NAMED_RUNS = 100


class Lake:
    """Jobs are safe to repeat: data is written first, the ledger last.

    ``dates`` narrows a job to some days, so that only their folders are listed and read.
    """

    def __init__(self, spark: SparkSession, root: str):
        require_utc(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.ledger = Ledger(spark, f"{self.root}/_state/ledger")

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    # Reads

    def _read(self, layer: str, schema, dates: Sequence[str] | None) -> DataFrame:
        path = self.path(layer)
        if not files.path_exists(self.spark, path):
            raise FileNotFoundError(f"there is no {layer} at {path}")
        return files.read_partitioned(self.spark, path, schema, RUN_AND_FARM, dates)

    def bronze(self, dates: Sequence[str] | None = None) -> DataFrame:
        return self._read("bronze", schemas.BRONZE, dates)

    def silver(self, dates: Sequence[str] | None = None) -> DataFrame:
        return self._read("silver", schemas.SILVER, dates)

    def hourly_energy(self, dates: Sequence[str] | None = None) -> DataFrame:
        return self._read("gold/hourly_energy", schemas.HOURLY_ENERGY, dates)

    def farm_kpis(self, dates: Sequence[str] | None = None) -> DataFrame:
        return self._read("gold/farm_kpis", schemas.FARM_KPIS, dates)

    def quarantine(self) -> DataFrame:
        """Bronze rows without run, farm or event time: those in Hive's null partitions."""
        return self.bronze().filter("sim_run_id IS NULL OR farm_id IS NULL OR hour IS NULL")

    # Jobs

    def write_bronze(self, df: DataFrame) -> None:
        """Append telemetry. Duplicates and faulty rows are kept."""
        missing = set(REQUIRED) - set(df.columns)
        if missing:
            raise ValueError(f"telemetry lacks the columns {sorted(missing)}")
        absent = set(schemas.TELEMETRY.names) - set(df.columns)
        if absent:
            raise KeyError(f"telemetry lacks the columns {sorted(absent)}")
        if df.isEmpty():
            raise ValueError("No rows to write to bronze")
        files.append(
            to_bronze(df),
            self.path("bronze"),
            schemas.BRONZE_PARTITIONS,
            ["turbine_id", "event_time"],
        )

    def run_silver(
        self,
        dates: Sequence[str] | None = None,
        keys: Sequence[str] = DEDUP_KEYS,
        ranges: Sequence[tuple[str, float, float]] = RANGES,
    ) -> str:
        """Clean the bronze hours silver has not closed yet. Late rows for closed hours are ignored."""
        bronze = self.bronze(dates)
        ensure_checkpoint_dir(self.spark, self.path("_state/checkpoints"))
        layer = bronze.withColumnRenamed("hour", "hour_key")
        increment = open_increment(layer, self.ledger.closed("silver", dates))
        if increment.n_present == 0 and dates is None and bronze.isEmpty():
            raise ValueError(f"No data: bronze at {self.path('bronze')} is empty")
        path = self.path("silver")
        if increment.n_hours == 0:
            log.info("silver: no new hours to process")
            return path
        rows = increment.restrict(layer, ["sim_run_id", "farm_id", "date", "hour_key"])
        clean = clean_telemetry(rows, keys, ranges, also=["date", "hour_key"])
        emptied = self._emptied(clean, increment.hours) if files.path_exists(self.spark, path) else []
        files.replace_partitions(
            clean, path, schemas.SILVER_PARTITIONS, ["turbine_id", "event_time"]
        )
        files.remove_partitions(self.spark, path, emptied)
        self.ledger.close("silver", increment.hours)
        return path

    def _emptied(self, clean: DataFrame, hours: DataFrame) -> list[str]:
        """Silver folders of open hours that are written already and now get no row.

        Only hours that run again, after ``reopen`` or a failure, are looked at.
        """
        names = list(schemas.SILVER_PARTITIONS)
        stored = self.silver([r[0] for r in hours.select("date").distinct().collect()])
        again = stored.select(*names).distinct().join(hours.select(*names), names, "left_semi").checkpoint()
        if again.isEmpty():
            return []
        filled = clean.join(again, names, "left_semi").select(*names).distinct()
        gone = again.join(filled, names, "left_anti").collect()
        return ["/".join(f"{name}={files.folder_name(row[name])}" for name in names) for row in gone]

    def run_hourly_energy(self, dt_seconds: float, dates: Sequence[str] | None = None) -> str:
        check_step(dt_seconds)
        return self._run_gold(
            "hourly_energy", lambda silver: hourly_energy(silver, dt_seconds), dates
        )

    def run_farm_kpis(
        self,
        dt_seconds: float,
        rated_power_kw: float = 2000.0,
        dates: Sequence[str] | None = None,
    ) -> str:
        check_step(dt_seconds)
        return self._run_gold(
            "farm_kpis", lambda silver: farm_kpis(silver, dt_seconds, rated_power_kw), dates
        )

    def _run_gold(
        self,
        dataset: str,
        rollup: Callable[[DataFrame], DataFrame],
        dates: Sequence[str] | None,
    ) -> str:
        """Roll up every farm's day that has an open hour.

        A rollup holds few rows per hour, so it is stored by day, not by hour. The whole day is
        computed again from silver, whose closed hours do not change, and replaced: repeating a
        run that failed anywhere gives the same day.
        """
        path = self.path(f"gold/{dataset}")
        silver = self.silver(dates)
        ensure_checkpoint_dir(self.spark, self.path("_state/checkpoints"))
        # An hour silver wrote but did not close will be written again. Silver that came without a
        # ledger is taken as it is.
        ready = self.ledger.closed("silver", dates) if self.ledger.has("silver") else None
        increment = open_increment(silver, self.ledger.closed(dataset, dates), ready)
        if increment.n_hours == 0:
            log.info("%s: no new hours to process", dataset)
            return path
        days = increment.restrict(silver, schemas.GOLD_PARTITIONS)
        if ready is not None:
            # Of an open day only hours that silver has closed, now or before this table took them.
            whole = ready.unionByName(self.ledger.closed(dataset, dates)).distinct()
            days = days.join(whole, list(HOUR), "left_semi")
        files.replace_partitions(rollup(days), path, schemas.GOLD_PARTITIONS, ["hour"])
        self.ledger.close(dataset, increment.hours)
        return path

    # Checks

    def assert_runs_present(
        self, layer: str, expected: Sequence[str], dates: Sequence[str] | None = None
    ) -> None:
        """Raise ``RuntimeError`` if an expected run has no row in bronze, silver or a gold table."""
        schema = {
            "bronze": schemas.BRONZE,
            "silver": schemas.SILVER,
            "gold/hourly_energy": schemas.HOURLY_ENERGY,
            "gold/farm_kpis": schemas.FARM_KPIS,
        }[layer]
        table = self._read(layer, schema, dates)
        missing = sorted(row["sim_run_id"] for row in missing_runs(table, expected).collect())
        if missing:
            found = [r["sim_run_id"] for r in runs_present(table).limit(NAMED_RUNS).collect()]
            raise RuntimeError(f"{layer} has no row of {missing}; it has {found} (at most {NAMED_RUNS} are named)")

    def reopen(self, dataset: str, hours: DataFrame) -> None:
        """Have the next run of ``silver``, ``hourly_energy`` or ``farm_kpis`` redo ``hours``."""
        self.ledger.reopen(dataset, hours)
