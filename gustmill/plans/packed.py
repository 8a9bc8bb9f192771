"""Layers packed by day, and the jobs between them, published in versions.

Where ``Lake`` keeps a folder for each farm and hour, a ``PackedLake`` keeps a few files for each day,
sorted by hour, run and farm, so that a filter on the hour skips pages within them. Rows and
ledger of a table become visible together, by a new version of the table (``sources.versions``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustmill import schemas
from gustmill.functions.quality import RANGES
from gustmill.functions.timekeys import process_key
from gustmill.operators.dedup import DEDUP_KEYS
from gustmill.operators.increments import HOUR
from gustmill.operators.rollups import check_step, farm_kpis, hourly_energy
from gustmill.operators.runs import missing_runs, runs_present
from gustmill.operators.telemetry import clean_telemetry, to_bronze, unaddressable
from gustmill.plans.increment import MAX_BROADCAST_ROWS, MAX_LITERALS
from gustmill.plans.lake import NAMED_RUNS, REQUIRED
from gustmill.session import require_utc
from gustmill.sources.versions import Change, ConcurrentChange, Version, VersionLog, new_batch

log = logging.getLogger("gustmill")

#: Days with more folders of ledger entries than this get one folder instead.
MOST_HOUR_FOLDERS = 10
TARGET_BYTES = 128 << 20
#: Rows that no ledger entry can name lie apart, under this instead of a day.
UNADDRESSABLE = "unaddressable"


@dataclass(frozen=True)
class Table:
    """A stored table: its folder, the columns of its rows, and the order within files."""

    folder: str
    schema: T.StructType
    order: tuple[str, ...]


TABLES = {
    "bronze": Table("bronze", schemas.BRONZE, ("hour", "sim_run_id", "farm_id", "turbine_id", "event_time")),
    "silver": Table("silver", schemas.SILVER, ("hour_key", "sim_run_id", "farm_id", "turbine_id", "event_time")),
    "hourly_energy": Table("gold/hourly_energy", schemas.HOURLY_ENERGY, ("hour_key", "sim_run_id", "farm_id", "turbine_id")),
    "farm_kpis": Table("gold/farm_kpis", schemas.FARM_KPIS, ("hour_key", "sim_run_id", "farm_id")),
}


class PackedLake:
    """Jobs are safe to repeat, and to run beside readers and each other.

    Any number of writers may append to bronze at once. Of two runs of one job over the same
    days, the later to finish raises ``ConcurrentChange`` and leaves no trace. Readers see the
    version that was the latest when they asked. ``dates`` narrows a read or a job to some days.
    """

    def __init__(self, spark: SparkSession, root: str, retention_seconds: float = 86_400.0):
        require_utc(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.logs = {
            name: VersionLog(spark, f"{self.root}/{table.folder}", retention_seconds) for name, table in TABLES.items()
        }

    # Reads

    def _read(self, name: str, version: Version, days: Sequence[str] | None) -> DataFrame:
        """Rows of some days, from their folders alone; of all days without ``days``."""
        chosen = version.rows if days is None else [d for d in days if d in version.rows]
        return self._rows_in(name, [folder for day in chosen for folder in version.rows[day]])

    def _rows_in(self, name: str, folders: Sequence[str]) -> DataFrame:
        return self._files(name, folders, TABLES[name].schema)

    def _files(self, name: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.logs[name].root}/{f}" for f in folders])

    def _stored(self, name: str, dates: Sequence[str] | None) -> DataFrame:
        return self._read(name, self._existing(name), dates)

    def _existing(self, name: str) -> Version:
        version = self.logs[name].latest()
        if version.number == 0:
            raise FileNotFoundError(f"nothing was ever written to {name} below {self.root}")
        return version

    def bronze(self, dates: Sequence[str] | None = None) -> DataFrame:
        return self._stored("bronze", dates)

    def silver(self, dates: Sequence[str] | None = None) -> DataFrame:
        return self._stored("silver", dates)

    def hourly_energy(self, dates: Sequence[str] | None = None) -> DataFrame:
        return self._stored("hourly_energy", dates)

    def farm_kpis(self, dates: Sequence[str] | None = None) -> DataFrame:
        return self._stored("farm_kpis", dates)

    def quarantine(self) -> DataFrame:
        """Bronze rows without run, farm or event time. They are kept in folders of their own."""
        return self._stored("bronze", [UNADDRESSABLE])

    # Ledgers

    def _entries(self, name: str, version: Version, days: Sequence[str] | None = None) -> DataFrame:
        """The last entry of each hour: ``closed`` and the version it came with."""
        chosen = version.hours if days is None else [d for d in days if d in version.hours]
        folders = [folder for day in chosen for folder in version.hours[day]]
        rows = self._files(name, folders, schemas.HOURS)
        if folders:
            # Entries folded into one folder carry their version, others that of their folder.
            named = [(f.split("/")[1], version.added_in[f]) for f in folders]
            of_folder = F.create_map(*[F.lit(x) for pair in sorted(set(named)) for x in pair])
            batch = F.regexp_extract(F.col("_metadata.file_path"), r"/hours/([^/]+)/", 1)
            rows = rows.withColumn("version", F.coalesce("version", of_folder[batch]))
        newest = F.max_by("closed", "version").alias("closed")
        return rows.groupBy("date", *HOUR).agg(newest, F.max("version").alias("version"), F.sum("n_rows").alias("n_rows"))

    def arrived(self, dates: Sequence[str] | None = None) -> DataFrame:
        """Hours that bronze holds and their rows, as the appends wrote them down."""
        hours = self._entries("bronze", self.logs["bronze"].latest(), dates)
        return hours.select("date", *HOUR, "n_rows")

    def closed(self, name: str, dates: Sequence[str] | None = None) -> DataFrame:
        """Hours that ``silver``, ``hourly_energy`` or ``farm_kpis`` has closed."""
        return self._entries(name, self.logs[name].latest(), dates).filter("closed").select("date", *HOUR, "version")

    def ledger_items(self, name: str) -> DataFrame:
        """Sorted ``run|farm|hour`` labels."""
        label = process_key(*[F.col(column) for column in HOUR]).alias("process_key")
        return self.closed(name).select(label).orderBy("process_key")

    def reopen(self, name: str, hours: DataFrame) -> None:
        """Have the next run of ``silver``, ``hourly_energy`` or ``farm_kpis`` redo ``hours``."""
        entries = hours.select(*HOUR).distinct()
        added = self._write_hours(name, entries, closed=False)
        self._commit(name, Change(add_hours=added, seen=dict.fromkeys(added, -1)))

    # Writes

    def _write_rows(self, name: str, rows: DataFrame) -> dict[str, list[str]]:
        """Write ``rows`` (with a column ``day``) to new folders, by day.

        Rows of one day go together; AQE splits large days over tasks and lets a task write
        several small ones.
        """
        batch = f"rows/{new_batch()}"
        packed = rows.hint("rebalance", "day").sortWithinPartitions("day", *TABLES[name].order)
        packed.write.partitionBy("day").parquet(f"{self.logs[name].root}/{batch}")
        return self._by_day(name, batch)

    def _write_hours(self, name: str, hours: DataFrame, closed: bool | None) -> dict[str, list[str]]:
        batch = f"hours/{new_batch()}"
        own = set(hours.columns)
        rows = hours.select(
            *HOUR,
            F.substring("hour_key", 1, 10).alias("date"),
            F.lit(closed).cast("boolean").alias("closed"),
            F.col("version") if "version" in own else F.lit(None).cast("long").alias("version"),
            F.col("n_rows") if "n_rows" in own else F.lit(None).cast("long").alias("n_rows"),
            F.col("again") if "again" in own else F.lit(None).cast("boolean").alias("again"),
        )
        return self._save_hours(name, rows, batch)

    def _save_hours(self, name: str, rows: DataFrame, batch: str) -> dict[str, list[str]]:
        packed = rows.withColumn("day", F.col("date")).hint("rebalance", "day").sortWithinPartitions("day", *HOUR)
        packed.write.partitionBy("day").parquet(f"{self.logs[name].root}/{batch}")
        return self._by_day(name, batch)

    def _by_day(self, name: str, batch: str) -> dict[str, list[str]]:
        """The day folders that a write has made: as many as days."""
        found = [n for n in self.logs[name].storage.names(batch) if n.startswith("day=")]
        return {n.removeprefix("day="): [f"{batch}/{n}"] for n in found}

    def _commit(self, name: str, change: Change, check: Callable[[Version], None] = lambda _: None) -> None:
        version = self.logs[name].commit(change, check)
        log.info("%s: version %d, %s", name, version.number, change.counts)
        many = [day for day, folders in version.hours.items() if len(folders) > MOST_HOUR_FOLDERS]
        if many:
            self._fold_hours(name, version, many)

    def _fold_hours(self, name: str, version: Version, days: Sequence[str]) -> None:
        """One folder of ledger entries instead of many, for each of ``days``."""
        columns = [*HOUR, "date", "closed", "version", "n_rows", F.lit(None).cast("boolean").alias("again")]
        rows = self._entries(name, version, days).select(*columns)
        added = self._save_hours(name, rows, f"hours/{new_batch()}")
        removed = {day: version.hours[day] for day in days}
        try:
            self.logs[name].commit(Change(add_hours=added, remove_hours=removed, keeps_content=True))
        except ConcurrentChange:
            log.info("%s: another job has folded the ledger of these days", name)

    # Jobs

    def write_bronze(self, df: DataFrame) -> None:
        """Append telemetry. Duplicates and faulty rows are kept.

        The hours that came are written down with the rows, so that jobs find them without listing.
        """
        _check_columns(df)
        seen = Observation()
        rows = to_bronze(df).withColumn("day", F.when(unaddressable(), UNADDRESSABLE).otherwise(F.col("date")))
        counts = F.count(F.lit(1)).alias("rows"), F.count_if(F.col("day") == UNADDRESSABLE).alias("unaddressable")
        added = self._write_rows("bronze", rows.observe(seen, *counts))
        if not added:
            raise ValueError("telemetry to append has no rows")
        folders = [f for day, own in added.items() if day != UNADDRESSABLE for f in own]
        written = self._rows_in("bronze", folders).withColumnRenamed("hour", "hour_key")
        hours = written.groupBy(*HOUR).agg(F.count(F.lit(1)).alias("n_rows"))
        arrived = self._write_hours("bronze", hours, closed=None) if folders else {}
        self._commit("bronze", Change(add_rows=added, add_hours=arrived, counts=dict(seen.get)))

    def run_silver(
        self,
        dates: Sequence[str] | None = None,
        keys: Sequence[str] = DEDUP_KEYS,
        ranges: Sequence[tuple[str, float, float]] = RANGES,
    ) -> str:
        """Clean the bronze hours silver has not closed yet. Late rows for closed hours are ignored."""

        def clean(bronze: DataFrame) -> DataFrame:
            rows = bronze.withColumnRenamed("hour", "hour_key")
            return clean_telemetry(rows, keys, ranges, also=["date", "hour_key"])

        return self._run("silver", "bronze", clean, "has_range_violation", dates)

    def run_hourly_energy(self, dt_seconds: float, dates: Sequence[str] | None = None) -> str:
        """Roll up the hours that silver has closed and this table has not."""
        check_step(dt_seconds)
        return self._run("hourly_energy", "silver", lambda rows: hourly_energy(rows, dt_seconds), "bad_rows > 0", dates)

    def run_farm_kpis(
        self, dt_seconds: float, rated_power_kw: float = 2000.0, dates: Sequence[str] | None = None
    ) -> str:
        check_step(dt_seconds)
        rollup = lambda rows: farm_kpis(rows, dt_seconds, rated_power_kw)
        return self._run("farm_kpis", "silver", rollup, "bad_rows > 0", dates)

    def _run(
        self,
        name: str,
        source: str,
        derive: Callable[[DataFrame], DataFrame],
        flagged: str,
        dates: Sequence[str] | None,
    ) -> str:
        """Derive the open hours of ``name`` from ``source`` and publish them with their ledger entries.

        Only days are looked at whose source has changed since this table last took all of
        their hours. The open hours are written first, so that the filter, the rows and the ledger name
        the same ones whatever arrives meanwhile. Hours that were in the table before replace
        their rows: the days they lie in are written again, other rows of these days as they are.
        """
        came, have = self._existing(source), self.logs[name].latest()
        days = _changed_days(came, have, dates)
        path = self.logs[name].root
        if not days:
            log.info("%s: no new hours", name)
            return path
        seen = {day: came.touched[day] for day in days}
        staged, n_open, n_again = self._open_hours(name, source, came, have, days)
        if not staged:
            self._commit(name, Change(seen=seen))
            return path
        rows, again = self._restricted(name, source, came, staged, n_open), {}
        counted = Observation()
        new = derive(rows).withColumns({"day": F.col("date"), "fresh": F.lit(True)})
        if n_again:
            again = self._days_again(name, staged)
            kept = self._read(name, have, again)
            redone = self._open_in(name, staged).filter("again").select(*HOUR)
            kept = kept.join(_sized(redone, n_again), list(HOUR), "left_anti")
            new = new.unionByName(kept.withColumns({"day": F.col("date"), "fresh": F.lit(False)}))
        # Counted over all that is written, as a plan of no rows would not report.
        measures = F.count_if("fresh").alias("rows"), F.count_if(F.expr(f"fresh AND {flagged}")).alias("flagged")
        new = new.observe(counted, *measures).drop("fresh")
        added = self._write_rows(name, new)
        removed = {day: have.rows[day] for day in again if have.rows.get(day)}

        def unchanged(base: Version) -> None:
            late = [day for day in staged if base.touched.get(day) != have.touched.get(day)]
            if late:
                raise ConcurrentChange(f"{name}: another run has published {late[:5]}")

        counts = {**counted.get, "hours": n_open} if added else {"rows": 0, "hours": n_open}
        change = Change(add_rows=added, remove_rows=removed, add_hours=staged, seen=seen, counts=counts)
        self._commit(name, change, unchanged)
        return path

    def _open_hours(
        self, name: str, source: str, came: Version, have: Version, days: Sequence[str]
    ) -> tuple[dict[str, list[str]], int, int]:
        """Folders with the open hours of ``days``, as entries that close them; their number, and the
        number of those that have an entry already."""
        present = self._entries(source, came, days)
        if source != "bronze":
            present = present.filter("closed")
        known = self._entries(name, have, days).select(*HOUR, F.col("closed").alias("was_closed"))
        joined = present.select(*HOUR).join(known, list(HOUR), "left")
        is_open = joined.filter(~F.coalesce("was_closed", F.lit(False)))
        rows = is_open.withColumn("again", F.col("was_closed").isNotNull())
        counted = Observation()
        rows = rows.observe(counted, F.count(F.lit(1)).alias("n"), F.count_if("again").alias("again"))
        staged = self._write_hours(name, rows, closed=True)
        return (staged, counted.get["n"], counted.get["again"]) if staged else ({}, 0, 0)

    def _open_in(self, name: str, staged: Mapping[str, list[str]]) -> DataFrame:
        return self._files(name, [f for folders in staged.values() for f in folders], schemas.HOURS)

    def _days_again(self, name: str, staged: Mapping[str, list[str]]) -> list[str]:
        found = self._open_in(name, staged).filter("again").select("date").distinct()
        return sorted(r[0] for r in found.collect())  # at most the days of the run

    def _restricted(
        self, name: str, source: str, came: Version, staged: Mapping[str, list[str]], n_open: int
    ) -> DataFrame:
        """Source rows of the open hours. The hours' names reach the scan as a filter."""
        rows = self._read(source, came, list(staged))
        column = "hour" if source == "bronze" else "hour_key"
        hours = self._open_in(name, staged)
        listed = [r[0] for r in hours.select("hour_key").distinct().limit(MAX_LITERALS + 1).collect()]
        if len(listed) <= MAX_LITERALS:
            rows = rows.filter(F.col(column).isin(sorted(listed)))
        wanted = hours.select(*HOUR).withColumnRenamed("hour_key", column)
        return rows.join(_sized(wanted, n_open), ["sim_run_id", "farm_id", column], "left_semi")

    # Upkeep

    def compact(self, name: str, dates: Sequence[str] | None = None, target_bytes: int = TARGET_BYTES) -> int:
        """Pack the small folders of each day into files of up to ``target_bytes``; number of folders packed.

        Folders are put into bins by their measured size, the largest first, each into the first
        bin with room. Of the days' bins all are written by one job, a task for each. Readers keep
        the folders they have; a job that replaces a day meanwhile wins.
        """
        log_of, version = self.logs[name], self.logs[name].latest()
        chosen = [d for d in version.rows if len(version.rows[d]) > 1 and (dates is None or d in dates)]
        bins = []
        for day in chosen:
            sizes = {f: log_of.storage.size(f) for f in version.rows[day]}
            bins += [(day, own) for own in packed_bins(sizes, target_bytes) if len(own) > 1]
        if not bins:
            return 0
        of_folder = [(f.split("/", 1)[1], day, n) for n, (day, own) in enumerate(bins) for f in own]
        # A row for each folder of the version, which the driver has just named.
        places = F.broadcast(self.spark.createDataFrame(of_folder, "folder string, day string, bin int"))
        rows = self._rows_in(name, [f for _, own in bins for f in own])
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"/rows/(.+)/[^/]+$", 1)
        rows = rows.withColumn("folder", folder).join(places, "folder").drop("folder")
        batch = f"rows/{new_batch()}"
        dealt = rows.repartition(len(bins), "day", "bin").sortWithinPartitions("day", "bin", *TABLES[name].order)
        dealt.write.partitionBy("day", "bin").parquet(f"{log_of.root}/{batch}")
        added: dict[str, list[str]] = {}
        removed: dict[str, list[str]] = {}
        for n, (day, own) in enumerate(bins):
            added.setdefault(day, []).append(f"{batch}/day={day}/bin={n}")
            removed.setdefault(day, []).extend(own)
        try:
            log_of.commit(Change(add_rows=added, remove_rows=removed, keeps_content=True))
        except ConcurrentChange:
            log.info("%s: days were replaced while they were packed; nothing changed", name)
            return 0
        return len(of_folder)

    def vacuum(self, older_than_seconds: float | None = None) -> list[str]:
        """Delete what failed jobs have left; not what is younger than the retention or the time given."""
        return [f"{n}/{f}" for n, own in self.logs.items() for f in own.remove_orphans(["rows", "hours"], older_than_seconds)]

    # Checks

    def assert_runs_present(self, name: str, expected: Sequence[str], dates: Sequence[str] | None = None) -> None:
        """Raise ``RuntimeError`` if an expected run has no row in a table."""
        table = self._stored(name, dates)
        missing = sorted(row["sim_run_id"] for row in missing_runs(table, expected).collect())
        if missing:
            found = [r["sim_run_id"] for r in runs_present(table).limit(NAMED_RUNS).collect()]
            raise RuntimeError(f"{name} has no row of {missing}; it has {found} (at most {NAMED_RUNS} are named)")


def _check_columns(df: DataFrame) -> None:
    missing = sorted(set(REQUIRED) - set(df.columns))
    if missing:
        raise ValueError(f"telemetry lacks the columns {missing}")
    absent = sorted(set(schemas.TELEMETRY.names) - set(df.columns))
    if absent:
        raise KeyError(f"telemetry lacks the columns {absent}")


def _changed_days(came: Version, have: Version, dates: Sequence[str] | None) -> list[str]:
    """Days whose source has changed since all of their hours were taken."""
    changed = [day for day, number in came.touched.items() if day != UNADDRESSABLE and have.seen.get(day) != number]
    return sorted(changed if dates is None else set(changed) & set(dates))


def _sized(hours: DataFrame, n: int) -> DataFrame:
    """``n`` hours for a join: broadcast below a bound."""
    return F.broadcast(hours) if n <= MAX_BROADCAST_ROWS else hours


def packed_bins(sizes: Mapping[str, int], target_bytes: int) -> list[list[str]]:
    """First fit by falling size: bins of at most ``target_bytes``, larger items alone."""
    bins: list[tuple[int, list[str]]] = []
    for item, size in sorted(sizes.items(), key=lambda kv: (-kv[1], kv[0])):
        for n, (filled, own) in enumerate(bins):
            if filled + size <= target_bytes:
                bins[n] = (filled + size, [*own, item])
                break
        else:
            bins.append((size, [item]))
    return [own for _, own in bins]
