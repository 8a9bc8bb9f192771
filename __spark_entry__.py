"""

Every query reads telemetry derived from the ``events`` table. Timestamps leave as
``timestamp_ntz`` and computed doubles rounded to six places, so that both engines agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustmill.functions.quality import add_range_flags
from gustmill.operators.dedup import THREE_COLUMN_KEYS, flag_duplicates, keep_first
from gustmill.operators.increments import closed_hours, hours_present, latest_entries, ledger_entries
from gustmill.operators.layout import turbine_layout
from gustmill.operators.rollups import farm_kpis, hourly_energy, row_energy
from gustmill.operators.runs import missing_runs, runs_present, scenario_compare
from gustmill.operators.telemetry import bronze_keys, clean_telemetry, to_bronze
from gustmill.operators.whatif import (
    expected_power,
    under_scenarios,
    wake_effective_speed,
    what_if_energy,
    what_if_turbine_energy,
)
from gustmill.plans.increment import open_increment
from gustmill.plans.packed import PackedLake
from gustmill.session import ensure_checkpoint_dir
from gustmill.sources.events import farms_of, telemetry_from_events, wake_scenarios

MINUTE, HOUR = 60.0, 3600.0
CUTOFF = "2024-01-15T00:00:00Z"
REDONE_BEFORE, COMMITTED_BEFORE = "2024-01-03T00:00:00Z", "2024-01-25T00:00:00Z"
EXPECTED_RUNS = ("SIM-A", "SIM-B", "SIM-C")
SMOKE_DIR = "/root/testdata/sf0.001"


# Inputs of the queries


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return telemetry_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(_telemetry(spark, sf_dir))


def _share_checkpoints(spark: SparkSession) -> None:
    warehouse = spark.conf.get("spark.sql.warehouse.dir")  # shared, as checkpoints must be
    ensure_checkpoint_dir(spark, f"{warehouse}/_checkpoints")


def _once(df: DataFrame) -> DataFrame:
    """``df`` computed here and now, for tables that a query reads more than once."""
    _share_checkpoints(df.sparkSession)
    return df.checkpoint()


def _layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as the jobs take it up, with a ledger's name for the hour."""
    return _bronze(spark, sf_dir).withColumnRenamed("hour", "hour_key")


def _ledger(layer: DataFrame) -> DataFrame:
    """Entries that have closed every hour before the cutoff."""
    return ledger_entries(hours_present(layer).filter(F.col("hour_key") < CUTOFF), True, 1)


def _increment(layer: DataFrame, entries: DataFrame):
    _share_checkpoints(layer.sparkSession)
    return open_increment(layer, closed_hours(entries))


def _turbines(telemetry: DataFrame) -> DataFrame:
    return _once(turbine_layout(farms_of(telemetry)))


def _out(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# Queries


def _bronze_scan(spark, sf_dir):
    return _out(_telemetry(spark, sf_dir))


def _bronze_keys(spark, sf_dir):
    keys = ["source", "event_time", "ingest_time", "date", "hour_key", "process_key"]
    return _out(bronze_keys(_bronze(spark, sf_dir)).select(*keys))


def _range_flags(spark, sf_dir):
    flags = ["source", "has_range_violation", "range_violation_fields"]
    return _out(add_range_flags(_bronze(spark, sf_dir)).select(*flags))


def _flag_duplicates(spark, sf_dir):
    columns = ["sim_run_id", "farm_id", "turbine_id", "event_time", "source", "is_duplicate"]
    return _out(flag_duplicates(_bronze(spark, sf_dir)).select(*columns))


def _dedup(spark, sf_dir):
    return _out(keep_first(_telemetry(spark, sf_dir)))


def _dedup_three_key(spark, sf_dir):
    return _out(keep_first(_telemetry(spark, sf_dir), THREE_COLUMN_KEYS))


def _silver(spark, sf_dir):
    return _out(clean_telemetry(_bronze(spark, sf_dir)))


def _row_energy(spark, sf_dir):
    columns = ["source", "hour", "energy_kwh", "is_running"]
    return _out(row_energy(clean_telemetry(_bronze(spark, sf_dir)), MINUTE).select(*columns))


def _hourly_energy(spark, sf_dir):
    return _out(hourly_energy(clean_telemetry(_bronze(spark, sf_dir)), MINUTE))


def _farm_kpis(spark, sf_dir):
    return _out(farm_kpis(clean_telemetry(_bronze(spark, sf_dir)), HOUR))


def _pending_hours(spark, sf_dir):
    layer = _layer(spark, sf_dir)
    return _out(_increment(layer, _ledger(layer)).hours)


def _commit_keys(spark, sf_dir):
    """A part of the closed hours is reopened, then a part of the open ones is closed."""
    layer = _layer(spark, sf_dir)
    closed = _ledger(layer)
    redone = ledger_entries(closed.filter(F.col("hour_key") < REDONE_BEFORE), False, 2)
    entries = _once(closed.unionByName(redone))
    pending = _increment(layer, entries).hours
    done = ledger_entries(pending.filter(F.col("hour_key") < COMMITTED_BEFORE), True, 3)
    return _out(latest_entries(entries.unionByName(done)).filter("closed").drop("closed"))


def _open_silver(spark, sf_dir):
    layer = _layer(spark, sf_dir)
    rows = _increment(layer, _ledger(layer)).restrict(layer, ["sim_run_id", "farm_id", "date", "hour_key"])
    return clean_telemetry(rows, also=["date", "hour_key"])


def _hourly_energy_incremental(spark, sf_dir):
    return _out(hourly_energy(_open_silver(spark, sf_dir), MINUTE))


def _farm_kpis_incremental(spark, sf_dir):
    return _out(farm_kpis(_open_silver(spark, sf_dir), HOUR))


def _runs_present(spark, sf_dir):
    return _out(runs_present(_bronze(spark, sf_dir)))


def _missing_runs(spark, sf_dir):
    return _out(missing_runs(_bronze(spark, sf_dir), EXPECTED_RUNS))


def _scenario_compare(spark, sf_dir):
    kpis = farm_kpis(clean_telemetry(_bronze(spark, sf_dir)), HOUR)
    return _out(scenario_compare(kpis, "SIM-A", "SIM-B"))


def _turbine_layout(spark, sf_dir):
    return _out(turbine_layout(farms_of(_telemetry(spark, sf_dir))))


def _expected_power(spark, sf_dir):
    telemetry = _telemetry(spark, sf_dir)
    columns = [
        "source",
        "wind_speed_mps",
        "expected_power_kw",
        "expected_status",
        "expected_rotor_rpm",
        "power_gap_kw",
    ]
    return _out(expected_power(to_bronze(telemetry), _turbines(telemetry)).select(*columns))


def _wake_effective_speed(spark, sf_dir):
    telemetry = _telemetry(spark, sf_dir)
    rows = wake_effective_speed(
        to_bronze(telemetry), _turbines(telemetry), wake_scenarios(spark)
    )
    columns = ["sim_run_id", "farm_id", "turbine_id", "event_time", "source"]
    return _out(rows.select(*columns, "wind_dir_deg", "wake_factor", "wind_speed_eff_mps"))


def _what_if_energy(spark, sf_dir):
    telemetry = _telemetry(spark, sf_dir)
    silver = clean_telemetry(to_bronze(telemetry))
    return _out(what_if_energy(silver, _turbines(telemetry), wake_scenarios(spark), HOUR))


def _what_if_turbine_energy(spark, sf_dir):
    telemetry = _telemetry(spark, sf_dir)
    silver = clean_telemetry(to_bronze(telemetry))
    return _out(
        what_if_turbine_energy(silver, _turbines(telemetry), wake_scenarios(spark), MINUTE)
    )


def _what_if_compare(spark, sf_dir):
    telemetry = _telemetry(spark, sf_dir)
    wind = under_scenarios(clean_telemetry(to_bronze(telemetry)), "SIM-A", ["SIM-A", "SIM-B"])
    kpis = what_if_energy(wind, _turbines(telemetry), wake_scenarios(spark), HOUR)
    return _out(scenario_compare(kpis, "SIM-A", "SIM-B"))


# Queries over a stored lake. Events from the cutoff on, and some of each hundred before it, come
# by a second append: late rows for hours that are closed by then. Then the hours of the first days
# are run again, and take their late rows up.


def _stored_lake(spark, sf_dir, *, silver: bool = True, gold: tuple[str, ...] = ()) -> PackedLake:
    telemetry = _telemetry(spark, sf_dir)
    _share_checkpoints(spark)
    lake = PackedLake(spark, f"{spark.sparkContext.getCheckpointDir()}/lake-{uuid.uuid4().hex}")

    def run_jobs() -> None:
        if silver:
            lake.run_silver()
        if "hourly_energy" in gold:
            lake.run_hourly_energy(MINUTE)
        if "farm_kpis" in gold:
            lake.run_farm_kpis(HOUR)

    late = F.col("source").cast("bigint") % 100 == 7
    early = (F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'") < CUTOFF) & ~late
    for batch in (telemetry.filter(early), telemetry.filter(~early)):
        lake.write_bronze(batch)
        run_jobs()
    if silver:
        redone = lake.closed("silver").filter(F.col("hour_key") < REDONE_BEFORE)
        for name in ("silver", *gold):
            lake.reopen(name, redone)
        run_jobs()
    return lake


def _lake_bronze(spark, sf_dir):
    """After both appends have been packed into one file a day."""
    lake = _stored_lake(spark, sf_dir, silver=False)
    lake.compact("bronze")
    return _out(lake.bronze())


def _lake_arrived(spark, sf_dir):
    return _out(_stored_lake(spark, sf_dir, silver=False).arrived())


def _lake_silver(spark, sf_dir):
    return _out(_stored_lake(spark, sf_dir).silver())


def _lake_hourly_energy(spark, sf_dir):
    return _out(_stored_lake(spark, sf_dir, gold=("hourly_energy",)).hourly_energy())


def _lake_farm_kpis(spark, sf_dir):
    return _out(_stored_lake(spark, sf_dir, gold=("farm_kpis",)).farm_kpis())


def _lake_ledger(spark, sf_dir):
    """Closed hours of silver and farm KPIs, with the version that closed them."""
    lake = _stored_lake(spark, sf_dir, gold=("farm_kpis",))
    ledgers = [lake.closed(name).withColumn("dataset", F.lit(name)) for name in ("silver", "farm_kpis")]
    return _out(ledgers[0].unionByName(ledgers[1]))


def entry(spark: SparkSession) -> DataFrame:
    """Hourly turbine energy on the smallest test data."""
    return _hourly_energy(spark, SMOKE_DIR)


def _corpus_modules():
    """The corpus queries and their pipeline; none where they, or what they import, are not there."""
    try:
        import corpus_pipeline
        from gustmill.llm import queries as corpus_queries
    except ImportError:
        return None
    return corpus_queries, corpus_pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _telemetry_queries()
    if modules := _corpus_modules():
        found |= modules[0].queries() | {"pipeline": modules[1].run}
    return found


def oracle_sql() -> dict[str, str]:
    found = _telemetry_sql()
    if modules := _corpus_modules():
        found |= modules[0].oracle_sql()
        if modules[1].ORACLE_SQL:
            found["pipeline"] = modules[1].ORACLE_SQL
    return found


def _telemetry_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "bronze_scan": _bronze_scan,
        "bronze_keys": _bronze_keys,
        "range_flags": _range_flags,
        "flag_duplicates": _flag_duplicates,
        "dedup_telemetry": _dedup,
        "dedup_telemetry_three_key": _dedup_three_key,
        "silver": _silver,
        "row_energy": _row_energy,
        "hourly_energy": _hourly_energy,
        "farm_kpis": _farm_kpis,
        "pending_hours": _pending_hours,
        "commit_keys": _commit_keys,
        "hourly_energy_incremental": _hourly_energy_incremental,
        "farm_kpis_incremental": _farm_kpis_incremental,
        "runs_present": _runs_present,
        "missing_runs": _missing_runs,
        "scenario_compare": _scenario_compare,
        "turbine_layout": _turbine_layout,
        "expected_power": _expected_power,
        "wake_effective_speed": _wake_effective_speed,
        "what_if_energy": _what_if_energy,
        "what_if_turbine_energy": _what_if_turbine_energy,
        "what_if_compare": _what_if_compare,
        "lake_bronze": _lake_bronze,
        "lake_arrived": _lake_arrived,
        "lake_silver": _lake_silver,
        "lake_hourly_energy": _lake_hourly_energy,
        "lake_farm_kpis": _lake_farm_kpis,
        "lake_ledger": _lake_ledger,
    }


# SQL counterparts. Each is a WITH list followed by one SELECT.

_TELEMETRY = """
telemetry AS (
  SELECT
    CASE WHEN event_id % 2 = 0 THEN 'SIM-A' ELSE 'SIM-B' END AS sim_run_id,
    'F' || lpad(CAST(user_id // 12 % 3 + 1 AS VARCHAR), 3, '0') AS farm_id,
    'T' || lpad(CAST(user_id % 12 + 1 AS VARCHAR), 3, '0') AS turbine_id,
    CAST(date_trunc('minute', ts) AS TIMESTAMP) AS event_time,
    ts AS ingest_time,
    CAST(value / 10 AS FLOAT) AS wind_speed_free_mps,
    CAST(CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -5
              ELSE value / 12 END AS FLOAT) AS wind_speed_mps,
    CAST(event_id % 367 AS FLOAT) AS wind_dir_deg,
    CAST(CASE WHEN event_id % 101 = 0 THEN 99999 ELSE value * 4 END AS FLOAT) AS power_kw,
    CAST(event_id % 32 AS FLOAT) AS rotor_speed_rpm,
    CAST(event_id % 360 AS FLOAT) AS yaw_deg,
    CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_type = 'error' THEN 'STOPPED'
         WHEN value > 250 THEN 'CUT_OUT' ELSE 'RUNNING' END AS status,
    CAST(event_id AS VARCHAR) AS source
  FROM events, range(2) AS copy(n)
  WHERE n = 0 OR event_id % 500 = 0
)"""

_BRONZE = f"""{_TELEMETRY},
bronze AS (
  SELECT * REPLACE (CAST(date_trunc('millisecond', ingest_time) AS TIMESTAMP) AS ingest_time),
    CAST(date_trunc('hour', event_time) AS TIMESTAMP) AS hour,
    strftime(event_time, '%Y-%m-%d') AS date,
    strftime(event_time, '%Y-%m-%dT%H:00:00Z') AS hour_key
  FROM telemetry
)"""

_FIELDS = """concat_ws(',',
      CASE WHEN wind_speed_mps IS NULL OR wind_speed_mps < 0 OR wind_speed_mps > 60 THEN 'wind_speed_mps' END,
      CASE WHEN wind_dir_deg IS NULL OR wind_dir_deg < 0 OR wind_dir_deg > 360 THEN 'wind_dir_deg' END,
      CASE WHEN rotor_speed_rpm IS NULL OR rotor_speed_rpm < 0 OR rotor_speed_rpm > 30 THEN 'rotor_speed_rpm' END,
      CASE WHEN yaw_deg IS NULL OR yaw_deg < 0 OR yaw_deg > 360 THEN 'yaw_deg' END,
      CASE WHEN power_kw IS NULL OR power_kw < 0 OR power_kw > 10000 THEN 'power_kw' END)"""

_FOUR = "sim_run_id, farm_id, turbine_id, event_time"
_THREE = "farm_id, turbine_id, event_time"


def _first(table: str, keys: str) -> str:
    # The remaining columns tie only between exact copies: source is unique per event.
    return (
        f"SELECT * FROM {table} QUALIFY row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY ingest_time NULLS FIRST, source NULLS FIRST) = 1"
    )


_CLOSED = f"""
closed AS (
  SELECT DISTINCT sim_run_id, farm_id, date, hour_key FROM bronze WHERE hour_key < '{CUTOFF}'
)"""


def _silver_cte(source: str) -> str:
    return f"""
silver AS (
  SELECT *, FALSE AS is_duplicate, {_FIELDS} <> '' AS has_range_violation,
    {_FIELDS} AS range_violation_fields
  FROM ({_first(source, _FOUR)})
)"""


_SILVER = f"{_BRONZE},{_silver_cte('bronze')}"
_OPEN_SILVER = f"""{_BRONZE},{_CLOSED},
open_bronze AS (SELECT * FROM bronze ANTI JOIN closed USING (sim_run_id, farm_id, hour_key)),
{_silver_cte('open_bronze')}"""

_LABEL = "sim_run_id || '|' || farm_id || '|' || hour_key AS process_key"


def _hourly(table: str, dt: float) -> str:
    return f"""
SELECT *, {_LABEL} FROM (
  SELECT sim_run_id, farm_id, turbine_id, hour,
    round(avg(CAST(wind_speed_mps AS DOUBLE)), 6) AS wind_speed_mps_avg,
    round(avg(CAST(power_kw AS DOUBLE)), 6) AS power_kw_avg,
    round(coalesce(sum(CAST(power_kw AS DOUBLE) * CAST({dt / 3600!r} AS DOUBLE)), 0), 6) AS energy_kwh,
    round(count(*) FILTER (status IS DISTINCT FROM 'RUNNING') * CAST({dt / 60!r} AS DOUBLE), 6)
      AS downtime_minutes,
    count(*) FILTER (has_range_violation) AS bad_rows,
    count(event_time) AS rows,
    strftime(hour, '%Y-%m-%d') AS date,
    strftime(hour, '%Y-%m-%dT%H:00:00Z') AS hour_key
  FROM {table} GROUP BY sim_run_id, farm_id, turbine_id, hour)"""


def _kpi_ctes(table: str, dt: float) -> str:
    """``kpis``: unrounded farm KPIs of ``table``."""
    return f"""
totals AS (
  SELECT sim_run_id, farm_id, hour,
    avg(CAST(power_kw AS DOUBLE)) AS farm_power_kw_avg,
    coalesce(sum(CAST(power_kw AS DOUBLE) * CAST({dt / 3600!r} AS DOUBLE)), 0) AS farm_energy_kwh,
    count(*) FILTER (status = 'RUNNING') AS running_rows,
    count(*) AS total_rows,
    count(*) FILTER (has_range_violation) AS bad_rows,
    avg(CAST(wind_speed_free_mps AS DOUBLE)) AS avg_free_wind,
    avg(CAST(wind_speed_mps AS DOUBLE)) AS avg_effective_wind,
    strftime(hour, '%Y-%m-%d') AS date,
    strftime(hour, '%Y-%m-%dT%H:00:00Z') AS hour_key
  FROM {table} GROUP BY sim_run_id, farm_id, hour
),
rates AS (
  SELECT *,
    CAST(running_rows AS DOUBLE) / total_rows AS availability,
    avg_free_wind - avg_effective_wind AS avg_wake_loss_mps,
    CAST(bad_rows AS DOUBLE) / total_rows AS bad_row_rate,
    CAST(round_even(CAST(total_rows AS DOUBLE) / {int(3600 / dt)}, 0) AS BIGINT) AS n_turbines_est
  FROM totals
),
kpis AS (
  SELECT *, farm_energy_kwh / nullif(n_turbines_est * CAST(2000 AS DOUBLE), 0) AS capacity_factor,
    {_LABEL}
  FROM rates
)"""


_KPI_SELECT = """
SELECT * REPLACE (
  round(farm_power_kw_avg, 6) AS farm_power_kw_avg,
  round(farm_energy_kwh, 6) AS farm_energy_kwh,
  round(avg_free_wind, 6) AS avg_free_wind,
  round(avg_effective_wind, 6) AS avg_effective_wind,
  round(availability, 6) AS availability,
  round(avg_wake_loss_mps, 6) AS avg_wake_loss_mps,
  round(bad_row_rate, 6) AS bad_row_rate,
  round(capacity_factor, 6) AS capacity_factor)
FROM kpis"""

_COMPARED = ("farm_energy_kwh", "capacity_factor", "availability", "avg_wake_loss_mps")
_COMPARE_SELECT = (
    "SELECT farm_id, hour, "
    + ", ".join(
        f"round(a.{n}, 6) AS {n}_a, round(b.{n}, 6) AS {n}_b, round(b.{n} - a.{n}, 6) AS {n}_delta"
        for n in _COMPARED
    )
    + " FROM kpis a JOIN kpis b USING (farm_id, hour)"
    + " WHERE a.sim_run_id = 'SIM-A' AND b.sim_run_id = 'SIM-B'"
)

_TURBINES = """
turbines AS (
  SELECT farm_id, 'T' || lpad(CAST(slot + 1 AS VARCHAR), 3, '0') AS turbine_id,
    CAST(slot % 4 * 600 AS DOUBLE) AS x_m, CAST(slot // 4 * 600 AS DOUBLE) AS y_m,
    CAST(2000 AS DOUBLE) AS rated_power_kw
  FROM (SELECT DISTINCT farm_id FROM telemetry), range(12) AS grid(slot)
)"""

_SCENARIOS = """
scenarios AS (
  SELECT DISTINCT sim_run_id,
    CAST(CASE sim_run_id WHEN 'SIM-A' THEN 0.12 WHEN 'SIM-B' THEN 0.25 END AS DOUBLE) AS strength,
    CAST(900 AS DOUBLE) AS decay, CAST(250 AS DOUBLE) AS sigma
  FROM telemetry
)"""


def _power(v: str) -> str:
    return (
        f"CASE WHEN {v} >= 25 OR {v} < 3 THEN 0 WHEN {v} < 12 THEN "
        f"rated_power_kw * pow((CAST({v} AS DOUBLE) - 3) / 9, 3) "
        f"WHEN {v} IS NOT NULL THEN rated_power_kw END"
    )


def _status(v: str) -> str:
    return (
        f"CASE WHEN {v} >= 25 THEN 'CUT_OUT' WHEN {v} < 3 THEN 'STOPPED' "
        f"WHEN {v} IS NOT NULL THEN 'RUNNING' END"
    )


def _rotor(v: str) -> str:
    return (
        f"CASE WHEN {v} >= 3 AND {v} < 25 THEN "
        f"6 + (least(CAST({v} AS DOUBLE), 12) - 3) * (CAST(12 AS DOUBLE) / 9) "
        f"WHEN {v} IS NOT NULL THEN 0 END"
    )


def _wake_ctes(table: str) -> str:
    """``waked``: rows of ``table`` (unique by source and run) with factor and effective speed."""
    return f"""
posed AS (
  SELECT r.*, x_m, y_m, rated_power_kw, strength, decay, sigma,
    cos(radians(CAST(wind_dir_deg AS DOUBLE))) AS ux,
    sin(radians(CAST(wind_dir_deg AS DOUBLE))) AS uy
  FROM {table} r JOIN turbines USING (farm_id, turbine_id) JOIN scenarios USING (sim_run_id)
),
offsets AS (
  SELECT p.sim_run_id, p.source, p.strength, p.decay, p.sigma,
    (p.x_m - s.x_m) * ux + (p.y_m - s.y_m) * uy AS downwind,
    abs(-(p.x_m - s.x_m) * uy + (p.y_m - s.y_m) * ux) AS crosswind
  FROM posed p JOIN turbines s ON p.farm_id = s.farm_id AND p.turbine_id <> s.turbine_id
),
factors AS (
  SELECT sim_run_id, source, product(CASE WHEN downwind > 0 THEN
      1 - strength * exp(-pow(crosswind, 2) / (2 * pow(sigma, 2))) * exp(-downwind / decay)
    ELSE 1 END) AS wake_factor
  FROM offsets GROUP BY sim_run_id, source
),
waked AS (
  SELECT *, greatest(0, CAST(wind_speed_free_mps AS DOUBLE) * wake_factor) AS wind_speed_eff_mps
  FROM posed JOIN factors USING (sim_run_id, source)
)"""


_WHAT_IF = f"""
replaced AS (
  SELECT * EXCLUDE (has_range_violation, range_violation_fields) REPLACE (
    wind_speed_eff_mps AS wind_speed_mps, {_power('wind_speed_eff_mps')} AS power_kw,
    {_status('wind_speed_eff_mps')} AS status, {_rotor('wind_speed_eff_mps')} AS rotor_speed_rpm,
    wind_dir_deg AS yaw_deg)
  FROM waked
),
whatif AS (SELECT *, {_FIELDS} <> '' AS has_range_violation FROM replaced)"""

_DIMENSIONS = f"{_TURBINES},{_SCENARIOS}"
_WHAT_IF_SILVER = f"{_SILVER},{_DIMENSIONS},{_wake_ctes('silver')},{_WHAT_IF}"
_SAME_WIND = f"""{_SILVER},{_DIMENSIONS},
wind AS (
  SELECT silver.* REPLACE (run AS sim_run_id)
  FROM silver, (VALUES ('SIM-A'), ('SIM-B')) AS runs(run) WHERE sim_run_id = 'SIM-A'
),{_wake_ctes('wind')},{_WHAT_IF}"""

_STORED = f"""{_BRONZE},
first_batch AS (SELECT * FROM bronze WHERE hour_key < '{CUTOFF}' AND CAST(source AS BIGINT) % 100 <> 7),
first_hours AS (SELECT DISTINCT sim_run_id, farm_id, hour_key FROM first_batch),
taken AS (
  SELECT * FROM bronze WHERE hour_key < '{REDONE_BEFORE}'
  UNION ALL SELECT * FROM first_batch WHERE hour_key >= '{REDONE_BEFORE}'
  UNION ALL SELECT * FROM bronze ANTI JOIN first_hours USING (sim_run_id, farm_id, hour_key)
  WHERE hour_key >= '{REDONE_BEFORE}'
),{_silver_cte('taken')}"""

_TELEMETRY_COLUMNS = """event_time, farm_id, turbine_id, wind_speed_free_mps, wind_speed_mps,
  wind_dir_deg, power_kw, rotor_speed_rpm, yaw_deg, status, sim_run_id, ingest_time, source"""


def _telemetry_sql() -> dict[str, str]:
    selects = {
        "bronze_scan": (_TELEMETRY, f"SELECT {_TELEMETRY_COLUMNS} FROM telemetry"),
        "bronze_keys": (
            _BRONZE,
            f"SELECT source, event_time, ingest_time, date, hour_key, {_LABEL} FROM bronze",
        ),
        "range_flags": (
            _BRONZE,
            f"SELECT source, {_FIELDS} <> '' AS has_range_violation, "
            f"{_FIELDS} AS range_violation_fields FROM bronze",
        ),
        "flag_duplicates": (
            _BRONZE,
            f"SELECT {_FOUR}, source, row_number() OVER (PARTITION BY {_FOUR} ORDER BY "
            "ingest_time NULLS FIRST, source NULLS FIRST) > 1 AS is_duplicate FROM bronze",
        ),
        "dedup_telemetry": (
            _TELEMETRY,
            f"SELECT {_TELEMETRY_COLUMNS} FROM ({_first('telemetry', _FOUR)})",
        ),
        "dedup_telemetry_three_key": (
            _TELEMETRY,
            f"SELECT {_TELEMETRY_COLUMNS} FROM ({_first('telemetry', _THREE)})",
        ),
        "silver": (
            _SILVER,
            f"SELECT {_TELEMETRY_COLUMNS}, is_duplicate, has_range_violation, "
            "range_violation_fields FROM silver",
        ),
        "row_energy": (
            _SILVER,
            "SELECT source, hour, round(CAST(power_kw AS DOUBLE) * "
            f"CAST({MINUTE / 3600!r} AS DOUBLE), 6) AS energy_kwh, "
            "status IS NOT DISTINCT FROM 'RUNNING' AS is_running FROM silver",
        ),
        "hourly_energy": (_SILVER, _hourly("silver", MINUTE)),
        "farm_kpis": (f"{_SILVER},{_kpi_ctes('silver', HOUR)}", _KPI_SELECT),
        "pending_hours": (
            f"{_BRONZE},{_CLOSED}",
            "SELECT DISTINCT sim_run_id, farm_id, date, hour_key FROM bronze "
            "ANTI JOIN closed USING (sim_run_id, farm_id, hour_key)",
        ),
        "commit_keys": (
            _BRONZE,
            "SELECT DISTINCT sim_run_id, farm_id, hour_key, CAST(CASE WHEN "
            f"hour_key >= '{REDONE_BEFORE}' AND hour_key < '{CUTOFF}' THEN 1 ELSE 3 END AS BIGINT) "
            f"AS sequence FROM bronze WHERE hour_key < '{COMMITTED_BEFORE}'",
        ),
        "hourly_energy_incremental": (_OPEN_SILVER, _hourly("silver", MINUTE)),
        "farm_kpis_incremental": (f"{_OPEN_SILVER},{_kpi_ctes('silver', HOUR)}", _KPI_SELECT),
        "runs_present": (
            _BRONZE,
            "SELECT DISTINCT sim_run_id FROM bronze ORDER BY sim_run_id",
        ),
        "missing_runs": (
            _BRONZE,
            "SELECT sim_run_id FROM (VALUES "
            + ", ".join(f"('{run}')" for run in EXPECTED_RUNS)
            + ") AS expected(sim_run_id) WHERE sim_run_id NOT IN (SELECT sim_run_id FROM bronze)",
        ),
        "scenario_compare": (f"{_SILVER},{_kpi_ctes('silver', HOUR)}", _COMPARE_SELECT),
        "turbine_layout": (f"{_TELEMETRY},{_TURBINES}", "SELECT * FROM turbines"),
        "expected_power": (
            f"{_BRONZE},{_TURBINES}",
            f"SELECT source, wind_speed_mps, round({_power('wind_speed_mps')}, 6) AS expected_power_kw, "
            f"{_status('wind_speed_mps')} AS expected_status, "
            f"round({_rotor('wind_speed_mps')}, 6) AS expected_rotor_rpm, "
            f"round(CAST(power_kw AS DOUBLE) - ({_power('wind_speed_mps')}), 6) AS power_gap_kw "
            "FROM bronze JOIN turbines USING (farm_id, turbine_id)",
        ),
        "wake_effective_speed": (
            # Exact copies share one factor, so it is computed on distinct rows and joined back.
            f"{_BRONZE},{_DIMENSIONS},\nonce AS (SELECT DISTINCT * FROM bronze),{_wake_ctes('once')}",
            "SELECT sim_run_id, farm_id, turbine_id, b.event_time, source, b.wind_dir_deg, "
            "round(wake_factor, 6) AS wake_factor, "
            "round(wind_speed_eff_mps, 6) AS wind_speed_eff_mps "
            "FROM bronze b JOIN waked USING (sim_run_id, farm_id, turbine_id, source)",
        ),
        "what_if_energy": (f"{_WHAT_IF_SILVER},{_kpi_ctes('whatif', HOUR)}", _KPI_SELECT),
        "what_if_turbine_energy": (_WHAT_IF_SILVER, _hourly("whatif", MINUTE)),
        "what_if_compare": (f"{_SAME_WIND},{_kpi_ctes('whatif', HOUR)}", _COMPARE_SELECT),
        "lake_bronze": (_BRONZE, f"SELECT {_TELEMETRY_COLUMNS}, date, hour_key AS hour FROM bronze"),
        "lake_arrived": (
            _BRONZE,
            "SELECT date, sim_run_id, farm_id, hour_key, count(*) AS n_rows FROM bronze GROUP BY ALL",
        ),
        "lake_silver": (
            _STORED,
            f"SELECT {_TELEMETRY_COLUMNS}, is_duplicate, has_range_violation, "
            "range_violation_fields, date, hour_key FROM silver",
        ),
        "lake_hourly_energy": (_STORED, _hourly("silver", MINUTE)),
        "lake_farm_kpis": (f"{_STORED},{_kpi_ctes('silver', HOUR)}", _KPI_SELECT),
        "lake_ledger": (
            _STORED,
            "SELECT dataset, date, sim_run_id, farm_id, hour_key, CAST(CASE "
            f"WHEN hour_key < '{REDONE_BEFORE}' THEN 4 WHEN first_hours.hour_key IS NOT NULL THEN 1 "
            "ELSE 2 END AS BIGINT) AS version FROM (SELECT DISTINCT date, sim_run_id, farm_id, hour_key "
            "FROM bronze) LEFT JOIN first_hours USING (sim_run_id, farm_id, hour_key), "
            "(VALUES ('silver'), ('farm_kpis')) AS names(dataset)",
        ),
    }
    return {name: f"WITH {ctes}\n{select}" for name, (ctes, select) in selects.items()}
