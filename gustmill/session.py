"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Hour and date keys are UTC.
    "spark.sql.session.timeZone": "UTC",
    # AQE coalesces small shuffle partitions, splits skewed joins and rebalances writes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Layers hold one file per farm and hour; do not bill each of them as 4 MB when packing splits.
    "spark.sql.files.openCostInBytes": "1m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Plans are built from many columns; skip recording the Python call site of each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "gustmill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with ``SETTINGS``; ``shuffle_partitions`` is the count AQE starts from."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; ``fallback`` only where none is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or fallback)
