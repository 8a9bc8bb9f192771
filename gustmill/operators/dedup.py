"""Duplicate readings: keep the first of each key, or flag the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from gustmill.schemas import TELEMETRY

# The time leads: sorting then mostly compares one number, seldom strings.
DEDUP_KEYS = ("event_time", "turbine_id", "farm_id", "sim_run_id")
THREE_COLUMN_KEYS = ("event_time", "turbine_id", "farm_id")

#: Of the filter of repeated keys: 8 MB as words and their places.
FILTER_BITS = 1 << 25


def _arrival(df: DataFrame, groups: Sequence, keys: Sequence[str]) -> WindowSpec:
    """Earliest ``ingest_time``, then ``source``; the other columns make the order total."""
    lead = ["ingest_time", "source"]
    rest = [n for n in TELEMETRY.names if n not in (*lead, *keys)]
    order = [F.col(n).asc_nulls_first() for n in lead + rest if n in df.columns]
    return Window.partitionBy(*groups).orderBy(*order)


def keep_first(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """One row per key. NULL key parts compare equal.

    ``rank = 1`` lets Spark keep one row per key and input task before the shuffle, so a key with
    any number of copies reaches its reducer as at most one row per task.
    """
    window = _arrival(df, keys, keys)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def _repeated(df: DataFrame, keys: Sequence[str], filter_bits: int) -> DataFrame:
    """Words of 64 bits of a filter in which each repeated key sets the bit of its hash.

    Only hashes are counted and shuffled, a hot one as one row per task. There are at most
    ``filter_bits / 64`` words, whatever the table.
    """
    counted = df.select(F.xxhash64(*keys).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    place = F.pmod(F.col("_hash"), F.lit(filter_bits))
    bit = F.expr("shiftleft(1L, CAST(_place % 64 AS INT))")
    places = counted.filter("_n > 1").select(place.alias("_place"))
    return places.groupBy(F.expr("_place div 64").alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def flag_duplicates(
    df: DataFrame, keys: Sequence[str] = DEDUP_KEYS, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """All rows, with ``is_duplicate`` true on every row of a key but the first.

    A filter of the repeated keys, of a bounded size, goes to all tasks. Rows it does not hold are
    first of their key and stay where they are; the others, the repeated ones and a few that
    share a bit with them, are ranked. The more repeated keys there are for ``filter_bits``, the more
    rows are ranked; the result is the same.

    A hot key cannot shrink before the shuffle, as no row is dropped. It is split by input task
    instead: each task's share is ranked on its own, then only the leaders meet under the bare
    key, while the rest stay with their share.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(filter_bits))
    looked = df.withColumn("_place", place).withColumn("_word", F.expr("_place div 64"))
    # At most filter_bits / 64 words of 16 bytes.
    marked = looked.join(F.broadcast(_repeated(df, keys, filter_bits)), "_word", "left")
    held = F.expr("coalesce(shiftright(_bits, CAST(_place % 64 AS INT)) & 1L, 0L) = 1")
    suspects = marked.filter(held).select(*df.columns)
    single = marked.filter(~held).select(*df.columns, F.lit(False).alias("is_duplicate"))
    return single.unionByName(_ranked(suspects, keys))


def _ranked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    share = F.col("_share")
    by_share = _arrival(df, [*keys, share], keys)
    arena = F.when(F.col("_in_share") == 1, F.lit(-1)).otherwise(share)
    by_key = _arrival(df, [*keys, F.col("_arena")], keys)
    return (
        df.withColumn("_share", F.spark_partition_id())
        .withColumn("_in_share", F.row_number().over(by_share))
        .withColumn("_arena", arena)
        .withColumn("_in_arena", F.row_number().over(by_key))
        .withColumn("is_duplicate", (F.col("_in_share") > 1) | (F.col("_in_arena") > 1))
        .drop("_share", "_in_share", "_arena", "_in_arena")
    )
