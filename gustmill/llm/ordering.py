"""Rows in one global order, with each partition also holding its neighbours' edge rows.

An order over all rows needs no task that sees them all. Bounds of a string key split the rows
into many parts; a part's first row is also sent to the part before it, its last one to the part
after it, marked as edges. Streaming through the sorted parts, each row meets the one before and
after it.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys drawn for each bound. They only set where parts end, never what is in the result.
DRAWN = 20
PARTS_PER_PARTITION = 6

FIRST, OWN, LAST = 0, 1, 2  # order of edges around a part's own rows


def bounds_of(keys: DataFrame, parts: int) -> list[str]:
    """About ``parts`` - 1 values of ``key`` that split its distinct values evenly."""
    distinct = keys.select("key").distinct()
    every = max(1, keys.count() // (DRAWN * parts))
    drawn = distinct.filter(F.pmod(F.xxhash64("key"), F.lit(every)) == 0)
    found = sorted(r[0].encode() for r in drawn.collect())
    step = max(1, len(found) // parts)
    return found[step::step]


def in_order(df: DataFrame, wrap: bool, shaped: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` (with a string ``key``, not null) dealt into sorted parts.

    Adds ``part`` and ``edge``: OWN for a row, FIRST and LAST for copies of the neighbours'
    rows. With ``wrap`` the first row of all also follows the last. Equal keys share a part.
    ``df`` is read several times for its keys; ``shaped`` is applied once, to the rows that move.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select("key")
    shared = spark.sparkContext.broadcast(bounds_of(keys, partitions * PARTS_PER_PARTITION))

    @F.pandas_udf("int")
    def part(key: pd.Series) -> pd.Series:
        return key.map(lambda k: bisect.bisect_right(shared.value, k.encode()))

    ends = keys.withColumn("part", part("key")).groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    ends = sorted(ends.collect())  # a row for each part
    copies: dict[str, list[tuple[int, int]]] = {}
    for one, two in zip(ends, ends[1:], strict=False):
        copies.setdefault(two["low"], []).append((one["part"], LAST))
        copies.setdefault(one["high"], []).append((two["part"], FIRST))
    if wrap and ends:
        copies.setdefault(ends[0]["low"], []).append((ends[-1]["part"], LAST))
    sent = spark.sparkContext.broadcast(copies)

    @F.pandas_udf("array<struct<part:int,edge:int>>")
    def places(key: pd.Series) -> pd.Series:
        def of(k: str) -> list[dict]:
            own = bisect.bisect_right(shared.value, k.encode())
            return [{"part": p, "edge": e} for p, e in [(own, OWN), *sent.value.get(k, ())]]

        return key.map(of)

    dealt = df.withColumn("place", F.explode(places("key"))).select(*df.columns, "place.part", "place.edge")
    dealt = shaped(dealt) if shaped else dealt
    rest = [c for c in dealt.columns if c not in ("part", "edge", "key")]
    return dealt.repartition(partitions, "part").sortWithinPartitions("part", "edge", "key", *rest)
