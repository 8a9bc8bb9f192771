"""Broadcast only what has been measured."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def row_bytes() -> Column:
    """Text size of a row, as a stand-in for its size in memory."""
    return F.octet_length(F.to_json(F.struct("*")))


def table_bytes(table: DataFrame) -> int:
    """Size of ``table``, measured with one distributed aggregate."""
    return table.agg(F.sum(row_bytes()).alias("n")).first()["n"] or 0


def fits(n_bytes: int) -> bool:
    return n_bytes <= MAX_BROADCAST_BYTES


def join_side(n_bytes: int) -> Callable[[DataFrame], DataFrame]:
    """How to join projections of a table measured at ``n_bytes``.

    Below the bound they are hinted for broadcast. Beyond it they are left as they are, and the
    join shuffles, with AQE splitting its hot keys.
    """
    return F.broadcast if fits(n_bytes) else lambda df: df


def measured_side(table: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """``join_side`` of ``table``."""
    return join_side(table_bytes(table))
