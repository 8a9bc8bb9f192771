"""The open hours of one run, fixed before any work starts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustmill.operators.increments import HOUR, hours_present

# Above these bounds a list of literals gives way to a range, a broadcast to a shuffled join.
MAX_LITERALS = 5000
MAX_BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Increment:
    """``hours`` are the ``n_hours`` open ones among the ``n_present`` hours of a layer."""

    hours: DataFrame
    n_hours: int
    n_present: int

    def restrict(self, layer: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows of ``layer`` whose ``keys``, all partition columns, belong to an open hour.

        An anti-join against the ledger prunes no folder, and neither does a semi-join against its
        result. So the open dates and runs go in as literals first, each by a list of its own or,
        if that would be too long, by its range.
        """
        rows = layer
        for name in ("date", "sim_run_id"):
            values = self.hours.select(name).distinct()
            listed = sorted(r[0] for r in values.limit(MAX_LITERALS + 1).collect())
            if len(listed) <= MAX_LITERALS:
                rows = rows.filter(F.col(name).isin(listed))
            else:
                low, high = values.agg(F.min(name), F.max(name)).first()
                rows = rows.filter(F.col(name).between(low, high))
        if self.n_hours == self.n_present:
            return rows.dropna(subset=list(keys))
        wanted = self.hours.select(*keys).distinct()
        if self.n_hours <= MAX_BROADCAST_ROWS:
            wanted = F.broadcast(wanted)
        return rows.join(wanted, list(keys), "left_semi")


def open_increment(
    layer: DataFrame, closed: DataFrame, ready: DataFrame | None = None
) -> Increment:
    """Hours ``layer`` has and ``closed`` lacks; with ``ready``, only those among them.

    Checkpointed, so the filter, the join and the ledger entries of one run name the same hours
    whatever executors are lost or files arrive meanwhile.
    """
    marks = closed.select(*HOUR).withColumn("_closed", F.lit(True))
    present = hours_present(layer)
    if ready is not None:
        present = present.join(ready.select(*HOUR), list(HOUR), "left_semi")
    hours = present.join(marks, list(HOUR), "left").checkpoint()
    is_open = F.col("_closed").isNull()
    counts = hours.agg(F.count_if(is_open).alias("open"), F.count(F.lit(1)).alias("all")).first()
    return Increment(hours.filter(is_open).drop("_closed"), counts["open"], counts["all"])
