"""Power curve, rotor speed and wake as columns."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustmill.functions.quality import measure

# Thresholds in m/s and the rotor line in rpm.
CUT_IN_MPS = 3.0
RATED_MPS = 12.0
CUT_OUT_MPS = 25.0
ROTOR_BASE_RPM = 6.0
ROTOR_RISE_RPM = 12.0
ROTOR_START_MPS = 3.0
ROTOR_SPAN_MPS = 9.0
ROTOR_TOP_MPS = 12.0


class PowerCurve(NamedTuple):
    cut_in_mps: float = CUT_IN_MPS
    rated_mps: float = RATED_MPS
    cut_out_mps: float = CUT_OUT_MPS


def turbine_status(speed: Column, curve: PowerCurve = PowerCurve()) -> Column:
    """RUNNING, STOPPED or CUT_OUT; NULL where the speed is missing."""
    v = measure(speed)
    return (
        F.when(v >= curve.cut_out_mps, "CUT_OUT")
        .when(v < curve.cut_in_mps, "STOPPED")
        .when(v.isNotNull(), "RUNNING")
    )


def curve_power_kw(speed: Column, rated_kw: Column, curve: PowerCurve = PowerCurve()) -> Column:
    """Zero below cut-in and from cut-out on, cubic up to rated speed, then rated power."""
    v = measure(speed)
    share = (v - curve.cut_in_mps) / (curve.rated_mps - curve.cut_in_mps)
    return (
        F.when((v < curve.cut_in_mps) | (v >= curve.cut_out_mps), 0.0)
        .when(v < curve.rated_mps, rated_kw * share * share * share)
        .when(v.isNotNull(), rated_kw)
    )


def rotor_rpm(speed: Column, status: Column) -> Column:
    above = F.least(measure(speed), F.lit(ROTOR_TOP_MPS)) - ROTOR_START_MPS
    return F.when(
        status == "RUNNING", ROTOR_BASE_RPM + above * (ROTOR_RISE_RPM / ROTOR_SPAN_MPS)
    ).when(status.isNotNull(), 0.0)


def wake_factor(
    x: str,
    y: str,
    wind_x: str,
    wind_y: str,
    source_x: str,
    source_y: str,
    strength: str,
    per_decay: str,
    per_width: str,
) -> Column:
    """Share of the free wind left at ``(x, y)`` behind the turbines of two coordinate lists.

    ``per_decay`` is ``1 / L`` and ``per_width`` is ``1 / (2 sigma^2)``. NULL if any input is.
    """
    share = _share_left()

    def factors(
        x: pa.Array,
        y: pa.Array,
        ux: pa.Array,
        uy: pa.Array,
        strength: pa.Array,
        per_decay: pa.Array,
        per_width: pa.Array,
        source_x: pa.Array,
        source_y: pa.Array,
    ) -> pa.Array:
        counts = source_x.value_lengths().fill_null(0).to_numpy(False).astype(np.int64)
        sources = (source_x.flatten().to_numpy(False), source_y.flatten().to_numpy(False))
        unknown = source_x.is_null().to_numpy(False) | source_y.is_null().to_numpy(False)
        numbers = [x, y, ux, uy, strength, per_decay, per_width]
        return share(numbers, unknown, np.cumsum(counts) - counts, counts, *sources)

    columns = (x, y, wind_x, wind_y, strength, per_decay, per_width, source_x, source_y)
    return F.arrow_udf(factors, T.DoubleType())(*columns)


class FarmPlaces(NamedTuple):
    """Coordinates of all farms one after the other; ``index`` says which farm is which.

    ``starts`` and ``counts`` end with an entry for farms that are not known.
    """

    index: dict[str, int]
    starts: np.ndarray
    counts: np.ndarray
    x: np.ndarray
    y: np.ndarray


def farm_places(turbines: pa.Table) -> FarmPlaces:
    """Of rows ``farm_id, x_m, y_m`` sorted by farm."""
    names = turbines["farm_id"].to_numpy()
    farms, starts, counts = np.unique(names, return_index=True, return_counts=True)
    places = (turbines["x_m"].to_numpy(), turbines["y_m"].to_numpy())
    index = {name: i for i, name in enumerate(farms.tolist())}
    return FarmPlaces(index, np.append(starts, 0), np.append(counts, 0), *places)


def farm_wake_factor(
    places: Broadcast,
    farm_id: str,
    x: str,
    y: str,
    wind_x: str,
    wind_y: str,
    strength: str,
    per_decay: str,
    per_width: str,
) -> Column:
    """``wake_factor`` where every executor has the ``FarmPlaces``, so that rows carry no list.

    NULL where the farm is not among them.
    """
    share = _share_left()

    def factors(
        farm: pa.Array,
        x: pa.Array,
        y: pa.Array,
        ux: pa.Array,
        uy: pa.Array,
        strength: pa.Array,
        per_decay: pa.Array,
        per_width: pa.Array,
    ) -> pa.Array:
        index, starts, counts, *sources = places.value
        coded = farm.dictionary_encode()
        known = np.array([index.get(n, -1) for n in coded.dictionary.to_pylist()] + [-1])
        at = known[coded.indices.fill_null(len(known) - 1).to_numpy(False)]
        numbers = [x, y, ux, uy, strength, per_decay, per_width]
        return share(numbers, at < 0, starts[at], counts[at], *sources)

    columns = (farm_id, x, y, wind_x, wind_y, strength, per_decay, per_width)
    return F.arrow_udf(factors, T.DoubleType())(*columns)


def _share_left(pairs_at_once: int = 2_000_000):
    """The function for a batch; local, so that workers need no copy of this package.

    Row i meets the sources from ``starts[i]`` on, ``counts[i]`` of them. The work is sliced by
    pairs of row and source, so memory is bounded whatever the size of a farm.
    """

    def share(numbers, unknown, starts, counts, source_x, source_y):
        unknown = np.any([unknown, *[c.is_null().to_numpy(False) for c in numbers]], 0)
        x, y, ux, uy, strength, per_decay, per_width = (c.to_numpy(False) for c in numbers)
        factor, ends = np.ones(len(x)), np.cumsum(counts)
        low = 0
        while low < len(x):
            full = ends[low] - counts[low] + pairs_at_once
            high = max(low + 1, int(np.searchsorted(ends, full, "right")))
            n = counts[low:high]
            row = np.repeat(np.arange(low, high), n)
            source = np.arange(len(row)) + np.repeat(starts[low:high] - (np.cumsum(n) - n), n)
            dx, dy = x[row] - source_x[source], y[row] - source_y[source]
            downwind = dx * ux[row] + dy * uy[row]
            # Only turbines strictly upwind count. A turbine is at distance 0 from itself.
            upwind = np.flatnonzero(downwind > 0)
            row, dx, dy, downwind = row[upwind], dx[upwind], dy[upwind], downwind[upwind]
            crosswind = dy * ux[row] - dx * uy[row]
            fade = crosswind * crosswind * per_width[row] + downwind * per_decay[row]
            left = 1.0 - strength[row] * np.exp(-fade)
            heads = np.flatnonzero(np.diff(row, prepend=-1))
            if len(heads):
                factor[row[heads]] = np.multiply.reduceat(left, heads)
            low = high
        return pa.array(factor, mask=unknown)

    return share
