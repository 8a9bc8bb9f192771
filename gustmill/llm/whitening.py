"""Whitening of embeddings by eigenvectors found in float32 and corrected to double precision.

The vectors become integers (``scaled``); each distinct one counts once. Their covariance is
summed by tasks, from centred vectors. ``eigenvectors`` decomposes it in float32 and corrects the
result by the iteration of Ogita and Aishima, which takes matrix products only: of the current
matrix X, with R = I - X'X and S = X'VX, the next one is X + XE, where E holds
(s_ij + l_j r_ij) / (l_j - l_i) for separated and r_ij / 2 for too close eigenvalues l. The
products are summed in a wider float type than the result's. Eigenvalues that the current
accuracy cannot separate form clusters: their subspace is corrected as a whole, and a sub-solve
of the covariance within it, shifted by the cluster's mean so that the differences keep their
digits, turns its basis to the eigenvectors.

Vectors that are null, hold a null or non-finite entry, or have another length than most
distinct ones (of equally frequent lengths, the longer), or none, are dropped. A repeated vector weighs as much as a single
one but gets a result for each row. Components without variance have a null ``whitened``, as
there is nothing to divide by; then ``explained`` is 0, or null where no component has any, and
``identity_error`` looks at the others (null without any). ``deviation`` is null where it does
not fit a long. An empty table gives an empty result; ids may be null or repeat; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustmill.llm.tables import scratch_folder

SCALE = 256
COMPONENTS = 4
MOST_STEPS = 12
#: Vectors multiplied at a time within a task.
ROWS_AT_ONCE = 4096

OUTPUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def scaled(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, x``: the valid vectors, with entries ``floor(256 * c)``."""
    entries = F.col(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(entries, lambda c: F.floor(c * F.lit(float(SCALE))))
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector)
    return rows.filter(entries.isNotNull() & finite).select("vec_id", x.alias("x"))


def eigenvectors(covariance: np.ndarray, wide: type = np.longdouble) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and their unit eigenvectors (columns) of a symmetric matrix.

    ``wide`` is the float type of the corrections.
    """
    size = len(covariance)
    scale = float(np.abs(covariance).max(initial=0.0))
    if scale == 0:
        return np.zeros(size), np.eye(size)
    a = (covariance / scale).astype(wide)
    a = (a + a.T) / 2
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(wide)
    goal = float(np.finfo(np.float64).eps)
    one = np.eye(size, dtype=wide)
    values = np.zeros(size, dtype=wide)
    for _ in range(MOST_STEPS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        off = s - np.diag(np.diag(s))
        near = 2 * (np.linalg.norm(off.astype(float), 2) + np.linalg.norm(a.astype(float), 2) * np.linalg.norm(r.astype(float), 2))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > near
        # Chains of close eigenvalues: the iteration treats all pairs within one alike.
        chain = np.concatenate(([0], np.cumsum(np.abs(np.diff(values)) > near)))
        apart &= chain[:, None] != chain[None, :]
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gaps, 1), r / 2)
        x = x + x @ e
        clusters = [np.flatnonzero(chain == c) for c in np.unique(chain)]
        for own in (c for c in clusters if len(c) > 1):
            x[:, own] = _turned(a, x[:, own], values[own])
        if np.abs(e).max() <= goal and all(len(c) == 1 or near <= 8 * goal * size for c in clusters):
            break
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order].astype(np.float64)
    largest = x[np.abs(x).argmax(axis=0), np.arange(size)]
    return (values[order] * scale).astype(np.float64), x * np.where(largest < 0, -1.0, 1.0)


def _turned(a: np.ndarray, basis: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``basis`` of a cluster's subspace, turned to the eigenvectors within it."""
    gram = basis.T @ basis
    basis = basis @ (1.5 * np.eye(len(gram), dtype=a.dtype) - gram / 2)  # orthonormal again
    within = basis.T @ (a @ basis - basis * values.mean())
    within = (within + within.T) / 2
    size = float(np.abs(within).max())
    if size == 0:
        return basis
    turn = np.linalg.eigh((within / size).astype(np.float64))[1][:, ::-1].astype(a.dtype)
    return basis @ turn


@dataclass(frozen=True)
class Whitening:
    """Statistics of the fit list and its leading components."""

    n: int
    sums: list[int]  # exact, per dimension
    values: np.ndarray
    components: np.ndarray  # columns
    trace: float

    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def positive(self) -> np.ndarray:
        """Components with a variance beyond what rounding leaves of none."""
        return self.values > len(self.sums) * np.finfo(np.float64).eps * self.trace

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """A column for each component; NaN for those without variance."""
        spread = np.sqrt(np.where(self.positive(), self.values, np.nan))
        return (x - self.means()) @ self.components / spread

    def explained(self) -> list[float | None]:
        shares = np.where(self.positive(), self.values, 0.0) / (self.trace or 1.0)
        return [float(v) if self.trace else None for v in shares]

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n * x - sums) ** 2``."""
        rough = self.n * x.astype(float) - np.array(self.sums, dtype=float)
        if self.n * np.abs(x.astype(float)).max(initial=0.0) < 2.0**62 and (rough * rough).sum(axis=1).max(initial=0.0) < 2.0**62:
            gaps = self.n * x - np.array(self.sums, dtype=np.int64)
            return (gaps * gaps).sum(axis=1).tolist()
        found = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [d if d < 1 << 63 else None for d in found]


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a column of equally long lists."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def _sums(vectors: DataFrame) -> list[int]:
    """Exact sum of every dimension. A task sends one row for each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list[int] = []
        for batch in batches:
            x = _matrix(batch.column(0))
            for low in range(0, len(x), ROWS_AT_ONCE):
                rows = x[low : low + ROWS_AT_ONCE]
                small = np.abs(rows.astype(float)).max() < 2.0**50
                own = (rows if small else rows.astype(object)).sum(axis=0).tolist()
                totals = [a + b for a, b in zip(totals or [0] * len(own), own, strict=True)]
        if totals:
            exact = pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))
            yield pa.record_batch([pa.array(np.arange(len(totals), dtype=np.int32)), exact], ["at", "s"])

    summed = vectors.select("x").mapInArrow(work, "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").alias("s"))
    return [int(s) for _, s in sorted(map(tuple, summed.collect()))]  # a row for each dimension


def _cross_products(vectors: DataFrame, rows_of, size: int) -> np.ndarray:
    """Sum of the outer products of the rows ``rows_of(x)``, ``size`` columns, of all vectors.

    Each task multiplies its own rows and sends one matrix; Spark adds these up entry by entry.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, upper = np.zeros((size, size)), np.triu_indices(size)
        for batch in batches:
            x = _matrix(batch.column(0))
            for low in range(0, len(x), ROWS_AT_ONCE):
                rows = rows_of(x[low : low + ROWS_AT_ONCE])
                total += rows.T @ rows
        if total.any():
            i, j = (pa.array(u.astype(np.int32)) for u in upper)
            yield pa.record_batch([i, j, pa.array(total[upper])], ["i", "j", "v"])

    summed = vectors.select("x").mapInArrow(work, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = np.zeros((size, size))
    for i, j, v in summed.collect():  # size * size entries at most
        found[i, j] = found[j, i] = v
    return found


def fit_list(x: DataFrame) -> tuple[DataFrame, int, int]:
    """Each distinct vector of the most frequent length once, with that length and their number.

    Written once to the folder that executors share, as several passes read it.
    """
    spark = x.sparkSession
    place = f"{scratch_folder(spark)}/vectors-{uuid.uuid4().hex}"
    x.select("x").distinct().write.parquet(place)
    distinct = spark.read.schema("x array<bigint>").parquet(place)
    lengths = distinct.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    # A row for each length; the longer of equally frequent ones.
    n, length = max(((r["n"], r["length"]) for r in lengths.collect() if r["length"] > 0), default=(0, 0))
    return distinct.filter(F.size("x") == length), length, n


def fitted(distinct: DataFrame, length: int, n: int, components: int = COMPONENTS) -> Whitening:
    sums = _sums(distinct)
    means = np.array([s / n for s in sums])
    covariance = _cross_products(distinct, lambda x: x - means, length) / n
    values, vectors = eigenvectors(covariance)
    return Whitening(n, sums, values[:components], vectors[:, :components], float(np.trace(covariance)))


def identity_error(model: Whitening, distinct: DataFrame) -> float | None:
    """Largest entry by which the covariance of the whitened fit list departs from the identity."""
    own = np.flatnonzero(model.positive())
    if not len(own):
        return None
    covariance = _cross_products(distinct, lambda x: model.whitened(x)[:, own], len(own)) / model.n
    return float(np.abs(covariance - np.eye(len(own))).max())


def whitened_rows(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each valid vector and leading component."""
    x = scaled(df, vector)
    distinct, length, n = fit_list(x)
    if not n:
        return df.sparkSession.createDataFrame([], OUTPUT)
    model = fitted(distinct, length, n, components)
    error, explained = identity_error(model, distinct), model.explained()
    kept = len(explained)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1))
            count = len(rows)
            results = model.whitened(rows) if count else np.zeros((0, kept))
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(count), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * kept, n, dtype=np.int64)),
                    pa.array(model.deviations(rows), pa.int64()).take(pa.array(np.repeat(np.arange(count), kept))),
                    pa.array(results.ravel(), pa.float64(), from_pandas=True),  # NaN: null
                    pa.array(explained * count, pa.float64()),
                    pa.array([error] * (count * kept), pa.float64()),
                ],
                [field.split()[0] for field in OUTPUT.split(", ")],
            )

    return x.filter(F.size("x") == length).mapInArrow(work, OUTPUT)
