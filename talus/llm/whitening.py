"""Whitening of embeddings by a one-sided Jacobi SVD over a blockwise QR.

The fit list is each distinct vector once. Tasks compress the centred rows they
read to a triangle each (QR of blocks, the triangle so far on top), and further
rounds of tasks compress the triangles, a few at a time, to one, ``R``, whose
Gram matrix is that of all rows though no row was multiplied by another. Plane
rotations make the columns of ``R`` orthogonal; the same rotations, accumulated,
are the components, and the columns' lengths their standard deviations.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, to_workers
from .vectors import SCALE, exact, largest, matrix, usable, whole

#: Triangles that one task folds into one.
FAN_IN = 8
#: Rounds of rotations after which the columns must be orthogonal; some ten are usual.
SWEEPS = 60
#: Exact sums leave tasks as decimals of so many digits.
_EXACT = "decimal(38,0)"


def _decimals(values: np.ndarray) -> pa.Array:
    """Whole numbers as decimals; null for one of more than 38 digits."""
    if values.dtype != object:
        return pa.array(values, pa.int64()).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(v) if abs(v) < 10**38 else None for v in map(int, values)], pa.decimal128(38, 0))


@dataclass
class FitList:
    """How many distinct vectors there are, and their sum in each dimension."""

    n: int
    sums: list[int]
    tasks: int

    def apart(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact."""
        most = self.n * largest(x) + max(map(abs, self.sums), default=0)
        return exact(x, most) * self.n - np.array(self.sums, dtype=np.int64 if most < 1 << 62 else object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.apart(x) / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """``sum((n * x - sums) ** 2)`` of each row, exact."""
        apart = self.apart(x)
        return (exact(apart, largest(apart) ** 2 * max(1, x.shape[1])) ** 2).sum(axis=1)


def fit_list(vectors: DataFrame, size: int) -> FitList:
    """Exact sums over the one column ``x`` of ``vectors``, added up in tasks and by dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, dtype=object)
        for batch in batches:
            x = matrix(batch.column("x"), size)
            n += len(x)
            sums += exact(x, largest(x) * len(x)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, size), pa.int32()), _decimals(np.array([n, *sums], dtype=object))], names=["at", "total"]
            )

    parts = to_workers(vectors).mapInArrow(add, f"at int, total {_EXACT}")
    rows = {r["at"]: r for r in parts.groupBy("at").agg(F.sum("total").alias("total"), F.count("*").alias("tasks")).collect()}
    if not rows:
        return FitList(0, [0] * size, 0)
    return FitList(int(rows[-1]["total"]), [int(rows[d]["total"]) for d in range(size)], rows[-1]["tasks"])


def triangle(vectors: DataFrame, fitted: FitList, size: int) -> np.ndarray:
    """``R`` of the centred rows: ``size`` numbers squared, however many the rows."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, size))
        for batch in batches:
            r = np.linalg.qr(np.vstack([r, fitted.centred(matrix(batch.column("x"), size))]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": pa.array([r.tobytes()], pa.binary())})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, size))
        for batch in batches:
            for part in batch.column("r"):
                r = np.linalg.qr(np.vstack([r, np.frombuffer(part.as_py()).reshape(-1, size)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": pa.array([r.tobytes()], pa.binary())})

    parts = to_workers(vectors).mapInArrow(compress, "r binary")
    left = fitted.tasks
    while left > 1:
        left = math.ceil(left / FAN_IN)
        parts = parts.repartition(left).mapInArrow(fold, "r binary")
    r = np.zeros((0, size))
    for row in parts.collect():  # one, or a few where the table was cut anew between the two reads
        r = np.linalg.qr(np.vstack([r, np.frombuffer(row["r"]).reshape(-1, size)]), mode="r")
    return r


def jacobi(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the orthogonal columns that rotations make of ``r``, falling, and the rotations' product.

    ``r @ v`` has these columns. Each round turns all pairs of columns, in
    disjoint pairs at a time; ValueError if ``SWEEPS`` rounds don't do.
    """
    size = r.shape[1]
    even = size + size % 2
    a = np.zeros((max(1, len(r)), even))
    a[: len(r), :size] = r
    v = np.eye(even)
    ring = np.arange(even)
    tolerance = max(1, size) * np.finfo(float).eps
    # What is left of a column that others explain is rounding, and has no direction to turn.
    nothing = (np.linalg.norm(a) * np.finfo(float).eps) ** 2
    for _ in range(SWEEPS):
        turned = False
        for _ in range(even - 1):
            i, j = ring[: even // 2], ring[even // 2 :][::-1]
            left, right = a[:, i], a[:, j]
            p, q, both = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
            act = (np.abs(both) > tolerance * np.sqrt(p * q)) & (np.minimum(p, q) > nothing)
            if act.any():
                turned = True
                i, j = i[act], j[act]
                zeta = (q[act] - p[act]) / (2 * both[act])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                c = 1 / np.hypot(1, t)
                s = c * t
                for m in (a, v):
                    m[:, i], m[:, j] = c * m[:, i] - s * m[:, j], s * m[:, i] + c * m[:, j]
            ring = np.concatenate([ring[:1], np.roll(ring[1:], 1)])
        if not turned:
            break
    else:
        if size > 1:
            raise ValueError(f"columns are not orthogonal after {SWEEPS} rounds")
    a, v = a[:, :size], v[:size, :size]
    lengths = np.sqrt((a * a).sum(0))
    order = np.argsort(-lengths, kind="stable")
    v = v[:, order]
    # Either sign would do: each component's largest entry is positive, in every run.
    v *= np.where(v[np.abs(v).argmax(0), range(size)] < 0, -1.0, 1.0) if size else 1.0
    return lengths[order], v


@dataclass
class Whitener:
    """The first components with their variances, falling; a variance of 0 is exact and its component has no scale."""

    fitted: FitList
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole-number rows; NaN for components without variance."""
        scale = np.where(self.variances > 0, 1 / np.sqrt(np.where(self.variances > 0, self.variances, 1)), np.nan)
        return self.fitted.centred(x) @ self.components * scale


def _identity_error(vectors: DataFrame, model: Whitener, size: int) -> float:
    """The largest entry of whitened rows' measured covariance minus the identity."""
    use = model.variances > 0
    k = int(use.sum())
    if not k:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = model(matrix(batch.column("x"), size))[:, use]
            total += np.vstack([z.sum(0), z.T @ z])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "total"])

    sums = to_workers(vectors).mapInArrow(add, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).orderBy("at")
    total = np.array([r["total"] for r in sums.collect()]).reshape(k + 1, k) / model.fitted.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def fit(vectors: DataFrame, size: int, components: int = 4) -> Whitener:
    """Components of the distinct rows of the one column ``x``, all of ``size`` entries, and the error they leave.

    The driver holds one triangle (``size`` squared) and ``size`` sums. Fewer
    dimensions than ``components`` give as many components as dimensions. A
    variance below the rounding of the largest (repeated or dependent
    dimensions, a single vector) counts as 0. Equal variances share a plane,
    of which some axes are taken.
    """
    distinct = materialise(vectors.distinct(), "fit-list")
    fitted = fit_list(distinct, size)
    lengths, v = jacobi(triangle(distinct, fitted, size))
    n = max(1, fitted.n)
    variances = lengths**2 / n
    top = lengths.max(initial=0.0)
    variances[lengths <= top * max(1, size) * np.finfo(float).eps] = 0.0
    whole_trace = variances.sum()
    k = min(components, size)
    explained = variances[:k] / whole_trace if whole_trace > 0 else np.zeros(k)
    model = Whitener(fitted, v[:, :k], variances[:k], explained)
    model.identity_error = _identity_error(distinct, model, size)
    return model


def whole_rows(df: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, int]:
    """``id, x`` of the rows with a usable vector, and the length of ``x``: that of the longest vector."""
    rows = df.where(usable(F.col(vector))).select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"))
    size = rows.agg(F.max(F.size("v")).alias("size")).first()["size"] or 0
    return rows.select("id", whole(F.col("v"), size, SCALE).alias("x")), size


OUTPUT = f"vec_id long, component int, n long, deviation {_EXACT}, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """A row for each row with a usable vector and each of the first ``components``, from 1 by falling variance.

    Entries become ``floor(256 * entry)``. The fit list is each distinct vector
    once: ``n`` vectors. ``deviation`` is exact (null beyond 38 digits),
    ``whitened`` is the centred vector's coordinate over the standard deviation,
    null where that is 0, ``explained`` the component's part of all variance (0
    if there is none), ``identity_error`` what the fit list's whitened
    covariance misses the identity by.

    Null vectors and those with a null or non-finite entry give no row. Shorter
    vectors are as if followed by zeros, empty ones too; if all are empty, or
    there is none, the result is empty. Null ids and repeated rows each give
    rows of their own; other columns are not read.
    """
    rows, size = whole_rows(df, id_col, vector)
    if not size:
        return df.sparkSession.createDataFrame([], OUTPUT)
    model = fit(rows.select("x"), size, components)
    shared = df.sparkSession.sparkContext.broadcast(model)
    k = len(model.variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            x = matrix(batch.column("x"), size)
            each = np.repeat(np.arange(len(x)), k)
            z = model(x).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.fitted.n)),
                    _decimals(model.fitted.deviation(x)).take(pa.array(each)),
                    pa.array(z, mask=np.isnan(z)),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(each), model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return to_workers(rows).mapInArrow(project, OUTPUT)
