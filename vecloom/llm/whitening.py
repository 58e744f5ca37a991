"""Operator 12: whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers x = floor(256 * c), so that equal vectors are equal and sums are exact. The
fit list is each distinct x once. Spark sums it to n and S, then sums the scatter of x - S/n,
centred before multiplying. That matrix has the width of a vector, whatever the number of rows; it
alone goes to the driver. There it is factored as P'LL'P by Cholesky with the largest pivot
first, and the columns of L are rotated in pairs until they are orthogonal (one-sided Jacobi):
their squared norms are the eigenvalues, the columns at length 1 the components.

How it scales: copies of a vector are dropped in the task before the shuffle that makes the fit list,
which is written once and then only scanned. Each task sums its part of the scatter to one matrix,
and Spark adds the entries of those by (row, column): no task takes the matrices of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.session import materialize, ship_package

UNIT = 256
ROWS = 4096
LONG = float(1 << 63)


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: components are the columns of `axes`, by falling eigenvalue."""

    width: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        return (x.astype(np.float64) - self.mean) @ (self.axes[:, :k] / np.sqrt(self.values[:k]))

    def deviation(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum over dimensions of (n*x - S)^2, whether that is more than a long can hold)."""
        wrap = lambda value: np.uint64(value & ((1 << 64) - 1))
        # Exact modulo 2^64, hence exact where the sum is below 2^63.
        off = x.astype(np.int64).view(np.uint64) * wrap(self.n) - np.array([wrap(s) for s in self.sums], np.uint64)
        about = ((self.n * (x.astype(np.float64) - self.mean)) ** 2).sum(axis=1)
        return (off * off).sum(axis=1, dtype=np.uint64).view(np.int64), about >= LONG * (1 - 1e-9)


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with a[order][:, order] = L L'; as many columns as pivots above rounding."""
    a, d = a.astype(np.float64).copy(), len(a)
    order, low = np.arange(d), np.zeros((d, d))
    floor = d * np.finfo(np.float64).eps * max(float(np.trace(a)), 0.0)
    for k in range(d):
        rest = np.diag(a)[k:]
        at = k + int(np.argmax(rest))
        if not a[at, at] > floor:
            return low[:, :k], order
        swap = [k, at]
        a[swap] = a[swap[::-1]]
        a[:, swap] = a[:, swap[::-1]]
        low[swap] = low[swap[::-1]]
        order[swap] = order[swap[::-1]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1 :, k] = a[k + 1 :, k] / low[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return low, order


def one_sided_jacobi(w: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Columns of `w` rotated in pairs until they are orthogonal to rounding.

    In each round the columns are paired so that no two pairs share one; as many rounds as needed
    for every pair to meet are a sweep.
    """
    w = w.copy()
    count = w.shape[1]
    seats = list(range(count + count % 2))
    tiny = np.finfo(np.float64).eps * 4
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(p, q) for p, q in zip(seats[:half], seats[half:][::-1], strict=True) if max(p, q) < count]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            p, q = np.array(pairs).T
            left, right = w[:, p], w[:, q]
            a, b, c = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
            scale = np.sqrt(a * b)
            off = np.divide(np.abs(c), scale, out=np.zeros_like(c), where=scale > 0)
            worst = max(worst, float(off.max()))
            turn = off > tiny
            z = np.divide(b - a, 2 * c, out=np.zeros_like(c), where=turn)
            t = np.where(turn, np.where(z < 0, -1.0, 1.0) / (np.abs(z) + np.hypot(1, z)), 0.0)
            cos = 1 / np.hypot(1, t)
            sin = cos * t
            w[:, p], w[:, q] = cos * left - sin * right, sin * left + cos * right
        if worst <= tiny:
            break
    return w


def principal_axes(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues of the scatter, falling; unit eigenvectors as columns), those of rounding left out."""
    low, order = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(low)
    norms = np.sqrt((turned * turned).sum(axis=0))
    by = np.argsort(-norms, kind="stable")
    by = by[norms[by] > 0]
    axes = np.zeros((len(scatter), len(by)))
    axes[order] = turned[:, by] / norms[by]
    return norms[by] ** 2, axes


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * UNIT))


def _finite(vector: Column) -> Column:
    double = lambda c: c.cast("double")
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(double(c)) & (F.abs(double(c)) < float("inf")))
    return F.coalesce(good, F.lit(False))


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, x) of the rows that take part, of whatever width."""
    kept = vectors.where(_finite(F.col(vector)) & (F.size(vector) > 0))
    return kept.select(F.col(id_col).alias("id"), whole_numbers(F.col(vector)).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums of each dimension, as Python's whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch["x"], width)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(high), pa.array(low)],
            names=["pos", "n", "high", "low"],
        )

    parts = rows.select("x").mapInArrow(run, "pos int, n long, high long, low long")
    found = parts.groupBy("pos").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    entries = {r["pos"]: r for r in found.collect()}  # as many as a vector has entries
    return entries[0]["n"], [(entries[i]["high"] << 32) + entries[i]["low"] for i in range(width)]


def _products(rows: DataFrame, width: int, size: int, of) -> np.ndarray:
    """Sum over all rows of y y', where y = of(x) has `size` entries."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((size, size)), False
        for batch in batches:
            x = _matrix(batch["x"], width)
            for at in range(0, len(x), ROWS):
                y = of(x[at : at + ROWS])
                total += y.T @ y
                some = True
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])],
                names=["i", "j", "value"],
            )

    parts = rows.select("x").mapInArrow(run, "i int, j int, value double")
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():  # half of a matrix of that size
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def main_width(rows: DataFrame) -> int | None:
    """The width that most vectors have, the larger one of equal counts; None without vectors."""
    widths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    first = widths.orderBy(F.desc("n"), F.desc("width")).first()
    return first["width"] if first else None


def fit_list(rows: DataFrame, width: int) -> DataFrame:
    """Each distinct x of that width once, in a written table."""
    return materialize(rows.where(F.size("x") == width).select("x").distinct(), "fit-list")


def fit(fitted: DataFrame, width: int) -> Whitening:
    """The whitening of a fit list of (x) rows."""
    ship_package(fitted.sparkSession)
    n, sums = _sums(fitted, width)
    mean = np.array([s / n for s in sums])
    scatter = _products(fitted, width, width, lambda x: x.astype(np.float64) - mean)
    values, axes = principal_axes(scatter)
    return Whitening(width, n, tuple(sums), values / n, axes, float(np.trace(scatter)) / n)


def identity_error(fitted: DataFrame, model: Whitening, k: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    if not k:
        return 0.0
    covariance = _products(fitted, model.width, k, lambda x: model.project(x, k)) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


SCHEMA = "{} {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    `component` runs from 1 by falling eigenvalue, up to `components`, the width, and the number of
    directions in which the fit list varies. `n` is the size of the fit list, `deviation` the exact sum
    of (n*x - S)^2 (NULL where a long can't hold it), `whitened` the projection of x - S/n over the
    root of the eigenvalue, `explained` the eigenvalue's share, `identity_error` how far the whitened
    fit list's covariance is from the identity.

    Vectors that are NULL or empty or hold NULL or non-finite entries are left out, and so are
    vectors of another width than most have. NULL ids stay NULL; repeated rows are
    returned each and fitted once. Other columns are ignored, whatever their names. An empty
    table, and one whose vectors are all equal, gives no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    schema = SCHEMA.format(f"`{id_col}`", vectors.schema[id_col].dataType.simpleString())
    rows = usable(vectors, id_col, vector)
    width = main_width(rows)
    if width is None:
        return spark.createDataFrame([], schema)
    fitted = fit_list(rows, width)
    model = fit(fitted, width)
    k = min(components, len(model.values))
    error = identity_error(fitted, model, k)
    share = [float(v / model.trace) for v in model.values[:k]]
    name = id_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x = _matrix(batch["x"], width)
                off, over = model.deviation(x)
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"].take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(each), model.n), pa.int64()),
                        pa.array(off[each], pa.int64(), mask=over[each]),
                        pa.array(model.project(x, k).ravel()),
                        pa.array(np.tile(share, len(x))),
                        pa.array(np.full(len(each), error)),
                    ],
                    names=[name, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.where(F.size("x") == width).mapInArrow(run, schema)
