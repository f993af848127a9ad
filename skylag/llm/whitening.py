"""Whitened principal components of vectors, by spectral divide and conquer.

Vectors become whole numbers on a grid first, ``floor(scale * c)``, and each distinct one
counts once for the fit. Sums over the fit list are exact; the covariance is summed over
vectors centred by the exact mean. Distinct vectors are found by a shuffle of packed grid
vectors and written once; a task then adds up its own matrix, and matrices of tasks are
added in a tree, so that neither rows nor a matrix a task come to the driver.

The covariance, dimensions by dimensions, is split on the driver. For a shift inside its
spectrum the QDWH iteration (dynamically weighted Halley steps, by QR factors first, by
Cholesky factors near the end) gives the orthogonal polar factor of the shifted matrix;
half of that factor plus one half projects onto the components above the shift. A basis of
the projector's range and its complement turns the matrix into two smaller ones, which are
split in the same way until single components are left; parts that hold none of the leading
components are not split further. The basis goes out to all rows, which are projected there.

Defined results: NULL vectors and those with NULL or non-finite entries take no part, nor do
those with an entry of ``2 ** 53`` or more on the grid, whose grid value a double need not hold.
Vectors of another length than the most frequent one (the longest of equals) take no part.
Zero vectors do. Rows alike get the same values each; NULL keys stay. Components without
variance beyond rounding are left out, so one distinct vector, or an empty table, gives no
rows; equal eigenvalues share a space in which any basis may come out. ``deviation`` is NULL
if it passes 64 bits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .batches import slices

_EPS = np.finfo(float).eps
# Widths in which a vector's grid values are packed, the narrowest that holds all of them.
_WIDTHS = ("<i1", "<i2", "<i4", "<i8")


# Divide and conquer on a symmetric matrix


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH."""
    size = len(a)
    x = a / np.linalg.norm(a)
    # A lower bound of the smallest singular value; a singular matrix has only zero as one.
    try:
        low = max(_EPS, 1 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(size)))
    except np.linalg.LinAlgError:
        low = _EPS
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        p = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            both = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(size)]))[0]
            step = (p - q / r) / np.sqrt(r) * both[:size] @ both[size:].T
        else:
            lower = np.linalg.cholesky(np.eye(size) + r * x.T @ x)
            half = np.linalg.solve(lower, x.T)
            step = (p - q / r) * np.linalg.solve(lower.T, half).T
        new = q / r * x + step
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (p + q * square) / (1 + r * square))
        if moved <= np.cbrt(5 * _EPS) and abs(1 - low) <= 10 * _EPS:
            break
    return x


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the spaces above and below a shift; None if they do not come out clean."""
    size = len(a)
    projector = (polar_factor(a - shift * np.eye(size)) + np.eye(size)) / 2
    rank = round(np.trace(projector))
    if not 0 < rank < size:
        return None
    # A basis of the projector's range, brought nearer to it once, and its complement.
    basis = np.linalg.qr(projector[:, _pivots(projector, rank)])[0]
    basis = np.linalg.qr(projector @ basis)[0]
    whole = np.linalg.qr(basis, mode="complete")[0]
    above, below = whole[:, :rank], whole[:, rank:]
    left = np.linalg.norm(below.T @ a @ above)
    return (above, below) if left <= 100 * size * _EPS * np.linalg.norm(a) else None


def _pivots(matrix: np.ndarray, rank: int) -> list[int]:
    """As many columns as the rank, each the longest once those before are taken out."""
    rest, chosen = matrix.copy(), []
    for _ in range(rank):
        at = int(np.argmax(np.einsum("ij,ij->j", rest, rest)))
        unit = rest[:, at] / np.linalg.norm(rest[:, at])
        rest -= np.outer(unit, unit @ rest)
        chosen.append(at)
    return chosen


def leading_components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.linalg.norm(a)
    if not scale:
        return np.zeros(min(wanted, len(a))), np.eye(len(a))[:, :wanted]

    def split(part: np.ndarray, count: int) -> np.ndarray:
        """Basis of the ``count`` largest components of a part, the largest first."""
        size = len(part)
        values = np.diag(part)
        order = np.argsort(-values, kind="stable")
        if size == 1 or np.linalg.norm(part - np.diag(values)) <= size * _EPS * scale:
            return np.eye(size)[:, order[:count]]
        # The mean of the diagonal lies inside the spectrum, and so does all between its ends.
        low, high = values.min(), values.max()
        shifts = [values.mean(), np.median(values)]
        shifts += [low + (high - low) * share for share in (0.5, 0.25, 0.75, 0.1, 0.9)]
        for shift in shifts:
            found = _halves(part, shift)
            if found is not None:
                break
        else:
            # No gap to divide at: all components are equal up to rounding.
            return np.eye(size)[:, order[:count]]
        above, below = found
        upper = above @ split(_inside(part, above), min(count, above.shape[1]))
        if count <= above.shape[1]:
            return upper
        lower = below @ split(_inside(part, below), count - above.shape[1])
        return np.hstack([upper, lower])

    vectors = split(a, min(wanted, len(a)))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _inside(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    inner = basis.T @ a @ basis
    return (inner + inner.T) / 2


# Vectors on the grid


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of equal length as doubles, one a row, and whether each holds a NULL."""
    entries = column.flatten()
    shape = (len(column), -1)
    holes = np.asarray(entries.is_null()).reshape(shape).any(axis=1)
    doubles = entries.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    return doubles.reshape(shape), holes


def on_grid(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """key, dim and packed grid vector (its width, then its numbers) of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            column = batch["vector"]
            lengths = np.asarray(column.value_lengths().fill_null(0))
            for length in np.unique(lengths[lengths > 0]).tolist():
                rows = np.flatnonzero(lengths == length)
                values, holes = _matrix(column.take(pa.array(rows)))
                with np.errstate(over="ignore", invalid="ignore"):
                    grid = np.floor(scale * values)
                    good = ~holes & (np.abs(grid) < 2.0**53).all(axis=1)
                grid, rows = grid[good].astype("<i8"), rows[good]
                large = np.abs(np.where(grid < 0, ~grid, grid)).max(axis=1, initial=0)
                width = np.searchsorted([1 << 7, 1 << 15, 1 << 31], large, side="right")
                packed = np.empty(len(rows), object)
                for w in np.unique(width).tolist():
                    own = np.flatnonzero(width == w)
                    cells = grid[own].astype(_WIDTHS[w])
                    packed[own] = [bytes([w]) + cell.tobytes() for cell in cells]
                yield pa.record_batch(
                    [
                        batch["key"].take(pa.array(rows)),
                        pa.array([length] * len(rows), pa.int32()),
                        pa.array(packed.tolist(), pa.binary()),
                    ],
                    ["key", "dim", "grid"],
                )

    named = df.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    kind = named.schema["key"].dataType.simpleString()
    return named.mapInArrow(run, f"key {kind}, dim int, grid binary")


def unpacked(column: pa.Array, dim: int) -> np.ndarray:
    """Grid vectors as 64-bit whole numbers, one a row."""
    out = np.empty((len(column), dim), "<i8")
    cells = column.to_pylist()
    widths = np.asarray([cell[0] for cell in cells], "u1")
    for w in np.unique(widths).tolist():
        own = np.flatnonzero(widths == w)
        raw = b"".join(cells[at][1:] for at in own.tolist())
        out[own] = np.frombuffer(raw, _WIDTHS[w]).reshape(-1, dim)
    return out


def _total(
    df: DataFrame, column: str, work: Callable[[np.ndarray], np.ndarray], dim: int
) -> np.ndarray | None:
    """Sum of ``work`` over all batches of grid vectors: inside tasks first, then in a tree.

    The sums of tasks are arrays of numpy, of one shape; no rows leave the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches, 4096):
            if batch.num_rows:
                own = work(unpacked(batch[column], dim))
                total = own if total is None else total + own
        if total is not None:
            made = pa.array([total.astype("<f8").tobytes()], pa.binary())
            yield pa.record_batch([made], ["sums"])

    parts = df.select(column).mapInArrow(run, "sums binary").rdd.map(
        lambda row: np.frombuffer(row[0], "<f8")
    )
    return parts.treeAggregate(
        None,
        lambda a, b: b if a is None else a + b,
        lambda a, b: b if a is None else a if b is None else a + b,
    )


class Whitener(NamedTuple):
    """What rows need: exact sums of the fit list, its size, components and their figures."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def whitened(self, grid: np.ndarray) -> np.ndarray:
        """Grid vectors centred, projected and scaled to unit variance."""
        mean = np.asarray([s / self.n for s in self.sums])
        return (grid - mean) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, grid: np.ndarray) -> list[int | None]:
        """Exact sums of squares of n times a vector less the sums; None beyond 64 bits."""
        reach = self.n * int(np.abs(grid).max(initial=0)) + max(map(abs, self.sums))
        if reach * reach * len(self.sums) < 1 << 63:
            away = grid * self.n - np.asarray(self.sums, "<i8")
            return (away * away).sum(axis=1).tolist()
        exact = [
            sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums, strict=True))
            for row in grid.tolist()
        ]
        return [value if value < 1 << 63 else None for value in exact]


_LIMB = 20


def _limbs(grid: np.ndarray) -> np.ndarray:
    """Column sums in parts of 20 bits, and the number of rows: doubles hold their sums exactly
    up to eight thousand million rows."""
    low, rest = grid & (1 << _LIMB) - 1, grid >> _LIMB
    middle, high = rest & (1 << _LIMB) - 1, rest >> _LIMB
    counts = [part.sum(axis=0) for part in (low, middle, high)]
    return np.concatenate([[len(grid)], *counts])


def fit(distinct: DataFrame, dim: int, components: int) -> Whitener | None:
    """Mean, covariance and leading components of a table of distinct grid vectors."""
    found = _total(distinct, "grid", _limbs, dim)
    if found is None:
        return None
    n, *parts = (int(x) for x in found)
    sums = [
        parts[i] + (parts[dim + i] << _LIMB) + (parts[2 * dim + i] << 2 * _LIMB) for i in range(dim)
    ]
    mean = np.asarray([s / n for s in sums])

    def products(grid: np.ndarray) -> np.ndarray:
        away = grid - mean
        return (away.T @ away).ravel()

    covariance = _total(distinct, "grid", products, dim).reshape(dim, dim) / n
    values, vectors = leading_components((covariance + covariance.T) / 2, components)
    trace = float(np.trace(covariance))
    some = values > dim * _EPS * trace
    return Whitener(n, sums, vectors[:, some], values[some], values[some] / (trace or 1.0))


def identity_error(distinct: DataFrame, whitener: Whitener) -> float:
    """Largest entry of the whitened fit list's covariance less the identity."""
    dim, size = whitener.vectors.shape
    if not size:
        return 0.0
    sums = _total(distinct, "grid", lambda grid: whitener.whitened(grid).sum(axis=0), dim)
    mean = sums / whitener.n

    def products(grid: np.ndarray) -> np.ndarray:
        away = whitener.whitened(grid) - mean
        return (away.T @ away).ravel()

    covariance = _total(distinct, "grid", products, dim).reshape(size, size) / whitener.n
    return float(np.abs(covariance - np.eye(size)).max())


def whitened(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = 4,
    scale: float = 256.0,
) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error of every row that takes part."""
    rows = on_grid(df, key, vector, scale)
    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, component int, n long, deviation long, whitened double,"
        " explained double, identity_error double"
    )
    spark = df.sparkSession
    # One row for each length that occurs, the most frequent and then the longest first.
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common["dim"]
    rows = rows.filter(F.col("dim") == dim)
    distinct = materialize(rows.select("grid").distinct(), "grid-vectors")
    whitener = fit(distinct, dim, components)
    if whitener is None or not len(whitener.values):
        return spark.createDataFrame([], schema)
    error = identity_error(distinct, whitener)
    sent = spark.sparkContext.broadcast(whitener)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        size = len(model.values)
        for batch in slices(batches, 4096):
            grid = unpacked(batch["grid"], dim)
            count = batch.num_rows
            numbers = np.tile(np.arange(1, size + 1, dtype="<i4"), count)
            made = [
                batch["key"].take(pa.array(np.repeat(np.arange(count), size))),
                pa.array(numbers),
                pa.array(np.full(count * size, model.n, "<i8")),
                pa.array(model.deviations(grid), pa.int64()).take(
                    pa.array(np.repeat(np.arange(count), size))
                ),
                pa.array(model.whitened(grid).ravel()),
                pa.array(np.tile(model.explained, count)),
                pa.array(np.full(count * size, error)),
            ]
            yield pa.record_batch(made, names)

    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return rows.select("key", "grid").mapInArrow(run, schema)
