"""Whitening of embedding vectors.

Entries become whole numbers ``floor(scale * entry)``, so that every sum below is
exact. The statistics come from the *fit list*: each distinct whole-number vector
once, written as a table. Its tasks multiply vectors centred on a whole number
near the mean, in digits small enough for a float64 matrix product to be exact,
and Spark adds the products up; what is left of the centring is taken off the
exact sums.

The scatter matrix (dimensions x dimensions, whatever the number of rows) is
factored by Cholesky with pivoting; one-sided Jacobi rotations then make the
columns of the triangular factor orthogonal. The squared column norms are the
eigenvalues and the normalised columns the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import runs, ship, written

LIMB = 32  # bits of the parts in which exact sums travel
DIGIT = 20  # bits of the digits of an exact matrix product
EXACT = 1 << 53
WIDTHS = (np.int8, np.int16, np.int32, np.int64)


# ---------------------------------------------------------------- exact sums


def whole(entries: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * entry) as int64; beyond its range, the range's end."""
    v, ends = np.floor(entries.astype(np.float64) * scale), np.iinfo(np.int64)
    inside = (v >= ends.min) & (v < 2.0**63)
    return np.where(inside, np.where(inside, v, 0.0).astype(np.int64), np.where(v > 0, ends.max, ends.min))


def digits(y: np.ndarray) -> list[np.ndarray]:
    """Float64 matrices d[0], d[1], ... with y = sum(d[k] * 2**(DIGIT * k)) and
    every |d[k]| below 2**DIGIT."""
    sign, rest, out = np.sign(y), np.abs(y.astype(object)) if y.dtype == object or (y.size and y.min() == np.iinfo(np.int64).min) else np.abs(y), []
    while True:
        out.append((sign * (rest % (1 << DIGIT))).astype(np.float64))
        rest = rest >> DIGIT
        if not rest.any():
            return out


def exact_products(y: np.ndarray) -> np.ndarray:
    """y.T @ y of whole numbers, exactly, as Python integers."""
    parts = digits(y)
    most = [max(1, int(np.abs(p).max())) if p.size else 1 for p in parts]
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for a, p in enumerate(parts):
        for b, q in enumerate(parts):
            rows = max(1, (EXACT - 1) // (most[a] * most[b]))
            for at in range(0, len(y), rows):
                total += (p[at : at + rows].T @ q[at : at + rows]).astype(np.int64).astype(object) << (DIGIT * (a + b))
    return total


def limbs(values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, limb, part) with value = sum(part * 2**(LIMB * limb)); zero parts
    are left out. Sums of parts stay below 2**63 for 2**31 tasks."""
    rows = []
    for place, v in enumerate(values):
        sign, rest, k = (1, v, 0) if v >= 0 else (-1, -v, 0)
        while rest:
            if part := rest & ((1 << LIMB) - 1):
                rows.append((place, k, sign * part))
            rest, k = rest >> LIMB, k + 1
    got = np.array(rows, dtype=np.int64).reshape(-1, 3)
    return got[:, 0], got[:, 1], got[:, 2]


def summed(partial: DataFrame, size: int) -> list[int]:
    """The exact sums of ``size`` places over all tasks: Spark adds the limbs up,
    the driver receives a few for each place."""
    got = [0] * size
    for r in partial.groupBy("place", "limb").agg(F.sum("part").alias("part")).collect():
        got[r["place"]] += r["part"] << (LIMB * r["limb"])
    return got


PLACES = "place int, limb int, part long"


def _places(values: list[int]) -> pa.RecordBatch:
    place, limb, part = limbs(values)
    return pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(limb, pa.int32()), pa.array(part, pa.int64())], names=["place", "limb", "part"])


# ---------------------------------------------------------------- vectors


def _matrices(batch: pa.RecordBatch, scale: float, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the batch, their whole-number matrix) for the vectors that take
    part, by length and in slices of at most ``most`` entries."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    flat, sizes = column.flatten(), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry becomes NaN
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - sizes])
    for size in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == size))
        for a, b in runs([max(1, int(size))] * len(rows), most):
            part = rows[a:b]
            yield part, whole(values[(ends[part] - size)[:, None] + np.arange(size)], scale)


def _packed(x: np.ndarray) -> list[bytes]:
    """A vector as bytes: the narrowest width that holds it, then the numbers.
    Equal vectors have equal bytes."""
    low, high = (x.min(axis=1), x.max(axis=1)) if x.shape[1] else (np.zeros(len(x)), np.zeros(len(x)))
    width = sum(((low < np.iinfo(w).min) | (high > np.iinfo(w).max)).astype(int) for w in WIDTHS[:-1])
    out = [b""] * len(x)
    for k, w in enumerate(WIDTHS):
        for i, row in zip(np.flatnonzero(width == k), x[width == k].astype(np.dtype(w).newbyteorder("<"))):
            out[i] = bytes([k]) + row.tobytes()
    return out


def _unpacked(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.stack([np.frombuffer(r, np.dtype(WIDTHS[r[0]]).newbyteorder("<"), offset=1).astype(np.int64) for r in rows])


def fit_list(vectors: DataFrame, scale: float) -> DataFrame:
    """(size, x): each distinct whole-number vector once, written as a table."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _matrices(batch, scale):
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]] * len(x), pa.int32()), pa.array(_packed(x), pa.binary())], names=["size", "x"])

    return written(vectors.select("embedding").mapInArrow(encode, "size int, x binary").distinct())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            for a, b in runs([max(1, len(batch.column(0)[0].as_py()))] * batch.num_rows, 1 << 20):
                yield _unpacked(batch.column(0).slice(a, b - a))


# ---------------------------------------------------------------- factors


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """L with scatter = L @ L.T, of as many columns as the rank: the largest
    diagonal entry left is the pivot of each step, and the steps end where it is
    rounding only. Rows are in the order of the dimensions; read in the order of
    the pivots, L is lower triangular."""
    d = len(scatter)
    left, diagonal, columns = scatter.astype(np.float64).copy(), scatter.diagonal().astype(np.float64).copy(), []
    if not d or diagonal.max() <= 0:
        return np.zeros((d, 0))
    least = d * np.finfo(float).eps * diagonal.max()
    done = np.zeros(d, dtype=bool)
    for _ in range(d):
        k = int(np.where(done, -np.inf, diagonal).argmax())
        if diagonal[k] <= least:
            break
        column = np.where(done, 0.0, left[:, k]) / np.sqrt(diagonal[k])
        column[k] = np.sqrt(diagonal[k])
        done[k] = True
        left -= np.outer(column, column)
        diagonal = left.diagonal().copy()
        columns.append(column)
    return np.array(columns).T


def jacobi(factor: np.ndarray, sweeps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of factor @ factor.T, by falling
    eigenvalue: one-sided rotations make the columns orthogonal, disjoint pairs
    of columns at a time (a round robin), until a sweep turns none."""
    a = factor.astype(np.float64).copy()
    r = a.shape[1]
    order = np.argsort(-(a * a).sum(axis=0), kind="stable")
    a = a[:, order]
    if r > 1:
        seats = np.arange(r + r % 2)
        for _ in range(sweeps):
            turned = False
            for _ in range(len(seats) - 1):
                p, q = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
                real = (p < r) & (q < r)
                p, q = np.minimum(p, q)[real], np.maximum(p, q)[real]
                x, y = a[:, p], a[:, q]
                alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
                open_ = np.abs(gamma) > np.finfo(float).eps * np.sqrt(alpha * beta)
                turned |= bool(open_.any())
                zeta = (beta - alpha) / (2 * np.where(open_, gamma, 1.0))
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                t = np.where(open_, t, 0.0)
                c = 1 / np.hypot(1.0, t)
                s = c * t
                a[:, p], a[:, q] = c * x - s * y, s * x + c * y
                seats = np.concatenate([seats[:1], np.roll(seats[1:], 1)])
            if not turned:
                break
    norms = (a * a).sum(axis=0)
    order = np.argsort(-norms, kind="stable")
    return norms[order], a[:, order] / np.sqrt(norms[order])


@dataclass
class Whitening:
    """What the fit list says: its size and sums, and the leading components."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues of the covariance
    components: np.ndarray  # one column each
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly."""
        far = self.n * int(max(abs(int(x.max())), abs(int(x.min())))) + max(abs(s) for s in self.sums) if x.size else 0
        kind = np.int64 if far < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def project(self, dev: np.ndarray) -> np.ndarray:
        return (dev.astype(np.float64) / self.n) @ (self.components / np.sqrt(self.values))


def fit(fitted: DataFrame, components: int) -> Whitening | None:
    """The whitening of a fit list (None if it is empty). Vectors of several
    lengths have no covariance: ValueError."""
    sizes = [r["size"] for r in fitted.select("size").distinct().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError(f"vectors of several lengths: {min(sizes)}, {max(sizes)}")
    if not sizes:
        return None
    d, x = sizes[0], fitted.select("x")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros(d + 1, dtype=object)
        for block in _blocks(batches):
            got[:d] += block.astype(object).sum(axis=0) if np.abs(block.astype(np.float64)).max(initial=0) >= 2.0**40 else block.sum(axis=0)
            got[d] += len(block)
        yield _places([int(v) for v in got])

    *sums, n = summed(x.mapInArrow(totals, PLACES), d + 1)
    near = [(2 * s + n) // (2 * n) for s in sums]  # the mean to the nearest whole number
    upper = np.triu_indices(d)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros((d, d), dtype=object)
        for block in _blocks(batches):
            small = np.abs(block.astype(np.float64)).max(initial=0) < 2.0**61 and max(map(abs, near), default=0) < 1 << 61
            got += exact_products(block.astype(np.int64 if small else object) - np.array(near, dtype=np.int64 if small else object))
        yield _places([int(v) for v in got[upper]])

    flat = summed(x.mapInArrow(scatter, PLACES), len(upper[0]))
    rest = [s - n * m for s, m in zip(sums, near)]  # what the whole-number centre left
    cov = np.zeros((d, d))
    for i, j, v in zip(*upper, flat):
        cov[i, j] = cov[j, i] = float(Fraction(n * v - rest[i] * rest[j], n * n))
    values, parts = jacobi(pivoted_cholesky(cov))
    return Whitening(n, sums, values[:components], parts[:, :components], float(sum(Fraction(n * flat[k] - rest[i] ** 2, n * n) for k, (i, j) in enumerate(zip(*upper)) if i == j)))


def identity_error(fitted: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity)."""
    k = len(model.values)
    if not k:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros((k + 1, k + 1))
        for block in _blocks(batches):
            w = np.hstack([model.project(model.deviations(block)), np.ones((len(block), 1))])
            got += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(got.size), pa.int32()), pa.array(got.ravel())], names=["place", "value"])

    total = np.zeros((k + 1) ** 2)
    for r in fitted.select("x").mapInArrow(moments, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        total[r["place"]] = r["value"]
    total = total.reshape(k + 1, k + 1) / model.n
    mean = total[k, :k]
    return float(np.abs(total[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 4, scale: float = 256.0) -> DataFrame:
    """Whitened coordinates of ``vectors`` (vec_id, embedding).

    One row per vector and component (numbered from 1): n, the vectors of the
    fit list; deviation, the exact squared distance from the mean times n**2
    (null if it doesn't fit a long); whitened; explained, the component's share
    of the variance; identity_error, the same in every row.

    Vectors that are null or hold a null, NaN or infinite entry give no row.
    Repeated rows each give theirs; a null vec_id stays null; other columns are
    ignored. There are as many components as the fit list has rank, so an empty
    table, one distinct vector, or vectors without entries give no rows. Entries
    beyond a long after scaling count as its largest or smallest number. Vectors
    of several lengths raise a ValueError."""
    ship(vectors.sparkSession)
    fitted = fit_list(vectors, scale)
    model = fit(fitted, components)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], WHITENED)
    error = identity_error(fitted, model)
    explained = model.values / model.trace

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            for rows, x in _matrices(batch, scale):
                dev, k = model.deviations(x), len(model.values)
                most = max(abs(int(dev.max())), abs(int(dev.min())))
                square = dev if dev.shape[1] * most * most < 1 << 63 else dev.astype(object)
                square = [v if v < 1 << 63 else None for v in (square * square).sum(axis=1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                     pa.array(np.full(len(rows) * k, model.n)), pa.array(square, pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                     pa.array(model.project(dev).ravel()), pa.array(np.tile(explained, len(rows))), pa.array(np.full(len(rows) * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(apply, WHITENED)
