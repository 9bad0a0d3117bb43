"""Whitening of embeddings by a bit-sliced scatter matrix.

An entry ``c`` becomes the integer ``x = floor(64 c) + 1000000``. The scatter of all rows is
counted on bits: each dimension is shifted to start at 0, every bit of it is packed across
rows into 64-bit words (a plane), and the AND of two planes is counted. The sum over rows of
``u_i u_j`` is the sum of ``2**(a + b)`` times the count of plane ``a`` of ``i`` AND plane
``b`` of ``j``; a plane of ones gives the sums of single dimensions and the number of rows.
Everything up to the covariance is integer arithmetic, so any split of the rows into tasks
gives the same matrix. A task returns a number per pair of dimensions, never a row's data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheaf.session import stage

#: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: An entry whose x would not fit a signed long with room for the shift has no x.
LARGEST = 2.0**61
MOST_COMPONENTS = 32
#: Rows whose planes are ANDed at a time: 256 words a plane, so all planes stay in the cache.
BLOCK_ROWS = 16_384
#: Counts are weighted by 2**(weight % 16) in a task, by the rest on the driver.
LIMB = 16
#: Components with less variance than this share of all of it, times dimensions, are rounding.
LEAST_SHARE = 1e-14

SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double"
)


@dataclass
class Fit:
    """What the fit list determines; its size depends on the dimensions only."""

    n: int
    least: list[int]
    most: list[int]
    sums: list[int]
    #: Exact numerators of the covariance: n * sum(x_i x_j) - S_i S_j; the divisor is n * n.
    scatter: np.ndarray
    values: np.ndarray
    axes: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float | None]:
        return [float(e) / self.trace if self.trace > 0 else None for e in self.values]

    @property
    def steps(self) -> np.ndarray:
        """Axes over the root of their variance; NaN where a component has none."""
        floor = self.trace * len(self.least) * LEAST_SHARE
        with np.errstate(invalid="ignore", divide="ignore"):
            return self.axes / np.where(self.values > floor, np.sqrt(self.values), np.nan)


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the rows whose vector and all of its entries are finite numbers."""
    whole = vectors.select(
        F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("v")
    )
    return whole.filter(
        F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & (F.abs(c * SCALE) < LARGEST))
    )


def integers(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The x-vectors of a batch whose vectors have ``dims`` entries, and where they stand."""
    column = batch.column("v")
    lengths = np.asarray(pa.compute.list_value_length(column))
    at = np.flatnonzero(lengths == dims)
    flat = np.asarray(column.take(pa.array(at)).flatten(), dtype=np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, dims) + SHIFT, at


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        lengths = np.asarray(pa.compute.list_value_length(batch.column("v")))
        for dims in np.unique(lengths).tolist():
            x, _ = integers(batch, dims)
            n, least, most = found.get(dims, (0, x[0], x[0]))
            found[dims] = [n + len(x), np.minimum(least, x.min(0)), np.maximum(most, x.max(0))]
    for dims, (n, least, most) in found.items():
        yield pa.RecordBatch.from_pydict({
            "dims": pa.array(np.full(dims, dims), pa.int32()), "i": pa.array(np.arange(dims), pa.int32()),
            "n": pa.array(np.full(dims, n), pa.int64()), "least": pa.array(least), "most": pa.array(most),
        })


def planes(u: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Bit planes of the columns of ``u`` (rows, dimensions), packed across rows.

    One row of 64-bit words per plane, dimension by dimension, lowest bit first; a last
    plane marks the rows that exist.
    """
    rows, dims = u.shape
    words = -(-rows // 64)
    starts = np.concatenate([[0], np.cumsum(widths)])
    out = np.zeros((int(starts[-1]) + 1, words * 8), np.uint8)
    for bit in range(int(widths.max(initial=0))):
        have = np.flatnonzero(widths > bit)
        packed = np.packbits(((u[:, have] >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8), axis=0)
        out[starts[have] + bit, : len(packed)] = packed.T
    out[-1, : -(-rows // 8)] = np.packbits(np.ones(rows, np.uint8))
    return out.view(np.uint64)


class Scatter:
    """Sums of products of shifted dimensions, in limbs of weight 2**(16 g)."""

    def __init__(self, least: list[int], most: list[int]):
        self.least = np.array(least, np.int64)
        self.widths = np.array([(b - a).bit_length() for a, b in zip(least, most)], np.int64)
        dims = len(least)
        #: Dimension and weight of every plane; the plane of ones counts as dimension ``dims``.
        self.owner = np.append(np.repeat(np.arange(dims), self.widths), dims)
        self.weight = np.append(np.concatenate([np.arange(w) for w in self.widths] or [[]]), 0).astype(np.int64)
        self.limbs = int(2 * self.weight.max(initial=0)) // LIMB + 1
        self.sums = np.zeros((self.limbs, dims + 1, dims + 1), np.int64)

    def add(self, x: np.ndarray) -> None:
        for start in range(0, len(x), BLOCK_ROWS):
            u = (x[start : start + BLOCK_ROWS] - self.least).view(np.uint64)
            self._count(planes(u, self.widths))

    def _count(self, words: np.ndarray) -> None:
        firsts = np.flatnonzero(np.diff(self.owner, prepend=-1))
        for p in range(len(words)):
            own = self.owner[p]
            begin = int(np.searchsorted(self.owner, own))
            counts = np.bitwise_count(words[p] & words[begin:]).sum(axis=1, dtype=np.int64)
            weight = self.weight[p] + self.weight[begin:]
            value = counts << (weight % LIMB)
            cuts = firsts[firsts >= begin]
            for limb in np.unique(weight // LIMB).tolist():
                held = np.where(weight // LIMB == limb, value, 0)
                self.sums[limb, own, self.owner[cuts]] += np.add.reduceat(held, cuts - begin)

    def rows(self) -> pa.RecordBatch:
        limb, i, j = np.nonzero(self.sums)
        return pa.RecordBatch.from_pydict({
            "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "limb": pa.array(limb, pa.int32()),
            "total": pa.array(self.sums[limb, i, j]),
        })


def fitted(rows: DataFrame) -> Fit | None:
    """Covariance and components of the rows of :func:`usable`; None without any.

    The dimension is the commonest length of a vector, the greater one of two that are
    equally common; vectors of other lengths have no place in one covariance.
    """
    ranges = stage(
        rows.mapInArrow(_ranges, "dims int, i int, n bigint, least bigint, most bigint").groupBy("dims", "i").agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")
        ),
        "whitening-ranges",
    )
    common = ranges.filter("i = 0").orderBy(F.desc("n"), F.desc("dims")).first()
    if common is None:
        return None
    dims = common["dims"]
    bounds = sorted(ranges.filter(F.col("dims") == dims).collect(), key=lambda r: r["i"])
    least, most = [r["least"] for r in bounds], [r["most"] for r in bounds]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Scatter(least, most)
        held, waiting = [], 0
        for batch in batches:
            x, _ = integers(batch, dims)
            held.append(x)
            waiting += len(x)
            if waiting >= BLOCK_ROWS:
                total.add(np.concatenate(held))
                held, waiting = [], 0
        if waiting:
            total.add(np.concatenate(held))
        yield total.rows()

    cells = rows.mapInArrow(scatter, "i int, j int, limb int, total bigint").groupBy("i", "j", "limb").agg(
        F.sum("total").alias("total")
    )
    u = np.zeros((dims + 1, dims + 1), object)
    for r in cells.toLocalIterator():
        u[r["i"], r["j"]] += r["total"] << (LIMB * r["limb"])
        if r["i"] != r["j"]:
            u[r["j"], r["i"]] = u[r["i"], r["j"]]
    return solved(u, least, most)


def solved(u: np.ndarray, least: list[int], most: list[int]) -> Fit:
    """The fit, from exact sums of products of the shifted dimensions and of ones."""
    n = int(u[-1, -1])
    sums = [int(s) for s in u[:-1, -1]]
    # the shift falls out of the centred sums, so it need not be undone
    centred = n * u[:-1, :-1] - np.outer(np.array(sums, object), np.array(sums, object))
    covariance = (centred / (n * n)).astype(np.float64)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    values, axes = values[order][:MOST_COMPONENTS], axes[:, order][:, :MOST_COMPONENTS]
    # either sign would do; the entry farthest from 0 is made positive
    top = np.abs(axes).argmax(axis=0)
    axes = axes * np.where(axes[top, np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    trace = float(np.trace(covariance))
    return Fit(n, least, most, [s + n * a for s, a in zip(sums, least)], centred, values, axes, trace)


def projected(x: np.ndarray, fit: Fit) -> np.ndarray:
    """Whitened rows: x - S/n on the axes, over the roots of their variances."""
    near = np.array([s // fit.n for s in fit.sums], np.int64)
    rest = np.array([(s - fit.n * int(a)) / fit.n for s, a in zip(fit.sums, near)])
    return ((x - near).astype(np.float64) - rest) @ fit.steps


def deviations(x: np.ndarray, fit: Fit) -> list[int | None]:
    """Exact sums of (n x - S)**2; None where one does not fit a long."""
    far = [max(fit.n * b - s, s - fit.n * a) for a, b, s in zip(fit.least, fit.most, fit.sums)]
    if sum(f * f for f in far) < 2**63 and fit.n * max(map(abs, [*fit.least, *fit.most])) < 2**63:
        away = fit.n * x - np.array(fit.sums, np.int64)
        return (away * away).sum(axis=1).tolist()
    away = fit.n * x.astype(object) - np.array(fit.sums, object)
    return [d if d < 2**63 else None for d in (away * away).sum(axis=1).tolist()]


def identity_error(rows: DataFrame, fit: Fit) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows minus the identity.

    Measured on the whitened rows themselves. Components without variance are left out;
    None if no other is left.
    """
    live = np.flatnonzero(np.isfinite(fit.steps).all(axis=0))
    if not len(live):
        return None
    dims = len(fit.least)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(live) + 1, len(live) + 1))
        for batch in batches:
            x, _ = integers(batch, dims)
            w = np.hstack([projected(x, fit)[:, live], np.ones((len(x), 1))])
            total += w.T @ w
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "total": pa.array(total.ravel()),
        })

    found = np.zeros((len(live) + 1, len(live) + 1))
    for r in rows.mapInArrow(products, "i int, j int, total double").groupBy("i", "j").agg(
        F.sum("total").alias("total")
    ).toLocalIterator():
        found[r["i"], r["j"]] = r["total"]
    mean = found[:-1, -1] / fit.n
    return float(np.abs(found[:-1, :-1] / fit.n - np.outer(mean, mean) - np.eye(len(live))).max())


def whitened(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per usable vector and component, the columns of ``SCHEMA``.

    A vector is usable if neither it nor an entry is null, NaN, infinite or so large that
    its x is no long (2**61 or more in 64ths), if it has entries, and if its length is the
    commonest one. Other rows are dropped. Ids may be null or repeat; each row counts and
    is returned. Further columns are ignored, whatever they are called. No usable row gives
    an empty table. ``whitened`` is null for a component without variance (one row, equal
    rows, fewer rows than dimensions), ``explained`` is null if there is no variance at
    all, and ``deviation`` is null where it exceeds a long; n times the range of an entry
    must reach about 10**9 for that.
    """
    rows = usable(vectors, id_column, column)
    fit = fitted(rows)
    if fit is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    error = identity_error(rows, fit)
    dims = len(fit.least)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = integers(batch, dims)
            if not len(x):
                continue
            w = projected(x, fit)
            flat = pa.array(w.ravel(), mask=np.isnan(w).ravel())
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(at)),
                "deviation": pa.array(deviations(x, fit), pa.int64()),
                "w": pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], flat),
            })

    per_row = rows.mapInArrow(out, "vec_id bigint, deviation bigint, w array<double>")
    shares = F.array(*[F.lit(e).cast("double") for e in fit.explained])
    return per_row.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(fit.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
