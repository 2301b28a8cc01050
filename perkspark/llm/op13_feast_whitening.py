"""Whitening of embeddings onto leading components found by contour integration (FEAST).

Spark does everything that grows with the table: exact sums per dimension, the
covariance of the centred vectors, the projection and the check of the whitened
covariance, each one scan with one partial result a task.  Only the covariance
(dimensions squared) comes to the driver, where ``components`` works:

1. Householder steps make it tridiagonal; the signs of the pivots of a shifted
   factorisation (Sylvester's inertia) then count the eigenvalues above any shift.
2. Bisection by such counts brackets the wanted eigenvalues, and edges are laid in
   the gaps between them, so that every interval holds a known number.
3. For each interval, Gauss-Legendre points on half a circle around it give complex
   shifted solves of the covariance; their weighted sum projects a block of vectors
   onto the interval's invariant subspace.  Rayleigh-Ritz on the orthonormal block
   gives candidates, and the step is repeated on them until the residuals are at
   rounding level.
4. The candidates inside the interval must be as many as the inertia counts say; if
   not, the block grows, and at last an error is raised: none is missed in silence.
   One Rayleigh-Ritz step over all intervals together makes the set orthonormal.

Defined cases: vectors that are null or hold null, NaN or infinite entries take no
part; a shorter vector counts as ending in zeros, up to the longest one's length,
an empty one as zeros alone; rows with a null or repeated id are rows like any
other; integers beyond +-2**61 count as that bound; a deviation beyond a long's range is
null; equal eigenvalues give some orthonormal basis of their space; components
whose eigenvalue is rounding error against the largest (constant or dependent
dimensions, a single row, equal rows) do not exist, so that fewer than 32, or no
rows at all, come out; an empty table gives no rows; columns but the two named are
not read.  Vectors longer than ``MOST_DIMENSIONS`` are an error, since the
covariance must fit in the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
MOST_DIMENSIONS = 4096
#: Integers are clipped here, so that differences of two fit in 64 bits.
BOUND = 1 << 61
#: Points on the half circle of an interval, and eigenvalues an interval should hold.
POINTS, GROUP = 8, 8


# ------------------------------------------------------------------ eigenpairs, on a dimensions-squared matrix
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix."""
    a = v.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x /= norm
        p = 2 * a[k + 1 :, k + 1 :] @ x
        w = p - (x @ p) * x
        a[k + 1 :, k + 1 :] -= np.outer(x, w) + np.outer(w, x)
        column = a[k + 1 :, k] - 2 * x * (x @ a[k + 1 :, k])
        a[k + 1 :, k] = a[k, k + 1 :] = column
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues above each shift: positive pivots of the shifted matrix's factorisation."""
    least = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - shifts
    above = (pivot > 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        with np.errstate(over="ignore"):  # an infinite pivot has the right sign
            pivot = diagonal[k] - shifts - off[k - 1] ** 2 / pivot
        above += pivot > 0
    return above


def bracketed(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, by bisection with inertia counts."""
    reach = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    low = np.full(most, (diagonal - reach).min())
    high = np.full(most, (diagonal + reach).max())
    for _ in range(80):
        middle = (low + high) / 2
        enough = count_above(diagonal, off, middle) > np.arange(most)
        low, high = np.where(enough, middle, low), np.where(enough, high, middle)
    return (low + high) / 2


def intervals(values: np.ndarray, wanted: int) -> list[tuple[float, float]]:
    """(low, high) around the first ``wanted`` of the falling ``values``, with edges in gaps."""
    out = []
    first = 0
    high = values[0] + max(values[0] - values[-1], values[0]) * 0.1
    while first < wanted:
        last = first
        while last + 1 < len(values):
            gap = values[last] - values[last + 1]
            full = last + 1 >= wanted or last + 1 - first >= GROUP or values[last + 1] < values[first] / 4
            if full and gap > 0.01 * (values[first] - values[last + 1]):
                break
            last += 1
        low = (values[last] + values[last + 1]) / 2 if last + 1 < len(values) else values[last] / 2
        out.append((low, high))
        first, high = last + 1, low
    return out


def contour_pairs(v: np.ndarray, low: float, high: float, held: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values and vectors of ``v`` in (low, high], which holds ``held`` eigenvalues."""
    d = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi / 2 * (1 - nodes)
    centre, radius = (low + high) / 2, (high - low) / 2
    size = min(d, held + held // 2 + 4)
    tolerance = 8 * d * np.finfo(float).eps * scale
    while True:
        block = np.random.default_rng(13).standard_normal((d, size))
        best = None
        for _ in range(30):
            projected = np.zeros((d, block.shape[1]))
            for angle, weight in zip(angles, weights, strict=True):
                z = centre + radius * np.exp(1j * angle)
                projected += weight / 2 * (radius * np.exp(1j * angle) * np.linalg.solve(z * np.eye(d) - v, block.astype(complex))).real
            q, _ = np.linalg.qr(projected)
            ritz, turn = np.linalg.eigh(q.T @ v @ q)
            block = q @ turn
            inside = (ritz > low) & (ritz <= high)
            x = block[:, inside]
            residual = np.abs(v @ x - x * ritz[inside]).max(initial=0)
            if inside.sum() == held and (best is None or residual < best[0]):
                best = (residual, ritz[inside], x)
                if residual <= tolerance:
                    break
        if best is not None and best[0] <= 100 * tolerance:
            return best[1], best[2]
        if size == d:
            raise ArithmeticError(f"{held} eigenvalues are in ({low}, {high}], not as many were found")
        size = min(d, 2 * size)


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and unit eigenvectors as columns."""
    d = len(v)
    if not d or not np.abs(v).max() > 0:
        return np.zeros(0), np.zeros((d, 0))
    diagonal, off = tridiagonal(v)
    scale = bracketed(diagonal, off, 1)[0]
    real = int(count_above(diagonal, off, np.array([4 * d * np.finfo(float).eps * scale]))[0])
    wanted = min(most, real)
    values = bracketed(diagonal, off, min(real, max(2 * wanted, wanted + GROUP)))
    found = []
    for low, high in intervals(values, wanted):
        counts = count_above(diagonal, off, np.array([low, high]))
        found.append(contour_pairs(v, low, high, int(counts[0] - counts[1]), scale)[1])
    q, _ = np.linalg.qr(np.hstack(found))
    ritz, turn = np.linalg.eigh(q.T @ v @ q)
    return ritz[::-1][:wanted].copy(), (q @ turn)[:, ::-1][:, :wanted].copy()


# ------------------------------------------------------------------ scans
def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part."""
    rows = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("embedding").isNotNull() & finite)


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a batch as integers, and each row's number of them."""
    sizes = np.diff(column.offsets.to_numpy())
    with np.errstate(over="ignore"):
        entries = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)) + SHIFT
    return np.clip(entries, -float(BOUND), float(BOUND)).astype(np.int64), sizes


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    entries, sizes = _integers(column)
    if (sizes == dims).all():
        return entries.reshape(len(sizes), dims)
    out = np.full((len(sizes), dims), SHIFT, np.int64)
    out[np.arange(dims) < sizes[:, None]] = entries
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, rows, high, low): a task's sums per dimension in two exact parts; dim -1 has all rows."""
    rows, high, low, total = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for batch in batches:
        entries, sizes = _integers(batch.column(1))
        total += len(sizes)
        longest = int(sizes.max(initial=0))
        if longest > MOST_DIMENSIONS:
            raise ValueError(f"a vector has {longest} dimensions; the most are {MOST_DIMENSIONS}")
        if longest > len(rows):
            rows, high, low = (np.pad(a, (0, longest - len(a))) for a in (rows, high, low))
        at = np.arange(len(entries)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        np.add.at(rows, at, 1)
        np.add.at(high, at, entries >> 32)
        np.add.at(low, at, entries & 0xFFFFFFFF)
    columns = [np.arange(-1, len(rows)), *(np.concatenate([[first], a]) for first, a in ((total, rows), (0, high), (0, low)))]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["dim", "rows", "high", "low"])


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact integer sums per dimension."""
    parts = rows.mapInArrow(_sums, "dim long, rows long, high long, low long")
    whole = parts.groupBy("dim").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).cast("decimal(38,0)").alias(c) for c in ("rows", "high", "low")))
    by_dim = {r["dim"]: (int(r["rows"]), (int(r["high"]) << 32) + int(r["low"])) for r in whole.collect()}
    n = by_dim.pop(-1, (0, 0))[0]
    return n, [by_dim[k][1] + (n - by_dim[k][0]) * SHIFT for k in range(len(by_dim))]


class Centre:
    """Sums of ``n`` vectors as integer means and the remainders: x - S/n without loss."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.dims = n, len(sums)
        self.mean = np.array([round_div(s, n) for s in sums], np.int64)
        self.rest = [s - int(m) * n for s, m in zip(sums, self.mean, strict=True)]  # at most n / 2
        self.fraction = np.array([r / n for r in self.rest])

    def apart(self, column: pa.Array) -> np.ndarray:
        return _matrix(column, self.dims) - self.mean

    def deviations(self, apart: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) ** 2, exact; None beyond a long."""
        far = int(np.abs(apart).max(initial=0)) * self.n + self.n
        if far * far * max(1, self.dims) < 1 << 63:
            return ((self.n * apart - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * x - r) ** 2 for x, r in zip(row, self.rest, strict=True)) for row in apart.tolist()]
        return [x if x < 1 << 63 else None for x in exact]


def round_div(a: int, b: int) -> int:
    return (2 * a + b) // (2 * b)


def _gram(rows: DataFrame, size: int, centred) -> np.ndarray:
    """Sum over all rows of z z', where ``centred`` gives a batch's z; partial sums are added in task order."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((size, size))
        for batch in batches:
            z = centred(batch.column(1))
            total += z.T @ z
        columns = [pa.array(range(size), pa.int32()), pa.array([TaskContext.get().partitionId()] * size, pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "part", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            sums = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)
            for at, row in zip(batch.column(0).to_pylist(), sums, strict=True):
                totals[at] = totals[at] + row if at in totals else row.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array(list(totals.values()), pa.list_(pa.float64()))], names=["at", "sums"])

    parts = rows.mapInArrow(partial, "at int, part int, sums array<double>")
    dealt = parts.repartition("at").sortWithinPartitions("at", "part")
    out = np.zeros((size, size))
    for r in dealt.mapInArrow(added, "at int, sums array<double>").collect():
        out[r["at"]] = r["sums"]
    return out


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    rows = bounded_batches(usable_vectors(vectors))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, sums = exact_sums(rows)
    if not n or not sums:
        return vectors.sparkSession.createDataFrame([], schema)
    centre = Centre(n, sums)
    covariance = _gram(rows, centre.dims, lambda column: centre.apart(column) - centre.fraction) / n
    covariance = (covariance + covariance.T) / 2
    values, axes = components(covariance, most)
    k = len(values)
    explained = values / np.trace(covariance) if k else values
    scaled = axes / np.sqrt(values)
    # the whitened rows' mean is zero because the centred ones' is
    check = _gram(rows, k, lambda column: (centre.apart(column) - centre.fraction) @ scaled) / n if k else np.zeros((0, 0))
    error = float(np.abs(check - np.eye(k)).max(initial=0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = centre.apart(batch.column(1))
            white = (apart - centre.fraction) @ scaled
            b = batch.num_rows
            every = np.repeat(np.arange(b), k)
            columns = [
                batch.column(0).cast(pa.int64()).take(pa.array(every)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b)),
                pa.array(np.full(b * k, n, np.int64)),
                pa.array(centre.deviations(apart), pa.int64()).take(pa.array(every)),
                pa.array(white.ravel()),
                pa.array(np.tile(explained, b)),
                pa.array(np.full(b * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` whitened onto up to 32 components."""
    return whiten(table(spark, sf_dir, "embeddings"))
