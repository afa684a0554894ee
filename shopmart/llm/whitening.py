"""Embedding whitening by incremental eigendecomposition.

A task keeps the spectrum (count, mean, eigenvalues, eigenvectors) of the
scatter matrix of the vectors it has seen.  A new vector is a centred rank-one
update of that matrix: the new eigenvalues are the roots of a secular
equation, found between the old ones; components that the vector does not
touch, and all but one of equal eigenvalues, are deflated and stay as they
are.  The spectra of tasks are combined in a tree, again by rank-one updates:
the eigenpairs of one and the distance of the two means enter the other one
by one.  A last distributed pass projects the exact covariance of all vectors
on the basis found (Rayleigh-Ritz), which takes the rounding of the updates
out of the result.

A spectrum is d * d numbers for vectors of d entries, whatever their count;
only single spectra and sums of that size reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm._store import shipped, stored

#: Spectra that one task combines; steps of the root search; vectors of a block in the last passes.
FAN_IN, STEPS, BLOCK = 8, 60, 4096
#: What counts as untouched or equal, and as no variance, relative to the largest eigenvalue.
SMALL, FLAT = 4e-16, 1e-11
#: Entries of a vector as integers: floor(GRID * c) + SHIFT; beyond this they are no exact doubles.
GRID, SHIFT, EXACT = 64, 1000000, 1 << 52


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z2 / (d - x) for rising d and positive z2, one above each d.

    Returns, for each root, the nearer pole and the distance from it, which
    keeps the digits of roots that almost meet a pole.  Newton steps on the
    two-pole model of the function (exact value and slope on either side),
    kept inside a shrinking bracket.
    """
    m = len(d)
    right = np.append(d[1:], d[-1] + z2.sum())
    width = right - d
    gap = d[None, :] - d[:, None]  # [root, pole], seen from the left pole
    middle = 1 + (z2 / (gap - width[:, None] / 2)).sum(1)
    near = np.arange(m)
    near[:-1] += middle[:-1] < 0  # the root is in the right half
    shift = d[near]
    delta = d[None, :] - shift[:, None]
    low, high = d - shift, right - shift
    half = (low + high) / 2
    low, high = np.where(middle < 0, half, low), np.where(middle < 0, high, half)
    left_pole, right_pole = d - shift, right - shift
    x = (low + high) / 2
    below = np.tri(m)  # poles up to the one left of the root
    last = np.arange(m) == m - 1
    done = np.zeros(m, bool)
    for _ in range(STEPS):
        t = delta - x[:, None]
        q = z2 / t
        both, psi = q.sum(1), np.einsum("ij,ij->i", q, below)
        q /= t
        slope, dpsi = q.sum(1), np.einsum("ij,ij->i", q, below)
        value = 1 + both
        up = value < 0
        low, high = np.where(up & ~done, x, low), np.where(up | done, high, x)
        p, r = left_pole - x, right_pole - x
        dphi = np.where(last, 0, slope - dpsi)
        s, S = p * p * dpsi, r * r * dphi
        c = value - p * dpsi - r * dphi
        # the step y solves c + s / (p - y) + S / (r - y) = 0
        B, C = -(c * (p + r) + s + S), c * p * r + s * r + S * p
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(B * B - 4 * c * C, 0))
            y = np.where(last, p + s / c, np.where(B <= 0, 2 * C / (root - B), (-B - root) / (2 * c)))
        new = x + y
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        met = done | (np.abs(value) <= 1e-13 * (1 + 2 * np.abs(psi) + np.abs(both)))
        done = met | (np.abs(new - x) <= 4e-16 * np.abs(new)) | (new == low) | (new == high)
        x = np.where(met, x, new)
        if done.all():
            break
    return near, x


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of basis * diag(values) * basis' + v v'."""
    z = basis.T @ v
    scale = max(values[-1], 0.0) + z @ z
    if not scale > 0:
        return values, basis
    # deflate equal eigenvalues: turn the basis so that only one of them meets the vector
    tied = np.flatnonzero(np.diff(values) <= SMALL * len(values) * scale)
    if len(tied):
        basis, z = basis.copy(), z.copy()
        for i in tied:
            r = np.hypot(z[i], z[i + 1])
            if r > 0:
                c, s = z[i + 1] / r, z[i] / r
                basis[:, [i, i + 1]] = basis[:, [i, i + 1]] @ np.array([[c, s], [-s, c]])
                z[i], z[i + 1] = 0.0, r
    on = np.abs(z) > SMALL * np.sqrt(scale) * len(values)
    on[tied] = False
    if not on.any():
        return values, basis
    d, z2 = values[on], z[on] ** 2
    # tied runs leave equal neighbours only if deflated in between: keep the poles apart
    d = np.maximum.accumulate(d)
    near, x = secular_roots(d, z2)
    diff = (d[None, :] - d[near][:, None]) - x[:, None]  # pole - root
    # weights for which these are the exact roots (Loewner), so that the eigenvectors are orthogonal
    pole = d[None, :] - d[:, None]
    np.fill_diagonal(pole, -1.0)
    ratio = diff / pole.T  # [root, pole]: (d_j - x_i) / (d_j - d_i)
    weight = np.sqrt(np.abs(np.prod(ratio, 0))) * np.sign(z[on])
    turned = weight[None, :] / diff
    turned /= np.linalg.norm(turned, axis=1, keepdims=True)
    values, basis = values.copy(), basis.copy()
    values[on] = d[near] + x
    basis[:, on] = basis[:, on] @ turned.T
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


@dataclass
class Spectrum:
    """Count, mean, and the eigenpairs of the scatter matrix (sum of centred squares)."""
    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, width: int) -> Spectrum:
        return cls(0, np.zeros(width), np.zeros(width), np.eye(width))

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        self.values, self.basis = rank_one(self.values, self.basis, away * np.sqrt(self.n / (self.n + 1)))
        self.mean = self.mean + away / (self.n + 1)
        self.n += 1

    def join(self, other: Spectrum) -> None:
        """Take in another spectrum, one rank-one update for each of its eigenpairs and one for the means."""
        if not other.n:
            return
        for value, v in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, v * np.sqrt(value))
        away = other.mean - self.mean
        n = self.n + other.n
        self.values, self.basis = rank_one(self.values, self.basis, away * np.sqrt(self.n * other.n / n))
        self.mean = self.mean + away * (other.n / n)
        self.n = n

    def packed(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.values, self.basis.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes, width: int) -> Spectrum:
        a = np.frombuffer(data)
        return cls(int(a[0]), a[1: 1 + width].copy(), a[1 + width: 1 + 2 * width].copy(), a[1 + 2 * width:].reshape(width, width).copy())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of longs, padded as a zero entry would be."""
    lengths = np.diff(column.offsets.to_numpy())
    x = np.full((len(lengths), width), SHIFT, np.int64)
    x[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return x


def _spectra(batches, width: int):
    """The spectrum of a task's vectors."""
    found = Spectrum.empty(width)
    for batch in batches:
        for x in (_matrix(batch.column(0), width) - SHIFT).astype(float):
            found.add(x)
    if found.n:
        yield pa.RecordBatch.from_arrays([pa.array([found.packed()], pa.binary())], names=["spectrum"])


def _joined(batches, width: int):
    found = None
    for batch in batches:
        for data in batch.column(0).to_pylist():
            s = Spectrum.unpacked(data, width)
            if found is None:
                found = s
            else:
                found.join(s)
    if found is not None:
        yield pa.RecordBatch.from_arrays([pa.array([found.packed()], pa.binary())], names=["spectrum"])


def _outer(batches, width: int, mean: np.ndarray, basis: np.ndarray):
    """Sum over a task's vectors of y y', where y are their coordinates in the basis, centred before."""
    total = np.zeros((basis.shape[1],) * 2)
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            y = (_matrix(batch.column(0).slice(i, BLOCK), width) - SHIFT - mean) @ basis
            total += y.T @ y
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])


def _summed(batches):
    total = None
    for batch in batches:
        for data in batch.column(0).to_pylist():
            total = np.frombuffer(data) + (0 if total is None else total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])


def _down(rows: DataFrame, run, schema: str) -> bytes | None:
    """Combine rows in a tree of ``FAN_IN`` until one is left."""
    rows = stored(rows)
    n = rows.count()
    while n > 1:
        n = -(-n // FAN_IN)
        # rows are few and small; a number of their own deals them evenly
        rows = stored(rows.repartition(n).mapInArrow(run, schema))
        n = rows.count()
    first = rows.first()
    return None if first is None else bytes(first[0])


def integers(vector) -> F.Column:
    """The vector as longs, or null where it is null, or holds null, non-finite or huge entries."""
    wide = vector.cast("array<double>")
    bad = F.exists(wide, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) >= EXACT / GRID))
    return F.when(~bad, F.transform(wide, lambda e: F.floor(e * GRID) + SHIFT))


@dataclass
class Whitening:
    """What the fit gives; ``components`` are rows."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(distinct: DataFrame, most: int = 16) -> Whitening:
    """Fit on a stored table of distinct integer vectors (column ``x``)."""
    least, width = distinct.agg(F.coalesce(F.min(F.size("x")), F.lit(0)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if least < width:  # a short vector and its padded form are one
        padded = F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x")))
        distinct = stored(distinct.select(padded.alias("x")).distinct())
    none = Whitening(0, [0] * width, np.zeros(0), np.zeros((0, width)), np.zeros(0), 0.0)
    if not width:
        return none
    n, *exact = distinct.agg(F.count(F.lit(1)), *[F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")) for i in range(width)]).first()
    sums = [int(s) for s in exact]
    spectrum = _down(distinct.select("x").mapInArrow(lambda it: _spectra(it, width), "spectrum binary"), lambda it: _joined(it, width), "spectrum binary")
    found = Spectrum.unpacked(spectrum, width)
    basis = np.linalg.qr(found.basis[:, ::-1])[0]
    mean = np.array([(s - n * SHIFT) / n for s in sums])
    # Rayleigh-Ritz on the exact covariance
    part = _down(distinct.select("x").mapInArrow(lambda it: _outer(it, width, mean, basis), "part binary"), _summed, "part binary")
    values, turn = np.linalg.eigh(np.frombuffer(part).reshape(width, width) / n)
    values, vectors = values[::-1], (basis @ turn[:, ::-1]).T
    trace = values.sum()
    k = int((values[:most] > FLAT * max(values[0], 0)).sum()) if values[0] > 0 else 0
    if not k:
        return none
    vectors = vectors[:k] / np.linalg.norm(vectors[:k], axis=1, keepdims=True)
    sign = np.sign(vectors[np.arange(k), np.abs(vectors).argmax(1)])
    vectors = vectors * sign[:, None]
    scaled = (vectors / np.sqrt(values[:k])[:, None]).T
    part = _down(distinct.select("x").mapInArrow(lambda it: _outer(it, width, mean, scaled), "part binary"), _summed, "part binary")
    error = np.abs(np.frombuffer(part).reshape(k, k) / n - np.eye(k)).max()
    return Whitening(n, sums, values[:k], vectors, values[:k] / trace, float(error))


def _whitened(batches, model: Whitening):
    """All components of each vector: id, component, deviation, whitened value, explained share."""
    width, k = len(model.sums), len(model.values)
    mean = np.array([(s - model.n * SHIFT) / model.n for s in model.sums])
    scaled = (model.components / np.sqrt(model.values)[:, None]).T
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            x = _matrix(part.column(1), width)
            y = (x - SHIFT - mean) @ scaled
            far = int(np.abs(x - SHIFT).max(initial=0)) * model.n + max(abs(s - model.n * SHIFT) for s in model.sums)
            if far * far * width < 1 << 63:
                deviation = ((model.n * (x - SHIFT) - np.array([s - model.n * SHIFT for s in model.sums])) ** 2).sum(1).tolist()
            else:  # beyond 64 bits on the way
                s = np.array(model.sums, object)
                deviation = [v if v < 1 << 63 else None for v in ((model.n * x.astype(object) - s) ** 2).sum(1).tolist()]
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array([d for d in deviation for _ in range(k)], pa.int64()), pa.array(y.ravel()), pa.array(np.tile(model.explained, len(x)))],
                names=["row", "component", "deviation", "whitened", "explained"])


def whiten(vectors: DataFrame, keep: list[str], vector_col: str = "embedding", most: int = 16) -> DataFrame:
    """Whitened coordinates of every vector on the first ``most`` components.

    Vectors are taken as integers, floor(64 c) + 1000000; the fit counts each
    distinct one once.  Returns, for each vector and component (from 1, by
    falling eigenvalue, the largest entry of a component positive), ``row`` (a
    struct of the columns in ``keep``), ``component``, ``n`` (distinct
    vectors), ``deviation`` (sum over entries of (n x - S)^2, exact; null
    beyond a long), ``whitened``, ``explained`` and ``identity_error`` (the
    largest entry of the whitened covariance minus the identity, measured).

    Rows whose vector is null or holds null, non-finite or huge entries (2**46
    or more) are dropped.  Vectors of unequal length are padded with zeros;
    rows that repeat are rows of their own.  Components without variance
    (1e-11 of the largest eigenvalue or less) are left out, so one distinct
    vector, like an empty table, gives no rows.
    """
    x = integers(F.col(f"`{vector_col}`"))
    rows = vectors.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), x.alias("x")).filter("x IS NOT NULL")
    distinct = stored(rows.select("x").distinct())
    model = fit(distinct, most)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, component int, deviation long, whitened double, explained double"
    if not len(model.values):
        rows = rows.limit(0)
    get = shipped(vectors.sparkSession, model)
    out = rows.mapInArrow(lambda it: _whitened(it, get()), schema)
    return out.select("row", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(model.identity_error).alias("identity_error"))
