"""Whitening of embeddings by incremental eigendecomposition.

Every partition keeps the spectrum of the vectors it has seen (mean, eigenvalues and eigenvectors
of their scatter). A vector is one centred rank-one update: the scatter gains
n / (n + 1) * (x - mean)(x - mean)', whose new eigenvalues are the roots of a secular equation.
Directions that the update does not touch, and all but one of the directions of equal eigenvalues,
are deflated first. Spectra are combined in rounds of `FAN`: the smaller side's eigenvectors, and the
difference of the means, are further rank-one updates of the larger one.

The basis so found only has to be near. A last distributed pass projects the exactly centred
vectors on it and sums their products (Rayleigh-Ritz); the Ritz vectors of that matrix are
the components, so rounding in some billions of updates leaves no trace.

Vectors that are null or empty or hold null or non-finite entries are dropped. So are vectors whose
length is not the most frequent one (the longer among equals), since one covariance has one
length. Rows repeated, with or without the same id, count as often as they occur. Components without
variance cannot be whitened and have no rows: an empty table, a single vector, or copies of one vector
give none. A deviation beyond 64 bits is null. Columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.sources.tables import durable

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
FAN = 16
ROWS = 1024
#: Eigenvalues below this part of the trace are rounding, not variance.
FLAT = 1e-13
LIMIT = float(1 << 53)
EPS = np.finfo(float).eps


@dataclass
class Spectrum:
    """`n` vectors with their mean, and the eigenvalues (rising) and eigenvectors of their scatter."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        """One centred rank-one update."""
        away = x - self.mean
        self.values, self.vectors = rank_one(
            self.values, self.vectors, away * np.sqrt(self.n / (self.n + 1))
        )
        self.n += 1
        self.mean = self.mean + away / self.n

    def combine(self, other: Spectrum) -> Spectrum:
        big, small = (self, other) if self.n >= other.n else (other, self)
        if not small.n:
            return big
        values, vectors = big.values, big.vectors
        n, away = big.n + small.n, small.mean - big.mean
        for value, vector in zip(small.values, small.vectors.T):
            if value > 0:
                values, vectors = rank_one(values, vectors, vector * np.sqrt(value))
        values, vectors = rank_one(values, vectors, away * np.sqrt(big.n / n * small.n))
        return Spectrum(n, big.mean + away * (small.n / n), values, vectors)


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - x)), one above each pole.

    Poles rise strictly and weights are positive. A root is returned as its nearest pole and its
    distance from it, which keeps differences between roots and poles accurate.
    Steps interpolate the function by one pole on each side; a step that leaves the interval known to
    hold the root is replaced by its middle.
    """
    k = len(poles)
    at = np.arange(k)
    total = weights.sum()
    gap = np.append(np.diff(poles), total)
    middle = poles + gap / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        halfway = 1 + (weights / (poles - middle[:, None])).sum(axis=1)
        base = np.where((halfway < 0) & (at < k - 1), at + 1, at)
        low = np.where(base == at, 0.0, -gap / 2)
        high = np.where(base == at, np.where(at < k - 1, gap / 2, gap), 0.0)
        delta = poles - poles[base][:, None]
        left = at <= at[:, None]
        own, following = delta[at, at], delta[at, np.minimum(at + 1, k - 1)]
        last = at == k - 1
        step = (low + high) / 2
        for _ in range(64):
            away = delta - step[:, None]
            terms = weights / away
            slopes = terms / away
            f = 1 + terms.sum(axis=1)
            size = 1 + np.abs(terms).sum(axis=1)
            done = (np.abs(f) <= 2 * EPS * size) | (high - low <= 2 * EPS * np.abs(step))
            if done.all():
                break
            low, high = np.where(f < 0, step, low), np.where(f > 0, step, high)
            psi = np.where(left, slopes, 0).sum(axis=1)
            phi = slopes.sum(axis=1) - psi
            d1, d2 = own - step, following - step
            a = (d1 + d2) * f - d1 * d2 * (psi + phi)
            b = d1 * d2 * f
            c = f - d1 * psi - d2 * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            move = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # Above the last pole there is none to interpolate with.
            move = np.where(last, d1 + psi * d1 * d1 / (f - psi * d1), move)
            tried = step + move
            inside = (tried > low) & (tried < high)
            step = np.where(done, step, np.where(inside, tried, (low + high) / 2))
    return base, step


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of vectors @ diag(values) @ vectors.T + x x'."""
    z = vectors.T @ x
    length = np.linalg.norm(z)
    if not length:
        return values, vectors
    tolerance = 8 * EPS * max(abs(values[-1]), length * length)
    used = np.flatnonzero(np.abs(z) * length > tolerance)
    if not len(used):
        return values, vectors
    values = values.copy()
    first, second = z[used[:-1]], z[used[1:]]
    overlap = np.abs(first * second) / (first * first + second * second)
    equal = bool((np.diff(values[used]) * overlap <= tolerance).any())
    if equal:
        # Turn equal eigenvalues' directions until the update touches one of them only.
        vectors = vectors.copy()
        keep, held = [], used[0]
        for i in used[1:]:
            r = np.hypot(z[held], z[i])
            c, s = z[i] / r, z[held] / r
            if (values[i] - values[held]) * abs(c * s) <= tolerance:
                z[i], z[held] = r, 0.0
                first, second = vectors[:, held].copy(), vectors[:, i].copy()
                vectors[:, held], vectors[:, i] = c * first - s * second, s * first + c * second
                d1, d2 = values[held], values[i]
                values[held], values[i] = c * c * d1 + s * s * d2, s * s * d1 + c * c * d2
            else:
                keep.append(held)
            held = i
        used = np.array([*keep, held])
        used = used[np.argsort(values[used], kind="stable")]
    poles, part = values[used], z[used]
    base, step = secular_roots(poles, part * part)
    # Rows are poles, columns are roots: root - pole.
    away = (poles[base][None, :] - poles[:, None]) + step[None, :]
    away[away == 0] = np.finfo(float).tiny
    # The update that has exactly these roots; its eigenvectors are orthogonal to rounding.
    spread = poles[None, :] - poles[:, None]
    np.fill_diagonal(spread, 1.0)
    ratio = away / spread
    own = np.diagonal(away).copy()
    np.fill_diagonal(ratio, 1.0)
    z_hat = np.sqrt(np.abs(own * np.prod(ratio, axis=1))) * np.sign(part)
    turned = z_hat[:, None] / away
    turned /= np.linalg.norm(turned, axis=0)
    values[used] = poles[base] + step
    if len(used) == len(values):
        vectors = vectors[:, used] @ turned
        values = values[used]
    else:
        if not equal:
            vectors = vectors.copy()
        vectors[:, used] = vectors[:, used] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


# ---- distributed passes ----------------------------------------------------------------------


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(SCALE * c) + SHIFT for each entry, as a matrix of long."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    # Beyond 53 bits a float has no finer parts left; the limit keeps it within a long.
    whole = np.clip(np.floor(SCALE * flat), -LIMIT, LIMIT)
    return whole.astype(np.int64).reshape(-1, dim) + SHIFT


def _slices(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            rows = batch.slice(start, ROWS)
            yield rows, integers(rows.column("embedding"), dim)


def _sums(dim: int):
    """Exact sums of each dimension over one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for _, x in _slices(batches, dim):
            small = np.abs(x).max() < 1 << 52
            own = x.sum(axis=0) if small else x.astype(object).sum(axis=0)
            total = [t + int(v) for t, v in zip(total, own)]
        sums = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), sums], ["pos", "s"])

    return run


_SPECTRUM = "part long, n long, mean array<double>, eigen array<double>, vectors array<double>"


def _row(part: int, s: Spectrum) -> pa.RecordBatch:
    doubles = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int64()),
            pa.array([s.n], pa.int64()),
            *(pa.array([v.ravel().tolist()], doubles) for v in (s.mean, s.values, s.vectors)),
        ],
        ["part", "n", "mean", "eigen", "vectors"],
    )


def _update(dim: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Spectrum.empty(dim)
        for _, x in _slices(batches, dim):
            for v in x.astype(float):
                seen.add(v)
        if seen.n:
            yield _row(TaskContext.get().partitionId(), seen)

    return run


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal `part`, which follow each other, to one."""
    part, held = None, None
    for batch in batches:
        for i in range(len(batch)):
            r = batch.slice(i, 1).to_pylist()[0]
            dim = len(r["mean"])
            own = Spectrum(
                r["n"],
                np.array(r["mean"]),
                np.array(r["eigen"]),
                np.array(r["vectors"]).reshape(dim, dim),
            )
            if held is not None and part == r["part"]:
                held = held.combine(own)
            else:
                if held is not None:
                    yield _row(part, held)
                part, held = r["part"], own
    if held is not None:
        yield _row(part, held)


def spectrum(vectors: DataFrame, dim: int) -> Spectrum:
    """The spectrum of all vectors: one of each task, then combined `FAN` at a time.

    A round's table has a row of dim * dim numbers for each group; only the last row comes to the driver.
    """
    table = durable(vectors.mapInArrow(_update(dim), _SPECTRUM))
    while table.count() > 1:
        place = F.floor(F.col("part") / FAN).cast("long")
        table = durable(
            table.withColumn("part", place)
            .repartition("part")
            .sortWithinPartitions("part", "n")
            .mapInArrow(_combine, _SPECTRUM)
        )
    r = table.first()
    if r is None:
        return Spectrum.empty(dim)
    return Spectrum(
        r["n"], np.array(r["mean"]), np.array(r["eigen"]), np.array(r["vectors"]).reshape(dim, dim)
    )


def _products(mean: np.ndarray, basis: np.ndarray):
    """Per task: sums of the projections on `basis` and of their products, by place.

    `mean` is S / n in two parts, so that centring is exact to rounding.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = basis.shape[1]
        sums = np.zeros(k * k + k)
        for _, x in _slices(batches, len(basis)):
            y = _centred(x, mean) @ basis
            sums[: k * k] += (y.T @ y).ravel()
            sums[k * k :] += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(sums)), pa.int32()), pa.array(sums)], ["pos", "s"]
        )

    return run


def _centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return (x - mean[0].astype(np.int64)).astype(float) - mean[1]


def products(vectors: DataFrame, n: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance of the projections, divisor n."""
    k = basis.shape[1]
    rows = vectors.mapInArrow(_products(mean, basis), "pos int, s double")
    total = np.zeros(k * k + k)
    for r in rows.groupBy("pos").agg(F.sum("s").alias("s")).collect():
        total[r["pos"]] = r["s"]
    average = total[k * k :] / n
    return total[: k * k].reshape(k, k) / n - np.outer(average, average)


@dataclass
class Whitening:
    """What `apply` needs: counts, exact sums, components (columns) and their eigenvalues."""

    dim: int
    n: int
    sums: list[int]
    mean: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors that are whole and finite."""
    x = F.col("embedding")
    whole = (F.size(x) > 0) & F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    )
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(
        F.coalesce(whole, F.lit(False))
    )


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn the whitening of `vectors` (all usable ones of the most frequent length)."""
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return None
    dim, n = most["dim"], most["n"]
    x = rows.filter(F.size("embedding") == dim).select("embedding")
    sums = [0] * dim
    for r in x.mapInArrow(_sums(dim), "pos int, s decimal(38,0)").groupBy("pos").agg(
        F.sum("s").alias("s")
    ).collect():
        sums[r["pos"]] = int(r["s"])
    whole = [s // n for s in sums]
    mean = np.array([whole, [(s - w * n) / n for s, w in zip(sums, whole)]])
    near = spectrum(x, dim)
    basis = np.linalg.qr(near.vectors[:, ::-1])[0]
    ritz = products(x, n, mean, basis)
    values, turned = np.linalg.eigh((ritz + ritz.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(ritz))
    order = order[values[order] > FLAT * max(trace, 0.0)]
    kept = (basis @ turned)[:, order]
    # One sign for all rows and every run: the entry largest in size is positive.
    if len(order):
        kept = kept * np.sign(kept[np.abs(kept).argmax(axis=0), np.arange(len(order))])
    scale = np.sqrt(values[order])
    white = products(x, n, mean, kept / scale) if len(order) else np.zeros((0, 0))
    error = float(np.abs(white - np.eye(len(order))).max()) if len(order) else 0.0
    return Whitening(dim, n, sums, mean, kept, values[order], trace, error)


def _whiten(w: Whitening):
    names = "vec_id component n deviation whitened explained identity_error".split()
    by = (w.components / np.sqrt(w.values)).copy()
    explained = w.values / w.trace
    k = len(w.values)
    exact = np.array(w.sums, dtype=object)
    fits = max(map(abs, w.sums), default=0) < 1 << 62

    def deviations(x: np.ndarray) -> list[int | None]:
        if fits and np.abs(x).max() < (1 << 61) // max(w.n, 1):
            own = w.n * x - np.array(w.sums, dtype=np.int64)
            if float(np.abs(own).max()) ** 2 * w.dim < 2.0**62:
                return (own * own).sum(axis=1).tolist()
        own = w.n * x.astype(object) - exact
        return [v if v < 1 << 63 else None for v in (own * own).sum(axis=1).tolist()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _slices(batches, w.dim):
            y = _centred(x, w.mean) @ by
            m = len(x)
            each = lambda v: np.repeat(v, k)
            index = pa.array(each(np.arange(m)))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("vec_id").take(index),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n, np.int64)),
                    pa.array(deviations(x), pa.int64()).take(index),
                    pa.array(y.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, w.identity_error)),
                ],
                names,
            )

    return run


def apply(vectors: DataFrame, w: Whitening | None) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable
    vector and component."""
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    if w is None or not len(w.values):
        return vectors.sparkSession.createDataFrame([], schema)
    rows = usable(vectors).filter(F.size("embedding") == w.dim)
    return rows.mapInArrow(_whiten(w), schema)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    return apply(vectors, fit(vectors, components))
