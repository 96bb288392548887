"""Whitening of embeddings by Jacobi-Davidson on distributed products.

Entries become whole numbers, so equal vectors, sums and deviations are exact. The fit list (each
vector once) is written in packed blocks. Nothing of the covariance is ever formed: one pass over the
blocks multiplies it with a few vectors, centring every row before. The driver holds only what has
the vectors' dimension: the search space, its products, the locked eigenvectors.

Each round solves the projected problem of the search space (Rayleigh-Ritz), locks the leading
vectors whose residual is down to rounding, and widens the space by corrections of the others: the
correction equations, projected away from locked and current vectors, are solved by MINRES, all of
them together, so an inner step is one pass. A space that grows too wide is restarted with its best
vectors. The locked vectors go through a last Rayleigh-Ritz step with fresh products.

Defined results: a vector that is null, empty, or holds a null or non-finite entry takes no part,
neither does one with an entry beyond 2^56, whose whole number a long can't hold, nor one of another
length than most rows have (ties: the longer). A component whose eigenvalue is zero to double
precision can't be whitened and is left out; with all vectors equal there is none, so there is no
row. Repeated rows come out alike and count once in the fit; a deviation that passes a long is null;
a null vec_id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapidar.llm.common import written

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 62)
COMPONENTS = 16
WIDEST = 6  # search space, as a multiple of the components
SPARE = 4  # more start vectors than components
INNER_STEPS, INNER_TOLERANCE = 6, 0.05
OUTER_ROUNDS = 200
CONVERGED = 16 * np.finfo(float).eps  # of the largest eigenvalue
STALLED = 3  # rounds without a smaller residual, near CONVERGED
BLOCK_BYTES = 1 << 20
ROWS = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double"
)


# -- whole numbers and blocks ----------------------------------------------------------


def whole(batch: pa.RecordBatch, name: str, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their entries as whole numbers without SHIFT: (rows, length)."""
    lists = batch.column(name)
    right = np.asarray(lists.value_lengths().fill_null(-1)) == length
    entries = lists.filter(pa.array(right)).flatten()
    c = np.floor(SCALE * entries.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length))  # a null is NaN
    fine = (np.abs(c) <= LARGEST).all(axis=1)
    right[right] = fine
    return right, c[fine].astype(np.int64)


def _narrowest(x: np.ndarray) -> np.ndarray:
    """Bytes of an entry that each row needs."""
    most = np.maximum(x.max(axis=1), -1 - x.min(axis=1))
    return np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)


def _keys(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each vector as one value: the bytes of an entry, then the entries. Equal values are equal vectors."""
    for batch in batches:
        _, x = whole(batch, "embedding", length)
        if not len(x):
            continue
        need = _narrowest(x)
        for size in np.unique(need):
            rows = x[need == size].astype(f"<i{size}")
            values = [bytes([size]) + r.tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["key"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors whose entries need as many bytes."""
    held: dict[int, list[bytes]] = {}

    def out(size: int) -> pa.RecordBatch:
        packed = pa.array([b"".join(held.pop(size))], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), packed], names=["size", "entries"])

    for batch in batches:
        for key in batch.column("key").to_pylist():
            rows = held.setdefault(key[0], [])
            rows.append(key[1:])
            if len(rows) * len(key) >= BLOCK_BYTES:
                yield out(key[0])
    for size in list(held):
        yield out(size)


def _rows_of(batch: pa.RecordBatch, length: int) -> Iterator[np.ndarray]:
    for size, entries in zip(batch.column("size").to_pylist(), batch.column("entries").to_pylist(), strict=True):
        yield np.frombuffer(entries, dtype=f"<i{size}").reshape(-1, length).astype(np.int64)


@dataclass(frozen=True)
class FitList:
    """The distinct vectors: written blocks, their number, and the mean as whole part and rest over n."""

    blocks: DataFrame
    length: int
    n: int
    mean: np.ndarray  # the whole part, without SHIFT
    rest: np.ndarray  # sums minus n times mean: 0 to n - 1

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows minus the mean; the difference of whole parts is exact."""
        return (x - self.mean) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; None beyond a long."""
        d = x - self.mean
        if len(d) and (int(np.abs(d).max()) + 1) ** 2 * self.n**2 * self.length < 1 << 63:
            return ((d * self.n - self.rest) ** 2).sum(axis=1).tolist()
        sums = [sum((int(a) * self.n - int(r)) ** 2 for a, r in zip(row, self.rest, strict=True)) for row in d]
        return [s if s < 1 << 63 else None for s in sums]

    def summed(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """Sum over all blocks of ``of`` (centred rows to ``size`` numbers): one pass, added up by Spark."""
        length, centred = self.length, self.centred_rows()

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                for x in _rows_of(batch, length):
                    total += of(centred(x))
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["slot", "value"])

        slots = self.blocks.mapInArrow(sums, "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(size)
        out[slots.column("slot").to_numpy()] = slots.column("value").to_numpy()
        return out

    def centred_rows(self) -> Callable[[np.ndarray], np.ndarray]:
        """``centred`` without the frame, for tasks."""
        mean, rest = self.mean, self.rest / self.n
        return lambda x: (x - mean) - rest

    def product(self, v: np.ndarray) -> np.ndarray:
        """Covariance times the columns of v."""
        shape = v.shape
        return self.summed(lambda c: (c.T @ (c @ v)).ravel(), v.size).reshape(shape) / self.n


def fit_list(vectors: DataFrame) -> FitList | None:
    """The fit list of a frame with the column embedding; None without any row."""
    lengths = vectors.where("size(embedding) > 0").groupBy(F.size("embedding").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if most is None:
        return None
    length = most["length"]
    keys = vectors.select("embedding").mapInArrow(lambda it: _keys(it, length), "key binary").distinct()
    blocks = written(keys.mapInArrow(_blocks, "size int, entries binary"), "whitening")

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """n in slot -1, and the sums of each dimension's upper and lower halves."""
        n, high, low = 0, np.zeros(length, np.int64), np.zeros(length, np.int64)
        for batch in batches:
            for x in _rows_of(batch, length):
                n += len(x)
                high += (x >> 32).sum(axis=0)
                low += (x & 0xFFFFFFFF).sum(axis=0)
        slots = pa.array(np.arange(-1, length, dtype=np.int32))
        columns = [slots, pa.array(np.append(0, high)), pa.array(np.append(n, low))]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    sums = blocks.mapInArrow(halves, "slot int, high long, low long").groupBy("slot").agg(wide("high"), wide("low")).collect()
    totals = {r["slot"]: (int(r["high"]) << 32) + int(r["low"]) for r in sums}
    if not totals.get(-1):
        return None
    n = totals[-1]
    mean, rest = zip(*(divmod(totals[i], n) for i in range(length)), strict=True)
    return FitList(blocks, length, n, np.array(mean, np.int64), np.array(rest, np.int64))


# -- Jacobi-Davidson -------------------------------------------------------------------


def _orthonormal(v: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of v add to the spaces of ``against``."""
    scale = np.linalg.norm(v, axis=0)
    v = v[:, scale > 0] / scale[scale > 0]
    for _ in range(3):
        for q in against:
            v = v - q @ (q.T @ v)
        if not v.shape[1]:
            return v
        u, s, _ = np.linalg.svd(v, full_matrices=False)
        v = u[:, s > 1e-10]
    return v


def minres(product: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of one symmetric system for each column of b, a product of all columns each step."""
    beta = np.linalg.norm(b, axis=0)
    first, x = np.where(beta > 0, beta, 1.0), np.zeros_like(b)
    v, before = b / first, np.zeros_like(b)
    w, w_before = np.zeros_like(b), np.zeros_like(b)
    cos, sin, cos_before, sin_before = (np.full(b.shape[1], value) for value in (1.0, 0.0, 1.0, 0.0))
    rest, beta = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        p = product(v) - beta * before
        alpha = np.sum(v * p, axis=0)
        p -= alpha * v
        beta_next = np.linalg.norm(p, axis=0)
        # the last two rotations, then the new one
        epsilon, middle = sin_before * beta, cos_before * beta
        delta, top = cos * middle + sin * alpha, -sin * middle + cos * alpha
        gamma = np.hypot(top, beta_next)
        safe = np.where(gamma > 0, gamma, 1.0)
        cos_before, sin_before, cos, sin = cos, sin, top / safe, beta_next / safe
        w, w_before = (v - delta * w - epsilon * w_before) / safe, w
        x += np.where(gamma > 0, cos * rest, 0.0) * w
        rest = -sin * rest
        if np.all(np.abs(rest) <= tolerance * first):
            break
        before, v = v, p / np.where(beta_next > 0, beta_next, 1.0)
        beta = beta_next
    return x


def leading(product: Callable[[np.ndarray], np.ndarray], length: int, wanted: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix known by products."""
    wanted = min(wanted, length)
    locked = np.zeros((length, 0))
    space = _orthonormal(np.random.default_rng(seed).standard_normal((length, min(length, wanted + SPARE))))
    images = product(space)
    largest, best, stalled = 0.0, np.inf, 0
    for _ in range(OUTER_ROUNDS):
        values, turn = np.linalg.eigh((space.T @ images + images.T @ space) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        largest = max(largest, float(values[0]))
        missing = wanted - locked.shape[1]
        away = images[:, :missing] - space[:, :missing] * values[:missing]
        away -= locked @ (locked.T @ away)
        size = np.linalg.norm(away, axis=0)
        limit = CONVERGED * largest
        # rounding in the products can keep a residual a little above the limit
        stalled = stalled + 1 if size.max() >= best / 2 and size.max() <= 100 * limit else 0
        best = min(best, float(size.max()))
        done = size <= limit
        if space.shape[1] + locked.shape[1] == length or stalled >= STALLED:
            done[:] = True
        lock = len(done) if done.all() else int(np.argmin(done))
        if lock:
            locked = _joined(locked, space[:, :lock])
            space, images, away, values = space[:, lock:], images[:, lock:], away[:, lock:], values[lock:]
            best, stalled = np.inf, 0
            if locked.shape[1] >= wanted:
                break
            missing -= lock
        kept = np.concatenate([locked, space[:, :missing]], axis=1)
        shift = values[:missing]
        project = lambda t, kept=kept: t - kept @ (kept.T @ t)

        def corrected(t: np.ndarray, shift=shift, project=project) -> np.ndarray:
            t = project(t)
            return project(product(t) - t * shift)

        correction = minres(corrected, project(-away), INNER_STEPS, INNER_TOLERANCE)
        if space.shape[1] + missing > WIDEST * wanted:
            space, images = space[:, : missing + wanted], images[:, : missing + wanted]
        new = _orthonormal(project(correction), locked, space)
        if not new.shape[1]:  # rounding alone is left; any other direction is as good
            new = _orthonormal(np.random.default_rng(seed + 1).standard_normal((length, missing)), locked, space)
        new = new[:, : length - locked.shape[1] - space.shape[1]]
        space, images = np.concatenate([space, new], axis=1), np.concatenate([images, product(new)], axis=1)
    else:
        locked = _joined(locked, space[:, : wanted - locked.shape[1]])
    fresh = product(locked)
    values, turn = np.linalg.eigh((locked.T @ fresh + fresh.T @ locked) / 2)
    vectors = locked @ turn[:, ::-1]
    return values[::-1], vectors / np.linalg.norm(vectors, axis=0)


def _joined(locked: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Locked vectors and new ones, orthonormal to rounding."""
    new = new - locked @ (locked.T @ new)
    return np.linalg.qr(np.concatenate([locked, new], axis=1))[0]


# -- whitening -------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    fit: FitList
    values: np.ndarray
    vectors: np.ndarray  # unit columns
    trace: float
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components and how far the whitened covariance is from the identity; None without a component."""
    fit = fit_list(vectors)
    if fit is None:
        return None
    trace = float(fit.summed(lambda c: np.array([np.square(c).sum()]), 1)[0] / fit.n)
    if trace <= 0:
        return None
    values, found = leading(fit.product, fit.length, components)
    kept = values > fit.length * np.finfo(float).eps * values[0]
    values, found = values[kept], found[:, kept]
    k, projection = len(values), found / np.sqrt(values)

    def moments(c: np.ndarray) -> np.ndarray:
        w = c @ projection
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    sums = fit.summed(moments, k + k * k) / fit.n
    error = sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)
    return Whitening(fit, values, found, trace, float(np.abs(error).max()))


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """ROWS: one for each row that takes part and component. ``vectors``: vec_id, embedding."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    model = fitted(rows, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], ROWS)
    # what the tasks take along: arrays of the vectors' dimension
    fit = FitList(None, model.fit.length, model.fit.n, model.fit.mean, model.fit.rest)
    values, projection, error, trace = model.values, model.projection, model.identity_error, model.trace
    names = [c.split()[0] for c in ROWS.split(", ")]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            right, x = whole(batch, "embedding", fit.length)
            n = len(x)
            out = fit.centred(x) @ projection
            ids = batch.column("vec_id").filter(pa.array(right))
            repeat = pa.array(np.repeat(np.arange(n), k))
            columns = [
                ids.take(repeat),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.full(n * k, fit.n, dtype=np.int64)),
                pa.array(fit.deviation(x), pa.int64()).take(repeat),
                pa.array(out.ravel()),
                pa.array(np.tile(values / trace, n)),
                pa.array(np.full(n * k, error)),
                pa.array(np.tile(values, n)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(projected, ROWS)
