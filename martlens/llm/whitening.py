"""Embedding whitening: components of the covariance by spectral divide-and-conquer, applied to every row.

Entries become whole numbers first. The covariance is that of the distinct whole vectors (copies
are met by a partial aggregate before the shuffle), centred before multiplying: tasks add up outer
products of their batches, Spark adds the tasks' entries per matrix row. What reaches the driver is
d sums and a d x d matrix, whatever the number of rows.

There QDWH splits the matrix: dynamically weighted Halley steps turn the matrix less a shift into
its orthogonal polar factor U, (U + I) / 2 projects on the eigenvectors above the shift, and an
orthonormal basis of the projector's range and of its complement leaves two smaller matrices, which
are split in turn until one row is left (or a multiple of the identity, of which any basis is right).
Iterations and products are backward stable, so components have the residual of a dense solver.
The components, d x 16 numbers at most, are sent to the tasks, which whiten and write the rows.

Rows without a vector, with a null or non-finite entry, with no entry at all, or with an entry of
2^52 or more (whose whole number would not be exact) take no part and are not returned. Of vectors of
different lengths the most frequent length takes part, the longer of equally frequent ones. A
component without variance (eigenvalue under d * 2^-50 of the largest) can't be scaled and isn't returned: one distinct
vector alone gives no rows. Repeated rows are returned as often as they stand; an empty table gives no rows.
``deviation`` is exact; where it doesn't fit a long it is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.llm.common import mapped, written

SCALE, OFFSET = 64, 1_000_000
#: Entries from here on have no exact whole number.
LARGEST = float(1 << 52)
#: Sums of whole numbers are kept as high and low parts, so that longs hold them.
LOW_BITS = 26
COMPONENTS = 16
#: Numbers of a batch that a task works on at once.
SLICE_NUMBERS = 1 << 19


# ---------------------------------------------------------------- spectral divide-and-conquer
def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps.

    The bound on the least singular value starts at the rounding unit, which costs two steps more
    than a good estimate and needs none. Directions of smaller singular values are left undecided.
    """
    d = len(a)
    x, least, one = a / np.linalg.norm(a), np.finfo(float).eps, np.eye(d)
    for _ in range(12):
        squared = least * least
        cube = np.cbrt(4 * (1 - squared) / (squared * squared))
        root = np.sqrt(1 + cube)
        alpha = root + 0.5 * np.sqrt(8 - 4 * cube + 8 * (2 - squared) / (squared * root))
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        before = x
        if gamma > 100:  # ill-conditioned: by orthogonal factors of the stacked matrix
            q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, one]))
            x = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * q[:d] @ q[d:].T
        else:
            lower = np.linalg.cholesky(one + gamma * x.T @ x)
            half = np.linalg.solve(lower, x.T)
            x = beta / gamma * x + (alpha - beta / gamma) * np.linalg.solve(lower.T, half).T
        x = (x + x.T) / 2
        least = min(1.0, least * (alpha + beta * squared) / (1 + gamma * squared))
        if abs(1 - least) < 1e-15 and np.linalg.norm(x - before) < 1e-10:
            break
        least = min(least, 1 - 1e-16)
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthonormal basis whose first k columns span the eigenvectors of ``a`` above some shift; None if ``a`` is a multiple of the identity."""
    d = len(a)
    mean = np.trace(a) / d
    spread = np.linalg.norm(a - mean * np.eye(d))
    if spread <= 4 * d * np.finfo(float).eps * max(np.linalg.norm(a), np.finfo(float).tiny):
        return None
    rng = np.random.default_rng(d)
    best = None
    # the mean always has eigenvalues on both sides; the median of the diagonal splits more evenly
    for shift in (np.median(np.diag(a)), mean, *(mean + spread / d * s for s in (1e-3, -1e-3, 1e-2, -1e-2, 1e-1, -1e-1))):
        moved = a - shift * np.eye(d)
        if not np.linalg.norm(moved):
            continue
        sign = polar(moved)
        k = int(round((np.trace(sign) + d) / 2))
        if not 0 < k < d:
            continue
        above, below = (np.eye(d) + sign) / 2, (np.eye(d) - sign) / 2
        basis, _ = np.linalg.qr(np.hstack([above @ rng.standard_normal((d, k)), below @ rng.standard_normal((d, d - k))]))
        for _ in range(2):  # subspace iteration with the projectors
            basis, _ = np.linalg.qr(np.hstack([above @ basis[:, :k], below @ basis[:, k:]]))
        error = np.linalg.norm(basis[:, :k].T @ a @ basis[:, k:])
        if best is None or error < best[0]:
            best = error, basis, k
        if error <= 8 * d * np.finfo(float).eps * np.linalg.norm(a):
            break
    return best[1:] if best else None


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    a = (a + a.T) / 2
    todo, values, vectors = [(a, np.eye(len(a)))], [], []
    while todo:
        block, basis = todo.pop()
        halves = _split(block) if len(block) > 1 else None
        if halves is None:
            values.extend(np.diag(block))
            vectors.append(basis)
            continue
        q, k = halves
        for part in (q[:, :k], q[:, k:]):
            if part.shape[1]:
                inner = part.T @ block @ part
                todo.append(((inner + inner.T) / 2, basis @ part))
    values, vectors = np.array(values), np.hstack(vectors) if vectors else np.zeros((0, 0))
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---------------------------------------------------------------- distributed moments
def _whole(column: pa.Array, d: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their whole vectors) of a list column; ``d``: their length (None: lengths only)."""
    column = column.cast(pa.list_(pa.float64()))
    sizes = np.diff(column.offsets.to_numpy())
    ok = np.array(column.is_valid()) & (sizes > 0)
    if d is not None:
        ok &= sizes == d
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros((0, d or 0), np.int64)
    flat = column.filter(pa.array(ok)).flatten()
    entries = flat.to_numpy(zero_copy_only=False)  # null: nan
    fine = np.isfinite(entries) & (np.abs(entries) < LARGEST)
    sizes = sizes[ok]
    fine = np.add.reduceat(fine, np.cumsum(sizes) - sizes) == sizes
    rows = np.flatnonzero(ok)[fine]
    if d is None:
        return rows, sizes[fine]
    whole = np.floor(SCALE * entries.reshape(-1, d)[fine]).astype(np.int64) + OFFSET
    return rows, whole


def _blocks(batch: pa.RecordBatch, d: int) -> Iterator[pa.RecordBatch]:
    step = max(1, SLICE_NUMBERS // d)
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def _unpacked(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n: whole numbers until the division, as longs where they fit and as Python's elsewhere."""
    return _scaled(x, n, sums).astype(np.float64) / n


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly."""
    top = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    return x * n - np.array(sums, np.int64) if top < 1 << 62 else x.astype(object) * n - np.array(sums, object)


def _deviation(scaled: np.ndarray) -> list[int | None]:
    d = scaled.shape[1]
    if scaled.dtype != object and int(np.abs(scaled).max(initial=0)) ** 2 * d < 1 << 63:
        return (scaled * scaled).sum(1).tolist()
    exact = (scaled.astype(object) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in exact]


class Fit:
    """n, exact sums, and the components that have variance: what the tasks are sent."""

    def __init__(self, d: int, n: int, sums: list[int]):
        self.d, self.n, self.sums = d, n, sums
        self.vectors, self.values, self.trace = np.zeros((d, 0)), np.zeros(0), 0.0
        self.identity_error = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.vectors / np.sqrt(self.values))


def _matrix(fit: DataFrame, values, width: int, n: int) -> np.ndarray:
    """Sum over the fit list of the outer products of ``values(batch)`` (rows x width), divided by n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((width, width)), False
        for batch in batches:
            for part in _blocks(batch, width):
                y = values(part)
                total += y.T @ y
                any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), width)), pa.array(np.tile(np.arange(width), width)), pa.array(total.ravel())], ["i", "j", "v"])

    sums = mapped(fit, run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    for r in sums.toLocalIterator():
        out[r["i"], r["j"]] = r["v"]
    return out / n


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """Components of the distinct whole vectors of ``df``; None if no row takes part."""
    rows = df.select(F.col(vector).cast("array<double>").alias("v"))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, many = np.unique(_whole(batch.column(0), None)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(many, pa.int64())], ["d", "many"])

    most = mapped(rows, lengths, "d long, many long").groupBy("d").agg(F.sum("many").alias("many")).orderBy(F.desc("many"), F.desc("d")).first()
    if most is None:
        return None
    d = most["d"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch, d):
                x = _whole(part.column(0), d)[1].astype("<i8")
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * d), len(x), [None, pa.py_buffer(x.tobytes())])
                yield pa.RecordBatch.from_arrays([raw.cast(pa.binary())], ["x"])

    distinct = written(mapped(rows, packed, "x binary").distinct(), "whitening-fit")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for batch in batches:
            for part in _blocks(batch, d):
                x = _unpacked(part, d)
                high, low, n = high + (x >> LOW_BITS).sum(0), low + (x & ((1 << LOW_BITS) - 1)).sum(0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(high), pa.array(low), pa.array(np.full(d, n))], ["j", "high", "low", "n"])

    totals = mapped(distinct, sums, "j long, high long, low long, n long").groupBy("j").agg(F.sum("high"), F.sum("low"), F.sum("n")).orderBy("j").collect()
    out = Fit(d, totals[0][3], [(t[1] << LOW_BITS) + t[2] for t in totals])
    n, s = out.n, out.sums
    covariance = _matrix(distinct, lambda part: centred(_unpacked(part, d), n, s), d, n)
    values, vectors = eigenvectors(covariance)
    used = min(components, int((values > d * 2.0**-50 * max(values[0], 0)).sum()))
    out.trace = float(np.trace(covariance))
    out.values, out.vectors = values[:used].copy(), vectors[:, :used].copy()
    if used:
        # the whitened fit list has no mean but rounding: one pass for it, one centred pass
        def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(used)
            for batch in batches:
                for part in _blocks(batch, d):
                    total += out.whitened(_unpacked(part, d)).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(used)), pa.array(total)], ["j", "v"])

        mean = np.zeros(used)
        for r in mapped(distinct, means, "j long, v double").groupBy("j").agg(F.sum("v").alias("v")).collect():
            mean[r["j"]] = r["v"] / n
        white = _matrix(distinct, lambda part: out.whitened(_unpacked(part, d)) - mean, used, n)
        out.identity_error = float(np.abs(white - np.eye(used)).max())
    return out


def whiten(df: DataFrame, model: Fit | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, component (from 1), n, deviation, whitened, explained and identity_error of each row that takes part and each component."""
    rows = df.select(F.col(key).alias("__key"), F.col(vector).cast("array<double>").alias("__vector"))
    fields = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
              ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
    schema = T.StructType([T.StructField(key, rows.schema["__key"].dataType), *[T.StructField(c, t) for c, t in fields]])
    used = 0 if model is None else len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not used:
                continue
            for part in _blocks(batch, model.d):
                at, x = _whole(part.column(1), model.d)
                if not len(at):
                    continue
                deviation = pa.array(_deviation(_scaled(x, model.n, model.sums)), pa.int64())
                times, size = np.repeat(np.arange(len(at)), used), len(at) * used
                explained = np.tile(model.values / model.trace, len(at))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at[times])), pa.array(np.tile(np.arange(1, used + 1, dtype=np.int32), len(at))), pa.array(np.full(size, model.n)),
                     deviation.take(pa.array(times)), pa.array(model.whitened(x).ravel()), pa.array(explained), pa.array(np.full(size, model.identity_error))],
                    [key, *[c for c, _ in fields]])

    return mapped(rows, run, schema)
