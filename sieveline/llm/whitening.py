"""Embedding whitening: principal components by block Lanczos that never forms a covariance matrix.

The covariance is applied, not built: a pass over the fit list centres each vector, multiplies it with a block of directions and
adds up ``Xᵀ(Xv)`` per dimension, so that a pass moves dimensions times block numbers, however many rows there are. The driver
holds the basis only: dimensions times at most ``basis`` numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from sieveline.llm.common import Scratch

#: Rows of one multiplication: a matrix of so many numbers at most.
NUMBERS = 1 << 21


def _vectors(column: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the vectors that take part, and their integer components."""
    at, found = [], []
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    bounds, flat, null = column.offsets.to_numpy(), column.values, column.is_null().to_numpy(zero_copy_only=False)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    missing = flat.is_null().to_numpy(zero_copy_only=False) | ~np.isfinite(values)
    before = np.concatenate([[0], np.cumsum(missing)])
    for i in np.flatnonzero(~null & (before[bounds[1:]] == before[bounds[:-1]])):
        x = np.floor(scale * values[bounds[i] : bounds[i + 1]])
        if len(x) and np.abs(x).max() >= 2.0**63:
            raise ValueError(f"a component times {scale} doesn't fit 64 bits")
        at.append(i)
        found.append(x.astype(np.int64))
    return np.array(at, np.int64), found


def integer_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """``x``: the components of every vector that takes part, as little-endian 64-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found = _vectors(batch.column(0), scale)
            yield pa.RecordBatch.from_pydict({"x": pa.array([x.astype("<i8").tobytes() for x in found], pa.binary())})

    return embeddings.mapInArrow(read, "x binary")


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """Vectors of a stream as integer matrices of ``d`` columns; shorter vectors end in zeros."""
    rows = max(1, NUMBERS // max(1, d))
    for batch in batches:
        column = batch.column(0)
        for start in range(0, len(column), rows):
            part = column.slice(start, rows).to_pylist()
            if all(len(x) == 8 * d for x in part):
                yield np.frombuffer(b"".join(part), "<i8").reshape(len(part), d)
                continue
            out = np.zeros((len(part), d), np.int64)
            for i, x in enumerate(part):
                out[i, : len(x) // 8] = np.frombuffer(x, "<i8")
            yield out


def _sums(batches: Iterator[pa.RecordBatch], d: int) -> list[int]:
    """Exact sums per dimension, of any size."""
    total = [0] * d
    for x in _matrices(batches, d):
        wide = not x.size or int(np.abs(x.astype(np.float64)).max()) * len(x) < 2**62
        part = x.sum(axis=0) if wide else x.astype(object).sum(axis=0)
        total = [a + int(b) for a, b in zip(total, part, strict=True)]
    return total


def squares(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Per row the exact sum over dimensions of (n*x - S)²; an array of objects where 64 bits don't hold it."""
    most = max((abs(s) for s in sums), default=0) + n * (int(np.abs(x.astype(np.float64)).max()) + 1 if x.size else 0)
    if x.shape[1] * most * most < 2**63:
        y = n * x - np.array(sums, np.int64)
        return np.einsum("ij,ij->i", y, y)
    y = x.astype(object) * n - np.array(sums, object)
    return (y * y).sum(axis=1)


class Fit:
    """The fit list: each distinct integer vector once, its count, its sums, and passes over it."""

    def __init__(self, embeddings: DataFrame, scale: int) -> None:
        self.scratch = Scratch(embeddings.sparkSession, "whitening")
        self.rows = self.scratch.table(integer_vectors(embeddings, scale).distinct(), "fit")
        sizes = self.rows.agg(F.count(F.lit(1)), F.max(F.octet_length("x"))).first()
        self.n, self.d = sizes[0], (sizes[1] or 0) // 8
        self.sums, self.passes = self._totals(), 0
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(self.d)

    def _totals(self) -> list[int]:
        d = self.d

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = _sums(batches, d)
            # Two halves: 64-bit sums of these stay exact over 2**31 tasks.
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(d), pa.int32()), "high": pa.array([s >> 32 for s in total], pa.int64()), "low": pa.array([s & 0xFFFFFFFF for s in total], pa.int64())})

        found = self.rows.mapInArrow(add, "dim int, high long, low long").groupBy("dim").agg(F.sum("high"), F.sum("low")).collect()
        return [high * 2**32 + low for _, high, low in sorted(found)]

    def trace(self) -> float:
        """Of the covariance: from the exact deviations of all rows."""
        n, d, sums = self.n, self.d, self.sums

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = sum(int(v) for x in _matrices(batches, d) for v in squares(x, n, sums))
            yield pa.RecordBatch.from_pydict({"part": pa.array([total / n / n / n])})

        return self.rows.mapInArrow(add, "part double").agg(F.sum("part")).first()[0] or 0.0

    def apply(self, block: np.ndarray) -> np.ndarray:
        """The covariance times a block of directions: one pass over the fit list."""
        self.passes += 1
        n, d, mean, width = self.n, self.d, self.mean, block.shape[1]

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((d, width))
            for x in _matrices(batches, d):
                centred = x - mean
                total += centred.T @ (centred @ block)
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(d), pa.int32())} | {f"v{i}": pa.array(total[:, i]) for i in range(width)})

        names = [f"v{i}" for i in range(width)]
        parts = self.rows.mapInArrow(multiply, ", ".join(["dim int", *(f"{v} double" for v in names)]))
        found = parts.groupBy("dim").agg(*(F.sum(v) for v in names)).collect()
        return np.array([r[1:] for r in sorted(found)]).reshape(d, width) / n


def lanczos(apply: Callable[[np.ndarray], np.ndarray], d: int, k: int, *, block: int = 8, basis: int = 160, tolerance: float = 1e-13, seed: int = 11, most_passes: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors (columns) of the symmetric operator ``apply`` on blocks.

    Every new block is orthogonalised twice against the whole basis. Directions that vanish on the way (a breakdown: the basis
    spans an invariant space) are replaced by random ones orthogonal to it, so that repeated eigenvalues and other invariant
    spaces are found too. A basis that has grown to ``basis`` columns is restarted from its best Ritz vectors. Ends when the
    residuals of the first k are below ``tolerance`` times the largest eigenvalue, when they stay where rounding keeps them, or
    when the basis spans everything.
    """
    rng, k = np.random.default_rng(seed), min(k, d)
    if k == 0:
        return np.zeros(0), np.zeros((d, 0))
    block = min(max(block, k), d)
    basis = max(basis, 4 * block)
    q, aq = np.zeros((d, 0)), np.zeros((d, 0))
    new, best, stalled = _orthonormal(rng.standard_normal((d, block)), q, rng, block), np.inf, 0
    for _ in range(most_passes):
        image = apply(new)
        q, aq = np.hstack([q, new]), np.hstack([aq, image])
        small = q.T @ aq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, held = q @ turn[:, :k], aq @ turn[:, :k]
        residual = np.linalg.norm(held - ritz * values[:k], axis=0).max() if q.shape[1] >= k else np.inf
        scale = max(abs(values[0]), np.finfo(float).tiny)
        stalled = 0 if residual < best / 2 else stalled + 1
        best = min(best, residual)
        enough = q.shape[1] > block  # a first block that is invariant says nothing of the rest
        if q.shape[1] == d or enough and (residual <= tolerance * scale or residual <= 1e-10 * scale and stalled >= 3):
            return values[:k], ritz / np.linalg.norm(ritz, axis=0)
        new = _orthonormal(image, q, rng, block)
        if q.shape[1] + block > basis:  # what the Ritz vectors lack lies in the new block, whichever of them are kept
            keep = k + 2 * block
            q, aq = q @ turn[:, :keep], aq @ turn[:, :keep]
    raise RuntimeError(f"no convergence after {most_passes} passes: residual {best:.3g}")


def _orthonormal(block: np.ndarray, q: np.ndarray, rng: np.random.Generator, width: int) -> np.ndarray:
    """Orthonormal columns beside ``q`` from ``block``; random ones take the place of those that vanish."""
    size = np.linalg.norm(block, axis=0).max(initial=0.0)
    for _ in range(2):
        block = block - q @ (q.T @ block)
    left, values, _ = np.linalg.svd(block, full_matrices=False)
    new = left[:, values > 1e-12 * size] if size > 0 else left[:, :0]
    while new.shape[1] < min(width, len(q) - q.shape[1]):
        both = np.hstack([q, new])
        more = rng.standard_normal((len(q), 1))
        for _ in range(3):
            more = more - both @ (both.T @ more)
            more /= np.linalg.norm(more)
        new = np.hstack([new, more])
    for _ in range(2):  # small singular directions carry rounding of q's space
        new = np.linalg.qr(new - q @ (q.T @ new))[0]
    return new


def whiten(embeddings: DataFrame, k: int = 4, scale: int = 256) -> DataFrame:
    """The first ``k`` whitened principal components of every vector of columns vec_id, embedding (an array of numbers).

    Returns vec_id, component (from 1), n, deviation, whitened, explained, identity_error, distance: a row per vector that takes
    part and component. The components are of the covariance of the distinct integer vectors floor(scale * c). ``distance`` is the
    Euclidean distance from the centre; its square times n² is ``deviation``, exact, and null where it doesn't fit 64 bits
    (from some 10**9 rows on).

    Vectors that are null or hold null or non-finite entries take no part. Equal vectors count once for the fit and each have
    their rows; a null or repeated vec_id is carried as it is. Vectors shorter than the longest are taken as ending in zeros. There
    are no components without variance: fewer than ``k`` where the fit list spans fewer dimensions, and no rows where it has one
    vector or none. A component that doesn't fit 64 bits is an error.
    """
    kind = embeddings.schema["embedding"].dataType
    if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, NumericType):
        raise TypeError(f"embedding has to be an array of numbers, not {kind.simpleString()}")
    given = embeddings.select(F.col("embedding").cast("array<double>").alias("embedding"), "vec_id")
    fit = Fit(given.select("embedding"), scale)
    n, d, mean, sums = fit.n, fit.d, fit.mean, fit.sums
    trace = fit.trace() if n > 1 else 0.0
    values, vectors = lanczos(fit.apply, d, k) if trace > 0 else (np.zeros(0), np.zeros((d, 0)))
    some = values > 1e-12 * trace
    values, vectors = values[some], vectors[:, some]
    k, project = len(values), vectors / np.sqrt(values)
    names = [f"w{i}" for i in range(k)]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _matrices(batches, d):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(((x - mean) @ project).T)], names=names)

    error = 0.0
    if k:
        fitted = fit.rows.mapInArrow(projected, ", ".join(f"{w} double" for w in names))
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        found = fitted.agg(*(F.covar_pop(names[i], names[j]) for i, j in pairs)).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))
    explained = values / trace if k else values
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()), ("distance", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = _vectors(batch.column(0), scale)
            ids, step = batch.column(1), max(1, NUMBERS // max(1, d))
            for start in range(0, len(at) if k else 0, step):
                part = found[start : start + step]
                x = np.zeros((len(part), d), np.int64)
                for i, v in enumerate(part):
                    x[i, : len(v)] = v
                white, exact = (x - mean) @ project, [int(v) for v in squares(x, n, sums)]
                each = np.repeat(np.arange(len(part)), k)
                columns = [
                    ids.take(pa.array(at[start : start + step][each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))), pa.array(np.full(len(each), n)),
                    pa.array([v if v < 2**63 else None for v in exact], pa.int64()).take(pa.array(each)), pa.array(white.ravel()), pa.array(np.tile(explained, len(part))),
                    pa.array(np.full(len(each), error)), pa.array(np.array([v**0.5 / n if v < 2**1000 else float("inf") for v in exact])[each]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema.set(0, schema.field(0).with_type(ids.type)))

    of = given.schema["vec_id"].dataType.simpleString()
    return given.mapInArrow(scored, f"vec_id {of}, component int, n long, deviation long, whitened double, explained double, identity_error double, distance double")

