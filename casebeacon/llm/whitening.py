"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of a covariance come from repeated passes over the distributed rows: each
pass multiplies the centred rows X with a block Q and with the transpose again, XᵀXQ, so no task
holds more than a batch of rows and a (dimensions x block width) matrix. A Chebyshev polynomial in the
covariance damps the unwanted end of the spectrum, QR and Rayleigh-Ritz give the eigenpairs.
What the driver gets is bounded by the dimension, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebeacon.llm.tables import stored

SCALE = 256  # steps per unit when entries become whole numbers
DEGREE = 10  # of the polynomial: passes per round before the Rayleigh-Ritz step
GUARD = 12  # further vectors in the block, which carry the edge of the unwanted spectrum
ROUNDS = 12  # with one block width; then it doubles, up to all dimensions, where Rayleigh-Ritz is exact
PROBE = 6  # Lanczos steps outside the block that certify that nothing was missed
EXACT = 1e-14  # residual of an eigenpair over the largest eigenvalue
SETTLED = 1e-12  # enough if more rounds don't lower it
_LONG = 2**63 - 1


@dataclass
class Whitening:
    n: int  # vectors in the fit list
    sums: list[int]  # exact, per dimension
    components: np.ndarray  # unit eigenvectors as rows, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float
    residuals: np.ndarray  # |Vq - eq| over the largest eigenvalue
    identity_error: float


def whole_vectors(vectors: DataFrame, column: str = "embedding", scale: int = SCALE, name: str = "x") -> DataFrame:
    """The rows with a column ``name``: ``floor(scale * entry)`` as longs.

    Left out are rows whose vector is null or empty or holds null, NaN or infinite entries. Entries
    beyond the range of a long are set to its ends. A column called ``name`` before is replaced.
    """
    entries = F.col(f"`{column}`").cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    held = vectors.filter(entries.isNotNull() & (F.size(entries) > 0) & ~F.coalesce(F.exists(entries, bad), F.lit(False)))
    steps = lambda c: F.floor(F.least(F.greatest(c * float(scale), F.lit(-(2.0**63))), F.lit(2.0**63 - 1024)))
    return held.withColumn(name, F.transform(entries, steps))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """Rows of a list column as one array."""
    lists = batch.column(batch.schema.get_field_index(name))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 0)


def _cells(rows: DataFrame, measure: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all rows of an array that ``measure`` gives for a batch, added up in Spark cell by cell.

    A task emits its sum once, so what is shuffled is a matrix of ``shape`` per task.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = measure(_matrix(batch, "x"))
                total = part if total is None else total + part
        if total is not None:
            flat = np.ascontiguousarray(total, np.float64).ravel()
            yield pa.record_batch({"cell": np.arange(len(flat)), "v": flat})

    sums = rows.select("x").mapInArrow(partial, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(int(np.prod(shape)))
    out[sums["cell"].to_numpy()] = sums["v"].to_numpy()
    return out.reshape(shape)


def _exact_sums(rows: DataFrame, width: int) -> list[int]:
    """Sum per dimension, exact: low and high halves of the longs are added apart."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, "x")
                halves = np.concatenate([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)])
                yield pa.record_batch({"cell": np.arange(2 * width), "v": halves})

    sums = rows.select("x").mapInArrow(partial, "cell long, v long").groupBy("cell").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    cells = {r.cell: int(r.v) for r in sums}
    return [(cells[i] << 32) + cells[width + i] for i in range(width)]


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz in span(q): values falling, vectors, and the covariance times them."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def _filtered(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, edge: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the covariance applied to ``q``: at most 1 on [0, edge], 1 at ``top`` by scaling.

    ``vq`` is the first product, so ``degree - 1`` passes follow.
    """
    half = edge / 2
    sigma = first = half / (half - top) if top != half else -1.0
    last, now = q, (vq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        last, now = now, (times(now) - half * now) * (2 * after / half) - sigma * after * last
        sigma = after
    return now


def _outside(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, rng: np.random.Generator) -> float:
    """An upper estimate of the largest eigenvalue of the covariance outside span(q), by Lanczos from a random start."""
    width = len(q)
    away = lambda v: v - q @ (q.T @ v)
    v = away(away(rng.standard_normal(width)))
    basis, diagonal, side = [v / np.linalg.norm(v)], [], []
    for _ in range(min(PROBE, width - q.shape[1])):
        w = away(times(basis[-1][:, None])[:, 0])
        diagonal.append(float(basis[-1] @ w))
        for b in (*basis, *basis):
            w = w - b * (b @ w)
        w = away(w)
        side.append(float(np.linalg.norm(w)))
        if side[-1] <= 1e-14 * max(abs(d) for d in diagonal) or side[-1] == 0:
            side[-1] = 0.0
            break
        basis.append(w / side[-1])
    t = np.diag(diagonal) + np.diag(side[:-1], 1)[: len(diagonal), : len(diagonal)] + np.diag(side[:-1], -1)[: len(diagonal), : len(diagonal)]
    values, vectors = np.linalg.eigh(t)
    return float(values[-1] + side[-1] * abs(vectors[-1, -1]))


def _certified(times, values: np.ndarray, q: np.ndarray, residual: np.ndarray, k: int, rng: np.random.Generator) -> bool:
    """Whether no eigenvalue above the k-th Ritz value is missing from the block.

    By the Schur complement: what lies outside the block stays below, and the guards' coupling to it can't
    lift them over the k-th. Holds up to the chance that a random start is blind to a vector.
    """
    if q.shape[1] == len(q):
        return True
    beyond = values[k - 1] - _outside(times, q, rng)
    guards = residual[:, k:]
    own = values[k - 1] - values[k] if q.shape[1] > k else beyond
    tie = own <= 1e-9 * values[0]
    return beyond > 0 and (tie or float((guards**2).sum()) <= beyond * own)


def leading(times: Callable[[np.ndarray], np.ndarray], width: int, k: int, trace: float, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest eigenvalues, unit eigenvectors as rows and residuals of a positive semidefinite matrix.

    ``times`` multiplies the matrix with a block. Runs until every residual is at the
    rounding level and the probe outside the block finds nothing larger.
    """
    rng = np.random.default_rng(seed)
    block = min(width, k + GUARD)
    q = np.linalg.qr(rng.standard_normal((width, block)))[0]
    while True:
        best = np.inf
        for turn in range(ROUNDS):
            values, q, vq = _ritz(q, times(q))
            residual = vq - q * values
            size = np.linalg.norm(residual[:, :k], axis=0) / max(values[0], np.finfo(float).tiny)
            worst = float(size.max())
            if worst <= EXACT or (worst <= SETTLED and worst > best / 2) or block == width:
                if _certified(times, values, q, residual, k, rng):
                    return values[:k], q[:, :k].T, size
                break
            best = min(best, worst)
            edge = max(values[-1], trace * 1e-15)
            q = np.linalg.qr(_filtered(times, q, vq, edge, values[0], DEGREE))[0]
        wider = min(width, 2 * block)
        q = np.linalg.qr(np.concatenate([q, rng.standard_normal((width, wider - block))], axis=1))[0]
        block = wider


def fit(rows: DataFrame, k: int = 4) -> Whitening | None:
    """Mean, leading eigenpairs and whitening error over the different vectors ``x`` (longs, one length) of ``rows``.

    Each different vector counts once, however many rows have it. Components whose eigenvalue is zero
    to double precision don't exist, so there may be fewer than ``k`` and none if all vectors are equal.
    None without rows. Vectors of different lengths are refused.
    """
    different = stored(rows.select("x").distinct(), "vectors")
    widths = [r[0] for r in different.select(F.size("x")).distinct().limit(2).collect()]
    if not widths:
        return None
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(widths)}")
    (width,), n = widths, different.count()
    sums = _exact_sums(different, width)
    mean = np.array([s / n for s in sums])
    trace = float(_cells(different, lambda x: ((x - mean) ** 2).sum(0), (width,)).sum()) / n

    def times(q: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ q)

        return _cells(different, product, q.shape) / n

    k = min(k, width)
    values, vectors, size = leading(times, width, k, trace) if trace > 0 else (np.zeros(0), np.zeros((0, width)), np.zeros(0))
    real = values > width * np.finfo(float).eps * max(trace, 0.0)
    values, vectors, size = values[real], vectors[real], size[real]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(1)[:, None], 1) < 0, -1.0, 1.0) if len(vectors) else vectors
    error = 0.0
    if len(values):
        scaled = (vectors / np.sqrt(values)[:, None]).T

        def moments(x: np.ndarray) -> np.ndarray:
            z = (x - mean) @ scaled
            return np.concatenate([z.T @ z, z.sum(0)[None]])

        both = _cells(different, moments, (len(values) + 1, len(values))) / n
        error = float(np.abs(both[:-1] - np.outer(both[-1], both[-1]) - np.eye(len(values))).max())
    return Whitening(n, sums, vectors, values, trace, size, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n * x - sum)²; null where it doesn't fit in a long."""
    far = max(int(x.max()), -int(x.min())) * n + max(map(abs, sums), default=0)
    if far * far * max(1, x.shape[1]) <= _LONG:
        return (((x * n - np.array(sums, np.int64)) ** 2).sum(1)).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v <= _LONG else None for v in exact]


def transform(rows: DataFrame, model: Whitening | None, key: Column, schema: str = "vec_id long") -> DataFrame:
    """One row per row and component: ``key``, component, n, deviation, whitened, explained, identity_error.

    The matrix in the closure has (components x dimensions) entries. Without a model, or with no component,
    there are no rows.
    """
    name = schema.split()[0]
    shape = f"{schema}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], shape)
    n, sums, k = model.n, model.sums, len(model.eigenvalues)
    mean = np.array([s / n for s in sums])
    scaled = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    explained = model.eigenvalues / model.trace
    error = model.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch, "x")
            z = (x - mean) @ scaled
            at = np.repeat(np.arange(m), k)
            yield pa.record_batch(
                {
                    name: batch.column(0).take(pa.array(at)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    "n": pa.array(np.full(m * k, n, np.int64)),
                    "deviation": pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(at)),
                    "whitened": z.ravel(),
                    "explained": np.tile(explained, m),
                    "identity_error": np.full(m * k, error),
                }
            )

    return rows.select(key.alias(name), "x").mapInArrow(project, shape)


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", k: int = 4, scale: int = SCALE) -> DataFrame:
    """Whitened leading components of every row's vector, in whole steps of 1 / ``scale``.

    Null, empty and non-finite vectors give no rows; repeated rows and null keys are kept; equal vectors count
    once in the fit; further columns are ignored, whatever their names. Of equal eigenvalues any
    order and any basis of their space may come. An empty table gives an empty result.
    """
    rows = whole_vectors(vectors.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{column}`").alias("v")), "v", scale)
    return transform(rows, fit(rows, k), F.col("key"), "vec_id long")
