"""Embedding whitening by FEAST contour integration.

Two passes over the vectors give exact sums and the centred covariance. Inertia counts (the signs of the pivots of a
shifted covariance) bracket its leading eigenvalues and cut them into intervals with free ends. For each interval a
contour round it in the complex plane is summed by quadrature: each node is a solve with the shifted covariance, a
Spark task of its own. The sum projects a block of vectors onto the interval's eigenspace, Rayleigh-Ritz extracts the
components from it, and this repeats until they are exact; an interval must yield as many as its inertia counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import read
from tessera.llm.vectors import is_finite_vector, matrix

COMPONENTS = 8
NODES = 16  # of the upper half of a contour; the lower half mirrors it
INTERVAL = 4  # eigenvalues of an interval, unless more lie too close together
ROUNDS = 30  # projections before the block is widened
SCALE, SHIFT = 1024, 100_000
_MOST = 1 << 52


def whole_numbers(column: pa.ListArray, width: int) -> np.ndarray:
    """floor(SCALE * c) + SHIFT for every entry; what a shorter vector lacks counts as zero."""
    x = np.floor(matrix(column, width).astype(np.float64) * SCALE)
    return np.clip(x, -_MOST, _MOST).astype(np.int64) + SHIFT


# The covariance's eigenvalues by inertia

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix congruent and similar to the symmetric ``a`` (reflections from
    both sides), so that its shifts have the inertia of those of ``a``."""
    a = a.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if not size:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        w = a[k + 1 :, k + 1 :] @ v
        w -= (v @ w) * v
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """For each shift the number of eigenvalues above it: the positive pivots of the matrix less the shift."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    above = np.zeros(shifts.shape, np.int64)
    pivot = diagonal[0] - shifts
    for k in range(len(diagonal)):
        if k:
            pivot = diagonal[k] - shifts - off[k - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        above += pivot > 0
    return above


def bracket(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Below and above each of the first ``wanted`` eigenvalues, down to rounding: the counts cut all brackets at once."""
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low = np.full(wanted, (diagonal - reach).min())
    high = np.full(wanted, (diagonal + reach).max())
    pad = np.finfo(float).eps * len(diagonal) * max(abs(low[0]), abs(high[0]), np.finfo(float).tiny)
    low, high = low - pad, high + pad
    rank = np.arange(1, wanted + 1)
    steps = np.linspace(0, 1, 34)[1:-1]
    for _ in range(11):  # 33 ** 11 parts are finer than a double
        shifts = low[:, None] + (high - low)[:, None] * steps
        enough = count_above(diagonal, off, shifts) >= rank[:, None]  # the eigenvalue lies above these shifts
        low = np.maximum(low, np.where(enough, shifts, -np.inf).max(axis=1))
        high = np.minimum(high, np.where(enough, np.inf, shifts).min(axis=1))
    return low, high


def intervals(low: np.ndarray, high: np.ndarray, wanted: int, floor: float) -> list[tuple[float, float, int]]:
    """Stretches that together hold the first ``wanted`` eigenvalues above ``floor`` (more, where those after cannot be
    told apart), with the number in each. Their ends lie in the middle of gaps."""
    middle = (low + high) / 2
    n = int(np.count_nonzero(middle > floor))
    scale = max(abs(middle[0]), np.finfo(float).tiny)
    gaps = middle[:-1] - middle[1:]  # gaps[k]: after eigenvalue k + 1
    free = gaps > 1e-7 * scale
    stop = min(wanted, n)
    while 0 < stop < n and not free[stop - 1]:
        stop += 1
    out, first = [], 0
    top = middle[0] + 0.25 * max(middle[0] - (middle[stop] if stop < len(middle) else 0.0), 1e-3 * scale) if n else 0.0
    while first < stop:
        ends = [k for k in range(first + 1, min(first + INTERVAL, stop) + 1) if k == stop or free[k - 1]]
        last = max(ends, key=lambda k: (gaps[k - 1] if k < len(middle) else np.inf, k)) if ends else next(k for k in range(first + 1, stop + 1) if k == stop or free[k - 1])
        below = (middle[last - 1] + max(middle[last], floor if last >= n else middle[last])) / 2 if last < len(middle) else middle[last - 1] / 2
        out.append((float(below), float(top), last - first))
        first, top = last, below
    return out


# Projection by contour integration

def _solves(spark: SparkSession, cov: np.ndarray, blocks: list[tuple[float, float, np.ndarray]]) -> list[np.ndarray]:
    """For each (low, high, block) the quadrature of the resolvent of ``cov`` round the interval, applied to the block."""
    shared = spark.sparkContext.broadcast((cov, blocks))
    angles = (np.arange(NODES) + 0.5) * np.pi / NODES
    nodes = pa.table({"part": pa.array(np.repeat(np.arange(len(blocks)), NODES)), "node": pa.array(np.tile(np.arange(NODES), len(blocks)))})

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cov, blocks = shared.value
        for batch in batches:
            for part, node in zip(batch.column("part").to_pylist(), batch.column("node").to_pylist(), strict=True):
                low, high, block = blocks[part]
                radius = (high - low) / 2
                step = radius * np.exp(1j * angles[node])
                x = np.linalg.solve(((low + high) / 2 + step) * np.eye(len(cov)) - cov, block.astype(complex))
                y = (step * x).real / NODES
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([node]), pa.array([y.ravel()], pa.list_(pa.float64()))], names=["part", "node", "y"])

    tasks = spark.createDataFrame(nodes).repartition(min(nodes.num_rows, max(1, spark.sparkContext.defaultParallelism)), "part", "node")
    rows = tasks.mapInArrow(solve, "part long, node long, y array<double>").toArrow().sort_by([("part", "ascending"), ("node", "ascending")])
    shared.destroy()
    out = [np.zeros(b.size) for _, _, b in blocks]
    for part, y in zip(rows["part"].to_pylist(), rows["y"], strict=True):
        out[part] += y.values.to_numpy()
    return [y.reshape(b.shape) for y, (_, _, b) in zip(out, blocks, strict=True)]


def feast(spark: SparkSession, cov: np.ndarray, wanted: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues of a covariance in falling order and their unit eigenvectors as rows; fewer
    where the others are zero to rounding."""
    d = len(cov)
    if not d or not np.any(cov):
        return np.empty(0), np.empty((0, d))
    scale = np.linalg.norm(cov, 2)
    eps = np.finfo(float).eps * scale
    floor = 16 * d * eps
    diagonal, off = tridiagonal(cov)
    low, high = bracket(diagonal, off, min(d, 4 * wanted))
    rng = np.random.default_rng(seed)
    todo = [[a, b, n, min(d, max(2 * n, n + 4)), None, np.inf] for a, b, n in intervals(low, high, min(wanted, d), floor)]
    for item in todo:
        item[4] = rng.standard_normal((d, item[3]))
    found: list[tuple[float, np.ndarray]] = []
    rounds = 0
    while todo:
        rounds += 1
        projected = _solves(spark, cov, [(a, b, q) for a, b, _, _, q, _ in todo])
        left = []
        for (a, b, n, size, _, last), y in zip(todo, projected, strict=True):
            q = np.linalg.qr(y)[0]
            values, turn = np.linalg.eigh(q.T @ cov @ q)  # Rayleigh-Ritz
            vectors = q @ turn
            errors = np.linalg.norm(cov @ vectors - vectors * values, axis=0)
            inside = np.flatnonzero((values > a) & (values < b))
            inside = inside[np.argsort(errors[inside])][:n]
            worst = errors[inside].max(initial=0.0) if len(inside) == n else np.inf  # inertia: none may be missing
            if worst <= eps or (worst <= 1e4 * d * eps and worst > last / 2) or size == d:  # as far as doubles go
                found += [(values[k], vectors[:, k]) for k in inside]
                continue
            if rounds % ROUNDS == 0:
                size = min(d, 2 * size)
                vectors = np.concatenate([vectors, rng.standard_normal((d, size - vectors.shape[1]))], axis=1)
            left.append([a, b, n, size, vectors, worst])
        todo = left
    found.sort(key=lambda f: -f[0])
    return np.array([f[0] for f in found[:wanted]]), np.array([f[1] for f in found[:wanted]]).reshape(-1, d)


# The vectors

@dataclass
class Whitening:
    """A fitted whitening: ``n`` vectors, their sums per dimension, the covariance's leading eigenvalues (falling) with
    unit eigenvectors as rows, and its trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x less the sums: exact whole numbers, of Python where they might not fit a long."""
        most = int(max(np.abs(x).max(initial=0), np.abs(self.sums).max(initial=0) // max(1, self.n) + 1))
        if self.n * most * 2 < 1 << 62:
            return x * self.n - self.sums
        return x.astype(object) * self.n - self.sums.astype(object)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """The exact sum of squares of each row; None where a long cannot hold it."""
        most = int(np.abs(centred).max(initial=0))
        if most * most * max(1, self.width) < 1 << 63:
            return np.einsum("ij,ij->i", centred, centred).astype(np.int64).tolist()
        sums = [sum(int(v) ** 2 for v in row) for row in centred]
        return [s if s < 1 << 63 else None for s in sums]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / max(1, self.n)) @ (self.components / np.sqrt(self.values)[:, None]).T


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """Element-wise sums of the tasks' rows of ``at`` and an array of doubles ``values``, as a matrix."""
    flat = parts.select("at", F.posexplode("values").alias("j", "value")).groupBy("at", "j").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((width, width))
    out[flat["at"].to_numpy(), flat["j"].to_numpy()] = flat["value"].to_numpy()
    return out


def _products(vectors: DataFrame, width: int, rows_of) -> np.ndarray:
    """The sum over all vectors of y times y transposed, y being ``rows_of`` a batch."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = rows_of(batch.column("v"))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], names=["at", "values"])

    return _summed(vectors.mapInArrow(products, "at long, values array<double>"), width)


def _sums(vectors: DataFrame, width: int) -> np.ndarray:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += whole_numbers(batch.column("v"), width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["at", "value"])

    flat = vectors.mapInArrow(sums, "at long, value long").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(width, np.int64)
    out[flat["at"].to_numpy()] = flat["value"].to_numpy()
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on the finite vectors of column ``v``."""
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = shape["n"], shape["width"] or 0
    if not width:
        return Whitening(n, np.zeros(0, np.int64), np.empty(0), np.empty((0, 0)), 0.0)
    base = Whitening(n, _sums(vectors, width), np.empty(0), np.empty((0, width)), 0.0)
    cov = _products(vectors, width, lambda v: base.centred(whole_numbers(v, width)).astype(np.float64) / n) / n
    values, vectors_ = feast(vectors.sparkSession, (cov + cov.T) / 2, components)
    return Whitening(n, base.sums, values, vectors_, float(np.trace(cov)))


def identity_error(vectors: DataFrame, fitted: Whitening) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance, centred, less the identity."""
    m = len(fitted.values)
    if not m:
        return None

    def rows_of(v: pa.ListArray) -> np.ndarray:
        y = fitted.whitened(fitted.centred(whole_numbers(v, fitted.width)))
        return np.concatenate([y, np.ones((len(y), 1))], axis=1)  # the last row and column are the sums

    products = _products(vectors, m + 1, rows_of)
    mean = products[m, :m] / fitted.n
    return float(np.abs(products[:m, :m] / fitted.n - np.outer(mean, mean) - np.eye(m)).max())


def whiten(rows: DataFrame, vector: str = "embedding", keep: list[str] | None = None, components: int = COMPONENTS) -> tuple[DataFrame, Whitening, float | None]:
    """Whiten a column of vectors: per row with a finite vector ``row`` (a struct of the columns ``keep``, or all),
    ``deviation`` long (the exact sum of (n*x - S)^2) and ``whitened`` array<double>, one value for each component, by
    falling eigenvalue; besides, the fit and its identity error.

    Rows whose vector is null or has a null, infinite or NaN entry are dropped; an empty vector, as any that is
    shorter than the longest, counts as filled up with zeros. All other rows, repeated ones included, are fitted on,
    and rows equal in their vector get equal values. Components whose eigenvalue is zero to rounding are left out, so
    one vector alone, or equal ones, have none. A deviation beyond a long is null. x is clamped to 2**52 in size.
    The driver holds the covariance: 8 bytes for each pair of dimensions, whatever the number of rows.
    """
    keep = rows.columns if keep is None else keep
    finite = rows.where(is_finite_vector(F.col(f"`{vector}`")))
    kept = finite.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{vector}`").alias("v"))
    fitted = fit(kept.select("v"), components)
    error = identity_error(kept.select("v"), fitted)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = fitted.centred(whole_numbers(batch.column("v"), fitted.width))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(fitted.deviations(centred), pa.int64()),
                                              pa.array(list(fitted.whitened(centred)), pa.list_(pa.float64()))], names=["row", "deviation", "whitened"])

    kind = T.StructType([T.StructField("row", T.StructType([rows.schema[c] for c in keep])), T.StructField("deviation", T.LongType()),
                         T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return kept.mapInArrow(apply, kind), fitted, error


def op13_feast_whitening(spark, sf_dir):
    out, fitted, error = whiten(read(spark, sf_dir, "embeddings"), keep=["vec_id"])
    explained = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values]) if len(fitted.values) else F.array().cast("array<double>")
    rows = out.select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
