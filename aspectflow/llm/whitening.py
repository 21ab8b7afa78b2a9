"""Embedding whitening by polarisation.

Vectors become integer vectors, and each distinct one counts once.  For every dimension and for the sum of every two
dimensions the squared centred values are added up exactly, as integers of any size; since
``Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b)``, differences of these variances are the cross-covariances.  The matrix
(dimensions x dimensions) is assembled on the driver for ``eigh``; its size depends on the vectors' length only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from aspectflow.llm.stored import stored

SCALE = 256
COMPONENTS = 4
LIMBS = 8              # exact sums travel as digits to the base 2^32, 256 bits in all
BATCH_ROWS = 1024      # rows squared at a time: 2^10 squares of 26-bit halves fit 64 bits


def integer_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``rows`` with ``x`` array<long>, floor(scale * c) for every entry c in double precision.

    Rows whose vector is null, empty, or holds null or non-finite entries go, and so do those with an entry that
    leaves no 64-bit integer.  Where lengths differ, the commonest stays (of equally common ones the longest).
    """
    scaled = F.transform(vector, lambda c: c.cast("double") * F.lit(float(scale)))
    good = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0**62)))
    kept = (rows.drop("x").where(F.coalesce(good & (F.size(vector) > 0), F.lit(False)))
            .withColumn("x", F.transform(scaled, lambda c: F.floor(c).cast("long"))))
    length = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return kept.where(F.size("x") == (length[0]["d"] if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column of equal lengths as rows of 64-bit integers."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, in 64 bits where that and sums of two entries are safe, else as integers of any size."""
    top = int(np.abs(x).max(initial=0)) * n + max((abs(int(s)) for s in sums), default=0)
    if top < 1 << 61:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _square_sums(y: np.ndarray) -> list[int]:
    """Exact sum of squares of every column of at most ``BATCH_ROWS`` rows."""
    if y.dtype == object:
        return [int(v) for v in (y * y).sum(axis=0)]
    top = int(np.abs(y).max(initial=0))
    if top < 1 << 26:
        return np.einsum("ij,ij->j", y, y).tolist()
    if top < 1 << 52:
        high, low = y >> 26, y & ((1 << 26) - 1)
        parts = [np.einsum("ij,ij->j", a, b).tolist() for a, b in ((high, high), (high, low), (low, low))]
        return [(a << 52) + (b << 27) + c for a, b, c in zip(*parts)]
    return _square_sums(y.astype(object))


def _exact_totals(fit: DataFrame, add: Callable[[list[int], np.ndarray], None], width: int) -> list[int]:
    """Integers of any size summed over all tasks: ``add`` adds a matrix of rows to a task's ``width`` totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * width
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                add(totals, _matrix(batch["x"].slice(at, BATCH_ROWS)))
        digits = [[(t >> (32 * k)) & 0xFFFFFFFF if k < LIMBS - 1 else t >> (32 * k) for t in totals] for k in range(LIMBS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int64()), *[pa.array(d, pa.int64()) for d in digits]],
                                         names=["k", *[f"l{i}" for i in range(LIMBS)]])

    names = [f"l{i}" for i in range(LIMBS)]
    rows = (fit.select("x").mapInArrow(run, "k long, " + ", ".join(f"{c} long" for c in names))
            .groupBy("k").agg(*[F.sum(c).alias(c) for c in names]).collect())
    totals = [0] * width
    for r in rows:
        totals[r["k"]] = sum(r[c] << (32 * i) for i, c in enumerate(names))
    return totals


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: count and sums of the fit list, and the covariance's eigenpairs by falling eigenvalue."""

    n: int
    sums: np.ndarray            # exact, integers of any size
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray         # a unit eigenvector per column
    trace: float

    def weights(self, components: int) -> np.ndarray:
        """Columns that turn n * x - sums into whitened values; NaN for a component without variance."""
        k = min(components, len(self.values))
        least = self.trace * len(self.values) * np.finfo(float).eps
        spread = np.where(self.values[:k] > least, self.values[:k], np.nan)
        return self.vectors[:, :k] / np.sqrt(spread) / max(self.n, 1)


def fit(vectors: DataFrame) -> tuple[Whitening, DataFrame]:
    """The transform of the distinct vectors ``x`` of ``vectors``, and the stored list of these.

    Copies meet after each task has folded its own, so a vector that many rows share is no burden.  An empty table
    gives n = 0 and no dimensions.
    """
    distinct = stored(vectors.select("x").distinct(), "whitening_fit")
    head = distinct.agg(F.count("*").alias("n"), F.first(F.size("x")).alias("d")).first()
    n, d = head["n"], head["d"] or 0

    def add_sums(totals: list[int], x: np.ndarray) -> None:
        high, low = (x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0)
        for i in range(d):
            totals[i] += (int(high[i]) << 31) + int(low[i])

    sums = np.array(_exact_totals(distinct, add_sums, d) if n else [], dtype=object)

    def add_squares(totals: list[int], x: np.ndarray) -> None:
        z, at = _centred(x, n, sums), d
        for i, s in enumerate(_square_sums(z)):
            totals[i] += s
        for i in range(d - 1):                     # the sums of dimension i and every later one
            for j, s in enumerate(_square_sums(z[:, i:i + 1] + z[:, i + 1:])):
                totals[at + j] += s
            at += d - 1 - i

    squares = _exact_totals(distinct, add_squares, d * (d + 1) // 2) if n else []
    cov = np.zeros((d, d))
    at = d
    for i in range(d):
        cov[i, i] = squares[i] / n**3              # integers, so each quotient is rounded once
        for j in range(i + 1, d):
            cov[i, j] = cov[j, i] = ((squares[at] - squares[i] - squares[j]) // 2) / n**3
            at += 1
    values, eigenvectors = np.linalg.eigh(cov) if d else (np.empty(0), np.empty((0, 0)))
    values, eigenvectors = values[::-1], eigenvectors[:, ::-1]
    if d:                                          # the largest entry of each is positive
        eigenvectors = eigenvectors * np.where(
            np.take_along_axis(eigenvectors, np.abs(eigenvectors).argmax(axis=0)[None], 0) < 0, -1.0, 1.0)
    return Whitening(n, sums, cov, values, eigenvectors, float(np.trace(cov))), distinct


def projected(vectors: DataFrame, w: Whitening, components: int = COMPONENTS) -> DataFrame:
    """``vectors`` (with ``x``, of the fit's length) with ``deviation_exact`` string, the decimal digits of
    sum over dimensions of (n x - S)^2, and ``whitened`` array<double>, one entry a component; an entry is null where
    the component has no variance.  Columns of these names are replaced."""
    weights, n, sums = w.weights(components), w.n, w.sums
    vectors = vectors.drop("deviation_exact", "whitened")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _centred(_matrix(batch["x"]), n, sums)
            flat = z.astype(np.float64) @ weights
            values = pa.array(flat.ravel(), from_pandas=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32()), values)
            small = z.dtype != object and int(np.abs(z).max(initial=0)) ** 2 * max(z.shape[1], 1) < 1 << 62
            total = np.einsum("ij,ij->i", z, z) if small else (z.astype(object) ** 2).sum(axis=1)
            exact = pa.array([str(int(t)) for t in total], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, exact, lists],
                                             names=[*batch.schema.names, "deviation_exact", "whitened"])

    schema = StructType([*vectors.schema.fields, StructField("deviation_exact", StringType()),
                         StructField("whitened", ArrayType(DoubleType()))])
    return vectors.mapInArrow(run, schema)


def identity_error(distinct: DataFrame, w: Whitening, components: int = COMPONENTS) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance (centred, divisor n) minus the identity.

    Components without variance take no part; without any other the result is null.
    """
    live = [k for k in range(min(components, len(w.values))) if not np.isnan(w.weights(components)[:, k]).any()]
    if not live:
        return None
    values = projected(distinct, w, components)
    pairs = [(a, b) for a in live for b in live if a <= b]
    row = values.agg(*[F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]) for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(row, pairs))


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
             components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``rows`` and component: the key, component (from 1), n, deviation, whitened, explained,
    identity_error, deviation_exact.

    ``deviation`` is null where its exact value, which ``deviation_exact`` holds as text, leaves 64 bits; ``whitened``
    is null for a component without variance, and ``explained`` where nothing varies.  Repeated rows and null keys get
    rows of their own, but equal vectors count once in the fit.  Vectors shorter than ``components`` have a component
    per dimension.  An empty table gives an empty result.  Other columns are not looked at.
    """
    vectors = stored(integer_vectors(rows.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector", scale)
                     .select("key", "x"), "whitening_vectors")
    w, distinct = fit(vectors)
    error = identity_error(distinct, w, components)
    shares = [float(v) / w.trace if w.trace > 0 else None for v in w.values[:components]]
    explained = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.array().cast("array<double>")
    out = projected(vectors, w, components).select("key", "deviation_exact", F.posexplode("whitened").alias("at", "value"))
    return out.select(
        F.col("key").alias(key), (F.col("at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"),
        F.col("deviation_exact").try_cast("long").alias("deviation"), F.col("value").alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
        "deviation_exact")
