"""Embedding whitening by shifted CholeskyQR.

The covariance of the centred rows is never squared into the result: the rows
are orthogonalised pass by pass. A pass sums the Gram matrix of the rows as they
are solved so far, Spark over tasks and then over Gram rows; the driver takes
its Cholesky factor, with a shift so that badly conditioned rows have one; the
next pass solves the rows against all factors so far (triangular systems, in the
tasks). When the rows are orthonormal, the composed factors R have the rows'
singular values and right vectors: the SVD of R gives the components.

The driver and the tasks hold matrices of dimension x dimension, whatever the
number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.common import staged, use_package_on_workers

#: x = floor(SCALE * component)
SCALE = 256
#: Orthogonalising passes at most; two or three do.
PASSES = 8
#: Gram matrices within this of the identity are orthonormal.
ORTHONORMAL = 1e-6
#: Columns solved together.
BLOCK = 64

_DECIMAL = pa.decimal128(38, 0)
_EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """What the fit found: rows are whitened by ``(x - sums / n) @ vectors.T / sqrt(values)``."""

    n: int
    sums: list[int]            # exact, by dimension
    values: np.ndarray         # eigenvalues, falling
    vectors: np.ndarray        # unit eigenvectors, one a row
    trace: float               # of the covariance

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def apply(self, x: np.ndarray, components: int) -> np.ndarray:
        return (x - self.mean) @ self.vectors[:components].T / np.sqrt(self.values[:components])


def integer_vectors(df: DataFrame, *, vector_col: str = "embedding") -> DataFrame:
    """``df``'s rows that take part, as (row struct, x array<bigint>).

    Rows whose vector is null, empty or holds a null or non-finite component
    take no part, nor do those of another length than most (the longer of two
    equally frequent ones). A component of 2**52 / 256 or more raises: beyond it
    a double has no exact floor.
    """
    limit = float(1 << 52)
    finite = F.forall(df[vector_col], lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    scaled = F.transform(df[vector_col], lambda c: F.lit(float(SCALE)) * c.cast("double"))
    exact = F.transform(scaled, lambda c: F.when(F.abs(c) < limit, F.floor(c)).otherwise(
        F.raise_error(F.lit("a vector component is too large to be whitened exactly")).cast("long")))
    usable = (F.size(df[vector_col]) > 0) & finite
    rows = df.filter(usable).select(F.struct(*[df[c] for c in df.columns]).alias("row"), exact.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (lengths["d"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows @ inv(R1) @ inv(R2) ...`` for upper triangular factors, by
    substitution over blocks of columns."""
    for r in factors:
        out = np.empty_like(rows)
        for a in range(0, r.shape[1], BLOCK):
            b = min(a + BLOCK, r.shape[1])
            out[:, a:b] = rows[:, a:b] - out[:, :a] @ r[:a, a:b]
            for j in range(a, b):
                out[:, j] = (out[:, j] - out[:, a:j] @ r[a:j, j]) / r[j, j]
        rows = out
    return rows


def _summed(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over batches of ``of(x)``, a matrix of ``size`` rows: each task adds
    its batches, Spark adds the tasks row by row of the matrix."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = of(_matrix(batch.column(0)).astype(float))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()),
                                              pa.array([r.tobytes() for r in total], pa.binary())], ["i", "v"])

    def add(frame):
        import pandas as pd

        total = sum(np.frombuffer(v) for v in frame["v"])
        return pd.DataFrame({"i": frame["i"][:1], "v": [total.tobytes()]})

    rows = fit.select("x").mapInArrow(part, "i int, v binary").groupBy("i").applyInPandas(add, "i int, v binary")
    return np.array([np.frombuffer(r["v"]) for r in sorted(rows.collect(), key=lambda r: r["i"])])


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            for at in range(0, len(x), 1024):       # 2**10 components below 2**52: in 64 bits
                own = x[at:at + 1024].sum(axis=0).astype(object)
                total = own if total is None else total + own
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(total)), pa.int32()), pa.array([str(v) for v in [n, *total]])], ["i", "v"])

    rows = (fit.select("x").mapInArrow(part, "i int, v string")
            .groupBy("i").agg(F.sum(F.col("v").cast("decimal(28,0)")).alias("v")).collect())
    found = {r["i"]: int(r["v"]) for r in rows}
    return found.pop(-1, 0), [found[i] for i in sorted(found)]


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with R.T @ R = gram + shift * identity; the shift
    grows where rounding has left the matrix without a factor."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(shift, _EPS * float(np.trace(gram))) * 16


def fit_whitening(fit: DataFrame) -> Whitening | None:
    """Whitening of the covariance (divisor n) of ``fit.x``, vectors of one
    length; None where no direction has variance. ``fit`` is read once a pass:
    pass a table. Directions whose singular value is rounding only are left out."""
    use_package_on_workers(fit.sparkSession)
    n, sums = exact_sums(fit)
    if not n:
        return None
    mean, d = np.array([s / n for s in sums]), len(sums)
    factors: list[np.ndarray] = []
    for _ in range(PASSES):
        def gram_of(x, mean=mean, factors=tuple(factors)):
            q = solved(x - mean, factors)
            return q.T @ q

        gram = _summed(fit, gram_of, d)
        if not np.trace(gram):
            return None
        left, turn = np.linalg.eigh(gram)
        # orthonormal, apart from directions in which there is nothing
        if factors and np.all((left < d * _EPS) | (np.abs(left - 1) < ORTHONORMAL)):
            break
        factors.append(_factor(gram, 0.0 if factors and left[0] > 0.1 else 11 * d * _EPS * float(np.trace(gram))))
    # what the last rows lack to being orthonormal, then all factors, last first
    r = np.sqrt(np.maximum(left, 0))[:, None] * turn.T
    for factor in reversed(factors):
        r = r @ factor
    _, singular, vectors = np.linalg.svd(r)
    real = singular > max(n, d) * _EPS * singular[0]
    return Whitening(n, sums, singular[real] ** 2 / n, vectors[real], float(np.sum(singular ** 2) / n))


def identity_error(fit: DataFrame, white: Whitening, components: int) -> float:
    """Largest entry by size of the whitened rows' covariance minus the identity."""
    k = min(components, len(white.values))

    def moments(x):
        w = white.apply(x, k)
        return np.vstack((w.sum(axis=0), w.T @ w))

    found = _summed(fit, moments, k + 1) / white.n
    return float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n * x - S) ** 2, exact; beyond 38 digits it raises."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        return pa.array(((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1)).cast(_DECIMAL)
    return pa.array([Decimal(sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)))
                     for row in x.tolist()], _DECIMAL)


def whitened(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
             components: int = 4) -> DataFrame:
    """Rows ``(id, component int, n long, deviation decimal(38,0), whitened
    double, explained double, identity_error double)``: for each row of ``df`` that takes
    part its first ``components`` whitened coordinates.

    The fit covers each distinct integer vector once, however many rows hold it.
    ``n`` is their number, ``deviation`` the exact sum over dimensions of
    (n * x - sum) ** 2, ``explained`` the component's
    share of the variance, ``identity_error`` how far the whitened fit rows'
    covariance is from the identity. Which rows take part: see
    :func:`integer_vectors`. Null and repeated ids keep their rows; other columns
    are not read. Directions without variance are no components, so an empty
    table, or one of a single distinct vector, gives an empty result; equal
    eigenvalues share a plane, in which any two right-angled components serve.
    """
    use_package_on_workers(df.sparkSession)
    rows = integer_vectors(df.select(df[id_col].alias("id"), df[vector_col].alias("vector")), vector_col="vector")
    schema = T.StructType([
        T.StructField(id_col, df.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])
    fit = staged(rows.select("x").distinct(), "fit-list")
    white = fit_whitening(fit)
    if white is None:
        return df.sparkSession.createDataFrame([], schema)
    k = min(components, len(white.values))
    error = identity_error(fit, white, k)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            each = np.repeat(np.arange(len(x)), k)
            number = np.tile(np.arange(k), len(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(number + 1, pa.int32()),
                 pa.array(np.full(len(each), white.n), pa.int64()),
                 deviations(x, white.n, white.sums).take(pa.array(each)),
                 pa.array(white.apply(x.astype(float), k).ravel()),
                 pa.array((white.values[:k] / white.trace)[number]), pa.array(np.full(len(each), error))],
                schema.names)

    return rows.select("row.id", "x").mapInArrow(apply, schema)
