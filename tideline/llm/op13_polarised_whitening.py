"""Whitening of embeddings from variances alone (polarisation).

The covariance of two dimensions is a difference of variances: ``2 cov(a, b) = var(a + b) - var(a) - var(b)``. So the fit
needs one kind of sum only, squares of centred values, for every dimension and for the sum of every two dimensions:

1. Components become integers ``x = floor(1024 * c) + 100000``; count n and sums S per dimension are added up exactly.
2. Rows are centred on the integer m nearest to S / n, and the squares of ``y = x - m`` and of ``y_a + y_b`` are added up
   exactly. What is left of the mean, ``T = S - n * m``, at most n / 2, is taken off in integers too:
   ``sum((n * x - S) ** 2) = n * (n * sum(y ** 2) - T ** 2)``. No float enters before the last division.
3. The covariance matrix, assembled on the driver (dimensions squared), is diagonalised by ``eigh``; every row is projected.
4. The covariance of the whitened rows, measured on the stored result, must be the identity.

Each of the passes 1 and 2 returns a few numbers per task. Sums are decimals of 38 digits, which 10 ** 30 values of 1,000 do not fill.

A vector that is NULL, empty, or holds NULL or non-finite components is dropped, and so is one of another length than most.
Repeated rows and ids are rows of their own, ids may be NULL, further columns have no influence, an empty table gives an empty
result. A component of no variance (a constant dimension, fewer rows than dimensions) has NULL as ``whitened`` and is left out
of ``identity_error``, which is NULL if no component is left; ``explained`` is NULL if no dimension varies. Of equal
eigenvalues, any orthonormal basis may come. ``deviation`` is NULL where the exact value exceeds a long, ``deviation_exact``
holds it in all cases. Components of 2 ** 53 or more, which have no 64-bit integer form, raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import finite_vector, main_length, matrix, slabs, staged
from tideline.llm.registry import llm_query, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
SLAB = 4096
# Sums of integers below this bound are exact in doubles.
_EXACT = 2 ** 53
_SUMS = pa.schema([("slot", pa.int32()), ("total", pa.decimal128(38, 0))])


@dataclass(frozen=True)
class Whitener:
    """n rows of integer vectors with sums S; eigenvectors as columns, their eigenvalues, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> list[int]:
        return [nearest(s, self.n) for s in self.sums]

    @property
    def varied(self) -> np.ndarray:
        """Which components have a variance beyond the rounding of the largest one."""
        return self.values > len(self.sums) * np.finfo(float).eps * max(self.values.max(initial=0.0), 0.0)


def nearest(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def integer_vectors(vectors: DataFrame, embedding: str) -> tuple[DataFrame, int]:
    """The usable rows with ``_x``, their integers, stored; and the number of dimensions."""
    def whole_number(c):
        c = c.cast("double")
        fits = F.abs(c) < F.lit(float(_EXACT))
        return F.when(fits, F.floor(F.lit(float(SCALE)) * c) + F.lit(SHIFT)).otherwise(F.raise_error(F.lit("a component has no 64-bit integer form")).cast("long"))

    whole = F.transform(F.col(embedding), whole_number)
    usable = staged(vectors.where(finite_vector(embedding)).withColumn("_x", whole), "integer-vectors")
    dims = main_length(usable, "_x")
    return usable.where(F.size("_x") == dims), dims


def square_sums(values: np.ndarray) -> list[int]:
    """The exact sum of squares of every row of an integer matrix."""
    most = int(max(values.max(initial=0), -int(values.min(initial=0)))) or 1
    room = _EXACT // (most * most)
    if not room:
        return [sum(v * v for v in row) for row in values.tolist()]
    floats = values.astype(np.float64)
    total = [0] * len(floats)
    for i in range(0, floats.shape[1], room):
        part = floats[:, i:i + room]
        total = [t + int(s) for t, s in zip(total, np.einsum("ij,ij->i", part, part))]
    return total


def _totals(rows: DataFrame, run) -> list[int]:
    """Sums by slot of what ``run`` yields in every task."""
    summed = rows.mapInArrow(run, "slot int, total decimal(38,0)").groupBy("slot").agg(F.sum("total").alias("total"))
    found = {r["slot"]: int(r["total"]) for r in summed.collect()}
    return [found[i] for i in range(len(found))]


def _sums(values: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(values)), type=pa.int32()),
                                       pa.array([Decimal(v) for v in values], type=pa.decimal128(38, 0))], schema=_SUMS)


def plain_sums(rows: DataFrame, dims: int) -> list[int]:
    """The sum of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for slab in slabs(batches, SLAB):
            x = matrix(slab, "_x", dims)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)  # two halves, neither of which can overflow
            total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high, low)]
        yield _sums(total)

    return _totals(rows.select("_x"), run)


def polarised_sums(rows: DataFrame, dims: int, centre: list[int]) -> list[int]:
    """Sums of squares of the centred values of every dimension, then of the sum of every two dimensions a < b in order."""
    middle = np.array(centre, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dims + dims * (dims - 1) // 2)
        for slab in slabs(batches, SLAB):
            y = np.ascontiguousarray((matrix(slab, "_x", dims) - middle).T)
            found = square_sums(y)
            for a in range(dims - 1):
                found += square_sums(y[a] + y[a + 1:])
            total = [t + f for t, f in zip(total, found)]
        yield _sums(total)

    return _totals(rows.select("_x"), run)


def polarised_covariance(n: int, sums: list[int], centre: list[int], squares: list[int]) -> np.ndarray:
    """Covariances as differences of variances, in integers up to one division each."""
    dims = len(sums)
    rest = [s - n * m for s, m in zip(sums, centre)]
    own = [n * q - t * t for q, t in zip(squares, rest)]  # n ** 2 times the variance
    out = np.zeros((dims, dims))
    at = dims
    for a in range(dims):
        out[a, a] = own[a] / (n * n)
        for b in range(a + 1, dims):
            pair = n * squares[at] - (rest[a] + rest[b]) ** 2
            out[a, b] = out[b, a] = (pair - own[a] - own[b]) / (2 * n * n)
            at += 1
    return out


def fit_whitener(rows: DataFrame, dims: int) -> Whitener:
    """Two passes over stored rows with ``_x``; at least one row."""
    n = rows.count()
    sums = plain_sums(rows, dims)
    centre = [nearest(s, n) for s in sums]
    covariance = polarised_covariance(n, sums, centre, polarised_sums(rows, dims, centre))
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1]
    return Whitener(n, sums, values[order], vectors[:, order], float(np.trace(covariance)))


def project(rows: DataFrame, whitener: Whitener, kept: list[str], components: int) -> DataFrame:
    """The columns ``kept``, ``deviation_exact``, and ``_w``, the whitened components (NULL where nothing varies)."""
    n, sums, dims = whitener.n, whitener.sums, len(whitener.sums)
    middle = np.array(whitener.centre, dtype=np.int64)
    rest = [s - n * m for s, m in zip(sums, whitener.centre)]
    fraction = np.array([t / n for t in rest])
    varied = whitener.varied[:components]
    scaled = whitener.vectors[:, :components] / np.sqrt(np.where(varied, whitener.values[:components], 1.0))
    squared_rest = sum(t * t for t in rest)
    most_rest = max(map(abs, rest), default=0)
    fields = [rows.schema[c] for c in kept]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in fields], "deviation_exact decimal(38,0)", "_w array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches, SLAB):
            y = matrix(slab, "_x", dims) - middle
            most = int(np.abs(y).max(initial=1)) or 1
            # sum((n * y - T) ** 2) = n ** 2 * sum(y ** 2) - 2 * n * sum(y * T) + sum(T ** 2), whose parts fit into longs or are Python's
            if dims * most * most < _EXACT * 512 and dims * most * max(1, most_rest) < _EXACT * 512:
                squares = (y * y).sum(axis=1).tolist()
                mixed = (y * np.array(rest, dtype=np.int64)).sum(axis=1).tolist()
            else:
                listed = y.tolist()
                squares = [sum(v * v for v in row) for row in listed]
                mixed = [sum(v * t for v, t in zip(row, rest)) for row in listed]
            exact = [n * n * q - 2 * n * p + squared_rest for q, p in zip(squares, mixed)]
            white = (y - fraction) @ scaled
            flat = pa.array(white.ravel(), mask=np.broadcast_to(~varied, white.shape).ravel().copy())
            offsets = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
            yield pa.RecordBatch.from_arrays([
                *[slab.column(c).combine_chunks() for c in kept],
                pa.array([Decimal(v) if v < 10 ** 38 else None for v in exact], type=pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(offsets, flat)], names=[*kept, "deviation_exact", "_w"])

    return rows.select(*kept, "_x").mapInArrow(run, schema)


def identity_error(white: DataFrame, varied: np.ndarray) -> float | None:
    """The largest entry of the covariance of ``_w`` minus the identity, over the components that vary, measured on the rows."""
    at = [int(i) for i in np.flatnonzero(varied)]
    if not at:
        return None
    means = white.agg(*[F.avg(F.get("_w", F.lit(i))).alias(f"m{i}") for i in at]).first()
    centred = {i: F.get("_w", F.lit(i)) - F.lit(means[f"m{i}"]) for i in at}
    pairs = [(a, b) for a in at for b in at if a <= b]
    found = white.agg(*[F.avg(centred[a] * centred[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, deviation_exact) per usable row and component."""
    rows, dims = integer_vectors(vectors.select(vec_id, embedding), embedding)
    id_type = vectors.schema[vec_id].dataType.simpleString()
    if not dims:
        return vectors.sparkSession.createDataFrame([], f"`{vec_id}` {id_type}, component int, n long, deviation long, whitened double, "
                                                        "explained double, identity_error double, deviation_exact decimal(38,0)")
    fitted = fit_whitener(rows, dims)
    components = min(components, dims)
    white = staged(project(rows, fitted, [vec_id], components), "whitened")
    error = identity_error(white, fitted.varied[:components])
    share = [float(max(v, 0.0) / fitted.trace) if fitted.trace > 0 else None for v in fitted.values[:components]]
    shares = F.array(*[F.lit(s).cast("double") for s in share])
    unrolled = white.select(vec_id, "deviation_exact", F.posexplode("_w").alias("_at", "whitened"))
    return unrolled.select(
        vec_id, (F.col("_at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"),
        F.col("deviation_exact").try_cast("long").alias("deviation"), "whitened", F.get(shares, F.col("_at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"), "deviation_exact")


@llm_query("op13_polarised_whitening")
def op13_polarised_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
