"""Whitening of embeddings with an exact polarisation covariance.

Entries become integers, floor(scale * c) + offset, and so all sums are exact. The fit
list holds each distinct vector once. With n vectors x and sums S per dimension, the
centred value n * x - S is an integer too; every task adds up its squares for each
dimension and for each sum of two dimensions. As

    (a + b)**2 - a**2 - b**2 = 2ab

the variances of the pair sums give all cross-covariances without a product of two
dimensions. What meets is one number per pair and task, whatever the number of rows;
the driver gets d * (d + 1) / 2 integers and has their matrix decomposed by ``eigh``.

Squares are added in limbs of 24 bits, so nothing overflows and nothing is rounded before
the covariance itself is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from keepwell.llm.common import ship, written

_EXACT = pa.decimal128(38, 0)
_LIMB = 24
#: Rows whose limb products (under 2**48 each) sum up within 62 bits.
_ROWS = 1 << 14


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found: ``n`` distinct vectors of ``dimensions`` entries, their ``sums`` per
    dimension, the ``covariance``, all its eigenvalues (``values``, falling) and the leading
    unit eigenvectors as columns (``vectors``, only those with variance). ``explained`` is
    each value's part of the trace, ``identity_error`` the largest absolute entry of the
    covariance of the whitened fit list less the identity."""

    n: int
    dimensions: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float
    scale: int
    offset: int
    components: int


def entries(vector: Column, scale: int, offset: int) -> Column:
    """``vector`` as integers; null unless it is given and all its entries are finite."""
    values = vector.cast("array<double>")
    finite = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite, F.transform(values, lambda c: F.floor(c * scale) + F.lit(offset).cast("long")))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def square_sums(p: np.ndarray) -> np.ndarray:
    """Exact column sums of ``p ** 2`` (int64 rows, under 2**62 in size) as Python integers."""
    limbs = max(1, -(-int(np.abs(p).max(initial=0)).bit_length() // _LIMB))
    total = np.zeros(p.shape[1], dtype=object)
    for at in range(0, len(p), _ROWS):
        rows = p[at:at + _ROWS]
        parts = [(rows >> _LIMB * k) & ((1 << _LIMB) - 1) for k in range(limbs - 1)] + [rows >> _LIMB * (limbs - 1)]
        for i in range(limbs):
            for j in range(i, limbs):
                total += (parts[i] * parts[j]).sum(axis=0).astype(object) * (1 << (_LIMB * (i + j) + (i != j)))
    return total


def _numbers(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([Decimal(int(v)) for v in c] if f.type == _EXACT else c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema)


def _sums(batches: Iterable[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    total, low, high = np.zeros(dimensions, dtype=object), None, None
    for batch in batches:
        x = _matrix(batch.column(0), dimensions)
        if len(x):
            total += x.sum(axis=0).astype(object)
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
    if low is not None:
        schema = pa.schema([("i", pa.int32()), ("total", _EXACT), ("low", pa.int64()), ("high", pa.int64())])
        yield _numbers([list(range(dimensions)), list(total), low.tolist(), high.tolist()], schema)


@dataclass(frozen=True)
class _Centre:
    """n * x - S as ``n * (x - whole) - rest`` with S = n * whole + rest, which stays in 62 bits."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: Iterable[int]) -> _Centre:
        pairs = [divmod(s, max(n, 1)) for s in sums]
        return cls(n, np.array([p[0] for p in pairs], dtype=np.int64), np.array([p[1] for p in pairs], dtype=np.int64))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.n * (x - self.whole) - self.rest


def _squares(batches: Iterable[pa.RecordBatch], centre: _Centre) -> Iterator[pa.RecordBatch]:
    d = len(centre.whole)
    own, pairs, seen = np.zeros(d, dtype=object), [np.zeros(d - i - 1, dtype=object) for i in range(d)], False
    for batch in batches:
        y = centre(_matrix(batch.column(0), d))
        seen = seen or len(y) > 0
        own += square_sums(y)
        for i in range(d - 1):
            pairs[i] += square_sums(y[:, i + 1:] + y[:, i:i + 1])
    if seen:
        at = [(i, i) for i in range(d)] + [(i, j) for i in range(d) for j in range(i + 1, d)]
        schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", _EXACT)])
        yield _numbers([[a for a, _ in at], [b for _, b in at], [*own, *(v for p in pairs for v in p)]], schema)


def _project(x: np.ndarray, centre: _Centre, values: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return (centre(x) / centre.n) @ vectors / np.sqrt(values[:vectors.shape[1]])


def _outer(batches: Iterable[pa.RecordBatch], centre: _Centre, values: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
    k = vectors.shape[1]
    total = np.zeros((k + 1, k))  # the last row: plain sums
    for batch in batches:
        w = _project(_matrix(batch.column(0), len(centre.whole)), centre, values, vectors)
        total += np.vstack([w.T @ w, w.sum(axis=0)])
    at = [(a, b) for a in range(k + 1) for b in range(k)]
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("total", pa.float64())])
    yield _numbers([[a for a, _ in at], [b for _, b in at], total.ravel().tolist()], schema)


def covariance(n: int, own: list[int], pairs: dict[tuple[int, int], int]) -> np.ndarray:
    """From the exact squares of centred values (times n) and of their pair sums; each entry
    is rounded once."""
    out = np.diag([v / n ** 3 for v in own])
    for (i, j), total in pairs.items():
        out[i, j] = out[j, i] = (total - own[i] - own[j]) / (2 * n ** 3)
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding", scale: int = 64, offset: int = 1_000_000,
        components: int = 16) -> Whitening:
    """The whitening of the distinct vectors of ``vectors``.

    Vectors that are null or hold null or non-finite entries are left out, and so are those
    of another length than the commonest among the distinct ones (the longest of equally
    common). Repeated rows count once. No vectors: ``n`` is 0. Dimensions without variance
    give eigenvalues of zero, which are not whitened. Entries must stay under 2**62 when
    scaled, shifted, centred and multiplied by ``n``; larger ones are an error.
    """
    spark = vectors.sparkSession
    ship(spark)
    points = written(vectors.select(entries(F.col(f"`{vector_col}`"), scale, offset).alias("x"))
                     .where("x is not null").distinct(), "points")
    lengths = points.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d, n = (lengths["d"], lengths["count"]) if lengths else (0, 0)
    nothing = Whitening(n, d, (), np.zeros((d, d)), np.zeros(d), np.zeros((d, 0)), np.zeros(d), 0.0, scale, offset, components)
    if not d:
        return nothing
    points = points.where(F.size("x") == d)
    found = (points.mapInArrow(partial(_sums, dimensions=d), "i int, total decimal(38,0), low long, high long").groupBy("i")
             .agg(F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect())
    if n * (max(r["high"] - r["low"] for r in found) + 1) >= 1 << 61:
        raise OverflowError("entries are too far apart for exact sums of this many vectors")
    sums = tuple(int(r["total"]) for r in found)
    centre = _Centre.of(n, sums)
    squares = {(r["i"], r["j"]): int(r["total"]) for r in
               points.mapInArrow(partial(_squares, centre=centre), "i int, j int, total decimal(38,0)")
               .groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    v = covariance(n, [squares[i, i] for i in range(d)], {at: s for at, s in squares.items() if at[0] < at[1]})
    rising, columns = np.linalg.eigh(v)
    values, columns = np.maximum(rising[::-1], 0.0), columns[:, ::-1]
    real = int((values > d * np.finfo(float).eps * values[0]).sum())  # the others are rounding
    leading = np.ascontiguousarray(columns[:, :min(components, real)])
    trace = float(np.trace(v))
    explained = values / trace if trace else np.zeros(d)
    error, k = 0.0, leading.shape[1]
    if k:
        total = np.zeros((k + 1, k))
        for r in (points.mapInArrow(partial(_outer, centre=centre, values=values, vectors=leading), "a int, b int, total double")
                  .groupBy("a", "b").agg(F.sum("total").alias("total")).collect()):
            total[r["a"], r["b"]] = r["total"]
        mean = total[k] / n
        error = float(np.abs(total[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, d, sums, v, values, leading, explained, error, scale, offset, components)


def _transform(batches: Iterable[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    centre, k, real = _Centre.of(model.n, model.sums), min(model.components, model.dimensions), model.vectors.shape[1]
    for batch in batches:
        x = _matrix(batch.column(1), model.dimensions)
        m = len(x)
        deviation = np.repeat(square_sums(np.ascontiguousarray(centre(x).T)), k)
        white = np.full((m, k), np.nan)
        white[:, :real] = _project(x, centre, model.values, model.vectors)
        component = np.tile(np.arange(k), m)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(component + 1, pa.int32()),
             pa.array([Decimal(int(v)) for v in deviation], _EXACT),
             pa.array(white.ravel(), pa.float64(), mask=component >= real), pa.array(model.explained[component], pa.float64())],
            names=["id", "component", "deviation", "whitened", "explained"])


def transform(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per vector of ``vectors`` and component up to ``model.components``: ``id_col``,
    ``component`` (from 1, by falling eigenvalue), ``n``, ``deviation`` (decimal: the exact sum
    over dimensions of (n * x - S) ** 2), ``whitened``, ``explained``, ``identity_error``.

    Vectors that ``fit`` leaves out have no rows; null and repeated ids are kept as they are.
    ``whitened`` is null for a component without variance. Other columns are ignored, whatever
    their names; an empty table, or a model of no vectors, gives no rows.
    """
    made = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    if id_col in made:
        raise ValueError(f"the id column may not be named like a result: {id_col}")
    ship(vectors.sparkSession)
    schema = StructType([StructField("id", vectors.schema[id_col].dataType), StructField("component", IntegerType()),
                         StructField("deviation", DecimalType(38, 0)), StructField("whitened", DoubleType()),
                         StructField("explained", DoubleType())])
    x = entries(F.col(f"`{vector_col}`"), model.scale, model.offset)
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), x.alias("x")).where(
        F.col("x").isNotNull() & (F.size("x") == model.dimensions) & F.lit(model.n > 0 and model.dimensions > 0))
    out = rows.mapInArrow(partial(_transform, model=model), schema)
    return out.select(F.col("id").alias(id_col), "component", F.lit(model.n).cast(LongType()).alias("n"), "deviation", "whitened",
                      "explained", F.lit(model.identity_error).alias("identity_error"))
