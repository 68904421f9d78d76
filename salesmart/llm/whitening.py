"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

Vectors are put on a grid, ``floor(scale * c) + offset``, so every sum over rows is a sum of
integers: exact, and the same in any order of tasks. Two scans give the sums of each dimension
and the scatter about the whole number next to the mean; that centre keeps the products small, and
the rest of the centring, done in exact integers, loses nothing. Only the sums leave the tasks:
for d dimensions d*(d+1)/2 numbers a task, added up by Spark and d*(d+1)/2 numbers on the driver.

The scatter is factored by Cholesky with pivoting, P' V P = L L', which stops at the rank. One-sided
Jacobi turns columns of that triangular factor until they are orthogonal: V itself is never iterated
on, so small eigenvalues keep their relative accuracy. Norms of the turned columns give the
eigenvalues, the normalised columns the components. A third scan measures the covariance of the
whitened rows.

Defined results: rows whose vector is NULL, empty, holds NULL, NaN, infinite entries or entries
beyond the grid (2**52), or has not the usual length (the one of most rows, of several the largest) take
no part and are left out. Repeated rows count each time; ids play no role and may be NULL.
Directions without any spread have no component; without a component there are no whitened values.
Columns of the caller are kept; one that has the name of a result gives way to it. An empty table
gives an empty table. ``deviation`` is NULL where it is beyond a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import flat, lists, quoted, with_columns

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32

#: Entries on the grid are below this.
LIMIT = 2**52

#: Halves of a number on the grid: sums of each stay in a long up to 2**36 rows.
HALF = 26

#: Whole numbers that a double holds exactly, and largest long.
EXACT, LONG = 2**53, 2**63 - 1

#: Jacobi: sweeps at most, and the cosine between two columns that counts as none.
SWEEPS, COSINE = 60, 1e-15

RESULTS = ["n", "deviation", "whitened"]


@dataclass
class Whitening:
    """What `fit` learns: rows, sums of each dimension, components by falling eigenvalue."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray  # a column each
    trace: float
    scale: int = SCALE
    offset: int = OFFSET
    explained: np.ndarray = field(init=False)

    def __post_init__(self):
        self.explained = self.eigenvalues / self.trace if self.trace else self.eigenvalues

    def centre(self) -> tuple[np.ndarray, list[int]]:
        """The whole number next to each mean, and n times what is left of the mean."""
        whole = [_nearest(s, self.n) for s in self.sums]
        return np.array(whole, np.int64), [s - self.n * w for s, w in zip(self.sums, whole)]


def _nearest(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def on_grid(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """The vector in whole numbers; NULL where it takes no part."""
    entries = vector.cast("array<double>")
    fine = F.forall(entries, lambda c: F.coalesce(F.abs(c * scale) < LIMIT - offset - 1, F.lit(False)))
    whole = F.transform(entries, lambda c: F.floor(c * scale) + F.lit(offset).cast("bigint"))
    return F.when(fine & (F.size(entries) > 0), whole)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and sums of each dimension, for the usual length; ``rows`` have x and d."""
    low = F.col("c").bitwiseAND(2**HALF - 1)
    found = (
        rows.select("d", F.posexplode("x").alias("at", "c"))
        .groupBy("d", "at")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("c", HALF)).alias("high"), F.sum(low).alias("low"))
        .groupBy("d")
        .agg(F.max("n").alias("n"), F.collect_list(F.struct("at", "high", "low")).alias("sums"))
        .orderBy(F.desc("n"), F.desc("d"))
        .first()
    )
    if found is None:
        return 0, []
    return found.n, [(s.high << HALF) + s.low for s in sorted(found.sums)]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return flat(column)[0].reshape(-1, d)


def _products(rows: np.ndarray) -> np.ndarray:
    """Sums of products of the columns of whole numbers, exact, as Python integers."""
    largest = int(np.abs(rows).max(initial=0))
    d = rows.shape[1]
    total = np.zeros((d, d), object)
    if largest * largest >= EXACT:
        rows = rows.astype(object)
        return total + rows.T @ rows
    step = max(1, min(len(rows), EXACT // max(1, largest * largest)))
    for begin in range(0, len(rows), step):
        part = rows[begin:begin + step].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _added(rows: DataFrame, kind: str) -> list:
    """Element-wise sum of the lists ``part``, in order."""
    found = (
        rows.select(F.posexplode("part").alias("at", "v"))
        .groupBy("at").agg(F.sum("v").cast(kind).alias("v")).collect()
    )
    return [row.v for row in sorted(found)]


def _scatter(rows: DataFrame, whole: np.ndarray) -> np.ndarray:
    """Upper triangle of the scatter about ``whole``, row by row, in exact integers."""
    upper = np.triu_indices(len(whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(whole), len(whole)), object)
        seen = False
        for batch in batches:
            total += _products(_matrix(batch.column("x"), len(whole)) - whole)
            seen = True
        if seen:
            part = pa.array([[Decimal(int(v)) for v in total[upper]]], pa.list_(pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays([part], names=["part"])

    parts = rows.select("x").mapInArrow(run, "part array<decimal(38,0)>")
    return np.array([int(v) for v in _added(parts, "decimal(38,0)")], object)


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """G with G G' = v (symmetric, not negative): rows in the order of v, a column per pivot.

    With rows in the order of the pivots it is lower triangular. It ends where what is left of
    the diagonal is rounding error.
    """
    d = len(v)
    left = v.diagonal().astype(float).copy()
    floor = left.max(initial=0.0) * d * np.finfo(float).eps
    factor = np.zeros((d, d))
    for k in range(d):
        pivot = int(np.argmax(left))
        if left[pivot] <= floor:
            return factor[:, :k]
        column = v[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        factor[:, k] = column / np.sqrt(left[pivot])
        factor[left == 0, k] = 0  # done before: exactly nothing left
        factor[pivot, k] = np.sqrt(left[pivot])
        left = np.maximum(left - factor[:, k] ** 2, 0)
        left[pivot] = 0
    return factor


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of pairs without a common column."""
    ring = list(range(n + n % 2))
    rounds = []
    for _ in range(len(ring) - 1):
        pairs = [(min(p), max(p)) for p in zip(ring[:len(ring) // 2], reversed(ring)) if max(p) < n]
        if pairs:
            rounds.append(tuple(np.array(side) for side in zip(*pairs)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return rounds


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and components (columns) of ``factor @ factor.T``."""
    g = factor.copy()
    rounds = _rounds(g.shape[1])
    for _ in range(SWEEPS):
        turned = False
        for left, right in rounds:
            a, b = g[:, left], g[:, right]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            open_ = np.abs(ab) > COSINE * np.sqrt(aa * bb)
            if not open_.any():
                continue
            turned = True
            with np.errstate(divide="ignore", invalid="ignore"):
                zeta = (bb - aa) / (2 * ab)
                tan = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            tan = np.where(open_, tan, 0)
            cos = 1 / np.hypot(1, tan)
            g[:, left], g[:, right] = cos * (a - tan * b), cos * (b + tan * a)
        if not turned:
            break
    norms = np.sqrt((g * g).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening:
    """Components of ``rows``, whose column x holds vectors on the grid (NULL: no part)."""
    rows = rows.where("x IS NOT NULL").select("x", F.size("x").alias("d"))
    n, sums = _sums(rows)
    d = len(sums)
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, scale, offset)
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, scale, offset)
    whole, rest = model.centre()
    about = _scatter(rows.where(F.col("d") == d), whole)
    v = np.zeros((d, d))
    for value, i, j in zip(about, *np.triu_indices(d)):
        v[i, j] = v[j, i] = (n * value - rest[i] * rest[j]) / (n * n)  # whole numbers, rounded once
    values, vectors = one_sided_jacobi(pivoted_cholesky(v))
    values, vectors = values[:components], vectors[:, :components]
    largest = np.abs(vectors).argmax(0)
    vectors = vectors * np.sign(vectors[largest, np.arange(len(values))])
    return Whitening(n, sums, values, vectors, float(v.trace()), scale, offset)


def _whitener(model: Whitening):
    """A function from rows on the grid to their deviations and whitened values."""
    whole, rest = model.centre()
    d, n = len(whole), model.n
    shift = np.array([r / n for r in rest])
    turn = model.components / np.sqrt(model.eigenvalues)

    def deviation(off: np.ndarray) -> list[int | None]:
        largest = int(np.abs(off).max(initial=0)) + 1
        if (n * largest) ** 2 * d <= LONG:
            return ((n * off - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        exact = ((n * off.astype(object) - np.array(rest, object)) ** 2).sum(1).tolist()
        return [value if value <= LONG else None for value in exact]

    def run(x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        off = x - whole
        return deviation(off), (off - shift) @ turn

    return run


def whiten(
    docs: DataFrame, model: Whitening, vector: str = "embedding", keep: list[str] | None = None
) -> DataFrame:
    """Columns ``keep`` (all) of the rows that take part, with n, deviation and whitened (a list)."""
    names = docs.columns if keep is None else keep
    names = [name for name in names if name.lower() not in RESULTS]
    d = len(model.sums)
    grid = on_grid(docs[quoted(vector)], model.scale, model.offset).alias("x")
    kept = F.struct(F.lit(0).alias("_"), *map(quoted, names)).alias("kept")
    rows = docs.select(kept, grid).where(F.size("x") == d).where(F.lit(model.n > 0))
    schema = T.StructType([
        rows.schema["kept"], T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _whitener(model) if model.n else None
        for batch in batches:
            off, white = work(_matrix(batch.column("x"), d))
            ends = np.arange(len(white) + 1) * white.shape[1]
            columns = [batch.column("kept"), pa.array([model.n] * len(off), pa.int64()),
                       pa.array(off, pa.int64()), lists(white.ravel(), ends)]
            yield pa.RecordBatch.from_arrays(columns, names=["kept", *RESULTS])

    back = [F.col(f"kept.{quoted(name)}").alias(name) for name in names]
    return rows.mapInArrow(run, schema).select(*back, *RESULTS)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of whitened rows minus the identity; rows as for `fit`.

    Sums of a task are rounded to twelve places, so their order does not matter.
    """
    d, k = len(model.sums), len(model.eigenvalues)
    if not k:
        return 0.0
    upper = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, total, seen = _whitener(model), np.zeros(k + len(upper[0])), False
        for batch in batches:
            _, white = work(_matrix(batch.column("x"), d))
            total += np.concatenate([white.sum(0), (white.T @ white)[upper]])
            seen = True
        if seen:
            part = pa.array([[_places(v) for v in total]], pa.list_(pa.decimal128(38, 12)))
            yield pa.RecordBatch.from_arrays([part], names=["part"])

    rows = rows.where(F.size("x") == d).select("x")
    sums = np.array([float(v) for v in _added(
        rows.mapInArrow(run, "part array<decimal(38,12)>"), "decimal(38,12)")])
    mean, products = sums[:k] / model.n, sums[k:] / model.n
    covariance = products - mean[upper[0]] * mean[upper[1]]  # the means are rounding errors
    return float(np.abs(covariance - (upper[0] == upper[1])).max())


def _places(value: float) -> Decimal:
    with localcontext() as context:
        context.prec = 60
        return Decimal(float(value)).quantize(Decimal("1e-12"))


def op13_whitening(spark, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = with_columns(rows, {"vec_id": "bigint", "embedding": "array<double>"})
    grid = rows.select(on_grid(F.col("embedding")).alias("x"))
    model = fit(grid)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return (
        whiten(rows, model, keep=["vec_id"])
        .select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
            F.get(explained, F.col("at")).alias("explained"),
            F.lit(identity_error(grid, model)).alias("identity_error"),
        )
    )
