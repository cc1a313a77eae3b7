"""Whitening of vectors by principal components, with covariances from variances alone.

Components are integers, ``floor(scale * c) + shift``. No products of two dimensions are summed:
the squared centred values of every dimension and of the sum of every two dimensions are, and
half the difference ``Var(x_i + x_j) - Var(x_i) - Var(x_j)`` is their covariance
(polarisation). With n vectors and sums S the centred values are the integers ``n * x - S``,
written as ``n * (x - q) - r`` with ``q = S // n``, ``r = S % n``. Tasks add the small integers
``x - q`` and their squares, one row per sum and task, Spark adds those rows up, and the driver
puts ``n`` and ``r`` back in whole numbers; no sum is rounded. It gets one number for each
dimension and pair of dimensions, however many vectors there are, and decomposes the matrix.

A map then projects every vector, and one more aggregate measures the covariance of what was
written, less the identity.

Edge cases: vectors that are null or hold null or non-finite entries take no part, nor do
vectors without entries or, where lengths differ, of another length than the most common one
(the greater of equally common ones); rows without an id take part and stay; rows that repeat
count and stay each time; fewer than ``k`` dimensions give as many components; a component
without variance has null ``whitened`` (all do, where the vectors are equal; ``explained`` is
null too, then), and ``identity_error`` measures the others, null if there are none. Equal
eigenvalues: any orthogonal choice, the same for all rows. A deviation beyond 64 bits is null.
Entries whose integer is beyond 2^52 raise an error. Extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cupola.session import materialise

#: Rows that a task works on at once.
ROWS = 2048
#: Share of the largest eigenvalue, per dimension, under which a component has no variance.
FLAT = 1e-14
LARGEST = 1 << 52


def sound(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows ``(id, v array<double>)`` of the vectors that take part."""
    v = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == F.lit(sizes[0]["d"] if sizes else 0))


def integers(column, scale: int, shift: int) -> np.ndarray:
    """The integer vectors of an Arrow list column, one per row."""
    x = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
    if len(x) and np.abs(x).max() > LARGEST - abs(shift):
        raise ValueError("an entry is too large to be taken as an integer of 52 bits")
    return x.astype(np.int64) + shift


def _slices(batches) -> Iterator:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def _added(rows: DataFrame, terms: Callable, scale: int, shift: int) -> dict[tuple[int, int], int]:
    """Whole-number sums by key ``(i, j)`` of what ``terms`` gives for a matrix of integers."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for part in _slices(batches):
            for key, value in terms(integers(part.column(0), scale, shift)):
                total[key] = total.get(key, 0) + value
        if total:
            i, j = zip(*total)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(t) for t in total.values()])], ["i", "j", "t"])

    parts = rows.select("v").mapInArrow(run, "i int, j int, t string").groupBy("i", "j")
    got = parts.agg(F.sum(F.col("t").cast("decimal(38,0)")).alias("t")).collect()  # a row per dimension or pair of them
    return {(r["i"], r["j"]): int(r["t"]) for r in got}


def _sums(x: np.ndarray):
    yield (-1, -1), len(x)
    for i, s in enumerate(x.sum(0, dtype=object) if np.abs(x).max(initial=0) > 1 << 50 else x.sum(0)):
        yield (i, -1), int(s)


def _squares(q: list[int]) -> Callable:
    """Squares of ``x_i - q_i``, keyed ``(i, i)``, and of ``x_i - q_i + x_j - q_j``, keyed ``(i, j)``."""
    centre = np.array(q, np.int64)

    def terms(x: np.ndarray):
        y = x - centre
        most = 2 * int(np.abs(y).max(initial=0))
        if most * most * len(y) >= 1 << 63:  # rare: sums beyond 64 bits are made of Python's integers
            y = y.astype(object)
        y = np.asfortranarray(y)
        for i in range(y.shape[1]):
            yield (i, i), int((y[:, i] * y[:, i]).sum())
            both = y[:, i : i + 1] + y[:, i + 1 :]
            for j, t in enumerate((both * both).sum(0), i + 1):
                yield (i, j), int(t)

    return terms


class Fit:
    """Exact moments of the vectors, and the components that they give."""

    def __init__(self, n: int, sums: list[int], squares: dict[tuple[int, int], int], k: int):
        d = len(sums)
        self.n, self.sums = n, sums
        self.q, self.r = [s // n for s in sums], [s % n for s in sums]

        def centred(i: int, j: int) -> int:  # sum of (n * x_i - S_i [+ n * x_j - S_j])^2
            both = i != j
            r = self.r[i] + self.r[j] * both
            # the sum of x - q is r, whatever the dimension
            return n * n * squares[i, j] - 2 * n * r * r + n * r * r

        one = [centred(i, i) for i in range(d)]
        self.covariance = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                c = one[i] if i == j else Fraction(centred(i, j) - one[i] - one[j], 2)
                self.covariance[i, j] = self.covariance[j, i] = float(Fraction(c, n**3))
        self.trace = float(Fraction(sum(one), n**3))
        values, vectors = np.linalg.eigh(self.covariance)
        order = np.argsort(-values, kind="stable")[: min(k, d)]
        self.values, self.vectors = values[order], vectors[:, order]
        top = np.abs(self.vectors).argmax(0)  # one sign for all rows: the largest entry is positive
        self.vectors = self.vectors * np.where(self.vectors[top, range(len(order))] < 0, -1.0, 1.0)
        self.flat = ~(self.values > FLAT * d * max(float(values.max()), 0.0))
        self.explained = self.values / self.trace if self.trace > 0 else np.full(len(order), np.nan)


def fit(rows: DataFrame, scale: int = 1024, shift: int = 100000, k: int = 8) -> Fit | None:
    """The fit on all rows of ``sound``; None without rows."""
    first = _added(rows, _sums, scale, shift)
    if not first:
        return None
    n = first.pop((-1, -1))
    sums = [first[i, -1] for i in range(len(first))]
    return Fit(n, sums, _added(rows, _squares([s // n for s in sums]), scale, shift), k)


def project(rows: DataFrame, model: Fit, scale: int = 1024, shift: int = 100000) -> DataFrame:
    """Rows ``(id, deviation, w array<double>)``: whitened coordinates, null without variance."""
    import pyarrow as pa

    kind = rows.schema["id"].dataType.simpleString()
    n, q, r = model.n, np.array(model.q, np.int64), np.array(model.r, object)
    part_mean = np.array([float(Fraction(int(a), n)) for a in r])
    to = np.where(model.flat, np.nan, 1.0) * model.vectors / np.sqrt(np.where(model.flat, 1.0, model.values))
    sum_rr = int(sum(int(a) ** 2 for a in r))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            y = integers(part.column(1), scale, shift) - q
            most = int(np.abs(y).max(initial=0))
            wide = y.astype(object) if (most * most + most * n) * y.shape[1] >= 1 << 63 else y
            squares = (wide * wide).sum(1).tolist()
            mixed = (wide * (r if wide.dtype == object else r.astype(np.int64))).sum(1).tolist()
            dev = [n * n * a - 2 * n * b + sum_rr for a, b in zip(squares, mixed)]
            w = (y - part_mean) @ to
            flat = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
            ends = pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32())
            cols = [part.column(0), pa.array([x if x < 1 << 63 else None for x in dev], pa.int64()), pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(cols, ["id", "deviation", "w"])

    return rows.select("id", "v").mapInArrow(run, f"id {kind}, deviation long, w array<double>")


def identity_error(projected: DataFrame, live: int, n: int) -> float | None:
    """Largest absolute entry of the covariance of the first ``live`` coordinates less the identity."""
    import pyarrow as pa

    if not live:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total = np.zeros((live, live)), np.zeros(live)
        for part in _slices(batches):
            w = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)[:, :live]
            gram += w.T @ w
            total += w.sum(0)
        i, j = np.indices((live, live + 1)).reshape(2, -1)
        t = np.column_stack([gram, total]).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(t)], ["i", "j", "t"])

    out = np.zeros((live, live + 1))
    for r in projected.select("w").mapInArrow(run, "i int, j int, t double").groupBy("i", "j").agg(F.sum("t").alias("t")).collect():  # k by k + 1 numbers
        out[r["i"], r["j"]] = r["t"] / n
    mean = out[:, live]
    return float(np.abs(out[:, :live] - np.outer(mean, mean) - np.eye(live)).max())


def whiten(vectors: DataFrame, k: int = 8, scale: int = 1024, shift: int = 100000, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows ``(id, component, n, deviation, whitened, explained, identity_error)``: the ``k``
    leading whitened coordinates of every vector, numbered from 1 by falling eigenvalue."""
    rows = sound(vectors, id_col, vec_col)
    model = fit(rows, scale, shift, k)
    if model is None:
        kind = vectors.schema[id_col].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    projected = materialise(project(rows, model, scale, shift))
    error = identity_error(projected, int((~model.flat).sum()), model.n)
    explained = F.array(*[F.lit(None if np.isnan(e) else float(e)).cast("double") for e in model.explained])
    return (
        projected.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
        .select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
    )
