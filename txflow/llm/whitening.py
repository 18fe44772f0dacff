"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Centred rows X of the fit list are brought to a bidiagonal B with X V = U B and X'U = V B' by products of X with a vector
v and of X' with a vector u in turn, each new vector made orthogonal to all before it. Vectors v are as long as a row and
live in the driver; vectors u have an entry for each row of the table and are nowhere stored: they are X times a short
vector w, kept instead, and worked out anew from the rows. So a pass over the table is a function of the stored rows and
a small matrix, which an executor that takes over can repeat. One pass makes both products of a step; what the new u has
in common with earlier ones comes back with it, and is taken off both results, which are linear in it. The singular
values of B give the deviations, its right singular vectors and V the components.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import written

SUMS = "part int, v array<double>"
TINY = 1e-13  # of the largest singular value: what is below it is rounding
FAN = 256


@dataclass(frozen=True)
class Grid:
    """Entries become floor(scale * entry) + shift; ``components`` is how many are wanted, ``steps`` how many passes may
    be made. By default there is a step for every dimension, which finds repeated singular values too."""

    scale: int = 64
    shift: int = 1_000_000
    components: int = 16
    steps: int | None = None


@dataclass(frozen=True)
class Fitted:
    """Rows and exact sums of the fit list, and its components (columns) with their eigenvalues; ``trace`` is the sum of
    all eigenvalues and ``identity_error`` how far the whitened fit list is from unit covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def gridded(vectors: DataFrame, column: str = "embedding", grid: Grid = Grid()) -> DataFrame:
    """``vec_id`` and the integer vector ``x`` of every row whose vector has no NULL, NaN or infinite entry.

    Vectors of another length than most (of several lengths as frequent, the longest) cannot be compared and are dropped
    too.
    """
    entry = lambda c: c.cast("double")
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) == math.inf))
    finite = vectors.where(F.col(column).isNotNull() & ~F.coalesce(bad, F.lit(True)))
    x = F.transform(column, lambda c: F.floor(entry(c) * grid.scale) + grid.shift)
    rows = finite.select(F.col("vec_id"), x.alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == (sizes[0].d if sizes else 0))


def centred(x: pa.Array, d: int, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Rows minus the mean: the whole part is taken off as integers, so nothing is lost to the shift."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    rows = np.asarray(x.flatten(), np.int64).reshape(-1, d)
    return (rows - whole).astype(np.float64) - rest


@dataclass(frozen=True)
class FitList:
    """The stored distinct vectors, how many tasks read them, and their number and exact sums."""

    table: DataFrame
    tasks: int
    n: int
    sums: tuple[int, ...]


def summed(held: FitList, size: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of centred rows of a small vector that ``work`` makes of each.

    Each task sends one vector; where there are many tasks, groups of them are summed up first. The order of summation
    is that of the partitions.
    """
    n, sums, d = held.n, held.sums, len(held.sums)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += work(centred(batch.column("x"), d, n, sums))
        yield of_task(total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((p, v) for b in batches for p, v in zip(b.column("part").to_pylist(), b.column("v").to_pylist(), strict=True))
        yield of_task(np.array([v for _, v in got]).sum(0) if got else np.zeros(size))

    def of_task(total: np.ndarray) -> pa.RecordBatch:
        part = pa.array([TaskContext.get().partitionId()], pa.int32())
        return pa.RecordBatch.from_arrays([part, pa.array([total.tolist()], pa.list_(pa.float64()))], ["part", "v"])

    sent = held.table.mapInArrow(partial, SUMS)
    if held.tasks > FAN:
        sent = sent.repartition(math.isqrt(held.tasks)).mapInArrow(merge, SUMS)
    return np.array(sent.repartition(1).mapInArrow(merge, SUMS).first().v)


def step(held: FitList, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both products of a step, in one pass: for u = X w, with w the last column of ``short``, the dot products of u
    with X times each column, and X'u."""
    c = short.shape[1]

    def work(rows: np.ndarray) -> np.ndarray:
        long = rows @ short
        return np.concatenate([long.T @ long[:, -1], rows.T @ long[:, -1]])

    got = summed(held, c + len(held.sums), work)
    return got[:c], got[c:]


def bidiagonal(product: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], d: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """V and B after at most ``steps`` steps; ``product`` is :func:`step` on the table.

    A vector that vanishes leaves a zero in B, and a fresh direction orthogonal to all others goes on from there.
    """
    draws = np.random.default_rng(0)

    def orthogonal(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            for o in others:
                v = v - (o @ v) * o
        return v

    def fresh(others: list[np.ndarray]) -> np.ndarray:
        v = orthogonal(draws.standard_normal(d), others)
        return v / np.linalg.norm(v)

    vs, ws, zs, alphas, betas, largest = [fresh([])], [], [], [], [], 0.0
    while True:
        w = vs[-1] - (betas[-1] * ws[-1] if betas else 0.0)
        for _ in range(2):
            dots, z = product(np.stack([*ws, w], 1))
            common, size = dots[:-1], math.sqrt(max(dots[-1], 0.0))
            for c, earlier, image in zip(common, ws, zs, strict=True):
                w, z = w - c * earlier, z - c * image
            alpha = math.sqrt(max(dots[-1] - common @ common, 0.0))
            if np.abs(common).max(initial=0.0) <= 1e-8 * size:
                break  # taking off so little leaves nothing to take off again
        largest = max(largest, alpha)
        lost = alpha <= TINY * largest
        alphas.append(0.0 if lost else alpha)
        ws.append(np.zeros(d) if lost else w / alpha)
        zs.append(np.zeros(d) if lost else z / alpha)
        if len(vs) == min(steps, d):
            break
        r = orthogonal(zs[-1] - alphas[-1] * vs[-1], vs)
        beta = float(np.linalg.norm(r))
        largest = max(largest, beta)
        ended = beta <= TINY * largest
        betas.append(0.0 if ended else beta)
        vs.append(fresh(vs) if ended else r / beta)
    return np.stack(vs, 1), np.diag(alphas) + np.diag(betas, 1)


def fit(rows: DataFrame, grid: Grid = Grid()) -> tuple[Fitted, DataFrame]:
    """Components of the distinct vectors of ``rows``, and the stored list of these.

    Components whose eigenvalue is zero but for rounding cannot be whitened and are left out; so an empty list, or one of
    a single vector, has none. Only sums with an entry for each dimension or pair of components come to the driver.
    """
    table = written(rows.select("x").distinct(), "whitening-fit")
    each = table.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.sum("c").alias("s"), F.count(F.lit(1)).alias("n"))
    got = sorted(each.collect())
    n, sums = (got[0].n, tuple(r.s for r in got)) if got else (0, ())
    d, held = len(sums), FitList(table, table.rdd.getNumPartitions(), n, sums)
    if n < 2:
        return Fitted(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0), table
    trace = float(summed(held, 1, lambda x: np.array([np.square(x).sum()]))[0]) / n
    basis, b = bidiagonal(lambda short: step(held, short), d, grid.steps or d)
    _, s, right = np.linalg.svd(b)
    k = int((s > TINY * d * max(s[0], 1e-300)).sum())
    k = min(k, grid.components)
    components, eigenvalues = basis @ right[:k].T, np.square(s[:k]) / n
    plain = Fitted(n, sums, components, eigenvalues, trace, 0.0)
    if not k:
        return plain, table
    scaled = components / np.sqrt(eigenvalues)
    mean = summed(held, k, lambda x: (x @ scaled).sum(0)) / n

    def products(x: np.ndarray) -> np.ndarray:
        y = x @ scaled - mean
        return (y.T @ y).ravel()

    error = np.abs(summed(held, k * k, products).reshape(k, k) / n - np.eye(k)).max()
    return Fitted(n, sums, components, eigenvalues, trace, float(error)), table


def deviation(x: Column, fitted: Fitted) -> Column:
    """Sum over dimensions of (n * x - S) squared, in integers; beyond 64 bits it raises, as Spark's integers do."""
    sums = F.array(*[F.lit(s).cast("long") for s in fitted.sums])
    off = F.zip_with(x, sums, lambda a, s: a * F.lit(fitted.n).cast("long") - s)
    return F.aggregate(off, F.lit(0).cast("long"), lambda total, o: total + o * o)


def whitened(rows: DataFrame, fitted: Fitted) -> DataFrame:
    """A row for each row of ``rows`` and component from 1, in order of falling eigenvalue."""
    k, d, n, sums = len(fitted.eigenvalues), len(fitted.sums), fitted.n, fitted.sums
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, deviation long, component int, whitened double, explained double"
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    scaled = fitted.components / np.sqrt(fitted.eigenvalues)
    explained = fitted.eigenvalues / fitted.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            y = centred(batch.column("x"), d, n, sums) @ scaled
            again = pa.array(np.repeat(np.arange(m), k))
            number = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m))
            columns = [batch.column("vec_id").take(again), batch.column("deviation").take(again), number]
            columns += [pa.array(y.ravel()), pa.array(np.tile(explained, m))]
            yield pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in schema.split(", ")])

    return rows.select("vec_id", deviation(F.col("x"), fitted).alias("deviation"), "x").mapInArrow(run, schema)


def op12_whitening(vectors: DataFrame, grid: Grid = Grid(), column: str = "embedding") -> DataFrame:
    """All embeddings whitened by the components of their distinct grid vectors.

    NULL vectors and those with a NULL or non-finite entry are dropped, also those of another length than most. Repeated
    vectors are fitted once and each returned; equal eigenvalues come in any order. Components without deviation are
    left out, so equal vectors alone, or an empty table, give no rows. NULL or repeated vec_ids are kept as they are, and
    other columns are not read. Long vectors need a pass for each dimension unless ``grid.steps`` bounds them.
    """
    rows = gridded(vectors, column, grid)
    fitted, _ = fit(rows, grid)
    return whitened(rows, fitted).select(
        "vec_id",
        "component",
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(fitted.identity_error).alias("identity_error"),
    )
