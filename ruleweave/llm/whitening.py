"""Embedding whitening: principal directions of unit variance, from a blockwise QR and a qd solver.

Entries are put on an integer grid, so means and deviations are exact. The distinct grid vectors are
centred and reduced to triangular factors, block by block and then in a tree of factors; only the last
one, of the size of the dimension squared, reaches the driver, where `qd` takes its singular values and
right singular vectors. The covariance itself is never formed, so small variances keep their accuracy.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.qd import right_singular
from ruleweave.llm.stage import staged

STEPS = 64
OFFSET = 1_000_000
#: Entries handled at once in a task, and factors merged by one.
_BLOCK = 1 << 21
_MERGE = 16
_LONG = 1 << 63


def grid_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): rows whose vector has only finite entries, on the grid x = floor(64 c) + 1,000,000.

    Entries of 2^56 or more have no place on the grid and count as not finite; so do empty vectors.
    """
    v = F.col(f"`{vector_col}`")
    whole = F.forall(v, lambda c: F.coalesce(F.abs(c) < F.lit(float(1 << 56)), F.lit(False)) & ~F.isnan(c))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & whole).select(
        F.col(f"`{id_col}`").alias("vec_id"),
        F.transform(v, lambda c: F.floor(c.cast("double") * STEPS) + F.lit(OFFSET).cast("bigint")).alias("x"))


def _matrices(batch: pa.RecordBatch, dim: int):
    """(first row, matrix) slices of the batch's x column."""
    flat = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
    rows = max(1, _BLOCK // dim)
    for at in range(0, batch.num_rows, rows):
        yield at, flat[at * dim:(at + rows) * dim].reshape(-1, dim)


def column_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension."""
    def run(batches):
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            for _, x in _matrices(batch, dim):
                n += len(x)
                high += (x >> 24).sum(axis=0)
                low += (x & 0xFFFFFF).sum(axis=0)
        yield pd.DataFrame({"j": np.arange(-1, dim), "high": [0, *high], "low": [n, *low]}).pipe(
            lambda d: pa.RecordBatch.from_pandas(d, preserve_index=False))

    sums = fit.mapInArrow(run, "j bigint, high bigint, low bigint").groupBy("j").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    got = {r.j: (int(r.high) << 24) + int(r.low) for r in sums.collect()}    # one row per dimension
    return got.pop(-1), [got[j] for j in range(dim)]


class Centre:
    """Exact centring: x - S/n as an integer part and a remainder shared by all rows."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None where a long can't hold it."""
        a = x - self.whole
        most = (int(np.abs(a).max()) + 1) * self.n if a.size else 0
        if most <= isqrt(_LONG - 1) // (isqrt(max(1, a.shape[1])) + 1):
            return ((a * self.n - np.array(self.rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        rest = np.array(self.rest, dtype=object)
        out = ((a.astype(object) * self.n - rest) ** 2).sum(axis=1)
        return [int(v) if v < _LONG else None for v in out]


def _stacked(upper: np.ndarray | None, block: np.ndarray) -> np.ndarray:
    """The triangular factor, square, of a factor and further rows."""
    both = block if upper is None else np.vstack([upper, block])
    r = np.linalg.qr(both, mode="r")
    if len(r) < r.shape[1]:
        r = np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])
    return r


def triangular_factor(fit: DataFrame, centre: Centre, dim: int) -> np.ndarray:
    """R of the centred rows: one factor per task, merged in a tree of `_MERGE` factors a task."""
    schema = "part bigint, r binary"

    def reduce_rows(batches):
        from pyspark import TaskContext
        upper = None
        for batch in batches:
            for _, x in _matrices(batch, dim):
                upper = _stacked(upper, centre.centred(x))
        if upper is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([upper.tobytes()], pa.binary())], ["part", "r"])

    def merge(key: tuple, factors: pd.DataFrame) -> pd.DataFrame:
        upper = None
        for r in factors.sort_values("part")["r"]:
            upper = _stacked(upper, np.frombuffer(r).reshape(dim, dim))
        return pd.DataFrame({"part": [key[0]], "r": [upper.tobytes()]})

    factors = staged(fit.mapInArrow(reduce_rows, schema), "factors")
    while factors.limit(2).count() > 1:
        by = F.expr(f"part div {_MERGE}").alias("group")
        factors = staged(factors.groupBy(by).applyInPandas(merge, schema), "factors")
    return np.frombuffer(factors.first().r).reshape(dim, dim)


def _identity_error(fit: DataFrame, centre: Centre, whiten: np.ndarray, dim: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = whiten.shape[1]

    def run(batches):
        total, first = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for _, x in _matrices(batch, dim):
                w = centre.centred(x) @ whiten
                total += w.T @ w
                first += w.sum(axis=0)
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array([*i, *range(k)], pa.int32()), pa.array([*j, *[-1] * k], pa.int32()),
                                          pa.array([*total[i, j], *first], pa.float64())], ["i", "j", "s"])

    sums = fit.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    mean = {r.i: r.s / centre.n for r in sums if r.j < 0}     # zero but for rounding
    return max(abs(r.s / centre.n - mean[r.i] * mean[r.j] - (r.i == r.j)) for r in sums if r.j >= 0)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """One row per remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows with a null or empty vector, or with null or non-finite entries, are left out. So are rows that
    are not of the most common dimension (of several, the largest). Ids may be null or repeated; equal
    vectors are fitted once and all returned. Directions without variance (beyond rounding) have no
    component, so a table of one distinct vector, or an empty one, gives no rows. deviation is null where
    it exceeds a long.
    """
    spark = vectors.sparkSession
    rows = grid_rows(vectors, id_col, vector_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common.dim
    rows = rows.where(F.size("x") == dim)
    fit = staged(rows.select("x").distinct(), "fit")
    n, sums = column_sums(fit, dim)
    centre = Centre(n, sums)
    squared, directions, total = right_singular(triangular_factor(fit, centre, dim), components)
    if len(squared) == 0:
        return spark.createDataFrame([], schema)
    matrix = directions / np.sqrt(squared / n)
    explained = (squared / total).tolist()
    error = _identity_error(fit, centre, matrix, dim)
    k = len(explained)

    def run(batches):
        for batch in batches:
            for at, x in _matrices(batch, dim):
                m = len(x)
                ids = batch.column(0).slice(at, m).take(pa.array(np.repeat(np.arange(m), k)))
                white = centre.centred(x) @ matrix
                deviation = pa.array(centre.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), deviation,
                     pa.array(white.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
