"""Embedding whitening by a weighted multiplicity covariance.

Entries become whole numbers x = floor(64 c) + 1000000, so equal vectors are found exactly.
Identical x vectors are grouped with their counts (or one) as weights; sums are exact, the
covariance is a weighted product of centred blocks; each distinct vector is whitened once
and joined back to the rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.spark_util import materialise

SCALE, SHIFT = 64, 1_000_000
#: entries beyond this are drawn to it, so that x and its products stay exact
LARGEST = 1e13
#: components whose variance is a smaller share of the whole are rounding, not data
LEAST_SHARE = 1e-13
LONG = 2**63 - 1


@dataclass(frozen=True)
class Whitener:
    n: int  # weight of the fit list
    sums: tuple[int, ...]  # exact, by dimension
    vectors: np.ndarray  # (dimensions, components), unit length
    values: np.ndarray  # eigenvalues, falling
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; the whole part of the mean is taken off exactly."""
        return (x - self.floors).astype(np.float64) - self.rest / self.n

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.float64)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - sums)^2, exact; None where no long holds it."""
        part = x - self.floors
        near = (self.n * np.abs(part).astype(np.float64) + self.n).max(axis=1, initial=0) < 2.0**31 / np.sqrt(max(1, x.shape[1]))
        out: list[int | None] = [None] * len(x)
        rest = [s % self.n for s in self.sums]
        if near.any():
            exact = ((self.n * part[near] - np.array(rest, np.int64)) ** 2).sum(axis=1)
            for i, v in zip(np.flatnonzero(near), exact.tolist()):
                out[i] = v
        for i in np.flatnonzero(~near):
            total = sum((self.n * p - r) ** 2 for p, r in zip(part[i].tolist(), rest))
            out[i] = total if total <= LONG else None
        return out


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows whose vector has no null or non-finite entry and the commonest
    length above 0 (of equally common ones the longest)."""
    vector = F.col(vector_col).cast("array<double>")
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("c")).where((F.size("c") > 0) & ~F.exists("c", bad))
    sizes = df.groupBy(F.size("c").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return df.select("vec_id", F.array().cast("array<long>").alias("x"))
    whole = lambda c: F.floor(F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)) * SCALE) + F.lit(SHIFT)
    return df.where(F.size("c") == sizes[0]["size"]).select("vec_id", F.transform("c", whole).alias("x"))


def matrix(table, name: str) -> np.ndarray:
    """(rows, dimensions) of a list column without nulls."""
    column = table.column(name)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _scatter(df: DataFrame, of) -> DataFrame:
    """(i, j, value): the sum of weight * y[i] * y[j] over the rows, with y = of(x); a task sends
    one matrix."""

    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                y = of(matrix(batch, "x"))
                part = (y * batch.column("weight").to_numpy(zero_copy_only=False)[:, None].astype(np.float64)).T @ y
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "value"])

    return df.select("x", "weight").mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))


def fit_whitener(groups: DataFrame, components: int = 32) -> Whitener | None:
    """Fit on distinct vectors ``x`` with ``weight``; None without rows.

    Only sums and one matrix of the vectors' length reach the driver.
    """

    def sums(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = matrix(batch, "x") - SHIFT, batch.column("weight").to_numpy(zero_copy_only=False).astype(np.int64)
            few = float(np.abs(x).max()) * float(w.sum()) < 2.0**62
            total = (w @ x).tolist() if few else (w.astype(object) @ x.astype(object)).tolist()
            n = int(w.sum())
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()),
                                              pa.array([Decimal(n), *(Decimal(t + SHIFT * n) for t in total)], pa.decimal128(38, 0))], ["i", "total"])

    found = groups.select("x", "weight").mapInArrow(sums, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total")).orderBy("i").collect()
    if not found:
        return None
    n, totals = int(found[0].total), tuple(int(r.total) for r in found[1:])
    d = len(totals)
    centre = Whitener(n, totals, np.empty((d, 0)), np.empty(0), 0.0)
    cov = np.zeros((d, d))
    for i, j, value in _scatter(groups, centre.centred).collect():
        cov[i, j] = value / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors, trace = values[::-1], vectors[:, ::-1], float(np.trace(cov))
    k = min(components, int((values > LEAST_SHARE * trace).sum()))
    return Whitener(n, totals, vectors[:, :k].copy(), values[:k].copy(), trace)


def identity_error(groups: DataFrame, model: Whitener) -> float:
    """Largest entry of |covariance of the whitened fit list - identity|."""
    cov = np.zeros((len(model.values),) * 2)
    for i, j, value in _scatter(groups, model.project).collect():
        cov[i, j] = value / model.n
    return float(np.abs(cov - np.eye(len(cov))).max(initial=0.0))


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, use_counts: bool = True) -> DataFrame:
    """One row per usable row and component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``.

    Rows whose vector is null, empty, of an uncommon length, or with a null or non-finite entry
    are left out; repeated ids and equal vectors keep their rows.  ``use_counts`` weighs each
    distinct vector by its rows, else by one.  Components are those with a variance above
    rounding, ``components`` at most: none if all vectors are equal.  ``deviation`` is null
    where it passes a long.  Entries beyond 1e13 count as 1e13.  An empty table gives no rows;
    other columns are ignored.
    """
    rows = whole_vectors(df, id_col, vector_col)
    weight = F.count("*") if use_counts else F.lit(1).cast("long")
    groups = materialise(rows.groupBy("x").agg(weight.alias("weight")))
    model = fit_whitener(groups, components)
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], out)
    error = identity_error(groups, model)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = matrix(batch, "x")
            y = model.project(x) if len(x) else np.empty((0, len(model.values)))
            ends = (np.arange(len(x) + 1) * y.shape[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("x"), pa.array(model.deviation(x) if len(x) else [], pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel()))], ["x", "deviation", "y"])

    whitened = groups.select("x").mapInArrow(run, "x array<long>, deviation long, y array<double>")
    explained = F.lit((model.values / model.trace).tolist())
    joined = rows.join(whitened, "x").select("vec_id", "deviation", F.posexplode("y").alias("k", "whitened"))
    return joined.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                         F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))
