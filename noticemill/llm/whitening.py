"""Whitening of embeddings from the singular values of a tall matrix, by QR factors that are merged as a tree.

The distinct vectors are centred with their exact sums.  Every partition folds its rows into one triangular factor, block by
block; factors are merged sixteen at a time until one is left.  Its right singular vectors are the principal components of all
rows, its singular values their spread.  The covariance is never formed, so that small variances keep their digits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored
from .top_k import quantised

SCALE = 256
COMPONENTS = 4
#: Factors that one task merges, and rows that are folded into a factor at a time.
FAN = 16
BLOCK_ROWS = 4096


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of longs, all of ``dims`` entries and none null."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass(frozen=True)
class Whitening:
    """Number of fitted vectors, their sums, unit components as rows by falling variance, all variances."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums without rounding: longs where they suffice, else whole numbers of any size."""
        return _scaled(x, self.n, self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections over the roots of the variances; nan where a component has no variance."""
        spread = np.sqrt(self.variances[: len(self.components)])
        spread = np.where(spread > 0, spread, np.nan)
        return (self.scaled(x).astype(np.float64) / self.n) @ self.components.T / spread

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum of (n * x - sums) squared for each row, exact."""
        y = self.scaled(x)
        if y.dtype != object and (not y.size or math.isqrt((1 << 63) // max(1, y.shape[1])) <= int(np.abs(y).max())):
            y = y.astype(object)
        return (y * y).sum(1)

    def explained(self) -> list[float | None]:
        total = float(self.variances.sum())
        return [float(v) / total if total else None for v in self.variances[: len(self.components)]]


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    largest = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))), default=0)
    if n * largest + max(map(abs, sums), default=0) < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def folded(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Triangular factor of the rows that ``r`` stands for and ``rows`` together."""
    return np.linalg.qr(np.concatenate([r, rows]), mode="r")


def triangular_factor(fitted: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """One factor for all rows ``q`` of ``fitted``, centred: at most dims x dims doubles, whatever the number of rows."""
    dims = len(sums)

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = np.zeros((0, dims))
        for batch in batches:
            x = matrix(batch.column("q"), dims)
            for at in range(0, len(x), BLOCK_ROWS):
                r = folded(r, _scaled(x[at : at + BLOCK_ROWS], n, sums).astype(np.float64) / n)
        if len(r):
            node = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["node", "r"])

    def of_nodes(pdf: pd.DataFrame) -> pd.DataFrame:
        r = np.zeros((0, dims))
        for part in pdf.sort_values("node")["r"]:
            r = folded(r, np.frombuffer(part).reshape(-1, dims))
        return pd.DataFrame({"node": [pdf["node"].iloc[0] // FAN], "r": [r.tobytes()]})

    nodes = fitted.rdd.getNumPartitions()
    factors = fitted.select("q").mapInArrow(of_partition, "node long, r binary")
    while nodes > 1:
        factors = factors.groupBy(F.floor(F.col("node") / FAN).alias("to")).applyInPandas(of_nodes, "node long, r binary")
        nodes = -(-nodes // FAN)
    return np.frombuffer(factors.first().r).reshape(-1, dims)


def fit(fitted: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the vectors ``q``, all of one length; None if there are none."""
    sizes = fitted.agg(F.count("*").alias("n"), F.min(F.size("q")).alias("low"), F.max(F.size("q")).alias("high")).first()
    if not sizes.n:
        return None
    if sizes.low != sizes.high:
        raise ValueError(f"vectors of {sizes.low} to {sizes.high} entries cannot be whitened together")
    entries = fitted.select(F.posexplode("q").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"))
    sums = [int(r.s) for r in entries.orderBy("at").collect()]  # one row a dimension
    _, s, right = np.linalg.svd(triangular_factor(fitted, sizes.n, sums), full_matrices=True)
    s = np.concatenate([s, np.zeros(len(sums) - len(s))])
    s[s <= s[0] * len(sums) * np.finfo(np.float64).eps] = 0  # of vectors in fewer dimensions only rounding is left
    return Whitening(sizes.n, sums, right[:components], s**2 / sizes.n)


def identity_error(fitted: DataFrame, found: Whitening) -> float | None:
    """Largest entry, without sign, of the whitened vectors' covariance minus the identity, over components with a variance."""
    kept = np.flatnonzero(found.variances[: len(found.components)] > 0)
    if not len(kept):
        return None
    dims, k = len(found.sums), len(kept)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k + k)
        for batch in batches:
            w = found.whitened(matrix(batch.column("q"), dims))[:, kept]  # centred by the exact sums
            total += np.concatenate([(w.T @ w).ravel(), w.sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "x"])

    sums = fitted.select("q").mapInArrow(moments, "at long, x double").groupBy("at").agg(F.sum("x").alias("x"))
    x = np.array([r.x for r in sums.orderBy("at").collect()]) / found.n
    mean = x[k * k :]
    return float(np.abs(x[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The id, n, deviation decimal(38,0), whitened array<double>, explained array<double> and identity_error of each usable row.

    Entries become floor(scale * x).  Rows whose vector is null, empty, or has a null or non-finite entry take no part.  The fit
    sees every distinct vector once, so that repeated rows and ids change nothing; each of them gets its own row back, null ids
    too.  Components without variance (fewer distinct vectors than dimensions) have a null in ``whitened``; with no variance at
    all ``explained`` and ``identity_error`` are null as well.  A deviation of more than 38 digits is null.  Of components with
    equal variances either order may come.  An empty table gives an empty result; vectors of several lengths are refused.  Other
    columns are not read.
    """
    source = quantised(rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v")), "v", scale).where(F.size("q") > 0)
    fitted = stored(source.select("q").distinct())
    found = fit(fitted, components)
    if found is None:
        empty = "n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split(" ", 1) for c in empty.split(", "))]
        return source.select(F.col("id").alias(id_col), *none).limit(0)
    error, dims, k = identity_error(fitted, found), len(found.sums), len(found.components)
    forget(fitted)  # what is still needed of it is in ``found``

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = pa.decimal128(38, 0)
        for batch in batches:
            x = matrix(batch.column("q"), dims)
            own = found.deviation(x)
            if own.dtype == object:
                exact = pa.array([Decimal(v) if v < 10**38 else None for v in own], digits)
            else:
                exact = pa.array(own).cast(digits)
            flat = pa.array(found.whitened(x).ravel(), from_pandas=True)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * k + 1, k), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), exact, listed], ["id", "deviation", "whitened"])

    kind = source.schema["id"].dataType.simpleString()
    out = source.select("id", "q").mapInArrow(project, f"id {kind}, deviation decimal(38,0), whitened array<double>")
    constant = [F.lit(found.n).cast("long").alias("n"), "deviation", "whitened"]
    explained = F.array(*[F.lit(v).cast("double") for v in found.explained()]).alias("explained")
    return out.select(F.col("id").alias(id_col), *constant, explained, F.lit(error).cast("double").alias("identity_error"))
