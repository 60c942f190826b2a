"""Whitening of embeddings by a covariance that is summed in double-double numbers.

Entries c become integers x = floor(scale * c) + shift. The fit list is each distinct x vector once; its sums S are exact
integers. Tasks centre the fit list on S / n, held as a double-double number, multiply the centred entries with the error
of each product (Dekker's splitting), and sum products in double-double by two-sums, pairwise, so that nothing is lost to
the size of the shift. A task gives one row for each row of the matrix, high and low parts apart; such rows are merged by
the same sums in two rounds, by groups of tasks and then all, so that no group grows with the rows. The matrix (dimensions
squared, MOST_DIMENSIONS bounds it) is all that comes to the driver, where it is brought to tridiagonal form by Householder's
reflections and solved by divide and conquer, which is what LAPACK's syevd behind numpy.linalg.eigh does.

Defined results: rows whose vector is null or empty, holds null or non-finite entries or entries beyond 2^40, or has
another length than most such vectors (of equally many the shorter), are left out; null and repeated ids keep all their
rows; where the fit list has fewer directions than components, the rest are null with explained 0 (null where all vectors
are equal); deviation is null where it is beyond 64 bits; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stored

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
LARGEST = float(1 << 40)
MOST_DIMENSIONS = 4096
ROWS = 256  # multiplied at once
MERGED = 64  # groups of tasks in the first round of merging
PARTS = "i int, salt int, high array<double>, low array<double>"
Double2 = tuple[np.ndarray, np.ndarray]


def two_sum(a: np.ndarray, b: np.ndarray) -> Double2:
    """a + b and its rounding error, exactly."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def fast_two_sum(a: np.ndarray, b: np.ndarray) -> Double2:
    """The same where |a| >= |b|."""
    s = a + b
    return s, b - (s - a)


def split(a: np.ndarray) -> Double2:
    """Two halves of 26 bits, so that products of halves are exact."""
    t = 134_217_729.0 * a
    high = t - (t - a)
    return high, a - high


def add(a: Double2, b: Double2) -> Double2:
    s, e = two_sum(a[0], b[0])
    return fast_two_sum(s, e + (a[1] + b[1]))


def pairwise(a: Double2) -> Double2:
    """The sum over the first axis."""
    high, low = a
    while len(high) > 1:
        half = len(high) // 2
        s = add((high[:half], low[:half]), (high[half : 2 * half], low[half : 2 * half]))
        high, low = (np.concatenate([x, y[2 * half :]]) for x, y in zip(s, (high, low), strict=True))
    return high[0], low[0]


class Covariance:
    """The sum of the outer products of centred rows, upper triangle, in double-double."""

    def __init__(self, mean: Double2):
        self.mean = mean
        d = len(mean[0])
        self.high, self.low = np.zeros((d, d)), np.zeros((d, d))

    def update(self, x: np.ndarray) -> None:
        for begin in range(0, len(x), ROWS):
            s, e = two_sum(x[begin : begin + ROWS].astype(np.float64), -self.mean[0])
            a, rest = (np.ascontiguousarray(y) for y in fast_two_sum(s, e - self.mean[1]))
            top, bottom = split(a)
            for i in range(a.shape[1]):
                p = a[:, i : i + 1] * a[:, i:]
                e = ((top[:, i : i + 1] * top[:, i:] - p) + top[:, i : i + 1] * bottom[:, i:] + bottom[:, i : i + 1] * top[:, i:]) + bottom[:, i : i + 1] * bottom[:, i:]
                e += a[:, i : i + 1] * rest[:, i:] + rest[:, i : i + 1] * a[:, i:]
                self.high[i, i:], self.low[i, i:] = add((self.high[i, i:], self.low[i, i:]), pairwise(fast_two_sum(p, e)))


@dataclass(frozen=True)
class Whitening:
    """What whitening needs. vectors: a column for each component, numbered by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float | None]
    identity_error: float | None = None

    def scaled(self) -> np.ndarray:
        """Components over the root of their eigenvalue; those without variance are nan."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, self.vectors / np.sqrt(self.values), np.nan)


def matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, d)


def integers(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """key and x of the rows that can be whitened, written."""
    good = F.coalesce(F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) <= LARGEST)), F.lit(False)) & (F.size(vector) > 0)
    x = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long") + F.lit(shift).cast("long"))
    return stored(embeddings.where(good).select(F.col(key).alias("key"), x.alias("x")), "whitening-rows")


def dimensions(rows: DataFrame) -> int:
    """The most frequent length, 0 of no rows."""
    found = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if found and found[0]["d"] > MOST_DIMENSIONS:
        raise ValueError(f"vectors of more than {MOST_DIMENSIONS} dimensions")
    return found[0]["d"] if found else 0


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension: a row for each task and dimension, summed as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = [0] * d, 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 1 << 14):  # 2^14 of up to 2^47 fit 64 bits
                x = matrix(batch.column(0).slice(begin, 1 << 14), d)
                sums = [a + b for a, b in zip(sums, x.sum(axis=0).tolist(), strict=True)]
                n += len(x)
        if n:
            yield pa.record_batch([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(sums, pa.decimal128(38, 0))], ["i", "n", "s"])

    found = fit.select("x").mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()  # d rows
    return found[0]["n"], [int(r["s"]) for r in found]


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """One row for each group, high and low parts added."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        high, low = pairwise((np.stack(group["high"].to_list()), np.stack(group["low"].to_list())))
        return pd.DataFrame({"i": group["i"].iloc[:1], "salt": group["salt"].iloc[:1], "high": [high], "low": [low]})

    return parts.groupBy(*keys).applyInPandas(run, PARTS)


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the fit list, divisor n."""
    d = len(sums)
    high = np.array([s / n for s in sums])  # correctly rounded
    low = np.array([float(Fraction(s, n) - Fraction(h)) for s, h in zip(sums, high.tolist(), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows = Covariance((high, low)), 0
        for batch in batches:
            own.update(matrix(batch.column(0), d))
            rows += batch.num_rows
        if rows:
            salt = TaskContext.get().partitionId() % MERGED
            yield pa.record_batch([pa.array(range(d), pa.int32()), pa.array([salt] * d, pa.int32()), pa.array(list(own.high)), pa.array(list(own.low))], ["i", "salt", "high", "low"])

    parts = fit.select("x").mapInArrow(run, PARTS)
    total = np.zeros((d, d))
    for r in merged(merged(parts, "i", "salt"), "i").collect():  # d rows
        total[r["i"]] = (np.array(r["high"]) + np.array(r["low"])) / n
    return total + np.triu(total, 1).T


def eigen(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, list[float | None]]:
    """The largest eigenvalues, 0 where rounding leaves no sign of variance; unit eigenvectors as columns; shares of the trace."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    values = np.where(values > len(v) * np.finfo(float).eps * max(values[0], 0.0), values, 0.0)
    trace = float(np.trace(v))
    return values, vectors, [float(e) / trace if trace > 0 else None for e in values]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S exactly: 64-bit where squares' sums fit them, else Python's integers."""
    near = np.array([s // n for s in sums], np.int64)
    y, rest = x - near, np.array([s % n for s in sums], np.int64)
    if len(y) and (n * (int(np.abs(y).max()) + 1)) ** 2 * y.shape[1] >= 1 << 63:
        y, rest = y.astype(object), rest.astype(object)
    return n * y - rest


def identity_error(fit: DataFrame, found: Whitening) -> float | None:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    kept = int((found.values > 0).sum())
    if not kept:
        return None
    d, n, sums, scaled = len(found.sums), found.n, found.sums, found.scaled()[:, :kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(kept), np.zeros((kept, kept))
        for batch in batches:
            w = (centred(matrix(batch.column(0), d), n, sums) / n).astype(np.float64) @ scaled
            total += w.sum(axis=0)
            products += w.T @ w
        values = np.concatenate([total, products.ravel()])
        yield pa.record_batch([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["i", "value"])

    rows = fit.select("x").mapInArrow(run, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).orderBy("i").collect()  # kept * (kept + 1) rows
    values = np.array([r["value"] for r in rows]) / n
    mean, products = values[:kept], values[kept:].reshape(kept, kept)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(kept)).max())


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learns from the distinct vectors of rows (of integers()); None of no rows."""
    d = dimensions(rows)
    if not d:
        return None
    fit = stored(rows.where(F.size("x") == d).select("x").distinct(), "whitening-fit")
    n, sums = exact_sums(fit, d)
    found = Whitening(n, sums, *eigen(covariance(fit, n, sums), min(components, d)))
    return Whitening(n, sums, found.values, found.vectors, found.explained, identity_error(fit, found))


def apply_whitening(rows: DataFrame, found: Whitening) -> DataFrame:
    """key, n, deviation and the whitened vector of each row that has found's dimensions."""
    d, n, sums, scaled = len(found.sums), found.n, found.sums, found.scaled()
    k = scaled.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = centred(matrix(batch.column(1), d), n, sums)
            deviation = [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]
            w = (y / n).astype(np.float64) @ scaled
            bounds = pa.array(np.arange(len(w) + 1, dtype=np.int32) * k)
            yield pa.record_batch([batch.column(0), pa.array([n] * len(w), pa.int64()), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(w.ravel(), from_pandas=True))], ["key", "n", "deviation", "whitened"])

    key = rows.schema["key"].dataType.simpleString()
    return rows.where(F.size("x") == d).select("key", "x").mapInArrow(run, f"key {key}, n long, deviation long, whitened array<double>")


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened vectors, a row for each row and component: key, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows = integers(embeddings, key, vector)
    found = fit_whitening(rows, components)
    if found is None:
        kind = embeddings.schema[key].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.lit(None).cast("array<double>") if None in found.explained else F.array(*map(F.lit, found.explained))
    each = apply_whitening(rows, found).select(F.col("key").alias(key), "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(key, (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(found.identity_error).cast("double").alias("identity_error"))
