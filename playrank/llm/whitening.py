"""Whiten embeddings by the covariance of their distinct vectors, each weighted by how often it occurs.

Entries become whole numbers on a lattice, so that equal vectors are equal exactly. Rows are grouped by their lattice
vector; a task multiplies its distinct vectors, centred first, as one matrix and hands on one small sum. The driver holds
that sum, dimension by dimension, and finds its eigenvectors. Each distinct vector is whitened once and joined back to the
rows that have it: vectors that hold a share of 1/``HOT`` of all rows, at most ``HOT`` of them, are broadcast, so a vector
that a third of the rows share is not one task's group; all others are joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playrank.session import materialize

SCALE, SHIFT = 64, 1_000_000  # lattice: floor(SCALE * entry) + SHIFT
LARGEST = 2.0**55  # entries from here on would leave 64 bits on the lattice
HOT = 1000
LEAST_SHARE = 1e-10  # of the largest eigenvalue; below it a direction is rounding noise
LOW = (1 << 31) - 1


@dataclass(frozen=True)
class Whitening:
    """A fitted model: arrays of the dimension's size."""

    n: int
    sums: list[int]  # per dimension, exact
    values: np.ndarray  # falling eigenvalues of the kept components
    vectors: np.ndarray  # (dimension, component), unit columns
    trace: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values


def lattice(vector: Column) -> Column:
    """The lattice vector (array of bigint); null where the vector cannot be used."""
    entries = vector.cast("array<double>")
    usable = (F.size(entries) > 0) & F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < LARGEST))
    return F.when(usable, F.transform(entries, lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT))


def lattice_rows(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x, digest): the rows whose vectors can be used; equal digests stand for equal vectors."""
    rows = table.select(F.col(key).alias("key"), lattice(F.col(vector)).alias("x")).where("x IS NOT NULL")
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat_ws(",", F.col("x").cast("array<string>")), 256)))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(size: int):
    """Exact weighted sums per dimension of one task, in two halves that cannot overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * size
        for batch in batches:
            x, w = _matrix(batch.column("x"), size), batch.column("weight").to_pylist()
            light = [k for k, v in enumerate(w) if v < 1 << 20]
            part, weight = x[light], np.array([w[k] for k in light], np.int64)[:, None]
            for from_ in range(0, len(part), 2048):  # 2048 rows * 2^20 * 2^31 < 2^63
                rows, many = part[from_ : from_ + 2048], weight[from_ : from_ + 2048]
                high, low = ((rows >> 31) * many).sum(0), ((rows & LOW) * many).sum(0)
                total = [t + (int(a) << 31) + int(b) for t, a, b in zip(total, high, low, strict=True)]
            for k in sorted(set(range(len(w))) - set(light)):
                total = [t + int(v) * w[k] for t, v in zip(total, x[k], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "total"])

    return run


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64 bits where they suffice."""
    largest = max(int(x.max()), -int(x.min()), 1) if x.size else 1
    if n * largest < 1 << 62 and max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _products(size: int, values):
    """Upper triangle of the weighted products of ``values(batch)`` (rows, size), and the weighted sums, of one task."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            y, w = values(batch), np.array(batch.column("weight").to_pylist(), np.float64)
            total += (y * w[:, None]).T @ y
            mean += w @ y
        i, j = np.concatenate([upper[0], np.arange(size)]), np.concatenate([upper[1], np.full(size, -1)])
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.concatenate([total[upper], mean]))], ["i", "j", "total"])

    return run


def _covariance(distinct: DataFrame, columns: list[str], size: int, n: int, values) -> np.ndarray:
    """Weighted covariance of a small dimension, summed over the tasks."""
    parts = distinct.select(*columns).mapInArrow(_products(size, values), "i int, j int, total double")
    found = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).orderBy("i", "j").toArrow()  # (size + 1) * size / 2 + size rows
    i, j, total = (found.column(c).to_numpy() for c in ("i", "j", "total"))
    square, mean = np.zeros((size, size)), np.zeros(size)
    square[i[j >= 0], j[j >= 0]] = square[j[j >= 0], i[j >= 0]] = total[j >= 0] / n
    mean[i[j < 0]] = total[j < 0] / n
    return square - np.outer(mean, mean)


def _project(n: int, sums: list[int], axes: np.ndarray):
    size = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _centred(_matrix(batch.column("x"), size), n, sums)
            y = z.astype(np.float64) / n
            largest = int(np.abs(z).max()) if z.size else 0
            squares = (z * z if largest**2 * size < 1 << 63 else z.astype(object) ** 2).sum(1)
            deviation = pa.array([Decimal(int(s)) if int(s) < 10**38 else None for s in squares], pa.decimal128(38, 0))
            white = pa.array(list(y @ axes), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("copies"), batch.column("weight"), deviation, white], ["digest", "copies", "weight", "deviation", "whitened"])

    return run


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32, weights: str = "copies") -> tuple[DataFrame, Whitening]:
    """(key, deviation, whitened) for every usable row, and the model.

    ``whitened`` holds the row's coordinates on the first ``components`` unit eigenvectors, each over the root of its
    eigenvalue, ``deviation`` the exact squared distance of ``n * x`` from the sums (decimal). ``weights`` says what the
    covariance counts: "copies" every row, "one" every distinct vector.

    Rows whose vector is null or empty, holds a null, non-finite or 64-bit-breaking entry, or has not the most common
    length (of equally common ones the longest) are dropped. Repeated rows and null keys stay. Directions in which the
    vectors do not vary have no component, so one vector alone, or equal ones, give empty arrays; an empty table gives no
    rows. A deviation beyond 38 digits is null. Other columns are left aside, whatever their names. An eigenvector's
    largest entry is positive.
    """
    if weights not in ("copies", "one"):
        raise ValueError(weights)
    spark = table.sparkSession
    rows = lattice_rows(table, key, vector)
    grouped = rows.groupBy("digest").agg(F.first("x").alias("x"), F.count("*").alias("copies"))
    distinct = materialize(grouped.withColumn("weight", F.col("copies") if weights == "copies" else F.lit(1).cast("bigint")), "vectors")
    lengths = distinct.groupBy(F.size("x").alias("size")).agg(F.sum("copies").alias("copies"), F.sum("weight").alias("n"))
    common = lengths.orderBy(F.desc("copies"), F.desc("size")).first()
    if common is None:
        empty = spark.createDataFrame([], "digest binary, deviation decimal(38,0), whitened array<double>")
        model = Whitening(0, [], np.empty(0), np.empty((0, 0)), 0.0, 0.0)
        return rows.join(empty, "digest").select(F.col("key").alias(key), "deviation", "whitened"), model
    size, n = int(common["size"]), int(common["n"])
    distinct = distinct.where(F.size("x") == size)

    parts = distinct.select("x", "weight").mapInArrow(_sums(size), "i int, total decimal(38,0)")
    sums = [int(r["total"]) for r in parts.groupBy("i").agg(F.sum("total").alias("total")).orderBy("i").collect()]  # one per dimension
    centred = lambda batch: _centred(_matrix(batch.column("x"), size), n, sums).astype(np.float64) / n
    cov = _covariance(distinct, ["x", "weight"], size, n, centred)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int((values[:components] > max(values[0], 0.0) * LEAST_SHARE).sum()) if values[0] > 0 else 0
    values, vectors = values[:kept], vectors[:, :kept]
    if kept:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(kept)])
    axes = vectors / np.sqrt(values)

    schema = "digest binary, copies bigint, weight bigint, deviation decimal(38,0), whitened array<double>"
    white = materialize(distinct.mapInArrow(_project(n, sums, axes), schema), "white")
    error = 0.0
    if kept:
        spread = _covariance(white, ["whitened", "weight"], kept, n, lambda batch: _matrix(batch.column("whitened"), kept))
        error = float(np.abs(spread - np.eye(kept)).max())
    model = Whitening(n, sums, values, vectors, float(np.trace(cov)), error)

    hot = F.col("copies") * HOT >= F.lit(int(common["copies"]))
    out = ["digest", "deviation", "whitened"]
    often = F.broadcast(white.where(hot).select(*out))  # at most HOT rows
    frequent = rows.select("key", "digest").join(often, "digest")
    others = rows.select("key", "digest").join(often.select("digest"), "digest", "left_anti").join(white.where(~hot).select(*out), "digest")
    return frequent.unionByName(others).select(F.col("key").alias(key), "deviation", "whitened"), model
