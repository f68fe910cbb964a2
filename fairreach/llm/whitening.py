"""Whitening of embeddings, each distinct vector once.

Entries become whole numbers (a grid of ``scale`` steps a unit), and equal vectors are one row with their multiplicity. Sums are exact
whole numbers; the deviation of an entry from its mean is taken as n x - S before anything is rounded. Each task adds up the
weighted products of its centred vectors in one matrix product, and the matrices are added up row by row, so that no task or driver
holds more than a few of them. The eigenvectors of the small matrix are found on the driver. Every distinct vector is projected
once, and its numbers are joined back to the rows that have it. A vector that very many rows share is a key of its own for each part
of them, by its counted multiplicity.

What is broadcast or collected is the mean and matrices of the dimension's square (at most MOST_DIMENSIONS, 32 MB) and the list of
shared vectors, at most SHARED_PARTS of them.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairreach.llm.common import table
from fairreach.llm.registry import query
from fairreach.session import stored

MOST_DIMENSIONS = 2048
#: A vector is dealt to several keys if it has more than this part of the rows, and SHARED_ROWS rows at least; so there are fewer such.
SHARED_PARTS, SHARED_ROWS = 4096, 20_000
#: Whole numbers up to this size and their sums of two fit 64 bits.
_SAFE = 1 << 62


def whole(entry: Column, scale: int, shift: int) -> Column:
    """floor(scale entry) + shift as a whole number."""
    return (F.floor(entry.cast("double") * scale) + F.lit(shift)).cast("bigint")


def on_grid(rows: DataFrame, vector: str = "embedding", scale: int = 64, shift: int = 1_000_000, name: str = "x") -> DataFrame:
    """``rows`` with the vectors' whole numbers as ``name``; see :func:`whiten` for the rows that are left out."""
    value, far = F.col(vector), float(1 << 61) / scale
    good = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & F.abs(c).between(0.0, far))
    kept = rows.where(value.isNotNull() & (F.size(value) > 0)).where(F.coalesce(good, F.lit(False)))
    sizes = kept.groupBy(F.size(value).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 1
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {d} entries, more than {MOST_DIMENSIONS}")
    return kept.where(F.size(value) == d).withColumn(name, F.transform(value, lambda c: whole(c, scale, shift)))


def _matrix(column: pa.Array, dtype=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exactly; with Python's whole numbers where 64 bits are too few."""
    if n * int(np.abs(x).max(initial=0)) < _SAFE and int(np.abs(sums).max(initial=0)) < _SAFE:
        return x * np.int64(n) - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _squares(dev: np.ndarray) -> list[str]:
    """The sum of squares of each row, in digits, as it may pass any fixed size."""
    if dev.dtype != object and int(np.abs(dev).max(initial=0)) ** 2 * dev.shape[1] >= _SAFE:
        dev = dev.astype(object)
    return [str(int(v)) for v in (dev * dev).sum(1)]


def _mapped(rows: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return rows.mapInArrow(run, schema)


def _sums(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fitted vectors and the exact sum of each of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | int = 0
        for batch in batches:
            x, m = _matrix(batch.column(0)), batch.column(1).to_numpy()
            if int(np.abs(x).max(initial=0)) * int(m.sum()) >= _SAFE:
                x, m = x.astype(object), m.astype(object)
            total = total + (x * m[:, None]).sum(0).astype(object)
        if isinstance(total, np.ndarray):
            numbers = pa.array([decimal.Decimal(int(v)) for v in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), numbers], names=["i", "s"])

    n = distinct.agg(F.sum("weight")).first()[0] or 0
    rows = distinct.select("x", "weight").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return n, np.array([int(r["s"]) for r in sorted(rows)], object)


def _products(rows: DataFrame, centred: Callable[[pa.Array], np.ndarray], column: str) -> np.ndarray:
    """The sum over rows of weight times the outer product of what ``centred`` makes of the column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | int = 0
        for batch in batches:
            if batch.num_rows:
                c = centred(batch.column(0))
                total = total + (c * batch.column(1).to_numpy()[:, None]).T @ c
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    def add(own: pa.Table) -> pa.Table:
        total = _matrix(own.column("row").combine_chunks(), np.float64).sum(0)
        return pa.table([own.column("i")[:1], pa.array([total], pa.list_(pa.float64()))], names=["i", "row"])

    parts = rows.select(column, "weight").mapInArrow(run, "i int, row array<double>")
    done = sorted(parts.groupBy("i").applyInArrow(add, "i int, row array<double>").collect())
    return np.array([r["row"] for r in done])


@dataclass
class Whitening:
    """Number of fitted vectors, their exact sums, the leading components (rows) with their eigenvalues, and the matrix's trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact deviations of vectors, and their whitened coordinates."""
        dev = _deviations(x, self.n, self.sums)
        return dev, (dev.astype(np.float64) / self.n) @ self.components.T / np.sqrt(self.values)


def fit(distinct: DataFrame, most: int = 32) -> Whitening | None:
    """The whitening of ``x, weight``, with up to ``most`` components; None without vectors.

    Directions in which the vectors do not differ (an eigenvalue that is zero but for rounding) are no components.
    """
    n, sums = _sums(distinct)
    if not n:
        return None
    matrix = _products(distinct, lambda x: _deviations(_matrix(x), n, sums).astype(np.float64) / n, "x") / n
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    values, vectors = values[::-1], vectors.T[::-1]
    some = values > max(values[0], 0.0) * len(values) * np.finfo(np.float64).eps * 8
    return Whitening(n, sums, vectors[some][:most], values[some][:most], float(np.trace(matrix)))


def identity_error(white: DataFrame, n: int) -> float:
    """The largest entry of the covariance of ``whitened, weight``, less the identity, in absolute value."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: np.ndarray | int = 0
        for batch in batches:
            if batch.num_rows:
                sums = sums + (_matrix(batch.column(0), np.float64) * batch.column(1).to_numpy()[:, None]).sum(0)
        if isinstance(sums, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.float64())], names=["i", "s"])

    rows = white.select("whitened", "weight").mapInArrow(total, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    mean = np.array([r["s"] for r in sorted(rows)]) / n
    matrix = _products(white, lambda w: _matrix(w, np.float64) - mean, "whitened") / n
    return float(np.abs(matrix - np.eye(len(matrix))).max(initial=0))


def _key(x: str) -> Column:
    """32 bytes for each vector: its SHA-256, which no two vectors share."""
    return F.unhex(F.sha2(F.array_join(x, ","), 256))


def whiten(
    rows: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = 32, weights: str = "count", scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """``key, n, deviation, whitened, explained, identity_error``: one row for each row of ``rows`` that has a vector.

    Entries become floor(``scale`` c) + ``shift``. The fit is over all rows' vectors (``weights="count"``), or over each distinct vector once
    (``"one"``); n is their number. ``deviation`` is the sum of (n x - S)^2 in digits, ``whitened`` the coordinates along the leading components,
    at most ``most``, in units of their deviation; ``explained`` is each component's part of the variance and ``identity_error`` how far the whitened
    vectors' covariance is from the identity. Components are in order of falling variance, with either sign.

    Left out are rows whose vector is null, empty, holds a null, not finite or larger than 2^61 / ``scale`` entry, or has not the length that most
    have (the shorter, if two lengths are equally frequent). Rows with a null or repeated key are kept each; other
    columns are ignored. Without vectors, or without two that differ, there are no components and ``whitened`` is empty, or no rows.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights are 'count' or 'one'")
    named = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector"))
    placed = on_grid(named, "vector", scale, shift).select("key", "x")
    grouped = placed.groupBy("x").agg(F.count("*").alias("times"))
    weight = F.col("times") if weights == "count" else F.lit(1).cast("bigint")
    distinct = stored(grouped.select("x", "times", weight.alias("weight")), "vectors")
    model = fit(distinct, most)
    kind = rows.schema[key].dataType.simpleString()
    if model is None:
        empty = f"`{key}` {kind}, n bigint, deviation string, whitened array<double>, explained array<double>, identity_error double"
        return rows.sparkSession.createDataFrame([], empty)

    def project(batch: pa.RecordBatch) -> pa.RecordBatch:
        dev, white = model.apply(_matrix(batch.column(0)))
        columns = [*batch.columns, pa.array(_squares(dev), pa.string()), pa.array(list(white), pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "deviation", "whitened"])

    white = _mapped(distinct.select("x", "times", "weight"), project, "x array<bigint>, times bigint, weight bigint, deviation string, whitened array<double>")
    white = stored(white.withColumn("x", _key("x")), "whitened")
    error = identity_error(white, model.n)

    total = white.agg(F.sum("times")).first()[0]
    limit = max(SHARED_ROWS, total // SHARED_PARTS)
    shares = F.ceil(F.col("times") / F.lit(limit)).cast("int")
    shared = white.where(F.col("times") > limit).select("x", shares.alias("shares"))
    spread = white.withColumn("share", F.explode(F.sequence(F.lit(1), shares)))
    own = placed.select("key", _key("x").alias("x")).join(F.broadcast(shared), "x", "left")
    own = own.withColumn("share", F.coalesce(1 + F.pmod(F.monotonically_increasing_id(), F.col("shares")), F.lit(1)).cast("int"))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    found = own.drop("shares").join(spread.select("x", "share", "deviation", "whitened"), ["x", "share"])
    return found.select(F.col("key").alias(key), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


@query("op11_embedding_whitening")
def op11(spark, sf_dir):
    found = whiten(table(spark, sf_dir, "embeddings"))
    each = found.select("vec_id", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "one"), "n", "deviation", "identity_error")
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("bigint").alias("deviation"),
        F.col("one.whitened").alias("whitened"),
        F.col("one.explained").alias("explained"),
        "identity_error",
    )
