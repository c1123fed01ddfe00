"""Embeddings projected on the main components of their covariance, with unit variance.

Entries become integers, so counts and sums are exact whatever the order. The
first pass over the distinct vectors sums them; the second sums outer products
of the centred vectors, a matrix product a batch. Partial results are merged
in a tree. The driver holds matrices of the dimension alone, whatever the rows.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import scratch, small_batches, written

SAFE = 1 << 62


def quantised(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(scale * entry) of vectors without null, infinite or NaN entries; beyond a long the nearest long."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    held = rows.select(rows[id_col].alias("vec_id"), rows[vector_col].alias("v")).where(F.col("v").isNotNull() & F.coalesce(F.forall("v", entry), F.lit(False)))
    return held.select("vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("x"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Centre:
    """n * x - S, exact, and x - S / n rounded once."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums = n, sums
        self.small = 2 * n * max(largest, 1) < SAFE

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return x * np.int64(self.n) - np.array(self.sums, np.int64) if self.small else x.astype(object) * self.n - np.array(self.sums, object)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of the squares of n * x - S; None where that is no long."""
        z = self.scaled(x)
        about = np.square(z.astype(np.float64)).sum(axis=1)
        whole = about < 0.99 * 2.0**63
        out = np.where(whole, np.square(z).sum(axis=1), 0).tolist() if self.small else [0] * len(z)  # what fits is right modulo 2 ** 64
        for k in range(len(z)) if not self.small else np.flatnonzero(~whole).tolist():
            exact = sum(int(v) ** 2 for v in z[k]) if about[k] < 2.0**64 else 1 << 63
            out[k] = exact if exact < 1 << 63 else None
        return out


def merged(fit: DataFrame, dim: int, make, depth: int = 2):
    """make(iterator of matrices) gives a partition's sums as an array; their sum over all partitions, merged in a tree."""

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([make(matrix(b.column(0), dim) for b in batches).tobytes()], pa.binary())], names=["part"])

    parts = fit.mapInArrow(run, "part binary").rdd.map(lambda r: np.frombuffer(bytes(r[0]), np.float64))
    return parts.treeAggregate(np.zeros(1), lambda a, b: a + b, lambda a, b: a + b, depth)


def exact_sums(fit: DataFrame, dim: int) -> Centre:
    """The first pass: rows, sums of each entry and the largest entry, all exact."""

    def run(batches):
        n, sums, largest = 0, [0] * dim, 0
        for b in batches:
            x = matrix(b.column(0), dim)
            top = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
            part = x.sum(axis=0) if top * max(len(x), 1) < SAFE else x.astype(object).sum(axis=0)
            n, sums, largest = n + len(x), [a + int(v) for a, v in zip(sums, part)], max(largest, top)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps([n, sums, largest])])], names=["part"])

    def add(a, b):
        return [a[0] + b[0], [x + y for x, y in zip(a[1], b[1])], max(a[2], b[2])]

    parts = fit.mapInArrow(run, "part string").rdd.map(lambda r: json.loads(r[0]))
    return Centre(*parts.treeAggregate([0, [0] * dim, 0], add, add, 2))


def outer(centre: Centre, dim: int, project: np.ndarray | None = None):
    """Sums of the outer products of centred (and projected) vectors."""

    def make(matrices):
        k = dim if project is None else project.shape[1]
        total = np.zeros((k, k))
        for x in matrices:
            y = centre(x) if project is None else centre(x) @ project
            total += y.T @ y
        return total.ravel()

    return make


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and their unit vectors as columns, the largest entry of each positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return values, vectors * np.where(signs == 0, 1, signs)


def whiten(rows: DataFrame, most: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each vector and each of the first `most` components.

    Rows whose vector is null, or holds null or non-finite entries, go. Vectors
    are fitted once each, however often they occur; every row gets its result.
    Vectors of another length than most of the rows have (of equal counts the
    longer) have no place on these components and go, too; so do empty ones. A
    component whose variance is nought, up to rounding, has null for whitened; with no
    variance at all explained is null, and identity_error tells of the
    components that have some (of none: null). A deviation beyond a long is null.
    Entries beyond a long count as the nearest long. Of an empty table the result is empty.
    """
    spark = rows.sparkSession
    small_batches(spark)
    vectors = quantised(rows, scale, id_col, vector_col)
    schema = StructType(
        [StructField("vec_id", rows.schema[id_col].dataType), StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType())]
        + [StructField(c, DoubleType()) for c in ("whitened", "explained", "identity_error")]
    )
    sizes = vectors.where("size(x) > 0").groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim = sizes["dim"]
    vectors = vectors.where(F.size("x") == dim)
    with scratch(spark):
        fit = written(vectors.select("x").distinct())
        centre = exact_sums(fit, dim)
        covariance = merged(fit, dim, outer(centre, dim)).reshape(dim, dim) / centre.n
        values, axes = components(covariance, min(most, dim))
        some = values > max(values[0], 0) * dim * 8 * np.finfo(float).eps
        project = axes[:, some] / np.sqrt(values[some])
        error = None
        if some.any():
            k = int(some.sum())
            error = float(np.abs(merged(fit, dim, outer(centre, dim, project)).reshape(k, k) / centre.n - np.eye(k)).max())
    trace = float(np.trace(covariance))
    explained = [max(float(v), 0.0) / trace if trace > 0 else None for v in values]
    shared = spark.sparkContext.broadcast((centre, project, np.flatnonzero(some)))

    def run(batches):
        centre, project, which = shared.value
        k = len(explained)
        for b in batches:
            x = matrix(b.column(1), dim)
            w = np.full((len(x), k), np.nan)
            w[:, which] = centre(x) @ project
            row = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(row)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(row), centre.n)),
                    pa.array(centre.deviations(x), pa.int64()).take(pa.array(row)),
                    pa.array(w.ravel(), pa.float64(), from_pandas=True),
                    pa.array(explained * len(x), pa.float64()),
                    pa.array([error] * len(row), pa.float64()),
                ],
                names=schema.names,
            )

    return vectors.mapInArrow(run, schema)
