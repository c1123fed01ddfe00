"""What several operators share: the document view, Arrow helpers and word hashing.

Every operator takes any DataFrame with an id and a text column, reads only
those two, treats a null text as empty, and gives each input row its own
result row (repeated rows and repeated or null ids included).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = (1 << 64) - 1
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


#: Texts in an Arrow batch. Spark's own default takes ten times as many, with long texts a large part of a small executor.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Sets the session's batch size unless it has one of its own, or its context was given one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000" and not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, BATCH_ROWS)


def doc_view(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty; other columns, whatever their names, are left out."""
    small_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:  # only without a cluster's setting, as in tests
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.checkpoints"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


#: Folders of written tables that the innermost scratch() is to delete.
_OPEN: ContextVar[list[str] | None] = ContextVar("open_scratch", default=None)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder, so that later steps neither recompute it nor lose it."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.parquet(path)
    if (held := _OPEN.get()) is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables written inside are deleted at its end, but for what the given function has written: keep(df)."""
    held: list[str] = []
    token = _OPEN.set(held)

    def keep(df: DataFrame) -> DataFrame:
        out = written(df)
        held.pop()
        return out

    try:
        yield keep
    finally:
        _OPEN.reset(token)
        for path in held:
            delete(spark, path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a string column without nulls; no copy."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about `most` bytes, so that a step's arrays stay in a core's cache: first row, end row, bytes, offsets. A longer text comes alone."""
    data, offs = utf8(column)
    lo = 0
    while lo < len(offs) - 1:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, side="right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def words_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word [^\\x20\\x09-\\x0D]+ and, per text, the index of its first word (n + 1)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    gap = SPACE[data]
    before = np.empty(n + 1, dtype=bool)
    before[0], before[1:] = True, gap
    before[offs[offs <= n]] = True
    after = np.empty(n + 1, dtype=bool)
    after[:-1], after[n] = gap, True
    after[offs[offs <= n]] = True
    starts = np.flatnonzero(~gap & before[:-1])
    ends = np.flatnonzero(~gap & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 1 .. base ** n, modulo 2 ** 64."""
    if len(_POWERS.get(base, ())) < n:
        _POWERS[base] = np.multiply.accumulate(np.full(max(n, 1024), base & MASK, dtype=np.uint64))
    return _POWERS[base][:n]


BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


#: For the last word of a span, which bytes of it count.
_FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [MASK], dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0, block: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of data[start:end] for ascending disjoint spans; memory is bound by `block` bytes or one span.

    Eight bytes at a time are mixed with their place, so that no structure of the
    bytes (as that which makes all polynomials agree) brings two spans together; another
    seed gives a second hash that doesn't follow from the first.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    salt = np.uint64((seed * BASES[1] + BASES[0]) & MASK)
    k = 0
    while k < len(starts):
        to = max(k + 1, int(np.searchsorted(ends, starts[k] + block)))
        s, lens = starts[k:to], ends[k:to] - starts[k:to]
        padded = np.concatenate([data[s[0] : ends[to - 1]], np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        at = s - s[0]
        if lens.max() <= 8:
            h = mix((eight[at] & _FIRST_BYTES[lens]) ^ mix(np.array([salt]))[0])
        else:
            n = np.maximum((lens + 7) // 8, 1)
            first = np.cumsum(n) - n
            j = np.arange(int(n.sum())) - np.repeat(first, n)
            words = eight[np.repeat(at, n) + 8 * j] & _FIRST_BYTES[np.minimum(np.repeat(lens, n) - 8 * j, 8)]
            h = np.add.reduceat(mix(words ^ mix(j.astype(np.uint64) * np.uint64(BASES[0]) + salt)), first)
        out[k:to] = mix(h + lens.astype(np.uint64) * np.uint64(BASES[1]))
        k = to
    return out


def gram_hashes(h: np.ndarray, k: int, base: int = BASES[1]) -> np.ndarray:
    """A hash of each run of k consecutive hashes (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    p = powers(base | 1, k)
    for j in range(k):
        out += h[j : j + n] * p[j]
    return mix(out)


def text_key(docs: DataFrame) -> DataFrame:
    """Adds fp, a 128-bit fingerprint of the text."""
    return docs.withColumn("fp", F.unhex(F.md5(F.col("text"))))
