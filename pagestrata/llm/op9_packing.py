"""Harmonic packing: pieces in reciprocal-capacity classes, a fixed count of pieces to a bin.

A piece of length l is of class k = capacity // l, and k pieces of a class fill
a bin. Of a document whole sequences are cut off first; the rest is a piece of
its own class if k of its length would leave at most `waste` of a bin empty.
Else it is cut to the exact share capacity // (k + 1) of the next class, and
what is left is looked at in turn. Each worker fills its own bins; the pieces in
its unfilled bins are put together at its end, longest first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import doc_view
from .tokens import encoder


def cut(n: int, capacity: int, min_piece: int, waste: int) -> list[int]:
    """Lengths, in order, of the pieces of a document of n tokens."""
    out = [capacity] * (n // capacity)
    left = n % capacity
    while left:
        k = capacity // left
        size = left if left <= min_piece or capacity - k * left <= waste else capacity // (k + 1)
        out.append(size)
        left -= size
    return out


class HarmonicBins:
    """Deals pieces out to bins; emits (piece, bin, offset) when a bin is full."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.bins = capacity, {}, 0

    def add(self, piece: tuple, length: int) -> list[tuple]:
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((piece, length))
        return self._close(self.open.pop(k)) if len(held) == k else []

    def _close(self, held: list) -> list[tuple]:
        at, out = 0, []
        for piece, length in held:
            out.append((piece, self.bins, at))
            at += length
        self.bins += 1
        return out

    def rest(self) -> Iterator[list[tuple]]:
        """Bins of what is left, filled in turn, longest pieces first."""
        held: list = []
        room = self.capacity
        for piece, length in sorted((p for ps in self.open.values() for p in ps), key=lambda p: (-p[1], str(p[0][:2]))):
            if length > room:
                yield self._close(held)
                held, room = [], self.capacity
            held.append((piece, length))
            room -= length
        if held:
            yield self._close(held)
        self.open = {}


OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", path: str | None = None, capacity: int = 1024, end_id: int = 0, min_piece: int = 16, waste: float = 1 / 64, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there, and its ids.

    A bin is padded by `waste` of its capacity at most, but for bins of pieces
    up to `min_piece` tokens and a worker's last ones.

    Each document is its ids and `end_id`; a null or empty text is `end_id`
    alone. Rows are documents: repeated ids are packed once per row. A
    sequence's number is its task's number and its bin's number there, so it is
    the same when a lost task runs again on the same input.
    """

    def run(batches):
        enc, bins = encoder(tokenizer, path), HarmonicBins(capacity)
        base = TaskContext.get().partitionId() << 40

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*[(*p[:5], base + b, at, p[5]) for p, b, at in rows]))
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            ids = pa.array(cols[7], pa.list_(pa.int32())) if with_ids else pa.nulls(len(rows), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([*arrays, ids], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for lo, hi, ids, counts in enc.encode_column(batch.column(1)):
                rows, at = [], 0
                for doc, n in zip(doc_ids[lo:hi], counts.tolist()):
                    own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    start = 0
                    for length in cut(n + 1, capacity, min_piece, int(waste * capacity)):
                        part = own[start : start + length]
                        rows += bins.add((doc, start, length, zlib.crc32(part.tobytes()), n + 1, part.copy() if with_ids else None), length)  # a copy, so that an open bin doesn't hold whole documents
                        start += length
                if rows:
                    yield batch_of(rows)
        for rows in bins.rest():
            yield batch_of(rows)

    return doc_view(docs, id_col, text_col).mapInArrow(run, OUT)
