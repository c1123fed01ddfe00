"""What substring dedup over bytes and over words share.

A window is `length` consecutive symbols of one text. Both operators first look
for anchors: in each window the k-gram with the smallest hash, which equal
windows share at the same place. Only windows whose anchor's k-gram occurs at
two places can repeat; everything after works on the texts that hold some,
one of each group of equal texts. All of it is keyed by hashes in shuffles that
are aggregated before they are sent, so a passage that a third of all texts
hold is a few rows a task.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASES, gram_hashes, mix, slices, span_hashes, text_key, words_of, written

BITS = np.uint64(24)
LOW = np.uint64((1 << 24) - 1)


def window_minima(h: np.ndarray, w: int, chunk: int = 1 << 15) -> np.ndarray:
    """For each run of w hashes the place of its smallest (by its upper 40 bits, the first of equals)."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.int64)
    for lo in range(0, n, chunk):
        hi = min(n, lo + chunk)
        part = h[lo : hi + w - 1]
        v = (part & ~LOW) | np.arange(len(part), dtype=np.uint64)
        pad = -len(v) % w
        rows = np.concatenate([v, np.full(pad, np.uint64((1 << 64) - 1))]).reshape(-1, w)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        m = hi - lo
        out[lo:hi] = (np.minimum(behind[:m], ahead[w - 1 : w - 1 + m]) & LOW).astype(np.int64) + lo
    return out


def byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k bytes; k is a power of two, 8 at least."""
    h = data.astype(np.uint64)
    for width in (1, 2, 4):  # the eight bytes themselves
        h = (h[:-width] << np.uint64(8 * width)) | h[width:]
    h = mix(h + np.uint64(BASES[0]))
    width = 8
    while width < k:
        h = h[:-width] * np.uint64(BASES[1] | 1) + h[width:] if len(h) > width else h[:0]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        width *= 2
    return mix(h)


class Bytes:
    """Texts as bytes; a slice's symbols are its bytes."""

    def __init__(self, length: int = 200, k: int = 32):
        self.length, self.k = length, k

    def symbols(self, data: np.ndarray, offs: np.ndarray):
        return data, offs, lambda: data

    def grams(self, symbols: np.ndarray) -> np.ndarray:
        return byte_grams(symbols, self.k)


class Words:
    """Texts as words; a slice's symbols are the hashes of its words, of which there is a second, independent set."""

    def __init__(self, length: int = 35, k: int = 6):
        self.length, self.k = length, k

    def symbols(self, data: np.ndarray, offs: np.ndarray):
        starts, ends, first = words_of(data, offs)
        return span_hashes(data, starts, ends), first, lambda: span_hashes(data, starts, ends, 1)

    def grams(self, symbols: np.ndarray) -> np.ndarray:
        return gram_hashes(symbols, self.k)


class Anchors:
    """Windows and anchors of the texts of a slice."""

    def __init__(self, of: Bytes | Words, data: np.ndarray, offs: np.ndarray):
        self.symbols, self.first, self._others = of.symbols(data, offs)
        n = np.diff(self.first)
        self.doc_of_window = np.repeat(np.arange(len(n)), np.maximum(n - of.length + 1, 0))
        per = np.maximum(n - of.length + 1, 0)
        self.window = self.first[:-1][self.doc_of_window] + np.arange(len(self.doc_of_window)) - np.repeat(np.cumsum(per) - per, per)
        if len(self.window):
            grams = of.grams(self.symbols)
            self.at = window_minima(grams, of.length - of.k + 1)[self.window]  # each window's anchor
            new = np.ones(len(self.at), bool)
            new[1:] = (self.at[1:] != self.at[:-1]) | (self.doc_of_window[1:] != self.doc_of_window[:-1])
            self.run = np.cumsum(new) - 1  # windows of one anchor are consecutive
            self.head = np.flatnonzero(new)
            self.place = self.at[self.head]
            self.doc = self.doc_of_window[self.head]
            self.hash = grams[self.place]
        else:
            self.at = self.run = self.head = self.place = self.doc = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)


    @cached_property
    def others(self) -> np.ndarray:
        """The second set of symbols: what tells windows apart needs both."""
        return self._others()


def occurrence(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(mix(key) + place.astype(np.uint64)).view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """Adds fk, a 64-bit key of the text that only narrows what is looked at, and fp, its fingerprint."""
    return text_key(docs).withColumn("fk", F.xxhash64("text"))


def twice(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys with two different occurrences, written."""
    return written(rows.groupBy(*keys).agg(F.min("occ").alias("lo"), F.max("occ").alias("hi")).where("lo != hi").select(*keys))


def emitted(df: DataFrame, make, schema: str) -> DataFrame:
    """make(anchors-ready slice) for every slice of df's columns fk, text and the rest; its batches."""

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(1)):
                yield from make(batch.slice(lo, hi - lo), data, offs)

    return df.mapInArrow(run, schema)


def anchor_rows(keyed_docs: DataFrame, of: Bytes | Words) -> DataFrame:
    """(h, fk, occ) of every anchor of every text."""

    def make(batch, data, offs):
        a = Anchors(of, data, offs)
        fk = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)[a.doc]
        yield pa.RecordBatch.from_arrays([pa.array(a.hash.view(np.int64)), pa.array(fk.view(np.int64)), pa.array(occurrence(fk, a.place - a_first(a)))], names=["h", "fk", "occ"])

    return emitted(keyed_docs.select("fk", "text"), make, "h long, fk long, occ long")


def a_first(a: Anchors) -> np.ndarray:
    return a.first[:-1][a.doc]


def live_texts(keyed_docs: DataFrame, reps: DataFrame, of: Bytes | Words) -> DataFrame:
    """(fk, text, live): one row for each distinct text with anchors that occur twice; live lists their hashes. Written."""
    rows = anchor_rows(keyed_docs, of)
    live = twice(rows, "h")
    of_text = rows.select("h", "fk").join(live, "h").groupBy("fk").agg(F.collect_set("h").alias("live"))
    chosen = written(reps.join(of_text, "fk").select(F.col("fk").alias("k"), "rep", "live"))
    one = (F.col("fk") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    return written(keyed_docs.join(chosen, one).select("fk", "text", "live"))


def own_keys(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that differ between the texts of a slice."""
    return keys ^ mix(doc.astype(np.uint64) + np.uint64(1))


def found_in(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which values are among the found ones; by one sort."""
    if not len(found) or not len(values):
        return np.zeros(len(values), bool)
    found = np.sort(found)
    at = np.searchsorted(found, values)
    at[at == len(found)] = 0
    return found[at] == values


def listed(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The text's index of each entry of a list column, and the entries; a null list has none."""
    sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def longs(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def is_live(a: Anchors, lists: pa.Array) -> np.ndarray:
    """Which anchors' hashes are in their text's list."""
    doc, entries = listed(lists)
    return found_in(own_keys(a.hash, a.doc), own_keys(longs(entries), doc))


def cover(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """True for each of n places that a window from one of `starts` covers."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:-1]) > 0


def distinct_texts(keyed_docs: DataFrame) -> DataFrame:
    """(fk, rep, copies) of each distinct text: its smallest id and its count of rows."""
    return keyed_docs.groupBy("fp", "fk").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
