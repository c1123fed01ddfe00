"""Benchmark decontamination: one automaton over item windows, texts scanned once.

Texts are reduced to their normalised words joined by single blanks, in bytes;
the Aho-Corasick automaton holds each window of ten item words between blanks.
Hits are mapped to word indices and, on demand, to spans of the original.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_view, written

#: Words of a text before A-Z are lower-cased.
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Bytes to a lower-case word byte, or to a blank.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def norm_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def windows(words: list[bytes], n: int) -> Iterator[bytes]:
    """Each run of n words; all words of a shorter text; nothing without words."""
    if words:
        for i in range(max(1, len(words) - n + 1)):
            yield b" ".join(words[i : i + n])


def automaton_of(items: list[tuple[str, str]], n: int):
    import ahocorasick

    found: dict[bytes, set[str]] = {}
    for item_id, text in items:
        for w in windows(norm_words(text), n):
            found.setdefault(w, set()).add(item_id)
    auto = ahocorasick.Automaton()
    for w, ids in found.items():
        auto.add_word(" " + w.decode("latin-1") + " ", (len(w) + 2, w.count(b" ") + 1, tuple(sorted(ids))))
    if found:
        auto.make_automaton()
    return auto if found else None


def scan(text: str, auto) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Word count, merged ranges of hit word indices, ids of the items that occur."""
    words = norm_words(text)
    if auto is None or not words:
        return len(words), [], set()
    line = " " + b" ".join(words).decode("latin-1") + " "
    spans, ids, at, seen = [], set(), 0, 0
    for end, (chars, n, names) in auto.iter(line):
        start = end + 1 - chars
        lo, hi = min(at, start), max(at, start)
        seen += line.count(" ", lo, hi) * (1 if start >= at else -1)
        at = start
        spans.append((seen, seen + n))
        ids.update(names)
    return len(words), merged_ranges(spans), ids


OUT = "doc_id long, n_words long, n_hit long, item_ids array<string>, spans array<struct<start:int,end:int>>"
HELD = "doc_id long, text string, words array<struct<start:int,end:int>>, item_ids array<string>"
RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

#: The automaton of this worker process: only the last one asked for is held.
_BUILT: dict[str, tuple] = {}


def built(key: str, items: list[tuple[str | None, str]], window: int) -> tuple:
    """The automaton of these items and the ids among them, made once a worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = automaton_of([(i or "", t) for i, t in items], window), {i for i, _ in items if i is not None}
    return _BUILT[key]


def item_blocks(benchmark: DataFrame, item_col: str, item_text: str, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The benchmark's items on the driver, one block of about `block_bytes` after the other; one empty block without items."""
    items = benchmark.select(benchmark[item_col].cast("string").alias("i"), benchmark[item_text].cast("string").alias("t")).where("t is not null").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        yield [(r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64("t", "i"), F.lit(blocks)) == k).collect()]


def merged_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = 32 << 20) -> DataFrame:
    """The rows of docs without any window of an item, as they are. A benchmark above `block_bytes` is looked for block by block, each in a pass that is written."""
    left = None
    for items in item_blocks(benchmark, item_col, item_text, block_bytes):
        docs = docs if left is None else written(left)
        left = docs.where(_clean(docs, items, window)(docs[text_col].cast("string")))
    return left


def _clean(docs: DataFrame, items: list, window: int):
    key, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(items)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        auto, _ = built(key, shared.value, window)
        return pd.Series([not scan(t or "", auto)[1] for t in texts], dtype=bool)

    return clean


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted) and the code-point spans of hit words in the original, one row per input row.

    A null text has no words; a null item id hits but is not listed; an item
    without words is no item. The automaton holds items of about `block_bytes`
    at a time: a larger benchmark is looked for block by block, in passes whose
    hits are written and joined row by row.
    """
    blocks = item_blocks(benchmark, item_col, item_text, block_bytes)
    rows = doc_view(docs, id_col, text_col).select("doc_id", "text", F.array().cast("array<struct<start:int,end:int>>").alias("words"), F.array().cast("array<string>").alias("item_ids"))
    items = next(blocks)
    for more in blocks:
        rows, items = written(_scanned(rows, items, window, HELD)), more
    return _scanned(rows, items, window, OUT)


def _scanned(rows: DataFrame, items: list, window: int, schema: str) -> DataFrame:
    """rows of HELD with the hits of these items added; as OUT in the end."""
    key, shared = uuid.uuid4().hex, rows.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        auto, named = built(key, shared.value, window)
        for batch in batches:
            n_words, words, item_ids = [], [], []
            for text, before, ids in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                n, ranges, found = scan(text.as_py(), auto)
                n_words.append(n)
                words.append(merged_ranges([*((r["start"], r["end"]) for r in before), *ranges]) if before else ranges)
                item_ids.append(sorted({*ids, *(found & named)}))
            listed = pa.array(item_ids, pa.list_(pa.string()))
            if schema == HELD:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([[{"start": s, "end": e} for s, e in w] for w in words], RANGES), listed], names=["doc_id", "text", "words", "item_ids"])
                continue
            spans = []
            for text, ranges in zip(batch.column(1), words):
                at = [m.span() for m in WORD.finditer(text.as_py())] if ranges else []
                spans.append([{"start": at[s][0], "end": at[e - 1][1]} for s, e in ranges])
            n_hit = [sum(e - s for s, e in w) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), listed, pa.array(spans, RANGES)], names=["doc_id", "n_words", "n_hit", "item_ids", "spans"])

    return rows.mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
