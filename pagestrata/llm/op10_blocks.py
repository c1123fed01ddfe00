"""Substring dedup over words by fixed-block anchors.

Texts are cut into non-overlapping blocks of `block` words, so that any window
of 2 * block - 1 words holds a whole block. The blocks are the index; every
rolling run of `block` words probes it. A hit is extended to the windows that
hold it, and a window whose words start at another place too is a repeat;
neighbouring repeats join to maximal ones. Before that, runs of words that
cannot be part of a repeat (see repeats.py) are left out of index and probes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASES, MASK, doc_view, gram_hashes, mix, powers, slices, written
from .repeats import Anchors, Words, cover, distinct_texts, emitted, found_in, is_live, keyed, listed, live_texts, longs, occurrence, own_keys, twice


def _keys(batch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def _runs(mask: np.ndarray, width: int) -> np.ndarray:
    """Starts of runs of `width` places that are all set."""
    if len(mask) < width:
        return np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(mask)])
    return np.flatnonzero(total[width:] - total[:-width] == width)


def _window_hashes(a: Anchors, length: int) -> tuple[np.ndarray, np.ndarray]:
    return gram_hashes(a.symbols, length), gram_hashes(a.others, length, BASES[0] ^ 0x5555)


def _context_keys(a: Anchors, which: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, end of the last one, and two hashes of all words from one to the other with the anchor's place, of the chosen anchors."""
    tails = np.append(a.head[1:], len(a.window)) - 1
    lo, hi = a.window[a.head[which]], a.window[tails[which]] + length
    out = []
    for base, symbols in zip(BASES, (a.symbols, a.others)):
        base |= 1
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbols * powers(base, len(symbols)))]) if len(symbols) else np.zeros(1, np.uint64)
        back = np.concatenate([np.ones(1, np.uint64), powers(pow(base, -1, MASK + 1), len(a.symbols))])
        place = (a.place[which] - lo).astype(np.uint64) << np.uint64(32) | (hi - lo).astype(np.uint64)
        out.append(mix((upto[hi] - upto[lo]) * back[lo] + mix(place) * np.uint64(base)))
    return lo, hi, out[0], out[1]


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """lo..hi - 1 of each pair, joined."""
    n = np.maximum(hi - lo, 0)
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def repeated_words(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one blank), spans of removed words; one row per input row.

    Repeated rows and ids are documents of their own: a text of `window` words
    or more with a copy is removed whole. Null, empty and shorter texts lose
    nothing. Windows are told apart by 128 bits: two hashes of two independent
    hashes of each word.
    """
    of, block = Words(window), (window + 1) // 2
    base = keyed(doc_view(docs, id_col, text_col))
    reps = written(distinct_texts(base))
    texts = live_texts(base, reps, of)

    def probes(batch, data, offs):
        a = Anchors(of, data, offs)
        live = is_live(a, batch.column(2))
        covered = cover(len(a.symbols), a.window[live[a.run]] if len(a.run) else a.window, window)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(a.first))
        at = _runs(covered, block)
        at = at[doc[at] == doc[at + block - 1]]
        key, place = _keys(batch)[doc[at]], at - a.first[doc[at]]
        yield pa.RecordBatch.from_arrays([pa.array(gram_hashes(a.symbols, block)[at].view(np.int64)), pa.array(key.view(np.int64)), pa.array(occurrence(key, place)), pa.array(place % block == 0)], names=["g", "fk", "occ", "indexed"])

    probe_rows = emitted(texts, probes, "g long, fk long, occ long, indexed boolean")
    hits = written(probe_rows.groupBy("g").agg(F.min("occ").alias("lo"), F.max("occ").alias("hi"), F.max("indexed").alias("indexed")).where("indexed and lo != hi").select("g"))
    of_text = probe_rows.select("g", "fk").join(hits, "g").groupBy("fk").agg(F.collect_set("g").alias("hits"))
    hit_texts = written(texts.join(of_text, "fk").select("fk", "text", "live", "hits"))

    def hit_contexts(batch, data, offs):
        a = Anchors(of, data, offs)
        fk = _keys(batch)
        live = is_live(a, batch.column(2))
        grams = gram_hashes(a.symbols, block)
        doc, entries = listed(batch.column(3))
        at = np.repeat(np.arange(len(fk)), np.diff(a.first))[: len(grams)]
        hit = np.zeros(len(a.symbols) + 1, bool)
        hit[: len(grams)] = found_in(own_keys(grams, at), own_keys(longs(entries), doc))
        some = np.concatenate([[0], np.cumsum(hit)])
        # A repeat holds a block of its own or of its other place, so a run of `block` words in it hits.
        held = some[a.window + window - block + 1] > some[a.window]
        which = np.flatnonzero(live & (np.bincount(a.run, weights=held, minlength=len(a.place)) > 0)) if len(a.place) else a.place
        _, _, k1, k2 = _context_keys(a, which, window)
        own = fk[a.doc[which]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64)) for x in (a.hash[which], k1, k2, own, occurrence(own, a.place[which] - a.first[:-1][a.doc[which]]))],
            names=["h", "k1", "k2", "fk", "occ"],
        )

    # Equal surroundings of an anchor are settled by their count; of different ones of one anchor's words each is
    # extended, at one of its places, to all its windows.
    rows = emitted(hit_texts, hit_contexts, "h long, k1 long, k2 long, fk long, occ long")
    kinds = written(rows.groupBy("h", "k1", "k2").agg(F.min("occ").alias("lo"), F.max("occ").alias("hi")))
    several = kinds.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", F.lit(True).alias("open"))
    settled = written(kinds.join(several, "h", "left").select("k1", "k2", (F.col("lo") != F.col("hi")).alias("whole"), "lo", F.coalesce("open", F.lit(False)).alias("open")).where("whole or open"))
    mark = F.struct("k1", "k2", "whole", (F.col("open") & (~F.col("whole") | (F.col("occ") == F.col("lo")))).alias("told"))
    marks = written(rows.select("k1", "k2", "fk", "occ").join(settled, ["k1", "k2"]).groupBy("fk").agg(F.collect_set(mark).alias("marks")))
    marked = written(hit_texts.join(marks, "fk").select("fk", "text", "live", "marks"))

    def extended(batch, data, offs):
        a = Anchors(of, data, offs)
        fk = _keys(batch)
        doc, entries = listed(batch.column(3))
        told = entries.field("told").to_numpy(zero_copy_only=False).astype(bool)
        whole = entries.field("whole").to_numpy(zero_copy_only=False).astype(bool)
        live = np.flatnonzero(is_live(a, batch.column(2))) if told.any() else np.zeros(0, np.int64)
        lo, hi, k1, k2 = _context_keys(a, live, window)
        names = own_keys(longs(entries.field("k1")) ^ mix(longs(entries.field("k2"))), doc)
        mine = own_keys(k1 ^ mix(k2), a.doc[live])
        use = found_in(mine, names[told])
        asked = ~found_in(mine, names[told & whole])
        lo, n = lo[use], (hi - lo)[use] - window + 1
        at = _ranges(lo, lo + n)
        w1, w2 = _window_hashes(a, window)
        rep = lambda x: np.repeat(x[use], n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(w1[at].view(np.int64)), pa.array(w2[at].view(np.int64)), pa.array(rep(fk[a.doc[live]]).view(np.int64)), pa.array(occurrence(rep(k1), at - np.repeat(lo, n))), pa.array(rep(asked))],
            names=["w1", "w2", "fk", "occ", "asked"],
        )

    windows = emitted(marked, extended, "w1 long, w2 long, fk long, occ long, asked boolean")
    repeated = twice(windows, "w1", "w2")
    found = written(windows.where("asked").select("w1", "w2", "fk").join(repeated, ["w1", "w2"]).groupBy("fk").agg(F.collect_set(F.struct("w1", "w2")).alias("windows")))
    told = marked.select("fk", "live", F.transform(F.filter("marks", lambda m: m["whole"]), lambda m: F.struct(m["k1"], m["k2"])).alias("wholes")).dropDuplicates(["fk"])  # repeated rows of the smallest id
    state = written(
        reps.join(told, "fk", "left").join(found, "fk", "left").where("copies > 1 or windows is not null or size(wholes) > 0").select(F.col("fk").alias("k"), F.col("fp").alias("p"), (F.col("copies") > 1).alias("copied"), "windows", "live", "wholes")
    )
    joined = base.join(state, (F.col("fk") == F.col("k")) & (F.col("fp") == F.col("p")), "left").select("doc_id", "text", F.coalesce("copied", F.lit(False)).alias("copied"), "windows", "live", "wholes")

    def gone_words(text, windows, live, wholes):
        """For each text the mask of its repeated words."""
        for lo_row, hi_row, data, offs in slices(text):
            a = Anchors(of, data, offs)
            part = slice(lo_row, hi_row)
            doc, entries = listed(windows[part])
            w1, w2 = _window_hashes(a, window)
            w = a.window
            hit = found_in(own_keys(w1[w] ^ mix(w2[w]), a.doc_of_window), own_keys(longs(entries.field(0)) ^ mix(longs(entries.field(1))), doc)) if len(w) else np.zeros(0, bool)
            doc, entries = listed(wholes[part])
            if len(doc) and len(w):
                which = np.flatnonzero(is_live(a, live[part]))
                _, _, k1, k2 = _context_keys(a, which, window)
                whole = np.zeros(len(a.place), bool)
                whole[which] = found_in(own_keys(k1 ^ mix(k2), a.doc[which]), own_keys(longs(entries.field(0)) ^ mix(longs(entries.field(1))), doc))
                hit |= whole[a.run]
            mask = cover(len(a.symbols), w[hit], window)
            for d in range(hi_row - lo_row):
                yield mask[a.first[d] : a.first[d + 1]]

    def run(batches):
        for batch in batches:
            text, copied = batch.column(1), batch.column(2).to_pylist()
            some = [k for k in range(batch.num_rows) if not copied[k] and (batch.column(3)[k].is_valid or (batch.column(5)[k].is_valid and len(batch.column(5)[k])))]
            take = pa.array(some, pa.int64())
            masks = dict(zip(some, gone_words(*(batch.column(c).take(take) for c in (1, 3, 4, 5))))) if some else {}
            n_words, n_removed, kept, spans = [], [], [], []
            for k in range(batch.num_rows):
                words = text[k].as_py().encode("utf-8", "surrogatepass").split()
                n, gone, edge = len(words), 0, []
                if copied[k] and n >= window:
                    gone, words, edge = n, [], [0, n]
                elif k in masks and masks[k].any():
                    mask = masks[k]
                    gone = int(mask.sum())
                    words = [w for w, g in zip(words, mask.tolist()) if not g]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()
                n_words.append(n)
                n_removed.append(gone)
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
                spans.append(edge)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.int32()))], names=["doc_id", "n_words", "n_removed", "kept_text", "spans"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string, spans array<int>")
