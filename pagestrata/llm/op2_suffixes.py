"""Substring dedup over bytes by suffix arrays.

Every window of 200 bytes that may repeat is part of the context of its anchor
(see repeats.py); equal windows stand in contexts of one anchor's hash. Equal
contexts are settled by their count. The different contexts of a hash go to
one shard, where external induced sorting (induced.py) orders all their
suffixes with common prefixes: neighbours that share a window are repeats. The
windows of a context are dealt out by ranges of offsets: all of a range hold one
core, which is the shard's key and stands in the sorted text as one symbol, so
that a window is as many symbols as the range has offsets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_view, written
from .induced import repeated_starts
from .repeats import Anchors, Bytes, cover, distinct_texts, emitted, is_live, keyed, live_texts, occurrence


def contexts(a: Anchors, length: int, which: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(anchor, text, first window, end of the last window, anchor's place in the context) of the chosen anchors."""
    tails = np.append(a.head[1:], len(a.window)) - 1
    lo, hi = a.window[a.head[which]], a.window[tails[which]] + length
    return list(zip(which.tolist(), a.doc[which].tolist(), lo.tolist(), hi.tolist(), (a.place[which] - lo).tolist()))


def context_key(h: int, off: int, text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16, key=b"%d:%d" % (h, off)).digest()


def _longest_common(cores: np.ndarray, sides: list[bytes], width: int) -> np.ndarray:
    """For each side (of `width` bytes at most) the longest prefix that it shares with another side of its core; -1 if it has no other."""
    pad = -(-max(width, 1) // 8) * 8
    lens = np.fromiter(map(len, sides), np.int64, len(sides))
    rows = np.frombuffer(b"".join(x.ljust(pad, b"\0") for x in sides), np.uint8).reshape(len(sides), pad)
    order = np.lexsort((lens, *rows.view(">u8").T[::-1], cores))
    a, b = order[:-1], order[1:]
    differ = rows[a] != rows[b]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), pad)
    common = np.where(cores[a] == cores[b], np.minimum(common, np.minimum(lens[a], lens[b])), -1)
    best = np.full(len(sides), -1)
    best[a] = common
    best[b] = np.maximum(best[b], common)
    return best


def _trimmed(rows: list[tuple[int, bytes, bytes]], span: int) -> tuple[np.ndarray, dict]:
    """rows (core, before, after), cut to what other rows of the core share: bytes cut off in front, and the rows of each core and text.

    A repeat takes in the core and `span - 1` symbols around it, so it reaches no
    further than a neighbour in the order of reversed `before`s and in that of
    `after`s agrees; rows that agree too little hold none and are left out.
    """
    cores = np.fromiter((c for c, _, _ in rows), np.int64, len(rows))
    back = _longest_common(cores, [b[::-1] for _, b, _ in rows], span - 1)
    ahead = _longest_common(cores, [a for _, _, a in rows], span - 1)
    lead = np.fromiter((len(b) for _, b, _ in rows), np.int64, len(rows)) - back
    groups: dict[tuple[int, tuple[bytes, bytes]], list[int]] = {}
    for k in np.flatnonzero(back + ahead >= span - 1).tolist():
        core, before, after = rows[k]
        groups.setdefault((core, (before[lead[k] :], after[: ahead[k]])), []).append(k)
    return lead, groups


def repeated_bytes(docs: DataFrame, length: int = 200, shard_symbols: int = 4 << 20, span: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), spans (starts and ends of removed runs); one row per input row.

    Repeated rows and ids are documents of their own: a text of `length` bytes
    or more with a copy is removed whole. Null, empty and shorter texts lose
    nothing. `span`: offsets in a range. Shards are sorted `shard_symbols` at a
    time; a core's contexts stay together.
    """
    of = Bytes(length)
    base = keyed(doc_view(docs, id_col, text_col))
    reps = written(distinct_texts(base))
    texts = live_texts(base, reps, of)

    def cut(batch, data, offs):
        a = Anchors(of, data, offs)
        fk = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        which = np.flatnonzero(is_live(a, batch.column(2)))
        raw = data.tobytes()
        found = contexts(a, length, which)
        ctx = [raw[lo:hi] for _, _, lo, hi, _ in found]
        hs, offsets = a.hash[which].view(np.int64), [f[4] for f in found]
        keys = [context_key(h, o, c) for h, o, c in zip(hs.tolist(), offsets, ctx)]
        own = fk[a.doc[which]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(hs), pa.array(offsets, pa.int32()), pa.array(keys, pa.binary()), pa.array(ctx, pa.binary()), pa.array(own.view(np.int64)), pa.array(occurrence(own, a.place[which] - a.first[:-1][a.doc[which]]))],
            names=["h", "off", "key", "ctx", "fk", "occ"],
        )

    rows = emitted(texts, cut, "h long, off int, key binary, ctx binary, fk long, occ long")
    kinds = written(rows.groupBy("h", "off", "key", "ctx").agg((F.min("occ") != F.max("occ")).alias("whole")))
    several = written(kinds.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))

    def ranges_of(off: int, size: int):
        """(smallest d, first start, last start) of the context's windows, by ranges of d: the window at s has its anchor at d = off - s."""
        for d_lo in range(0, length, span):
            first, last = max(0, off - d_lo - span + 1), min(size - length, off - d_lo)
            if first <= last:
                yield d_lo, first, last

    def core_key(h: int, d_lo: int, off: int, ctx: bytes) -> bytes:
        """Of the bytes that all windows of a range share."""
        return hashlib.blake2b(ctx[off - d_lo : off - d_lo - span + 1 + length], digest_size=16, key=b"%d:%d" % (h, d_lo)).digest()

    def cores(batches):
        for batch in batches:
            names, keys = [], []
            for h, off, key, ctx in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for d_lo, _, _ in ranges_of(off, len(ctx)):
                    names.append(core_key(h, d_lo, off, ctx))
                    keys.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(keys, pa.binary())], names=["core", "key"])

    # Contexts of one hash that share no range's core share no window: they need no order.
    crowded = kinds.join(several, "h")
    core_rows = crowded.select("h", "off", "key", "ctx").mapInArrow(cores, "core binary, key binary")
    shared = written(core_rows.groupBy("core").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo != hi").select("core"))
    open_ = written(core_rows.join(shared, "core").groupBy("key").agg(F.collect_set("core").alias("cores")))

    def deal(batches):
        """One row for each range of a context whose core another one has: what stands before and after the core."""
        for batch in batches:
            names, keys, lefts, rights, at = [], [], [], [], []
            for h, off, key, ctx, shared_cores in zip(*(batch.column(i).to_pylist() for i in range(5))):
                wanted = set(shared_cores)
                for d_lo, first, last in ranges_of(off, len(ctx)):
                    name = core_key(h, d_lo, off, ctx)
                    if name in wanted:
                        names.append(name)
                        keys.append(key)
                        lefts.append(ctx[first : off - d_lo])
                        rights.append(ctx[off - d_lo - span + 1 + length : last + length])
                        at.append(first)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(keys, pa.binary()), pa.array(lefts, pa.binary()), pa.array(rights, pa.binary()), pa.array(at, pa.int32())], names=["core", "key", "before", "after", "at"])

    dealt = crowded.join(open_, "key").select("h", "off", "key", "ctx", "cores").mapInArrow(deal, "core binary, key binary, before binary, after binary, at int")

    def sort(batches):
        """Shards in turn, several small ones in one order: each core is a symbol of its own, so windows of different ones never are equal."""
        held, size, last, n_cores = [], 0, None, 0

        def settle():
            lead, groups = _trimmed([(c, before, after) for _, c, before, after, _ in held], span)
            by_core: dict[int, list] = {}
            for core, text in groups:
                by_core.setdefault(core, []).append(text)
            texts_, of = [], []
            for (core, (before, after)), rows in groups.items():
                if len(by_core[core]) > 1:  # another text of this core: they need an order
                    texts_.append(np.concatenate([np.frombuffer(before, np.uint8).astype(np.int32), np.array([256 + core], np.int32), np.frombuffer(after, np.uint8).astype(np.int32)]))
                    of.append((core, (before, after)))
            starts_of = dict(zip(of, repeated_starts(texts_, span, 256 + n_cores))) if texts_ else {}
            keys, ranges = [], []
            for name, rows in groups.items():
                starts = np.arange(len(name[1][0]) + len(name[1][1]) + 2 - span) if len(rows) > 1 else starts_of.get(name, ())
                if not len(starts):
                    continue
                breaks = np.flatnonzero(np.diff(starts) > 1) + 1
                edges = np.stack([np.concatenate([starts[:1], starts[breaks]]), np.concatenate([starts[breaks - 1], starts[-1:]])], 1).ravel()
                for k in rows:
                    keys.append(held[k][0])
                    ranges.append((edges + held[k][4] + lead[k]).astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ranges, pa.list_(pa.int32()))], names=["key", "ranges"])

        for batch in batches:
            for core, key, before, after, at in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if core != last:
                    if size >= shard_symbols:
                        yield settle()
                        held, size, n_cores = [], 0, 0
                    n_cores += 1
                    last = core
                held.append((key, n_cores - 1, before, after, at))
                size += len(before) + len(after) + 2
        if held:
            yield settle()

    sorted_ = dealt.repartition("core").sortWithinPartitions("core").mapInArrow(sort, "key binary, ranges array<int>")
    ranges = written(sorted_.groupBy("key").agg(F.flatten(F.collect_list("ranges")).alias("ranges")))
    settled = written(kinds.select("key", "whole").join(ranges, "key", "left").where("whole or ranges is not null"))
    found = rows.select("key", "fk").join(settled, "key").groupBy("fk").agg(F.collect_set(F.struct("key", "whole", "ranges")).alias("marks"))
    state = written(
        reps.join(found, "fk", "left")
        .join(texts.select("fk", "live").dropDuplicates(["fk"]), "fk", "left")
        .where("copies > 1 or marks is not null")
        .select(F.col("fk").alias("k"), F.col("fp").alias("p"), (F.col("copies") > 1).alias("copied"), "marks", "live")
    )
    joined = base.join(state, (F.col("fk") == F.col("k")) & (F.col("fp") == F.col("p")), "left").select("doc_id", "text", F.coalesce("copied", F.lit(False)).alias("copied"), "marks", "live")

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for k in range(batch.num_rows):
                raw = batch.column(1)[k].as_py().encode("utf-8", "surrogatepass")
                n = len(raw)
                gone = None
                if n >= length and batch.column(2)[k].as_py():
                    gone = np.ones(n, bool)
                elif n >= length and batch.column(3)[k].is_valid:
                    marks = {m["key"]: (m["whole"], m["ranges"]) for m in batch.column(3)[k].as_py()}
                    a = Anchors(of, np.frombuffer(raw, np.uint8), np.array([0, n]))
                    which = np.flatnonzero(is_live(a, batch.column(4).slice(k, 1)))
                    starts = []
                    for (_, _, lo, hi, off), h in zip(contexts(a, length, which), a.hash[which].view(np.int64).tolist()):
                        whole, ranges = marks.get(context_key(h, off, raw[lo:hi]), (False, None))
                        if whole:
                            starts.append(np.arange(lo, hi - length + 1))
                        for s, e in zip(ranges[::2], ranges[1::2]) if ranges and not whole else ():
                            starts.append(np.arange(lo + s, lo + e + 1))
                    gone = cover(n, np.unique(np.concatenate(starts)), length) if starts else None
                if gone is None:
                    row = (n, 0, 0, raw, [])
                else:
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist()
                    row = (n, int(gone.sum()), len(edge) // 2, np.frombuffer(raw, np.uint8)[~gone].tobytes(), edge)
                for column, value in zip(out, row):
                    column.append(value)
            kinds_ = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds_))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<int>")
