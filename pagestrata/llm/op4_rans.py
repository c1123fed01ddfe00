"""Token ids as files: static range asymmetric numeral systems.

Ids are dealt out in doc_id order. Each worker gathers frames of some million
ids; a frame has one frequency table and blocks of whole documents that are
coded independently with it. In a block, `lanes` coders are interleaved: lane j
takes ids j, j + lanes, ...; all lanes take a step at once in numpy, so a large
frame has more of them. A block
names its word stream's place, checksums of stream and ids, and checkpoints
(the lanes' states and the stream's place every `EVERY` steps) from which
several readers can decode parts of it.

A frame is one binary value; frames are rows of a Parquet dataset, so that
Spark's commit protocol keeps the dataset whole when executors are lost and
any file system that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_view, shared_dir
from .tokens import encoder

MAGIC, VERSION = b"RANS", 1
LANES, WIDE = 512, 4096  # coders of a small frame, and of one with WIDE_IDS or more
WIDE_IDS = 1 << 20
EVERY = 64
SCALE_BITS = 18
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
HEAD = struct.Struct("<4sHHIIIQ")  # magic, version, lanes, symbols, blocks, documents, ids
BLOCK = struct.Struct("<QIIIIQQI")  # ids, documents, words, crc of words, crc of ids, place of words, place of checkpoints, checkpoints


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies of 1 or more that sum to 2 ** SCALE_BITS, nearly in proportion to counts (all above 0)."""
    total = 1 << SCALE_BITS
    f = np.maximum(1, np.floor(counts * (total / counts.sum())).astype(np.int64))
    over = int(f.sum()) - total
    if over < 0:
        f[np.argmax(f)] -= over
    while over > 0:  # taken from the largest, never below 1
        spare = f - 1
        take = np.minimum(spare, -(-spare * over // max(int(spare.sum()), 1)))
        order = np.argsort(-take, kind="stable")
        take = take[order]
        upto = np.cumsum(take)
        take = np.where(upto <= over, take, np.maximum(0, over - (upto - take)))
        f[order] -= take
        over = int(f.sum()) - total
    return f


def encode_block(index: np.ndarray, freq: np.ndarray, start: np.ndarray, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray, list]:
    """Final states, words in reading order, and checkpoints (step, words read before it, states)."""
    n = len(index)
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, dtype=np.uint64)
    f_all, c_all = freq[index], start[index]
    top_all = f_all << np.uint64(31 - SCALE_BITS + 32)
    words, marks = [], []
    rest = np.uint64(1 << SCALE_BITS)
    for t in range(steps - 1, -1, -1):
        at = slice(t * lanes, min(n, (t + 1) * lanes))
        f = f_all[at]
        x = state[: len(f)]
        full = np.flatnonzero(x >= top_all[at])
        out = x[full]
        words.append(out.astype(np.uint32))
        x[full] = out >> WORD
        q = x // f
        x += q * (rest - f)  # q * 2 ** SCALE_BITS + (x - q * f)
        x += c_all[at]
        if t and t % EVERY == 0:
            marks.append((t, len(words), state.copy()))
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    total = int(sizes.sum())
    upto = np.cumsum(sizes)
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    return state, stream, [(t, total - int(upto[k - 1]), s) for t, k, s in marks[::-1]]


def decode_block(n: int, state: np.ndarray, stream: np.ndarray, symbol: np.ndarray, freq: np.ndarray, start: np.ndarray, lanes: int = LANES, first: int = 0, at: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the steps first..last, from the states and the stream's place at `first`. symbol: index by slot."""
    steps = -(-n // lanes) if last is None else last
    state = state.copy()
    out = np.empty(max(0, min(n, steps * lanes) - first * lanes), dtype=symbol.dtype)
    bits, mask = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
    for t in range(first, steps):
        x = state[: min(lanes, n - t * lanes)]
        slot = x & mask
        s = symbol[slot]
        out[(t - first) * lanes : (t - first) * lanes + len(s)] = s
        x >>= bits
        x *= freq[s]
        x += slot
        x -= start[s]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | stream[at : at + len(low)]
        at += len(low)
    return out


class FrameWriter:
    """Documents in, frames out: (first doc, documents, ids, bytes)."""

    def __init__(self, frame_ids: int = 4 << 20, block_ids: int = 1 << 20):
        self.frame_ids, self.block_ids = frame_ids, block_ids
        self.parts, self.docs, self.lens, self.n = [], [], [], 0

    def add(self, doc_id, ids: np.ndarray):
        self.parts.append(ids)
        self.docs.append(doc_id)
        self.lens.append(len(ids))
        self.n += len(ids)
        return self.close() if self.n >= self.frame_ids else None

    def close(self):
        if not self.docs:
            return None
        ids, lens = np.concatenate(self.parts), np.array(self.lens, dtype=np.int64)
        counts = np.bincount(ids)
        used = np.flatnonzero(counts)
        freq = scaled(counts[used]).astype(np.uint64)
        start = np.cumsum(freq) - freq
        index = (np.cumsum(counts > 0) - 1)[ids]
        lanes = WIDE if len(ids) >= WIDE_IDS else LANES
        table = zlib.compress(np.diff(used, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
        doc_ids = np.array([d or 0 for d in self.docs], dtype="<i8")
        nulls = np.packbits(np.array([d is None for d in self.docs]))
        docs = zlib.compress(doc_ids.tobytes() + lens.astype("<i8").tobytes() + nulls.tobytes(), 6)
        upto = np.cumsum(lens)
        blocks, body, at, k = [], [], 0, 0
        while k < len(lens):
            lo = int(upto[k - 1]) if k else 0
            to = min(len(lens), max(k + 1, int(np.searchsorted(upto, lo + self.block_ids, side="left")) + 1))
            hi = int(upto[to - 1])
            state, stream, marks = encode_block(index[lo:hi], freq, start, lanes)
            words = state.astype("<u8").tobytes() + stream.astype("<u4").tobytes()
            mark = b"".join(struct.pack("<II", t, w) + s.astype("<u8").tobytes() for t, w, s in marks)
            blocks.append(BLOCK.pack(hi - lo, to - k, len(stream), zlib.crc32(words), zlib.crc32(ids[lo:hi].astype("<u4").tobytes()), at, at + len(words), len(marks)))
            body += [words, mark]
            at += len(words) + len(mark)
            k = to
        out = HEAD.pack(MAGIC, VERSION, lanes, len(used), len(blocks), len(lens), len(ids)) + struct.pack("<II", len(table), len(docs)) + table + docs + b"".join(blocks) + b"".join(body)
        done = (self.docs[0], len(lens), len(ids), out)
        self.parts, self.docs, self.lens, self.n = [], [], [], 0
        return done


class Frame:
    """A frame read back; each block on its own."""

    def __init__(self, raw: bytes):
        magic, version, self.lanes, n_symbols, n_blocks, n_docs, self.n = HEAD.unpack_from(raw)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a frame of token ids")
        at = HEAD.size
        n_table, n_doc_bytes = struct.unpack_from("<II", raw, at)
        at += 8
        table = np.frombuffer(zlib.decompress(raw[at : at + n_table]), dtype="<u4")
        at += n_table
        self.used = np.cumsum(table[:n_symbols]).astype(np.uint32)
        self.freq = table[n_symbols:].astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.symbol = np.repeat(np.arange(n_symbols, dtype=np.int32), self.freq.astype(np.int64))
        docs = zlib.decompress(raw[at : at + n_doc_bytes])
        at += n_doc_bytes
        ids = np.frombuffer(docs[: 8 * n_docs], dtype="<i8").tolist()
        self.lens = np.frombuffer(docs[8 * n_docs : 16 * n_docs], dtype="<i8")
        nulls = np.unpackbits(np.frombuffer(docs[16 * n_docs :], dtype=np.uint8))[:n_docs]
        self.docs = [None if null else d for d, null in zip(ids, nulls)]
        self.blocks = [BLOCK.unpack_from(raw, at + k * BLOCK.size) for k in range(n_blocks)]
        self.body = memoryview(raw)[at + n_blocks * BLOCK.size :]

    def block(self, k: int) -> np.ndarray:
        """All ids of a block, checked."""
        n, _, n_words, crc_words, crc_ids, at, _, _ = self.blocks[k]
        words = self.body[at : at + 8 * self.lanes + 4 * n_words]
        if zlib.crc32(words) != crc_words:
            raise ValueError(f"block {k}: its words are damaged")
        ids = self._ids(n, np.frombuffer(words[: 8 * self.lanes], dtype="<u8"), words)
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc_ids:
            raise ValueError(f"block {k}: its ids are damaged")
        return ids

    def parts(self, k: int) -> list[tuple[int, int, int, np.ndarray]]:
        """(first step, end step, place in the stream, states) of each part of a block that can be decoded on its own."""
        n, _, n_words, _, _, at, mark_at, n_marks = self.blocks[k]
        found = [(0, 0, np.frombuffer(self.body[at : at + 8 * self.lanes], dtype="<u8"))]
        for _ in range(n_marks):
            t, w = struct.unpack_from("<II", self.body, mark_at)
            found.append((t, w, np.frombuffer(self.body[mark_at + 8 : mark_at + 8 + 8 * self.lanes], dtype="<u8")))
            mark_at += 8 + 8 * self.lanes
        ends = [t for t, _, _ in found[1:]] + [-(-n // self.lanes)]
        return [(t, end, w, s) for (t, w, s), end in zip(found, ends)]

    def part(self, k: int, part: tuple) -> np.ndarray:
        n, _, n_words, _, _, at, _, _ = self.blocks[k]
        t, end, w, state = part
        return self._ids(n, state, self.body[at : at + 8 * self.lanes + 4 * n_words], t, w, end)

    def _ids(self, n, state, words, first=0, at=0, last=None) -> np.ndarray:
        stream = np.frombuffer(words[8 * self.lanes :], dtype="<u4").astype(np.uint64)
        return self.used[decode_block(n, state.astype(np.uint64), stream, self.symbol, self.freq, self.start, self.lanes, first, at, last)]


FRAMES = "shard int, frame int, first_doc long, n_docs long, n_ids long, data binary"


def shards(view: DataFrame, shard_bytes: int) -> int:
    """Ranges of ids: `spark.sql.shuffle.partitions`, or more where the texts' bytes ask for it."""
    size = view.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(view.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))


def encode_frames(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", path: str | None = None, end_id: int = 2, frame_ids: int = 4 << 20, block_ids: int = 1 << 20, shard_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (shard, frame, first_doc, n_docs, n_ids, data); shards and frames in ascending doc_id order, null ids first.

    Each document is the library's ids of its whole text and `end_id`. Rows
    with one id stand next to each other, in the order of their texts.
    """
    view = doc_view(docs, id_col, text_col)
    parts = shards(view, shard_bytes)

    def run(batches):
        enc, writer, shard, frames = encoder(tokenizer, path), FrameWriter(frame_ids, block_ids), TaskContext.get().partitionId(), 0

        def row(done):
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([frames], pa.int32()), pa.array([done[0]], pa.int64()), pa.array([done[1]], pa.int64()), pa.array([done[2]], pa.int64()), pa.array([done[3]], pa.binary())],
                names=["shard", "frame", "first_doc", "n_docs", "n_ids", "data"],
            )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, tokens, counts in enc.encode_column(batch.column(1)):
                at = 0
                for doc, n in zip(ids[lo:hi], counts.tolist()):
                    done = writer.add(doc, np.append(tokens[at : at + n], np.uint32(end_id)))
                    at += n
                    if done:
                        yield row(done)
                        frames += 1
        if done := writer.close():
            yield row(done)

    return view.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, FRAMES)


def write_tokens(docs: DataFrame, out: str, **how) -> None:
    encode_frames(docs, **how).write.mode("overwrite").parquet(out)


def read_tokens(spark, out: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids of every document in the dataset; frames are decoded independently."""
    frames = spark.read.schema(FRAMES).parquet(out)
    totals = frames.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row a file: a file system lists as many
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    inside = frames.select("shard", "frame", "n_ids").select("shard", "frame", (F.sum("n_ids").over(Window.partitionBy("shard").orderBy("frame")) - F.col("n_ids")).alias("frame_start"))
    starts = inside.join(before, "shard").select(F.col("shard").alias("s"), F.col("frame").alias("f"), (F.col("shard_start") + F.col("frame_start")).alias("at"))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                shard, number, frame = batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), Frame(batch.column(2)[k].as_py())
                doc = at = 0
                for b in range(len(frame.blocks)):
                    ids, n_docs = frame.block(b).astype("<u4"), frame.blocks[b][1]
                    lens = frame.lens[doc : doc + n_docs]
                    ends = np.cumsum(lens)
                    parts = [ids[e - n : e] for e, n in zip(ends.tolist(), lens.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard] * n_docs, pa.int32()), pa.array([number] * n_docs, pa.int32()), pa.array(frame.docs[doc : doc + n_docs], pa.int64()), pa.array(at + ends - lens, pa.int64()), pa.array(lens, pa.int64()), pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()), pa.array(parts, pa.list_(pa.int32())) if with_ids else pa.nulls(n_docs, pa.list_(pa.int32()))],
                        names=["shard", "frame", "doc_id", "local", "n_tokens", "ids_crc32", "ids"],
                    )
                    doc += n_docs
                    at += int(lens.sum())

    found = frames.select("shard", "frame", "data").mapInArrow(run, "shard int, frame int, doc_id long, local long, n_tokens long, ids_crc32 long, ids array<int>")
    return found.join(starts, (F.col("shard") == F.col("s")) & (F.col("frame") == F.col("f"))).select("doc_id", (F.col("at") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "ids")


def round_trip(docs: DataFrame, **how) -> DataFrame:
    """Writes the dataset to the shared folder and reads every document back from it."""
    spark, out = docs.sparkSession, shared_dir(docs.sparkSession)
    write_tokens(docs, out, **how)
    return read_tokens(spark, out, with_ids=False).drop("ids")
