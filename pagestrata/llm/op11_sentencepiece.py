"""SentencePiece ids of whole texts, by an agenda of symbol pairs, and back.

For merge-type vocabularies with byte fallback and plain normalisation. A text
is cut where no merge can join both sides: no piece of the vocabulary holds the
two bytes next to each other. Each distinct run between cuts is merged once in
a worker: all adjacent pairs that are pieces stand in a heap by score, leftmost
first; the best pair merges and its new neighbours join the heap. Runs that a
batch meets first are held against the library in one call, and so are the
decoded texts; a difference is an error, not a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_view
from .tokens import PieceEncoder, PieceMemo, encoder

MARK = "▁"
#: Fixed numbers of the model file: its fields, and kinds of pieces.
PIECES, TRAINER, MODEL_TYPE, MERGES = 1, 2, 3, 2
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class Agenda:
    """Merges by score over the pieces of a vocabulary; a blank stands for the vocabulary's own mark of one."""

    def __init__(self, model: bytes, scores: list[float]):
        kinds, texts, merges = [], [], False
        for field, value in fields(model):
            if field == PIECES:
                piece = dict(fields(value))
                texts.append(piece[1].decode("utf-8"))
                kinds.append(piece.get(3, NORMAL))
            elif field == TRAINER:
                merges = dict(fields(value)).get(MODEL_TYPE) == MERGES
        if not merges or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or kinds.count(BYTE) != 256:
            raise ValueError("a merge-type vocabulary with byte fallback and without symbols of its users is needed")
        pieces = {t.replace(MARK, " "): i for i, (t, k) in enumerate(zip(texts, kinds)) if k == NORMAL}
        self.ids = pieces
        self.cost = {t: -scores[i] for t, i in pieces.items()}
        self.bytes = [0] * 256
        self.surface = [t.replace(MARK, " ").encode() if k == NORMAL else b"" for t, k in zip(texts, kinds)]
        for i, (t, k) in enumerate(zip(texts, kinds)):
            if k == BYTE:
                value = int(t[3:5], 16)
                self.bytes[value] = i
                self.surface[i] = bytes([value])
        self.unknown = kinds.index(UNKNOWN)
        self.chars = set().union(*pieces)
        #: Whether some piece holds these two bytes on both sides of the edge of a character.
        self.joint = np.zeros((256, 256), bool)
        for t in pieces:
            parts = [c.encode() for c in t]
            for a, b in zip(parts, parts[1:]):
                self.joint[a[-1], b[0]] = True

    def merge(self, text: str) -> list[int]:
        """Ids of a run of text. Of equal scores the leftmost pair merges first; an entry whose symbols have changed since is passed over."""
        parts: list[str | None] = list(text)
        n, cost = len(parts), self.cost
        agenda = [(c, i, 2) for i in range(n - 1) if (c := cost.get(text[i : i + 2])) is not None]
        if agenda:
            heapify(agenda)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            while agenda:
                _, i, size = heappop(agenda)
                left, j = parts[i], after[i]
                if left is None or j == n or len(left) + len(parts[j]) != size:
                    continue
                parts[i] = left = left + parts[j]
                parts[j] = None
                after[i] = k = after[j]
                if k < n:
                    before[k] = i
                    if (c := cost.get(left + parts[k])) is not None:
                        heappush(agenda, (c, i, size + len(parts[k])))
                h = before[i]
                if h >= 0 and (c := cost.get(parts[h] + left)) is not None:
                    heappush(agenda, (c, h, size + len(parts[h])))
        out: list[int] = []
        for p in parts:
            if p is not None:
                if (one := self.ids.get(p)) is not None:
                    out.append(one)
                else:
                    out += [self.bytes[b] for b in p.encode("utf-8", "surrogatepass")]
        return out


class SentencePieces(PieceEncoder):
    """Whole texts to ids and back. Texts have to come with one blank in front and blanks for marks, see encode()."""

    def __init__(self, name: str, path: str | None = None, memo: int = 1_000_000):
        import public_tokenizers
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(name))
        if self.library.normalize("  ﬁ  Ａ́ ") != f"{MARK * 3}ﬁ{MARK * 2}Ａ́{MARK}":
            raise ValueError("a vocabulary that leaves texts as they are and puts a blank in front is needed")
        self.agenda = Agenda(self.library.serialized_model_proto(), [self.library.get_score(i) for i in range(self.library.get_piece_size())])
        self.end = self.library.eos_id()
        self.between = next(c for c in map(chr, [10, *range(32)]) if c not in self.agenda.chars)
        self.by_word, self.memo = True, PieceMemo(memo)

    def _pieces(self, data: np.ndarray, offs: np.ndarray):
        edge = np.zeros(len(data) + 1, bool)
        edge[1:-1] = ~self.agenda.joint[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
        edge[offs] = True
        cuts = np.flatnonzero(edge)
        return cuts[:-1], cuts[1:], np.searchsorted(cuts, offs)

    def measure(self, pieces: list[str]) -> list[list[int]]:
        """Ids by the agenda, all of them held against the library's: between two pieces stands a character that no merge takes."""
        made = [self.agenda.merge(p) for p in pieces]
        gap = [self.agenda.bytes[b] for b in self.between.encode()]
        want = self.agenda.merge(" ")
        for ids in made:
            want += gap
            want += ids
        if pieces and self.library.encode(self.between + self.between.join(pieces), num_threads=1) != want:
            raise ValueError(f"ids differ from the library's among {len(pieces)} pieces from {pieces[0]!r} to {pieces[-1]!r}")
        return made

    def decode(self, ids: list[int]) -> str:
        """The text of any ids of the vocabulary. Ids that no text gives (unknown, a first piece without blank, broken bytes) are left to the library."""
        surface = self.agenda.surface
        if ids and self.agenda.unknown not in ids and surface[ids[0]][:1] == b" ":
            try:
                return b"".join(map(surface.__getitem__, ids))[1:].decode("utf-8")
            except UnicodeDecodeError:
                pass
        return self.library.decode(ids)


def encode(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int> with the end id, decoded string; one row per input row.

    A null or empty text has the end id alone and decodes to the empty text.
    Texts of any length are encoded whole; the vocabulary's own mark of a blank
    in a text decodes to a blank, as the library has it.
    """

    def run(batches):
        pieces = encoder(tokenizer, path, SentencePieces)
        for batch in batches:
            for lo, hi, ids, counts in pieces.encode_column(batch.column(1)):
                flat, upto = ids.tolist(), np.concatenate([[0], np.cumsum(counts)]).tolist()
                lists = [[*flat[a:b], pieces.end] for a, b in zip(upto, upto[1:])]
                texts = [pieces.decode(x) for x in lists]
                if pieces.library.decode(lists, num_threads=1) != texts:
                    raise ValueError(f"a decoded text of {batch.column(0)[lo]} to {batch.column(0)[hi - 1]} differs from the library's")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(lists, pa.list_(pa.int32())), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    view = doc_view(docs, id_col, text_col)
    marked = F.when(F.col("text") == "", "").otherwise(F.concat(F.lit(" "), F.replace("text", F.lit(MARK), F.lit(" "))))
    return view.select("doc_id", marked.alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 of the decimal ids joined by one blank, decoded_sha256."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
