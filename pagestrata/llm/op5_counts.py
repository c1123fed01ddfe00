"""Token counts by rank-synchronous merging.

Pre-tokens of a batch are one ragged array of symbols. In each round every
sequence finds its lowest-ranked adjacent pair and all sequences merge theirs
at once; sequences without a pair that merges drop out, and the symbols that
survive are counted. The library gives the normaliser, the pre-tokens of text
outside ASCII, and the vocabulary; no merge is done by it.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from .common import doc_view
from .tokens import PieceEncoder, encoder

#: Pre-tokens of ASCII text, after lower-casing.
ASCII_PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
NONE = np.int64(1) << np.int64(40)


class MergeTable:
    """Ranks of pairs of symbol ids, and whether all places of a pair may merge in one round."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.suffix, self.vocab = suffix, vocab
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.size = max(vocab.values()) + 1
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order
        self.made = made
        lowest = np.full(self.size, len(pairs), dtype=np.int64)  # lowest rank of a pair with this symbol in it
        np.minimum.at(lowest, left, np.arange(len(pairs)))
        np.minimum.at(lowest, right, np.arange(len(pairs)))
        self.at_once = lowest[made] > np.arange(len(pairs))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def merged_lengths(symbols: np.ndarray, lens: np.ndarray, table: MergeTable) -> np.ndarray:
    """Symbols left of each sequence (all of length 1 or more) once no pair merges."""
    out = lens.copy()
    alive = np.flatnonzero(lens > 1)
    keep = np.repeat(lens > 1, lens)
    symbols, lens = symbols[keep], lens[lens > 1]
    while len(alive):
        starts = np.cumsum(lens) - lens
        seq = np.repeat(np.arange(len(lens)), lens)
        rank = np.full(len(symbols), NONE)
        rank[:-1] = np.where(seq[1:] == seq[:-1], table.rank(symbols[:-1], symbols[1:]), NONE)
        best = np.minimum.reduceat(rank, starts)
        hit = (rank == best[seq]) & (rank < NONE)
        # Overlapping places of a pair of one symbol: every second one, from the left.
        places = np.flatnonzero(hit)
        if len(places):
            run = np.ones(len(places), bool)
            run[1:] = places[1:] != places[:-1] + 1
            index = np.arange(len(places))
            odd = (index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 1
            # A pair after whose merge a lower rank may arise merges at its first place only.
            first = np.ones(len(places), bool)
            first[1:] = seq[places[1:]] != seq[places[:-1]]
            places = places[~odd & (first | table.at_once[best[seq[places]]])]
            symbols[places] = table.made[best[seq[places]]]
            stay = np.ones(len(symbols), bool)
            stay[places + 1] = False
            lens = lens - np.bincount(seq[places], minlength=len(lens))
            symbols, seq = symbols[stay], seq[stay]
        out[alive] = lens
        going = (best < NONE) & (lens > 1)
        symbols, alive, lens = symbols[going[seq]], alive[going], lens[going]
    return out


class MergeCounter(PieceEncoder):
    """Counts instead of ids: the memo holds one number for each piece."""

    def __init__(self, name: str, path: str | None = None, memo: int = 1_500_000):
        super().__init__(name, path, memo)
        spec = json.loads(self.tokenizer.to_str())
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.table = MergeTable(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.specials = re.compile("(" + "|".join(re.escape(t["content"]) for t in spec["added_tokens"]) + ")")

    def pre_tokens(self, piece: str) -> tuple[list[str], int]:
        """Pre-tokens in the vocabulary's letters, and special strings found."""
        if piece.isascii() and piece.isprintable() and "<|" not in piece:
            return ASCII_PRE.findall(piece.lower()), 0
        parts = self.specials.split(piece)
        out: list[str] = []
        for part in parts[::2]:
            if part:
                out += [t for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part))]
        return out, len(parts) // 2

    def measure(self, pieces: list[str]) -> list[tuple[int]]:
        found = [self.pre_tokens(p) for p in pieces]
        tokens = list(chain.from_iterable(t for t, _ in found))
        per_piece = np.fromiter((len(t) for t, _ in found), dtype=np.int64, count=len(found))
        total = np.fromiter((s for _, s in found), dtype=np.int64, count=len(found))
        if tokens:
            vocab, suffix = self.table.vocab, self.table.suffix
            lens = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
            symbols = np.fromiter(map(vocab.__getitem__, chain.from_iterable(tokens)), dtype=np.int64, count=int(lens.sum()))
            ends = np.cumsum(lens) - 1
            symbols[ends] = np.fromiter((vocab[t[-1] + suffix] for t in tokens), dtype=np.int64, count=len(tokens))
            counts = np.concatenate([[0], np.cumsum(merged_lengths(symbols, lens, self.table))])
            upto = np.concatenate([[0], np.cumsum(per_piece)])
            total += counts[upto[1:]] - counts[upto[:-1]]
        return [(n,) for n in total.tolist()]


def token_counts(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", path: str | None = None, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; one row per input row. A null or empty text has neither bytes nor tokens."""

    def run(batches):
        counter = encoder(tokenizer, path, MergeCounter)
        for batch in batches:
            n_tokens = np.zeros(batch.num_rows, np.int64)
            n_bytes = np.zeros(batch.num_rows, np.int64)
            for lo, hi, values, counts in counter.encode_column(batch.column(1)):
                upto = np.concatenate([[0], np.cumsum(values.astype(np.int64))])
                at = np.concatenate([[0], np.cumsum(counts)])
                n_tokens[lo:hi] = upto[at[1:]] - upto[at[:-1]]
            n_bytes[:] = pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return doc_view(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
