"""The two public tokenizers, applied once to each distinct run of text in a worker.

A text is cut where no pre-token of the vocabulary can span the cut: between
words for the vocabulary that drops white space, before a run of ASCII white
space for the byte-level one. The library's ids of the pieces, joined, are then
its ids of the whole text. Equal pieces are found by keys in numpy and then
compared byte for byte, so a value is never taken from another piece; the
library sees a piece once while a worker's bounded memo holds it. Texts with
white space outside ASCII go to the byte-level vocabulary whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from .common import BASES, mix, slices, words_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: UTF-8 of the white space outside ASCII.
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
WIDE_HEADS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")


STOP, ALNUM = np.zeros(256, bool), np.zeros(256, bool)
STOP[list(b".,;:!?")] = True
ALNUM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


def load(name: str, path: str | None = None):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path or public_tokenizers.path(name))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def gather(arena: np.ndarray, offs: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs arena[off:off + len], joined."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return arena[np.repeat(offs - (ends - lens), lens) + np.arange(total)]


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, a place of each, and for each place the index of its value."""
    order = np.argsort(h)
    h = h[order]
    new = np.empty(len(h), bool)
    new[:1], new[1:] = True, h[1:] != h[:-1]
    inverse = np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return h[new], order[new], inverse


#: Pieces up to SHORT bytes are their own key; longer ones are hashed and then compared; above LONG they have no key at all.
SHORT, LONG = 7, 256
TOP = np.uint64(56)
_SALTS = mix(np.arange(1, 2 + LONG // 8, dtype=np.uint64) * np.uint64(BASES[0]))


class Keys:
    """A 64-bit key of each piece data[start:end], its length in bytes on top.

    Up to SHORT bytes the key holds the piece itself. The other pieces up to LONG bytes
    are read in words of eight bytes (the last one ends with the piece), hashed, and
    kept here so that equal keys can be checked: `words` with `at` and `n` a piece. A
    piece above LONG bytes has its place in the slice as key and equals no other.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        lens = ends - starts
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
        low = np.minimum(lens, SHORT).astype(np.uint64)
        self.keys = (eight[starts] & ((np.uint64(1) << (low << np.uint64(3))) - np.uint64(1))) | (low << TOP)
        self.n = np.where((lens > SHORT) & (lens <= LONG), -(-lens // 8), 0)
        self.at = np.cumsum(self.n) - self.n
        mid = np.flatnonzero(self.n)
        self.words = np.zeros(0, np.uint64)
        if len(mid):
            n = self.n[mid]
            j = np.arange(int(n.sum())) - np.repeat(self.at[mid], n)
            self.words = eight[np.minimum(np.repeat(starts[mid], n) + 8 * j, np.repeat(ends[mid] - 8, n))]
            h = mix(np.add.reduceat(mix(self.words ^ _SALTS[j]), self.at[mid]) + lens[mid].astype(np.uint64))
            self.keys[mid] = (h >> np.uint64(8)) | np.uint64(0xFE << 56)
        self.big = np.flatnonzero(lens > LONG)
        self.keys[self.big] = self.big.astype(np.uint64) | np.uint64(0xFF << 56)
        self.lens = lens

    def same(self, one: np.ndarray, other: np.ndarray) -> bool:
        """Whether the pieces at `one` are those at `other`, given that their keys agree."""
        check = np.flatnonzero((self.n[one] > 0) & (one != other))
        one, other = one[check], other[check]
        return bool((self.lens[one] == self.lens[other]).all()) and bool((gather(self.words, self.at[one], self.n[one]) == gather(self.words, self.at[other], self.n[other])).all())


class PieceMemo:
    """Values of pieces by key, each a run in an arena, and the words of those that only have a hash for key. At most `most` pieces plus those of one slice."""

    def __init__(self, most: int):
        self.most, self.turn = most, 0
        self.keys = np.zeros(0, np.uint64)
        self.used = np.zeros(0, np.int32)
        self.offs = self.lens = self.at = self.n = self.bytes = np.zeros(0, np.int64)
        self.arena = np.zeros(0, np.uint32)
        self.words = np.zeros(0, np.uint64)

    def find(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, u)
        at[at == len(self.keys)] = 0
        return at, (self.keys[at] == u if len(self.keys) else np.zeros(len(u), bool))

    def same(self, at: np.ndarray, keys: Keys, one: np.ndarray) -> bool:
        """Whether the entries at `at` are the pieces `one` of a slice, given that their keys agree."""
        check = np.flatnonzero(keys.n[one] > 0)
        at, one = at[check], one[check]
        return bool((self.bytes[at] == keys.lens[one]).all()) and bool((gather(self.words, self.at[at], self.n[at]) == gather(keys.words, keys.at[one], keys.n[one])).all())

    def add(self, u: np.ndarray, keys: Keys, one: np.ndarray, lens: np.ndarray, values: np.ndarray) -> None:
        """New pieces, in order of their keys."""
        n = keys.n[one]
        fresh = {"keys": u, "used": np.full(len(u), self.turn, np.int32), "offs": len(self.arena) + np.cumsum(lens) - lens, "lens": lens, "at": len(self.words) + np.cumsum(n) - n, "n": n, "bytes": keys.lens[one]}
        self.arena = np.concatenate([self.arena, values])
        self.words = np.concatenate([self.words, gather(keys.words, keys.at[one], n)])
        at = np.searchsorted(self.keys, u)
        for name, new in fresh.items():
            setattr(self, name, np.insert(getattr(self, name), at, new))

    def shrink(self) -> None:
        """Beyond `most` entries the half stays that was used last, and places in the slice are forgotten."""
        self.turn += 1
        if len(self.keys) <= self.most:
            return
        bar = np.partition(self.used, len(self.used) // 2)[len(self.used) // 2]
        stay = np.flatnonzero((self.used > bar) | ((self.used == bar) & (bar == self.turn - 1)))
        self.arena, self.words = gather(self.arena, self.offs[stay], self.lens[stay]), gather(self.words, self.at[stay], self.n[stay])
        for name in ("keys", "used", "lens", "n", "bytes"):
            setattr(self, name, getattr(self, name)[stay])
        self.offs, self.at = np.cumsum(self.lens) - self.lens, np.cumsum(self.n) - self.n


class PieceEncoder:
    """Ids of whole texts, as the library gives them."""

    def __init__(self, name: str, path: str | None = None, memo: int = 1_500_000):
        self.tokenizer = load(name, path)
        self.by_word = name.startswith("word_")
        self.memo = PieceMemo(memo)

    def encode_column(self, column: pa.Array):
        """For runs of rows: first row, end row, ids of all their texts, ids in each text."""
        for lo, hi, data, offs in slices(column, 2 << 20):
            raw = data.tobytes()
            if not self.by_word and any(w in raw for w in WIDE_HEADS) and WIDE_SPACE.search(raw):
                for k in range(lo, hi):
                    one = raw[offs[k - lo] : offs[k - lo + 1]]
                    if WIDE_SPACE.search(one):
                        ids = np.array(self.tokenizer.encode(one.decode("utf-8"), add_special_tokens=False).ids, dtype=np.uint32)
                        yield k, k + 1, ids, np.array([len(ids)])
                    else:
                        yield (k, k + 1, *self._encode(np.frombuffer(one, np.uint8), one, np.array([0, len(one)])))
            else:
                yield (lo, hi, *self._encode(data, raw, offs))

    def _pieces(self, data: np.ndarray, offs: np.ndarray):
        starts, ends, first = words_of(data, offs)
        edge = np.zeros(len(data) + 1, bool)
        edge[1:-1] = STOP[data[1:]] & ALNUM[data[:-1]]  # no pre-token spans a letter or digit and a stop
        edge[offs] = False
        if self.by_word:
            cut = np.flatnonzero(edge)
            starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
            return starts, ends, np.searchsorted(starts, offs)
        edge[ends] = edge[offs] = True
        edge[0] = False
        cuts = np.flatnonzero(edge)  # each piece reaches from the end of the last one
        return np.concatenate([[0], cuts[:-1]]) if len(cuts) else cuts, cuts, np.searchsorted(cuts, offs, side="right")

    def _encode(self, data: np.ndarray, raw: bytes, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, first = self._pieces(data, offs)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        keys = Keys(data, starts, ends)
        u, one, inverse = distinct(keys.keys)
        small = keys.lens[one] <= LONG
        at, known = self.memo.find(u)
        known &= small
        if not (keys.same(np.arange(len(starts)), one[inverse]) and self.memo.same(at[known], keys, one[known])):
            made = self.measure([raw[s:e].decode("utf-8", "surrogatepass") for s, e in zip(offs[:-1].tolist(), offs[1:].tolist())])  # two pieces of one key: whole texts
            return np.fromiter(chain.from_iterable(made), dtype=np.uint32), np.fromiter(map(len, made), dtype=np.int64, count=len(made))
        self.memo.used[at[known]] = self.memo.turn
        new = np.flatnonzero(~known)
        lens, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for k in range(0, len(new), 20_000):
            where = one[new[k : k + 20_000]]
            made = self.measure([raw[s:e].decode("utf-8", "surrogatepass") for s, e in zip(starts[where].tolist(), ends[where].tolist())])
            lens.append(np.fromiter(map(len, made), dtype=np.int64, count=len(made)))
            values.append(np.fromiter(chain.from_iterable(made), dtype=np.uint32, count=int(lens[-1].sum())))
        lens, values = np.concatenate(lens), np.concatenate(values)
        # Values of the slice's distinct pieces: from the memo, and the new ones behind them.
        per, offs_ = np.empty(len(u), np.int64), np.empty(len(u), np.int64)
        per[known], per[new] = self.memo.lens[at[known]], lens
        offs_[known], offs_[new] = self.memo.offs[at[known]], len(self.memo.arena) + np.cumsum(lens) - lens
        n = per[inverse]
        ids = gather(np.concatenate([self.memo.arena, values]), offs_[inverse], n)
        upto = np.concatenate([[0], np.cumsum(n)])
        keep = small[new]
        self.memo.add(u[new][keep], keys, one[new][keep], lens[keep], values[np.repeat(keep, lens)])
        self.memo.shrink()
        return ids, np.diff(upto[first])

    def measure(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(name: str, path: str | None = None, kind: type = PieceEncoder) -> PieceEncoder:
    """One per worker process."""
    if (name, path, kind) not in _ENCODERS:
        _ENCODERS[name, path, kind] = kind(name, path)
    return _ENCODERS[name, path, kind]
