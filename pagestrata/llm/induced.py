"""Suffix order with common prefixes by external induced sorting.

The leftmost S-type (LMS) suffixes are sorted first, by naming their substrings
and recursing on the string of names; from them the L-type suffixes are induced
in one ascending scan and the S-type suffixes in one descending scan. Each
scan is a priority queue of suffix tuples (first symbol, order of arrival,
place, common prefix with the tuple before). A common prefix is induced with
its tuple: one more than the smallest one seen since the last tuple that went
to the same symbol. Common prefixes are cut off at `cap`.

Over bytes the queue is 257 first-in first-out buckets of numpy arrays, over
names a heap; both move to files in `workdir` beyond their memory bound, so the
text is the only thing that has to fit.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from bisect import bisect_right

import numpy as np

NEVER = 255  # no tuple yet since the last one that went to this symbol


class DiskBuckets:
    """One queue of (places, common prefixes) for each symbol, in files when over `most` tuples are held."""

    def __init__(self, sigma: int, workdir: str, most: int):
        self.held: list[list] = [[] for _ in range(sigma)]
        self.files: list[list] = [[] for _ in range(sigma)]
        self.workdir, self.most, self.n = workdir, most, 0

    def push(self, c: int, places: np.ndarray, common: np.ndarray) -> None:
        self.held[c].append((places, common))
        self.n += len(places)
        if self.n > self.most:
            self._spill()

    def _spill(self) -> None:
        for c, parts in enumerate(self.held):
            if parts:
                fd, name = tempfile.mkstemp(dir=self.workdir)
                os.close(fd)
                np.savez(name + ".npz", p=np.concatenate([p for p, _ in parts]), v=np.concatenate([v for _, v in parts]))
                os.unlink(name)
                self.files[c].append(name + ".npz")
                parts.clear()
        self.n = 0

    def pop(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for name in self.files[c]:
            with np.load(name) as z:
                parts.append((z["p"], z["v"]))
            os.unlink(name)
        self.files[c] = []
        self.n -= sum(len(p) for p, _ in self.held[c])
        parts += self.held[c]
        self.held[c] = []
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([p for p, _ in parts]), np.concatenate([v for _, v in parts])


class DiskHeap:
    """Tuples (order key, place, common) out in ascending order of key, first in first out among equals.

    A heap holds the keys, each with its own queue; the queues of the larger
    half of the keys go to files when over `most` tuples are held.
    """

    def __init__(self, workdir: str, most: int):
        self.keys: list[int] = []
        self.queues: dict[int, list] = {}
        self.files: dict[int, list[str]] = {}
        self.workdir, self.most, self.n = workdir, most, 0

    def push(self, key: int, place: int, common: int) -> None:
        q = self.queues.get(key)
        if q is None:
            self.queues[key] = [(place, common)]
            heapq.heappush(self.keys, key)
        else:
            q.append((place, common))
        self.n += 1
        if self.n > self.most:
            self._spill()

    def _spill(self) -> None:
        order = sorted(k for k, q in self.queues.items() if q)
        for key in order[len(order) // 2 :] if len(order) > 1 else ():
            q = self.queues[key]
            fd, name = tempfile.mkstemp(dir=self.workdir, suffix=".npy")
            os.close(fd)
            np.save(name, np.array(q, dtype=np.int64))
            self.files.setdefault(key, []).append(name)
            self.n -= len(q)
            q.clear()
        self.most = max(self.most, 2 * self.n)

    def take(self, key: int) -> list[tuple[int, int]]:
        """All tuples of a key so far."""
        out: list[tuple[int, int]] = []
        for name in self.files.pop(key, ()):
            out += map(tuple, np.load(name).tolist())
            os.unlink(name)
        q = self.queues[key]
        self.n -= len(q)
        out += q
        self.queues[key] = []
        return out

    def done(self, key: int) -> None:
        heapq.heappop(self.keys)
        del self.queues[key]


def types(s: np.ndarray) -> np.ndarray:
    """True for S-type suffixes. The end of the text is smaller than every symbol."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(np.diff(s.astype(np.int64)))
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return step[at] > 0


def compare(s: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int, known: np.ndarray | None = None) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, cut off at cap; known: symbols already known to agree."""
    n = len(s)
    out = np.zeros(len(a), np.int64) if known is None else np.minimum(known, cap)
    going = np.flatnonzero((out < cap) & (a + out < n) & (b + out < n))
    while len(going):
        going = going[s[a[going] + out[going]] == s[b[going] + out[going]]]
        out[going] += 1
        going = going[(out[going] < cap) & (a[going] + out[going] < n) & (b[going] + out[going] < n)]
    return out


class _Common:
    """Common prefixes of the tuples that a scan sends to each symbol, from those of the tuples it visits."""

    def __init__(self, sigma: int, cap: int):
        self.since = np.full(sigma, NEVER, np.uint8)
        self.sent = np.zeros(sigma, bool)
        self.cap = cap

    def send(self, v: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """v: of the visited tuples; at: which of them send, ascending; to: their symbols. Order by symbol, and common prefixes in that order."""
        order = np.argsort(to, kind="stable")
        at, to = at[order], to[order]
        first = np.ones(len(to), bool)
        first[1:] = to[1:] != to[:-1]
        lo = np.empty(len(at), np.int64)
        lo[1:] = at[:-1] + 1
        lo[first] = 0
        least = _range_min(v, lo, at)
        symbols = to[first]
        least[first] = np.minimum(least[first], self.since[symbols])
        out = np.minimum(least.astype(np.int64) + 1, self.cap).astype(np.uint8)
        fresh = first & ~self.sent[to]
        out[fresh] = 0
        self.sent[symbols] = True
        self.since = np.minimum(self.since, v.min())
        last = np.ones(len(to), bool)
        last[:-1] = first[1:]
        tail = np.minimum.accumulate(np.append(v, NEVER)[::-1])[::-1]
        self.since[symbols] = tail[at[last] + 1]
        return order, out

    def skip(self, v: np.ndarray) -> None:
        self.since = np.minimum(self.since, v.min())


def _range_min(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(v[lo:hi + 1]) for each pair, by a sparse table."""
    width = hi - lo + 1
    level = np.zeros(len(width), np.int64)
    level[width > 1] = np.floor(np.log2(width[width > 1])).astype(np.int64)
    out = np.empty(len(lo), np.uint8)
    table = v
    for k in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k) + 1])
        table = np.minimum(table[: -(1 << k)], table[1 << k :]) if len(table) > 1 << k else table
    return out


def induce_bytes(s: np.ndarray, sigma: int, seeds: np.ndarray, seed_common: np.ndarray | None, cap: int, workdir: str, most: int):
    """All suffixes of a string of small symbols, from sorted LMS suffixes: places and common prefixes."""
    carry = seed_common is not None
    common = seed_common if carry else np.zeros(len(seeds), np.uint8)
    queue, track = DiskBuckets(sigma, workdir, most), _Common(sigma, cap)
    bounds = np.searchsorted(s[seeds], np.arange(sigma + 1))
    big: list[tuple] = []

    def scan(queue, track, places, v, keep):
        """Sends the predecessors of visited tuples on; keep tells by symbol which are of the scan's type."""
        at = np.flatnonzero(places > 0)
        to = s[places[at] - 1]
        ok = keep(to)
        at, to = at[ok], to[ok].astype(np.int64)
        if not len(at):
            if carry and len(v):
                track.skip(v)
            return
        if carry:
            order, out = track.send(v, at, to)
        else:
            order, out = np.argsort(to, kind="stable"), np.zeros(len(at), np.uint8)
        places, to = places[at[order]] - 1, to[order]
        cuts = np.flatnonzero(np.diff(to)) + 1
        for lo, hi in zip(np.concatenate([[0], cuts]), np.append(cuts, len(to))):
            queue.push(int(to[lo]), places[lo:hi], out[lo:hi])

    last = len(s) - 1
    queue.push(int(s[last]), np.array([last]), np.zeros(1, np.uint8))
    track.sent[s[last]] = True
    track.since[s[last]] = 0
    for c in range(sigma):
        parts = []
        while len((got := queue.pop(c))[0]):
            parts.append(got)
            scan(queue, track, *got, lambda to: to >= c)
        big.append((np.concatenate([p for p, _ in parts]), np.concatenate([v for _, v in parts])) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint8)))
        lo, hi = bounds[c], bounds[c + 1]
        if lo < hi:
            v = common[lo:hi].copy()
            v[0] = compare(s, big[c][0][-1:], seeds[lo : lo + 1], cap)[0] if carry and len(big[c][0]) else 0
            scan(queue, track, seeds[lo:hi], v, lambda to: to > c)

    queue, track = DiskBuckets(sigma, workdir, most), _Common(sigma, cap)
    done: list[tuple] = []
    for c in range(sigma - 1, -1, -1):
        parts = []
        while len((got := queue.pop(c))[0]):
            parts.append(got)
            scan(queue, track, *got, lambda to: to <= c)
        small, v = (np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])) if parts else (np.zeros(0, np.int64), np.zeros(0, np.uint8))
        large, w = big[c]
        seam = compare(s, large[-1:], small[-1:], cap)[0] if carry and len(large) and len(small) else 0
        if len(large):
            down = np.empty(len(w), np.uint8)
            down[0], down[1:] = seam, w[:0:-1]
            scan(queue, track, large[::-1], down, lambda to: to < c)
        up = np.empty(len(v), np.uint8)
        if len(v):
            up[0], up[1:] = seam, v[:0:-1]
        done.append((np.concatenate([large, small[::-1]]), np.concatenate([w, up])))
    done.reverse()
    return np.concatenate([p for p, _ in done]), np.concatenate([v for _, v in done])


class _Since:
    """Smallest of the values seen after a given moment."""

    def __init__(self):
        self.at, self.value, self.n = [], [], 0

    def see(self, v: int) -> None:
        while self.value and self.value[-1] >= v:
            self.value.pop()
            self.at.pop()
        self.value.append(v)
        self.at.append(self.n)
        self.n += 1

    def after(self, moment: int) -> int:
        return self.value[bisect_right(self.at, moment)]


def induce_names(s: list[int], seeds: list[int], seed_common: list[int], workdir: str, most: int):
    """As induce_bytes, over names: every suffix passes through a heap of tuples."""
    n = len(s)

    def lcp(a: int, b: int) -> int:
        k = 0
        while a + k < n and b + k < n and s[a + k] == s[b + k]:
            k += 1
        return k

    def scan(sign: int, given, equal_first: bool):
        """Visits the heap's tuples of a symbol, then the given ones of it. given: symbol to (places, commons), the first common None for a seam."""
        heap, since, sent, out = DiskHeap(workdir, most), _Since(), {}, []
        see, after, push = since.see, since.after, heap.push
        symbols = sorted(given, reverse=sign < 0)
        at = 0
        if sign > 0:
            push(s[-1], n - 1, 0)
            see(0)
            sent[s[-1]] = 0
        while heap.keys or at < len(symbols):
            key = heap.keys[0] if heap.keys else None
            nxt = sign * symbols[at] if at < len(symbols) else None
            c = sign * (key if nxt is None or (key is not None and key <= nxt) else nxt)
            last = -1
            if key == sign * c and key is not None:
                while got := heap.take(key):
                    for i, v in got:
                        out.append((c, i, v, True))
                        last = i
                        see(v)
                        if i and (d := s[i - 1]) * sign >= key:
                            w = after(sent[d]) + 1 if d in sent else 0
                            sent[d] = since.n - 1
                            push(sign * d, i - 1, w)
                heap.done(key)
            if nxt == sign * c and nxt is not None:
                at += 1
                for i, v in zip(*given[c]):
                    if v is None:
                        v = lcp(i, last) if last >= 0 else 0
                    if not equal_first:
                        out.append((c, i, v, False))
                    see(v)
                    if i and (d := s[i - 1]) * sign > sign * c:
                        w = after(sent[d]) + 1 if d in sent else 0
                        sent[d] = since.n - 1
                        push(sign * d, i - 1, w)
        return out

    first: dict[int, tuple[list, list]] = {}
    for i, v in zip(seeds, seed_common):
        places, commons = first.setdefault(s[i], ([], []))
        commons.append(v if places else None)
        places.append(i)
    large = scan(1, first, True)
    down: dict[int, tuple[list, list]] = {}
    for k in range(len(large) - 1, -1, -1):
        c, i, _, _ = large[k]
        places, commons = down.setdefault(c, ([], []))
        commons.append(large[k + 1][2] if places else None)
        places.append(i)
    out = scan(-1, down, False)
    places = [i for _, i, _, _ in out][::-1]
    common = [0, *[v for _, _, v, _ in out][:0:-1]]
    return places, common


def name_by_scan(s: np.ndarray, lms: np.ndarray, induce) -> tuple[np.ndarray, np.ndarray]:
    """Names of the LMS substrings, equal for equal ones, in their order: by inducing from unsorted LMS suffixes."""
    n = len(s)
    rough, _ = induce(lms[np.argsort(s[lms], kind="stable")], None)
    of = np.full(n, -1, np.int64)
    of[lms] = np.arange(len(lms))
    order = of[rough]
    order = order[order >= 0]
    ends = np.append(lms[1:], n - 1)
    a, b = lms[order[:-1]], lms[order[1:]]
    la, lb = ends[order[:-1]] - a, ends[order[1:]] - b
    last = len(lms) - 1  # its substring ends with the text, like no other
    same = (la == lb) & (order[:-1] != last) & (order[1:] != last)
    depth = 0
    going = np.flatnonzero(same)
    while len(going):
        diff = s[a[going] + depth] != s[b[going] + depth]
        same[going[diff]] = False
        going = going[~diff]
        depth += 1
        going = going[depth <= la[going]]
    name = np.empty(len(lms), np.int64)
    name[order] = np.concatenate([[0], np.cumsum(~same)])
    return name, order


def name_by_sort(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same over names: the substrings' tuples (symbol, type) are sorted as they are, few of them being long."""
    raw = (2 * s + 2 + is_s).astype(">u4").tobytes()
    ends = np.append(lms[1:] + 1, len(s)) * 4
    keys = [raw[a:b] for a, b in zip((lms * 4).tolist(), ends.tolist())]
    keys[-1] += bytes(4)  # the end of the text
    order = sorted(range(len(keys)), key=keys.__getitem__)
    new = [0] + [int(keys[a] != keys[b]) for a, b in zip(order, order[1:])]
    name = np.empty(len(lms), np.int64)
    order = np.array(order, dtype=np.int64)
    name[order] = np.cumsum(new)
    return name, order


def suffix_order(s: np.ndarray, sigma: int, cap: int, workdir: str, most: int = 4 << 20, by_names: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of s in order, and the common prefix of each with the one before, cut off at cap (254 at most over bytes)."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    is_s = types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if by_names:
        listed = s.tolist()

    def induce(seeds, common):
        if by_names:
            p, v = induce_names(listed, seeds.tolist(), common.tolist(), workdir, most)
            return np.array(p, dtype=np.int64), np.array(v, dtype=np.int64)
        return induce_bytes(s, sigma, seeds, None if common is None else common.astype(np.uint8), cap, workdir, most)

    if len(lms) == 0:
        return induce(lms, np.zeros(0, np.int64))
    name, order = name_by_sort(s, is_s, lms) if by_names else name_by_scan(s, lms, induce)
    if int(name.max()) + 1 < len(lms):
        order, common_names = suffix_order(name, int(name.max()) + 1, 1 << 62, workdir, most, True)
    else:
        common_names = np.zeros(len(lms), np.int64)
    # Common names are common symbols; what follows them is compared.
    seeds = lms[order]
    known = np.zeros(len(seeds), np.int64)
    if len(seeds) > 1:
        prev = order[:-1]
        k = common_names[1:]
        known[1:] = np.append(lms, n)[prev + k] - lms[prev]
        common = np.concatenate([[0], compare(s, seeds[:-1], seeds[1:], cap, known[1:])])
    else:
        common = known
    return induce(seeds, common)


def repeated_starts(texts: list[np.ndarray], length: int, sigma: int = 256, workdir: str | None = None, most: int = 4 << 20) -> list[np.ndarray]:
    """For each text (symbols below sigma, or bytes), the starts of its runs of `length` symbols (254 at most) that also start anywhere else in the texts."""
    arrays = [np.frombuffer(t, np.uint8) if isinstance(t, bytes) else t for t in texts]
    sizes = np.array([len(t) for t in arrays], dtype=np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    s = np.zeros(int((sizes + 1).sum()), np.int32)
    for t, at in zip(arrays, first):
        s[at : at + len(t)] = t
        s[at : at + len(t)] += 1
    with tempfile.TemporaryDirectory(dir=workdir) as scratch:  # dies with the task, which starts again from its input
        places, common = suffix_order(s, sigma + 1, min(length, 254), scratch, most)
    mark = np.zeros(len(s) + 1, bool)
    near = np.flatnonzero(common >= length)
    mark[places[near]] = mark[places[near - 1]] = True
    return [np.flatnonzero(mark[at : at + max(n - length + 1, 0)]) for at, n in zip(first, sizes)]
