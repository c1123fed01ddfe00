"""Each operator against a brute-force version on a corpus of odd rows, and on empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagestrata.llm import op1_pii, op2_suffixes, op3_lines, op4_rans, op5_counts, op6_decontaminate, op7_quality, op8_neardup, op9_packing, op10_blocks, tokens
from pagestrata.llm.common import span_hashes
from pagestrata.llm.induced import suffix_order
from pagestrata.llm.tokens import load

from .fixture import SCHEMA, corpus


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1]) for r in corpus()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(values):
    return Counter(map(repr, values))


def covered(n, starts, length):
    out = [False] * n
    for s in starts:
        out[s : s + length] = [True] * length
    return out


def test_pii(docs, rows, none, spark):
    patterns = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]

    def luhn(d):
        return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0

    def base(t):
        out = []
        for k, (name, p) in enumerate(patterns):
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m[0])
                ok = {"email": True, "ip": name != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[name]
                out += [(m.start(), k, m.end())] if ok else []
        return ",".join(f"{patterns[k][0]}:{a}:{b}" for a, k, b in sorted(out))

    extra = [(900, "é a.b@c.d-e.fg, 1.2.3.4 and 999.1.1.1"), (901, "4111 1111 1111 1111 and 4111-1111-1111-1112"), (902, "+1 (555) 123-4567. +12"), (903, "a@b.cx_y@z.w"), (904, "x" * 20000 + "@y." + "1" * 20000), (905, "a@b" + ".c" * 5000)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = op1_pii.digest(op1_pii.find_pii(df)).collect()
    want = multiset((d, hashlib.sha256(base(t or "").encode()).hexdigest()) for d, t in rows + extra)
    assert multiset((r.doc_id, r.base_sha256) for r in got) == want
    assert op1_pii.digest(op1_pii.find_pii(none)).count() == 0


def test_pii_disclosing_terms(spark):
    told = [(i, f"Notes {w} about Kowalczyk and mail kow.al@x.example.com sent {z} today") for i, (w, z) in enumerate([("alpha", "early"), ("bravo", "later"), ("delta", "quick"), ("gamma", "never")])]
    rest = [(100 + i, f"Some other notes about weather and mail number {i} sent today") for i in range(60)]
    found = op1_pii.find_pii(spark.createDataFrame(told + rest, "doc_id long, text string"))
    terms = {(r.doc_id, s.value) for r in found.collect() for s in r.spans if s.kind == 4}
    assert terms == {(i, "Kowalczyk") for i in range(4)}
    clean = {r.doc_id: r.clean_text for r in op1_pii.sanitise(found).collect()}
    assert clean[0] == "Notes alpha about  and mail <email> sent early today" and clean[100] == rest[0][1]


def told_terms(spark, told, rest=()):
    rows = list(enumerate(told)) + [(1000 + i, t) for i, t in enumerate(rest or [f"Some other notes about weather and mail number {i} sent today" for i in range(60)])]
    return {(r.doc_id, s.value) for r in op1_pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect() for s in r.spans if s.kind == 4}


def test_pii_terms_at_the_edges(spark):
    words = ("alpha", "bravo", "delta", "gamma")
    assert told_terms(spark, [f"Kowalczyk: kow.al@x.example.com sent {w} notes" for w in words]) == {(i, "Kowalczyk") for i in range(4)}
    assert told_terms(spark, [f"Some {w} notes, +49 30 1234567 Kowalczyk" for w in words]) == {(i, "Kowalczyk") for i in range(4)}
    # A word that the window cuts isn't near, a whole one at its edge is.
    for gap, cut in ((70, False), (71, False), (72, True)):
        before = [f"So Kowalczyk{'.' * (gap - 7)} {w} +49 30 1234567" for w in words]
        after = [f"+49 30 1234567 {w} {'.' * (gap - 7)}Kowalczyk so" for w in words]
        for texts in (before, after):
            assert told_terms(spark, texts) == (set() if cut else {(i, "Kowalczyk") for i in range(4)})


def test_pii_terms_of_any_length_and_with_digits(spark):
    for term in ("Kim", "Æ", "7", "id4711x", "re\u0301ne\u0301", "l" * 70):
        got = told_terms(spark, [f"Mail {w} and other number {term} mail kow.al@x.example.com sent {w} today" for w in ("alpha", "bravo", "delta", "gamma")], [f"Some other notes about weather and mail number {'n' * (i + 1)} sent today" for i in range(60)])
        assert got == {(i, term) for i in range(4)}


def test_pii_terms_of_a_shared_passage(spark):
    passage = f"{'-' * 80} Kowalczyk +49 30 1234567 {'-' * 90}"
    assert told_terms(spark, [f"The {w} text {passage} ends {w}" for w in ("alpha", "bravo", "delta", "gamma")]) == {(i, "Kowalczyk") for i in range(4)}
    assert told_terms(spark, [f"One text {passage} ends"] * 4) == set()


def test_suffix_order():
    rng = np.random.default_rng(3)
    for _ in range(60):
        s = rng.integers(0, rng.integers(1, 5), rng.integers(1, 50)).astype(np.int16)
        order = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        for names in (False, True):
            places, common = suffix_order(s, 5, 200 if not names else 1 << 62, "/tmp", int(rng.integers(2, 40)), names)
            assert places.tolist() == order
            for k in range(1, len(order)):
                a, b = s[order[k - 1] :], s[order[k] :]
                n = min(len(a), len(b))
                same = np.append(a[:n] == b[:n], False)
                assert common[k] == int(np.argmin(same))


@pytest.mark.parametrize("span", [8, 32])
def test_substring_suffixes(docs, rows, none, span):
    raw = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    want = []
    for d, b in raw:
        gone = covered(len(b), [i for i in range(len(b) - 199) if count[b[i : i + 200]] > 1], 200)
        want.append((d, len(b), sum(gone), bytes(x for x, g in zip(b, gone) if not g)))
    got = op2_suffixes.repeated_bytes(docs, span=span, shard_symbols=20_000).collect()
    assert multiset((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == multiset(want)
    assert op2_suffixes.repeated_bytes(none).count() == 0


def test_substring_blocks(docs, rows, none):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    count = Counter(tuple(w[i : i + 35]) for _, w in words for i in range(len(w) - 34))
    want = []
    for d, w in words:
        gone = covered(len(w), [i for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1], 35)
        want.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    got = op10_blocks.repeated_words(docs).collect()
    assert multiset((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == multiset(want)
    assert op10_blocks.repeated_words(none).count() == 0


def dedup_lines(rows, min_docs=2):
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(str.maketrans(op3_lines.UPPER, op3_lines.LOWER))
    held = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                held[key(x)].add((d is None, d or 0))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(held[key(x)]) >= min_docs and min(held[key(x)]) != (d is None, d or 0))]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup(docs, rows, none, min_docs):
    got = op3_lines.dedup_lines(docs, min_docs=min_docs).collect()
    assert multiset((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got) == multiset(dedup_lines(rows, min_docs))
    assert op3_lines.dedup_lines(none).count() == 0


@pytest.fixture(scope="module")
def word_ids(rows):
    t = load("word_bpe_49k.json")
    return [(d, t.encode(x or "", add_special_tokens=False).ids) for d, x in rows]


SPECIAL = ["<|endoftext|> x<|startoftext|>", "a\x1c b\x85\xa0  c　d", "ΣΑΣ Σ'S I'LL 'Ll", "!?!!...!! a.b.c", "\U0001f600‍\U0001f600 é", "aaaa" * 300]


def test_token_counts(docs, rows, none, word_ids, spark):
    got = op5_counts.token_counts(docs).collect()
    assert multiset((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == multiset((d, len((x or "").encode()), len(i), len(i) > 2048) for (d, x), (_, i) in zip(rows, word_ids))
    t = load("word_bpe_49k.json")
    odd = {r.doc_id: r.n_tokens for r in op5_counts.token_counts(spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")).collect()}
    assert odd == {k: len(t.encode(x, add_special_tokens=False).ids) for k, x in enumerate(SPECIAL)}
    assert op5_counts.token_counts(none).count() == 0


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


def test_equal_keys_are_compared(spark, monkeypatch):
    """Pieces that a hash modulo 2 ** 64 can't tell apart, and a hash that tells none apart."""
    flip = str.maketrans("ab", "ba")
    texts = [t for n in (64, 128, 256, 1024, 4096) for t in (thue_morse(n), thue_morse(n).translate(flip))] + ["abcdefghij abcdefghik abcdefghij", "abcdefghik " * 50, "short sh short", "", "x" * 300 + " " + "x" * 300]
    column = pa.array(texts * 2)
    for poor in (False, True):
        if poor:
            monkeypatch.setattr(tokens, "mix", lambda x: x & np.uint64(0))
        for name, kind in (("word_bpe_49k.json", tokens.PieceEncoder), ("byte_bpe_50k.json", tokens.PieceEncoder), ("word_bpe_49k.json", op5_counts.MergeCounter)):
            enc, library = kind(name, memo=20), load(name)
            for turn in (column.slice(0, 9), column, column.slice(5, 10)):
                got = [x for _, _, ids, n in enc.encode_column(turn) for x in np.split(ids, np.cumsum(n)[:-1])]
                want = [library.encode(t, add_special_tokens=False).ids for t in turn.to_pylist()]
                assert [int(g.sum()) for g in got] == [len(w) for w in want] if kind is op5_counts.MergeCounter else [g.tolist() for g in got] == want


def test_token_files(docs, none, word_ids):
    start, want = 0, []
    for d, ids in sorted(((d, i + [2]) for d, i in word_ids), key=lambda x: (x[0] is not None, x[0] or 0)):
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = op4_rans.round_trip(docs, frame_ids=3000, block_ids=700).orderBy("start").collect()
    assert multiset((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == multiset(want)
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id for r in got] == [d for d, _, _ in want]
    assert op4_rans.round_trip(none).count() == 0


def test_rans_blocks_and_checkpoints():
    rng = np.random.default_rng(5)
    for ids in (rng.zipf(1.3, 300_000) % 49408, np.full(70_000, 7), np.arange(49408), np.array([3])):
        writer = op4_rans.FrameWriter(1 << 30, 90_000)
        half = len(ids) // 2
        writer.add(1, ids[:half].astype(np.uint32)) if half else None
        writer.add(None, ids[half:].astype(np.uint32))
        frame = op4_rans.Frame(writer.close()[3])
        assert np.concatenate([frame.block(k) for k in range(len(frame.blocks))]).tolist() == ids.tolist()
        for k in range(len(frame.blocks)):
            assert np.concatenate([frame.part(k, p) for p in frame.parts(k)]).tolist() == frame.block(k).tolist()
        assert frame.docs[-1] is None


def test_rans_damage_is_noticed():
    writer = op4_rans.FrameWriter()
    writer.add(1, np.arange(5000, dtype=np.uint32))
    raw = bytearray(writer.close()[3])
    raw[-20] ^= 1
    with pytest.raises((ValueError, zlib.error, struct.error, IndexError)):
        op4_rans.Frame(bytes(raw)).block(0)


def words6(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(str.maketrans(op3_lines.UPPER, op3_lines.LOWER)))


def test_decontamination(docs, rows, none, spark):
    texts = [t for _, t in rows if t and len(t.split()) > 60]
    items = [("a", " ".join(texts[0].split()[5:25]).upper()), ("b", "not, in: any text at all really nothing here of it"), ("c", "a b c d"), ("d", ""), ("e", None), (None, " ".join(texts[1].split()[:12])), ("a2", " ".join(texts[0].split()[10:22]))]
    bench = spark.createDataFrame(items, "item_id string, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = words6(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    want = []
    for d, t in rows:
        w, ids, hit = words6(t), set(), [False] * len(words6(t))
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit[k : k + n] = [True] * n
                    ids |= windows[x]
        ids.discard(None)
        want.append((d, len(w), sum(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), any(hit)))
    assert any(w[5] for w in want)
    found = op6_decontaminate.decontaminate(docs, bench)
    assert multiset(tuple(r) for r in op6_decontaminate.digest(found).collect()) == multiset(want)
    assert op6_decontaminate.digest(op6_decontaminate.decontaminate(none, bench)).count() == 0
    assert op6_decontaminate.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    for small in (300, 1):  # items in several blocks
        assert multiset(tuple(r) for r in op6_decontaminate.digest(op6_decontaminate.decontaminate(docs, bench, block_bytes=small)).collect()) == multiset(want)
    clean = multiset(d for d, *_, hit in want if not hit)
    assert multiset(r.doc_id for r in op6_decontaminate.clean_documents(docs, bench).collect()) == clean
    assert multiset(r.doc_id for r in op6_decontaminate.clean_documents(docs, bench, block_bytes=300).collect()) == clean
    by_id = {d: t for d, t in rows if d is not None and d > 20}
    for r in found.where("n_hit > 0 and doc_id > 20").collect():
        assert sum(len(words6(by_id[r.doc_id][s.start : s.end])) for s in r.spans) == r.n_hit


def stats7(t):
    w = re.findall("[^\x20\x09-\x0d]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = covered(len(w), [i for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1], 3)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), sum(rep)


def test_quality_statistics(docs, rows, none, spark):
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 1)], "doc_id long, quality int")
    got = op7_quality.quality_rules(docs, labels).collect()
    want = []
    for d, t in rows:
        s = stats7(t)
        bad = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want.append((d, *s, bad, not bad))
    assert multiset((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == multiset(want)
    assert op7_quality.quality_rules(none, labels.limit(0)).count() == 0


def test_quality_forest_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    known = labels.where("doc_id % 2 = 0")
    got = op7_quality.quality_rules(docs, known).where("not base_failed").join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad) and bad


def test_quality_forest_sees_combinations():
    """Rows that stay within what single rows reach in each statistic, but are off in several at once, have shorter paths; splits choose among all statistics."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    good = np.ones(3000, bool)
    x[:60, 0] += 9
    good[:60] = False
    rules, forest, cut = op7_quality.fitted(x, good, np.arange(3000) % 2 == 1, 256, 0.999, 0.001, 0.02)
    assert {int(f) for tree in forest.grown for f, v in zip(tree[0], tree[1]) if v < np.inf} == {0, 1, 2, 3}
    alone, together = rules.high + 0.5 * np.eye(4), rules.high + 0.5
    paths = forest.paths(rules(np.vstack([alone, [together], [x[100] * 0]])))
    assert paths[4] < paths[:4].min() and paths[:5].max() < paths[5]
    fresh = rng.normal(size=(2000, 4))
    assert (op7_quality.margins((rules, forest, cut), fresh) >= 0).mean() > 0.98
    fresh[:, 0] += 9
    assert (op7_quality.margins((rules, forest, cut), fresh) < 0).mean() > 0.95


def test_quality_model_is_of_all_labelled_rows(spark):
    """Bounds, trees and threshold follow from every labelled row of their half; so labels in any order and number count."""
    rng = random.Random(4)
    values = [rng.choice([0.0, 0.0, rng.random(), rng.gauss(0, 1e6)]) for _ in range(3000)]
    df = spark.createDataFrame([(v, -v / 3) for v in values], "a double, b double").repartition(5)
    ranks = [0, 1, 700, 1500, 2998, 2999]
    got = op7_quality.order_statistics(df, [(F.col("a"), r) for r in ranks] + [(F.col("b"), r) for r in ranks], bins=7)
    assert got == [sorted(values)[r] for r in ranks] + [sorted(-v / 3 for v in values)[r] for r in ranks]

    words = lambda n: " ".join(f"w{k}" for k in range(n))
    texts = [(k, words(60 + k % 40)) for k in range(9000)]
    docs, labels = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(k, int(k % 100 > 0)) for k, _ in texts], "doc_id long, quality int")
    known = spark.createDataFrame([(k, [0.0]) for k, _ in texts], "doc_id long, features array<double>")
    by_hash = [r.doc_id for r in known.orderBy(F.xxhash64("doc_id")).collect()]
    assert {r.doc_id for r in op7_quality.alternating(known).where("held").collect()} == set(by_hash[1::2])
    grown = [k for k in by_hash[::2] if k % 100]
    assert len(grown) > 4096  # more than half of what the model was taken from before
    features = np.array([op7_quality.text_stats(dict(texts)[k])[5] for k in grown])
    rules, forest, _ = op7_quality.calibrate(docs, labels, trees=16)
    want = op7_quality.Rules(features, 0.999)
    assert (rules.low == want.low).all() and (rules.high == want.high).all() and np.allclose(rules.unit, want.unit, rtol=1e-9)
    rows = spark.createDataFrame([(k, [float(k)]) for k in range(9000)], "doc_id long, features array<double>")
    samples = op7_quality.drawn(rows, 9000, 40, 60, 7)
    assert all(len({x[0] for x in s}) == 60 for s in samples) and len({x[0] for s in samples for x in s}) > 1900  # each tree draws from all of them


def test_quality_paths_are_those_of_the_trees():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(200, 3)), 1)
    forest = op7_quality.IsolationForest(16, 32).fit(x, np.arange(200) > 10)
    for row, path in zip(x[:40], forest.paths(x[:40])):
        total = 0.0
        for feature, value, left, right, length, _ in forest.grown:
            k = 0
            while value[k] < np.inf:
                k = left[k] if row[feature[k]] <= value[k] else right[k]
            total += length[k]
        assert abs(total / 16 - path) < 1e-9


def labelled(t):
    w, seen, out = (t or "").encode().split(), Counter(), []
    for g in [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []:
        seen[g] += 1
        out.append((g, seen[g]))
    return out


def in_order(a, b):
    at, tails = {x: k for k, x in enumerate(b)}, []
    for p in (at[x] for x in a if x in at):
        k = bisect_left(tails, p)
        tails[k : k + 1] = [p]
    return len(tails) / (len(a) + len(b) - len(tails))


def classes(rows):
    by_text = defaultdict(list)
    for d, t in rows:
        by_text[t or ""].append(d)
    texts = [t for t in by_text if t.split()]
    grams, parent = [labelled(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if in_order(grams[i], grams[j]) >= 0.8:
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, t in enumerate(texts):
        members[root(i)] += by_text[t]
    named = {}
    for i, t in enumerate(texts):
        ids = [d for d in members[root(i)] if d is not None]
        named[t] = min(ids) if ids else None
    classes.count = len(members)
    return named


@pytest.mark.parametrize("block", [2, 128])
def test_near_duplicates(docs, rows, none, block):
    named = classes(rows)
    got = op8_neardup.near_duplicates(docs, block=block).collect()
    assert multiset(tuple(r) for r in got) == multiset((d, named[t or ""] if (t or "").split() else d) for d, t in rows)
    assert op8_neardup.near_duplicates(none).count() == 0
    kept = op8_neardup.one_of_each(docs, block=block).collect()
    wordy = [r.text for r in kept if (r.text or "").split()]
    assert len(wordy) == classes.count and len(kept) - len(wordy) == sum(not (t or "").split() for _, t in rows)


def test_near_groups_need_enough_in_common(spark):
    """Texts of two labels meet under a key if they are similar, and not for half of their words, however many texts of one label hold the rest."""
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    passage, lone = words("p", 200), words("q", 200)
    rows = [(x.encode() + bytes([k]), x.encode(), " ".join([f"own{k}", *words(x, 200), *(words(f"{x}{k}_", 200) if k else passage)])) for x in "AB" for k in range(5)]
    rows += [(b"C", b"C", " ".join(lone)), (b"D", b"D", " ".join([*lone[:90], "changed", *lone[91:]]))]
    crowd = spark.createDataFrame(rows, "fp binary, label binary, text string")
    groups = defaultdict(set)
    for r in op8_neardup.near_groups(crowd, 5, 0.8).collect():
        groups[r.key].add((bytes(r.fp), r.indexed))
    assert groups and {fp for g in groups.values() for fp, _ in g} == {b"C", b"D"}
    assert all(len({fp for fp, _ in g}) == 2 and {kind for _, kind in g} == {True, False} for g in groups.values())


def test_near_duplicates_of_a_whole_table(spark):
    """Classes of all documents of a table against all pairs that share one of their rarest k-mers, as any two of the similarity do."""
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text or "") for r in table.collect()]
    texts = sorted({t for _, t in rows if t.split()})
    grams = [labelled(t) for t in texts]
    held = Counter(x for g in grams for x in g)
    holders, links = defaultdict(list), set()
    for k, g in enumerate(grams):
        for x in sorted(g, key=lambda x: (held[x], x))[: len(g) - -(-4 * len(g) // 5) + 1]:  # others share at least four fifths of it
            if held[x] > 1:
                holders[x].append(k)
    for i, j in {(i, j) for ks in holders.values() for n, i in enumerate(ks) for j in ks[n + 1 :]}:
        if 0.8 * max(len(grams[i]), len(grams[j])) <= min(len(grams[i]), len(grams[j])) and in_order(grams[i], grams[j]) >= 0.8:
            links.add((i, j))
    got = {r.doc_id: r.class_id for r in op8_neardup.near_duplicates(table).collect()}
    of = {t: got[d] for d, t in rows}
    missed = [(texts[i], texts[j]) for i, j in links if of[texts[i]] != of[texts[j]]]
    assert len(links) >= 40 and not missed
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        parent[root(i)] = root(j)
    assert len({root(k) for k in range(len(texts))}) == len(set(of[t] for t in texts))


def test_banded_alignment():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.permutation(200)[: rng.integers(1, 150)].astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 12)))
        if rng.random() < 0.5 and len(b) > 3:
            k = rng.integers(0, len(b) - 1)
            b[[k, k + 1]] = b[[k + 1, k]]
        exact = in_order(a.tolist(), b.tolist()) if len(b) else 0.0
        assert op8_neardup.similarity(a, b, 0.8) == pytest.approx(exact if exact >= 0.8 else 0.0)


def test_packing(docs, rows, none):
    t = load("byte_bpe_50k.json")
    ids = sorted(((d, t.encode(x or "", add_special_tokens=False).ids + [0]) for d, x in rows), key=repr)
    got = op9_packing.pack(docs).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for d, i in ids:  # each document's ids are cut into some of its pieces
        starts = {}
        for r in pieces[d, len(i)]:
            if r.ids == i[r.start : r.start + r.length]:
                starts[r.start] = r.length
        at = 0
        while at < len(i):
            at += starts[at]
        assert at == len(i)
    assert sum(r.length for r in got) == sum(len(i) for _, i in ids)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert op9_packing.pack(none).count() == 0


def test_packing_wastes_little(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    used = op9_packing.pack(df, with_ids=False).groupBy("sequence_id").sum("length").collect()
    full = sum(r[1] if r[1] & (r[1] - 1) == 0 else 1024 for r in used)
    assert sum(r[1] for r in used) >= 0.98 * full


def test_line_dedup_carries_rows(docs, rows):
    got = op3_lines.dedup_lines(docs, carry=True).select("row.*").collect()
    assert Counter(map(repr, got)) == Counter(map(repr, docs.collect()))


def test_words_that_polynomials_confuse(spark):
    """A Thue-Morse word and its complement have one polynomial hash modulo 2 ** 64, whatever the base: windows around them are different all the same."""
    signs = [bin(k).count("1") % 2 for k in range(4096)]
    one, other = ("".join("ab"[b ^ flip] for b in signs) for flip in (0, 1))
    around = [f"w{k}" for k in range(34)]
    rows = [(k, " ".join([*around[:17], word, *around[17:]])) for k, word in enumerate((one, other))]
    got = op10_blocks.repeated_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_words, r.n_removed) for r in got} == {(0, 35, 0), (1, 35, 0)}
    same = op10_blocks.repeated_words(spark.createDataFrame([*rows, (2, rows[0][1] + " end")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_removed) for r in same} == {(0, 35), (1, 0), (2, 35)}
    raw = np.frombuffer((one + other + "x" * 9 + "y" * 8).encode(), np.uint8)
    ends = np.array([4096, 8192, 8201, 8209])
    hashes = [span_hashes(raw, np.array([0, 4096, 8192, 8201]), ends, seed) for seed in (0, 1)]
    assert len({int(h) for hs in hashes for h in hs}) == 8
    small = np.frombuffer(b"abcabc" + b"ab" * 9, np.uint8)
    a = span_hashes(small, np.array([0, 3, 6]), np.array([3, 6, 24]))
    assert a[0] == a[1] == span_hashes(small, np.array([0]), np.array([3]))[0] and a[2] == span_hashes(small[6:], np.array([0]), np.array([18]))[0]
