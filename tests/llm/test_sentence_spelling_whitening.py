"""Operators 11 to 13 against the library, all pairs of words, and numpy on a corpus of odd rows; empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagestrata.llm import op11_sentencepiece, op12_spelling, op13_whitening, queries
from pagestrata.llm.op11_sentencepiece import SentencePieces

from .fixture import SCHEMA, corpus

MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def pieces():
    return SentencePieces(MODEL)


def odd_texts(seed=5):
    rng = random.Random(seed)
    signs = list("abcdeThinto  \n\t.,;:-'\"<>/0123456789éüßñÆ漢字かな한글Ж🙂▁ 　​\x00\x7f") + ["the ", " of", "tion", "<s>", "</s>", "<unk>", "<0x41>", "  ", "▁▁", "\r\n", "é"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return [*texts, "", " ", "  ", "▁", " a", "a ", "x" * 3000, " " * 700, "é" * 500, "ab" * 1500, "".join(chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000)]


def test_pieces_as_the_library_has_them(spark, docs, none, pieces):
    rows = list(enumerate(odd_texts())) + [(None, "no id"), (7, None), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").union(docs.select("doc_id", "text"))
    rows += [(r[0], r[1]) for r in corpus()]
    lists = {t: pieces.library.encode(t, add_eos=True) for _, t in rows if t is not None} | {None: [pieces.end]}
    got = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in op11_sentencepiece.encode(df).collect())
    assert got == Counter((d, tuple(lists[t]), pieces.library.decode(lists[t])) for d, t in rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    told = Counter(map(tuple, op11_sentencepiece.digest(op11_sentencepiece.encode(df)).collect()))
    assert told == Counter((d, len(lists[t]), sha(" ".join(map(str, lists[t]))), sha(pieces.library.decode(lists[t]))) for d, t in rows)
    assert op11_sentencepiece.encode(none).count() == 0 and op11_sentencepiece.encode(docs).columns == ["doc_id", "ids", "decoded"]


def test_ids_of_any_kind_decode(pieces):
    rng = random.Random(2)
    size = pieces.library.get_piece_size()
    for _ in range(400):
        ids = [rng.choice((rng.randrange(size), rng.randrange(300), pieces.agenda.bytes[rng.randrange(256)])) for _ in range(rng.randint(0, 12))]
        assert pieces.decode(ids) == pieces.library.decode(ids)


def test_agenda_takes_the_best_score_then_the_leftmost(pieces):
    model = pieces.agenda
    for text in odd_texts(9)[:200]:
        if text:
            whole = " " + text.replace("▁", " ")
            parts = list(whole)
            while True:  # by its definition
                open_ = [(model.cost[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in model.cost]
                if not open_:
                    break
                _, i = min(open_)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert model.merge(whole) == [x for p in parts for x in ([model.ids[p]] if p in model.ids else [model.bytes[b] for b in p.encode()])]


def test_a_difference_from_the_library_is_an_error(pieces):
    other = SentencePieces(MODEL)
    del other.agenda.cost[" the"]
    with pytest.raises(ValueError, match="library"):
        other.measure([" the", "x"])


def spelling(rows, least_length=5, least_count=3, times=2, one_of=97):
    """All pairs of words."""
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if one_of and h % one_of == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    close = {w: [v for v in words if near(w, v)] for w in words}
    form = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in close.items() if vs}
    form = {w: v for w, v in form.items() if words[v] >= times * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return Counter((w, form.get(w), root(w), c, len(close[w]), words.get(form.get(w))) for w, c in words.items())


def spelled(df, **kw):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in op12_spelling.spelling_groups(df, **kw).collect())


def variants(seed):
    rng = random.Random(seed)
    letters = "abé"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(12)] + ["q" * 40, "colour", "nation", "stationing"]
    rows = []
    for d in range(90):
        words = []
        for _ in range(60):
            w = rng.choice(stems)
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                k, kind = rng.randrange(len(w) + 1), rng.randrange(3)
                w = w[:k] + ("" if kind == 0 else rng.choice(letters)) + w[k + (kind != 1) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((d, rng.choice((" ", "-", "\n", "7", "×")).join(words)))
    return rows


@pytest.mark.parametrize("crowd", [0, 1, 16])
def test_spelling_variants_are_all_pairs_one_edit_apart(spark, crowd):
    """crowd=0 narrows every group to one open code point, so every way through the parts is taken."""
    rows = variants(crowd) + [(1, None), (None, "colour colour colours"), (3, ""), (3, "ñandú " * 5)]
    rows += rows[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert len(spelling(rows)) > 150
    assert spelled(df, crowd=crowd) == spelling(rows)
    assert spelled(df, crowd=crowd, least_length=1, least_count=2, times=3, one_of=0) == spelling(rows, 1, 2, 3, 0)


def test_spelling_odd_rows(spark, docs, none):
    assert spelled(docs) == spelling([(r[0], r[1]) for r in corpus()])
    assert op12_spelling.spelling_groups(none).count() == 0
    chain = [(0, "word" + "s" * k + " ") for k in range(1, 6) for _ in range(3 * 2 ** (5 - k))]
    got = {r.word: (r.form, r.root) for r in op12_spelling.spelling_groups(spark.createDataFrame(chain, "doc_id long, text string"), one_of=0).collect()}
    assert got["wordsssss"] == ("wordssss", "words") and got["words"] == (None, "words")
    assert op12_spelling.spelling_groups(spark.createDataFrame([("a", "letter " * 3)], "doc_id string, text string")).count() == 1  # ids of any kind


def whitened(rows, most=4, scale=256):
    """(n, deviations, V, fit) by exact integers and one covariance of all."""
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept]
    f = np.array(fit, float) - np.array(sums, float) / n
    return n, kept, deviation, f.T @ f / n, np.array(sums) / n


def test_whitening_is_that_of_the_whole_covariance(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 9)) * [5, 3, 2, 1.5, 1, 0.5, 0.3, 0.2, 0.1] @ np.linalg.qr(rng.normal(size=(9, 9)))[0] + 40
    rows = [(k, v.tolist()) for k, v in enumerate(base.astype(np.float32))] + [(1000 + k, base[3].astype(np.float32).tolist()) for k in range(300)]
    rows += [(7, None), (8, [None] + [1.0] * 8), (9, [math.nan] + [1.0] * 8), (10, [math.inf] * 9), (11, [-0.0] * 9), (None, [1.0] * 9), (11, [-0.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("component", F.lit(1)).repartition(5)
    got = op13_whitening.whiten(df).collect()
    n, kept, deviation, v, mean = whitened(rows)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter(deviation)
    assert {r.n for r in got} == {n} and len(got) == 4 * len(kept) and {r.component for r in got} == {1, 2, 3, 4}
    assert {(r.component, round(r.explained, 12)) for r in got} == {(k + 1, round(values[k] / np.trace(v), 12)) for k in range(4)}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    by_id = {}
    for r in got:
        if r.vec_id is not None and r.vec_id < 400 and r.vec_id != 11:
            by_id.setdefault(r.vec_id, {})[r.component] = r.whitened
    x = {i: (np.array(q) - mean) for i, q in kept if i is not None and i < 400 and i != 11}
    for k in range(4):
        want = np.array([x[i] @ axes[:, k] / np.sqrt(values[k]) for i in sorted(by_id)])
        have = np.array([by_id[i][k + 1] for i in sorted(by_id)])
        assert min(np.abs(want - have).max(), np.abs(want + have).max()) < 1e-9


def test_whitening_of_odd_tables(spark):
    of = lambda rows, kind="float", **kw: op13_whitening.whiten(spark.createDataFrame(rows, f"vec_id string, embedding array<{kind}>"), **kw).orderBy("vec_id", "component").collect()
    assert of([]) == [] and of([("a", []), ("b", None)]) == []
    same = of([("a", [1.0, 2.0]), ("b", [1.0, 2.0])])
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(i, c, 1, 0, None, None, None) for i in "ab" for c in (1, 2)]
    line = of([("a", [0.0, 0.0, 5.0]), ("b", [1.0, 1.0, 5.0]), ("short", [1.0])])  # one direction only
    assert [r.vec_id for r in line] == ["a"] * 3 + ["b"] * 3
    assert [r.whitened is None for r in line] == [False, True, True] * 2 and abs(abs(line[0].whitened) - 1) < 1e-12 and line[0].explained > 1 - 1e-12
    wide = of([("a", [1e300, 0.0]), ("b", [-1e300, 1.0]), ("c", [0.0, 0.0])], "double")  # entries beyond a long
    assert {r.deviation for r in wide} == {None, 2 * 0 + (3 * 0 + 1) ** 2 + 256**2} and all(r.n == 3 for r in wide)
    big = [("a", [1.5e6, 1.0]), ("b", [1.5e6 + 0.25, 2.0]), ("c", [1.5e6 + 0.75, 4.0])]
    x = [[math.floor(256 * c) for c in v] for _, v in big]
    sums = [sum(c) for c in zip(*x)]
    assert [r.deviation for r in of(big, "double") if r.component == 1] == [sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    huge = [(str(k), [v]) for k, v in enumerate((2e8, -2e8, 2.4e6, 0.0))]
    q = [math.floor(256 * v[0]) for _, v in huge]
    want = [(4 * a - sum(q)) ** 2 for a in q]
    assert [r.deviation for r in of(huge, "double")] == [w if w < 1 << 63 else None for w in want]


def test_queries_are_registered():
    assert {"op11_sentencepiece", "op12_spelling_variants", "op13_embedding_whitening"} <= set(queries.QUERIES)
