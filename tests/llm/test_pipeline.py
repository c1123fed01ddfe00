"""The pipeline's stages against brute-force versions, and what the driver may delete."""

from __future__ import annotations

import math
import re
import string
from collections import Counter

import pytest

import corpus_pipeline
from pagestrata.llm import op7_quality
from pagestrata.llm.tokens import load

from .fixture import corpus
from .test_operators import classes, dedup_lines, stats7, words6


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sf")
    rows = [r[:5] for r in corpus(n=90) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 9 != 0), 0) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(0, " ".join(rows[13][1].split()[8:30]))], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), [(r[0], r[1]) for r in rows]


def features(t, stats):
    """The forest's statistics, counted anew."""
    n, chars, symbols, dup_lines, repeat = stats
    words = re.findall("[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    marks, upper = (sum(c in pool for w in words for c in w) for pool in ("!?:;", string.ascii_uppercase))
    shares = symbols / chars, marks / chars, upper / chars, dup_lines / len(lines), repeat / n
    a, b, c, d, e = (math.log1p(100 * x) for x in shares)
    return a, b, c, math.log(chars / n), d, e, math.log(n)


def mean_path(model, row):
    """The mean path of what a row's features exceed their bounds by, tree by tree."""
    rules, forest, _ = model
    over = [(max(v - hi, 0) - max(lo - v, 0)) / unit for v, lo, hi, unit in zip(row, rules.low, rules.high, rules.unit)]
    total = 0.0
    for feature, value, left, right, length, _ in forest.grown:
        at = 0
        while value[at] < math.inf:
            at = left[at] if over[feature[at]] <= value[at] else right[at]
        total += length[at]
    return total / len(forest.grown)


def test_stages_match_brute_force(spark, tables):
    sf, rows = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = op7_quality.calibrate(docs, spark.read.parquet(f"{sf}/labels.parquet"))

    def good(t):
        s = stats7(t)
        if s[0] < 50 or 100 * s[4] > 50 * s[0]:
            return False
        return model is None or mean_path(model, features(t, s)) >= model[2]

    want = [(d, t) for d, t in rows if good(t or "")]
    want = [(d, t) for d, _, dropped, t in dedup_lines(want) if not dropped or t.split()]
    named = classes(want)
    want = [(d, t) for d, t in want if not (t or "").split() or named[t] == d]
    bench = words6(spark.read.parquet(f"{sf}/benchmark.parquet").first().text)
    grams = {tuple(bench[k : k + 10]) for k in range(len(bench) - 9)}
    want = [(d, t) for d, t in want if not any(tuple(words6(t)[k : k + 10]) in grams for k in range(len(words6(t)) - 9))]
    assert 0 < len(want) < len(rows)
    tok = load("byte_bpe_50k.json")
    tokens = {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in want}
    got = corpus_pipeline.run(spark, sf).groupBy("doc_id").sum("length").collect()
    assert Counter((r[0], r[1]) for r in got) == Counter(tokens.items())


def test_stages_keep_the_columns_of_documents(spark, tables):
    sf, _ = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_stages_take_odd_rows(spark, tables):
    """Nulls, a very long text, repeated rows and columns with the operators' own names."""
    sf, _ = tables
    long_ = " ".join(f"word{k}" for k in range(120_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, long_, "c"), (3, long_, "c"), (4, " \n ", None), (None, None, None), (5, "\n".join(f"line{k} of{k} this{k} text{k}" for k in range(40)), "e")]
    docs = spark.createDataFrame([(d, t, x, x, x, 7) for d, t, x in rows], "doc_id long, text string, fp string, row string, key string, n_dropped long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
        got = Counter(r.doc_id for r in out.select("doc_id").collect())
        assert got[5] and (got[3] >= 1)
        if name == "near_dedup":
            assert got == Counter([1, 2, 3, 4, None, 5])


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
