"""Substrings, containers and folds against brute force on small random tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from pagestrata.operators import cascade, folds, joins, postprocess, titles
from pagestrata.sources import markdown


def test_contained_is_brute_force(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("ab나é") for _ in range(n))
    texts = [(d, k, word(rng.randint(0, 40))) for d in "xyz" for k in range(30)] + [("w", 0, "no keys here")]
    keys = [(d, word(rng.randint(0, 12))) for d in "xyz" for _ in range(25)] + [("v", "ab")]
    t = spark.createDataFrame(texts, "d string, k int, t string").repartition(3)
    q = spark.createDataFrame(keys, "d string, key string")
    want = sorted((d, k, key) for d, k, x in texts for e, key in keys if d == e and key and key in x)
    assert len(want) > 50
    for most in (1, 3, 8):
        assert sorted((r.d, r.k, r.key) for r in joins.contained(t, q, ["d"], "t", "key", most).collect()) == want
    first = {(r.d, r.key): r.found_page for r in joins.first_page_with(t.withColumnRenamed("k", "p"), q, ["d"], "p", "t", "key").collect()}
    assert first == {(d, key): min(k for e, k, y in want if (e, y) == (d, key)) for d, _, key in want}
    plan = joins.contained(t, q, ["d"], "t", "key")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_containers_are_brute_force(spark):
    rng = random.Random(2)
    rows = [(d, a, a + rng.randint(0, 9), k) for d in "ab" for k, a in enumerate(rng.randint(0, 30) for _ in range(120))]
    for least in (1, 2, 3):
        got = sorted((r.d, r.s, r.e, r.k) for r in joins.drop_containers(spark.createDataFrame(rows, "d string, s int, e int, k int"), ["d"], "s", "e", least).collect())
        holds = lambda x, y: x[0] == y[0] and x[1] <= y[1] and y[2] <= x[2] and x[1:3] != y[1:3]
        assert got == sorted(x for x in rows if sum(holds(x, y) for y in rows) < least)


def test_kept_covers_take_numbers_of_dropped_ones(spark):
    rows = [("d", 1, None), ("d", 4, None), ("d", 5, 2), ("d", 8, 3), ("d", 20, None), ("d", 33, 4), ("d", 35, 5)]
    df = spark.createDataFrame(rows, "doc_id string, page int, no int")
    got = folds.greedy_covers(df, ["doc_id"], "page", 10, fill="no").orderBy("page").collect()
    assert [(r.page, r.no) for r in got] == [(1, 2), (20, None), (33, 4)]


def intervals(spark, rows):
    return spark.createDataFrame([("d", k, t, a, b, s, c) for k, (t, a, b, s, c) in enumerate(rows, 1)], postprocess.INTERVALS)


def test_ranges_are_repaired(spark):
    df = intervals(spark, [("a", 0, 4, 1, 1.0), ("b", 3, 1, 1, 1.0), ("c", 5, 99, 1, 1.0), ("d", 21, 22, 1, 1.0), ("e", 6, 7, 1, 1.0), ("f", 8, None, 1, 1.0)]).withColumn("n_pages", F.lit(20))
    assert sorted((r.title, r.page_start, r.page_end) for r in postprocess.repair_ranges(df).collect()) == [("b", 3, 3), ("c", 5, 5), ("e", 6, 7), ("f", 8, 8)]


def test_similar_titles(spark):
    """Equal heads and titles that hold one another are similar; the shorter title stays, and counts for what comes after."""
    rows = [("6G 이동통신기술 성능", 1, 2, 1, 1.0), ("6G 이동통신기술", 3, 4, 1, 1.0), ("QKD", 6, 7, 1, 1.0), ("양자 QKD 기술", 9, 9, 1, 1.0), ("QKD", 30, 31, 1, 1.0), ("QKD", 32, 33, 2, 1.0), ("", 34, 34, 2, 1.0), ("", 35, 35, 2, 1.0)]
    got = postprocess.merge_titles(intervals(spark, rows)).orderBy("page_start").collect()
    assert [(r.title, r.page_start, r.page_end, r.session) for r in got] == [("6G 이동통신기술", 1, 4, 1), ("QKD", 6, 9, 1), ("QKD", 32, 33, 2), ("", 34, 34, 2), ("", 35, 35, 2)]


def test_short_topics_at_a_sessions_start(spark):
    rows = [("a", 1, 1, 1, 0.5), ("b", 2, 2, 1, 0.3), ("c", 3, 3, 1, 0.5), ("d", 4, 4, 1, 0.2), ("e", 5, 5, 2, 0.1), ("f", 6, 6, 3, 0.1)]
    expected = spark.createDataFrame([("d", 1, 6), ("d", 3, 13)], "doc_id string, session int, expected int")
    got = postprocess.merge_short(intervals(spark, rows), expected).orderBy("page_start").collect()
    assert [(r.title, r.page_start, r.page_end) for r in got] == [("c", 1, 4), ("e", 5, 5), ("f", 6, 6)]


def test_verdicts_join_and_name(spark):
    rows = [("a", 1, 3, 1, 0.9), ("b", 4, 5, 1, 0.5), ("c", 6, 7, 1, 0.65), ("d", 8, 9, 1, 0.65)]
    verdicts = spark.createDataFrame([("d", 4, True, None), ("d", 6, True, "new"), ("d", 1, True, "not asked")], "doc_id string, page_start int, same_topic boolean, title string")
    got = postprocess.enhance(intervals(spark, rows), verdicts).orderBy("page_start").collect()
    assert [(r.title, r.page_start, r.page_end) for r in got] == [("a", 1, 5), ("new", 6, 7), ("d", 8, 9)]


def test_cleaning_refuses_what_is_not_coherent(spark):
    pages = spark.createDataFrame([("d", 20, False), ("e", 20, True), ("f", 100, False), ("g", 10, False)], "doc_id string, n_pages int, multi boolean")
    rows = [("d", 1, "one", 1, 9, 1), ("d", 2, "two", 3, 4, 1), ("e", 1, "1. one", 1, 6, 2), ("e", None, "two", 7, 7, 2), ("e", 3, "three", 9, 9, 3), ("e", 4, "four", 12, 13, 7), ("f", 1, "one", 1, 5, 1)]
    df = spark.createDataFrame(rows, "doc_id string, num int, title string, page_start int, page_end int, session int").withColumn("confidence", F.lit(0.5)).select(*[c.split()[0] for c in postprocess.INTERVALS.split(", ")])
    out, verdict = postprocess.cleaned(df, pages)
    assert {(r.doc_id, r.ok, r.reason) for r in verdict.collect()} == {("d", False, "topics go back"), ("e", True, ""), ("f", False, "few pages"), ("g", False, "no topics")}
    assert [(r.num, r.session_q, r.title, r.page_start, r.page_end, r.session) for r in out.orderBy("num").collect()] == [(1, 1, "one", 1, 7, 2), (2, 3, "three", 9, 9, 3), (3, 4, "four", 12, 13, 1)]


def test_publishers_and_kinds(spark):
    heads = {"a": "KPC 기술사 실전 IMPACT 실전 모의고사", "b": "ITPE 실전 명품 모의고사\n기출 문제 해설", "c": "빅데이터", "d": "동기회", "e": ""}
    pages = spark.createDataFrame([(d, 1, h.split("\n")) for d, h in heads.items()] + [("e", 6, ["KPC 기술사 IMPACT"])], "doc_id string, page int, lines array<string>")
    names = spark.createDataFrame([("a", "x"), ("c", "ITPE_모의_3.pdf"), ("d", "기출 kpc.pdf"), ("e", "other")], "doc_id string, name string")
    got = {r.doc_id: (r.publisher, r.kind, r.itpe_mock, r.kpc_mock) for r in cascade.classified(pages, names).collect()}
    assert got == {"a": ("KPC", "mock", False, True), "b": ("ITPE", "actual", False, False), "c": ("ITPE", "mock", True, False), "d": ("동기회", "actual", False, True), "e": ("unknown", "unknown", False, False)}


def test_engines_see_what_is_left(spark):
    seen = []

    def engine(name, takes):
        def run(docs):
            ids = sorted(r.doc_id for r in docs.collect())
            seen.append((name, ids))
            found = spark.createDataFrame([(d, 1, 1, name, 1, 2, 1.0) for d in ids if d in takes] or [], "doc_id string, session int, num int, title string, page_start int, page_end int, confidence double")
            return found, spark.createDataFrame([(d, d in takes, "" if d in takes else "no") for d in ids if d != "z"] or [], "doc_id string, ok boolean, reason string")

        return name, run

    docs = spark.createDataFrame([(d,) for d in "abcz"], "doc_id string")
    found, told = cascade.cascade(docs, [engine("one", "a"), engine("two", "ab"), engine("three", "c")])
    assert seen == [("one", ["a", "b", "c", "z"]), ("two", ["b", "c", "z"]), ("three", ["c", "z"])]
    assert {(r.doc_id, r.engine) for r in found.collect()} == {("a", "one"), ("b", "two"), ("c", "three")}
    assert {(r.doc_id, r.step, r.reason) for r in told.where("not ok").collect()} == {("b", 1, "no"), ("c", 1, "no"), ("z", 1, "nothing found"), ("c", 2, "no"), ("z", 2, "nothing found"), ("z", 3, "nothing found")}


def test_line_topics_are_verified(spark):
    topics = spark.createDataFrame([(d, s) for d, counts in {"a": {1: 12, 2: 8}, "b": {1: 12}, "c": {1: 4}, "d": {1: 5}, "e": {1: 9, 2: 6}}.items() for s, n in counts.items() for _ in range(n)], "doc_id string, session int")
    docs = spark.createDataFrame([(d,) for d in "abcdef"], "doc_id string")
    expected = spark.createDataFrame([(d, s, n) for d in "abe" for s, n in ((1, 13), (2, 6))], "doc_id string, session int, expected int")
    said = spark.createDataFrame([("b", 2)], "doc_id string, session int")
    got = {r.doc_id: (r.ok, r.reason) for r in cascade.verified(topics, docs, expected, said).collect()}
    assert got == {"a": (True, ""), "b": (False, "counts 2:0/6"), "c": (False, "few topics 4"), "d": (True, ""), "e": (False, "counts 1:9/13"), "f": (False, "no candidates")}


def test_markdown(spark):
    text = "# 3. 앞의 제목 \n|03| 표의 제목 |x|\n##### 4. 너무 깊다\n문 제 4. 카드 제목\n|5|ab|\n|5| abcd |\n## 3. 다시\n|6|둘\n셋째 줄|"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    assert sorted(map(tuple, markdown.markdown_topics(df, "id", "t").collect())) == [(1, 3, "앞의 제목", "heading"), (1, 4, "카드 제목", "menti_card"), (1, 5, "abcd", "table_cell"), (1, 6, "둘\n셋째 줄", "table_cell")]
    pages = spark.createDataFrame([("d", 2, "x" * 51), ("d", 1, " " * 60 + "y" * 50), ("d", 3, None), ("e", 1, "z")], "doc_id string, page int, text string")
    second = spark.createDataFrame([("d", 1, "read"), ("d", 2, "unused"), ("d", 3, "")], "doc_id string, page int, text string")
    assert {(r.doc_id, r.content) for r in markdown.text_or_image(pages, second).collect()} == {("d", "[OCR p1]\nread\n\n" + "x" * 51 + "\n\n"), ("e", "")}


def test_range_titles_take_the_first_rule(spark):
    shown = spark.createDataFrame([("d", 1, None, "b1"), ("d", 2, "a2", None), ("d", 3, "a3", "b3"), ("d", 4, None, "b4")], "doc_id string, page int, a string, b string")
    topics = spark.createDataFrame([("d", 1, 3), ("d", 3, 3), ("d", 4, 6), ("d", 7, 7)], "doc_id string, page_start int, page_end int")
    got = titles.range_titles(topics, shown, ["a", "b"]).orderBy("page_start").collect()
    assert [r.title for r in got] == ["a2", "a3", "b4", None]
