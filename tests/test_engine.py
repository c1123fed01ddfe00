"""Operators on small hand-made inputs with known results."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pagestrata.functions import text as T
from pagestrata.operators import aggregates, coverage, folds, formats, joins, line_engine, order, postprocess, signal_engine, titles
from pagestrata.sources import elements as E


def pages(spark, values, name="number"):
    return spark.createDataFrame([("d", p, v) for p, v in values], f"doc_id string, page long, {name} long")


def column(df, name="page"):
    return [r[name] for r in df.orderBy(name).collect()]


def test_number_restart(spark):
    assert column(order.restarts(pages(spark, [(1, 1), (2, 2), (3, 3), (4, 1), (5, 2), (6, 1)]), ["doc_id"], ["page"], "number")) == [4, 6]


def test_running_max_restart_never_resets(spark):
    assert column(order.running_max_restarts(pages(spark, [(1, 0), (2, 1), (3, 0), (4, 0)]), ["doc_id"], ["page"], "number")) == [3, 4]


def test_greedy_covers(spark):
    assert column(folds.greedy_covers(pages(spark, [(1, 0), (9, 0), (12, 0), (30, 0)]), ["doc_id"], "page", 10)) == [1, 12, 30]


def test_islands(spark):
    got = order.island_ranges(pages(spark, [(p, 0) for p in (2, 3, 5, 9, 10)]), ["doc_id"], "page", 2).orderBy("page_start").collect()
    assert [(r.page_start, r.page_end) for r in got] == [(2, 5), (9, 10)]


def test_gap_sessions(spark):
    got = order.gap_sessions(pages(spark, [(p, 0) for p in (0, 2, 4, 8, 12)]), ["doc_id"], "page").orderBy("page").collect()
    assert [r.session for r in got] == [1, 1, 1, 2, 2]


def test_monotone_selection_without_sessions(spark):
    rows = [("d", p, 2.5, n, None, "") for p, n in enumerate([1, 2, 3, 4, 5, 1, 2])]
    df = spark.createDataFrame(rows, "doc_id string, page int, score double, num int, session int, title string")
    got = line_engine.select_rising(df).orderBy("page").collect()
    assert [r.session for r in got] == [1] * 5 + [2] * 2


@pytest.mark.parametrize("papers,at,want", [((10, 20, 30), (5, 15, 25, 35), [1, 1, 2, 4]), ((10, 20, 30, 40), (5, 15, 25, 35, 45), [1, 1, 2, 3, 4])])
def test_paper_blocks(spark, papers, at, want):
    kinds = spark.createDataFrame([("d", p, "SESSION_PAPER") for p in papers], "doc_id string, page int, kind string")
    cands = spark.createDataFrame([("d", p, 2.0, 1, None, "t", False) for p in at], "doc_id string, page int, score double, num int, session int, title string, dan boolean")
    assert [r.session for r in line_engine.paper_sessions(cands, kinds).orderBy("page").collect()] == want


@pytest.mark.parametrize("end,roman,want", [(12, 5, (1.0, 0.5)), (4, 6, (0.666667, 1.0)), (2, 0, (0.0, 0.0))])
def test_calibration(spark, end, roman, want):
    got = aggregates.calibrate(spark.createDataFrame([("d", end, roman)], "doc_id string, end int, roman int"), {"end": 10, "roman": 10}).first()
    assert (round(got.w_end, 6), round(got.w_roman, 6)) == want


def test_selection_with_single_signal_penalty(spark):
    rows = [("d", 1, 1, 10.0, 2), ("d", 1, 5, 8.0, 1), ("d", 1, 9, 6.0, 2), ("d", 1, 12, 5.0, 1)]
    df = spark.createDataFrame(rows, "doc_id string, session int, page int, score double, n int")
    got = order.kth_threshold(df, ["doc_id", "session"], "score", ["page"], 3, weak=F.col("n") <= 1).orderBy("page").collect()
    assert [(r.page, round(r.score, 6)) for r in got] == [(1, 10.0), (5, 4.8), (9, 6.0)]


def intervals(spark, rows):
    return spark.createDataFrame([("d", k, t, a, b, s, c) for k, (t, a, b, s, c) in enumerate(rows, 1)], postprocess.INTERVALS)


def spans(df):
    return [(r.page_start, r.page_end) for r in df.orderBy("page_start", "page_end").collect()]


def test_short_topics_merge(spark):
    df = intervals(spark, [("a", 1, 1, 1, 0.5), ("b", 2, 4, 1, 0.9), ("c", 5, 6, 1, 0.3)])
    expected = spark.createDataFrame([("d", 1, 6)], "doc_id string, session int, expected int")
    assert spans(postprocess.merge_short(df, expected)) == [(1, 6)]


def test_containers_go(spark):
    df = intervals(spark, [("a", 29, 42, 1, 1.0), ("b", 30, 32, 1, 1.0), ("c", 33, 36, 1, 1.0)])
    assert spans(postprocess.without_containers(df)) == [(30, 32), (33, 36)]


def test_single_pages_chain(spark):
    df = intervals(spark, [("a", 1, 3, 2, 1.0), ("b", 4, 4, 2, 1.0), ("c", 5, 5, 2, 1.0), ("d", 7, 7, 2, 1.0)])
    assert spans(postprocess.merge_single_pages(df)) == [(1, 5), (7, 7)]


def test_equal_titles_merge(spark):
    df = intervals(spark, [("1. Big data", 1, 3, 1, 1.0), ("Big  Data", 5, 6, 1, 1.0), ("big data", 20, 21, 1, 1.0)])
    assert spans(postprocess.merge_titles(df)) == [(1, 6)]


def test_quality(spark):
    got = aggregates.quality(spark.createDataFrame([(29, 31, 1), (0, 0, 0)], "f int, e int, w int"), "f", "e", "w").orderBy(F.desc("f")).collect()
    assert [(r.score, r.grade) for r in got] == [(0.9155, "양호"), (0.5, "낮음")]


def test_number_gaps(spark):
    assert aggregates.number_gaps(pages(spark, [(1, 1), (2, 2), (3, 4), (4, 6)]), ["doc_id"], "number").first().missing == "3,5"


def test_session_lookup(spark):
    sessions = spark.createDataFrame([("d", 1, 3, 10), ("d", 2, 11, 20)], "doc_id string, session int, page_start long, page_end long")
    got = joins.session_of(pages(spark, [(1, 0), (5, 0), (25, 0)]), sessions, ["doc_id"]).orderBy("page").collect()
    assert [r.session for r in got] == [2, 1, 2]


@pytest.mark.parametrize("title,content,want", [("cloud ai", "edge", (7, "direct")), ("none", "cloud", None), ("none", "cloud ai", (2, "indirect"))])
def test_keyword_match(spark, title, content, want):
    topics = spark.createDataFrame([(1, title, content)], "id int, t string, c string")
    words = spark.createDataFrame([("q", w) for w in ("cloud", "ai", "edge", "x")], "q string, w string")
    got = joins.keyword_matches(topics, words, "id", "t", "c", ["q"], "w").first()
    assert (got and (got.score, got.match)) == want


def test_even_spacing(spark):
    df = spark.createDataFrame([("기 출 풀 이 의 견",), ("가. 나 다",), ("a b c",)], "x string")
    assert [r.y for r in df.select(T.collapse_spacing(F.col("x")).alias("y")).collect()] == ["기출풀이의견", "가. 나 다", "a b c"]


def test_text_functions(spark):
    df = spark.createDataFrame([("　1. 문제 3. 클라우드(Cloud)의 개념　",)], "x string")
    got = df.select(T.strip("x").alias("s"), T.title_key("x").alias("k"), T.nfc(F.lit("é")).alias("n"), T.bounded_filename(F.lit("a/b:c?")).alias("f"), T.bounded_filename(F.lit("???")).alias("u"), T.session_label(F.lit("x 2교시")).alias("l"), T.subject_codes(F.lit("FB_DS_AI.pdf"), ("DS", "AI", "NW")).alias("c")).first()
    assert got.s == "1. 문제 3. 클라우드(Cloud)의 개념" and got.n == "é" and got.u == "untitled" and got.l == "2교시" and got.f == "a b c"
    assert got.k == "클라우드의개념"


def test_engine_diff(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "s int, n int, t string")
    b = spark.createDataFrame([(1, 1, "x"), (1, 2, "q"), (3, 1, "z")], "s int, n int, t string")
    got = {(r.s, r.n): r.status for r in joins.engine_diff(a, b, ["s", "n"], ["t"], ["t"]).collect()}
    assert got == {(1, 1): "same", (1, 2): "differs", (2, 1): "only_a", (3, 1): "only_b"}


def test_line_engine(spark):
    rows = []
    for p in range(1, 13):
        head = ["누구나 ICT", f"- {p} -"]
        rows.append(("d", p, head + (["문제", f"{(p + 1) // 2}. 토픽 제목 {p}", "도메인", "본문"] if p % 2 else ["본문 내용입니다", "계속"])))
    got = line_engine.topics(spark.createDataFrame(rows, "doc_id string, page int, lines array<string>")).orderBy("page_start").collect()
    assert [(r.num, r.page_start, r.page_end) for r in got] == [(k, 2 * k - 1, 2 * k) for k in range(1, 7)]
    assert got[0].title == "토픽 제목 1"


def test_header_trim(spark):
    df = spark.createDataFrame([(["누구나 ICT", "12", "1", "제목"],), (["ITPE (x)", "본문"],), (["12"],)], "lines array<string>")
    assert [r.b for r in df.select(line_engine.body(F.col("lines")).alias("b")).collect()] == [["1", "제목"], ["본문"], ["12"]]


def element_rows(n_topics=6):
    rows, k = [], 0
    for t in range(n_topics):
        for page, texts in ((2 * t + 1, [f"I. 토픽 {t} 의 개요", "설명 문장이 여기에 길게 이어진다"]), (2 * t + 2, ["본문이 계속 이어지는 문장이다", "끝"])):
            for c in texts:
                k += 1
                rows.append(("d", page, k, "paragraph", c, 1.0, False, None))
    return rows


SCHEMA = "doc_id string, page int, elem_idx int, type string, content string, font_ratio double, is_table_cell boolean, source string"


def test_signal_engine(spark):
    got = signal_engine.boundaries(spark.createDataFrame(element_rows(), SCHEMA)).orderBy("page_start").collect()
    assert [(r.num, r.page_start, r.page_end) for r in got] == [(k, 2 * k - 1, 2 * k) for k in range(1, 7)]
    assert all(0 < r.confidence <= 1 for r in got) and got[1].title.startswith("토픽 1")


def test_signal_engine_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(element_rows(), SCHEMA)
    one, many = (sorted(map(tuple, signal_engine.boundaries(df.repartition(n)).collect())) for n in (1, 7))
    assert one == many


def day_rows(ended=(10, 10, 10, 0, 3), topics=10):
    """Days of two-page topics under a header that names the day; only the first `ended` topics of a day have the end mark."""
    rows = [("d", 1, 0, "paragraph", "1교시", 1.0, False, None)]
    for day, n in enumerate(ended, 1):
        for t in range(topics):
            page = 2 * topics * (day - 1) + 2 * t + 1
            second = ["본문이 계속 이어지는 문장이다", "끝" if t < n else "본문이 더 이어지는 문장이다"]
            for k, (at, c) in enumerate([(page, f"해설집 ({day}일차)"), (page, f"I. 토픽 {day}-{t} 의 개요"), (page + 1, f"해설집 ({day}일차)"), *((page + 1, c) for c in second)], 1):
                rows.append(("d", at, k, "paragraph", c, 1.0, False, None))
    return rows


def test_days_expect_their_own_topics(spark):
    df = spark.createDataFrame(day_rows(), SCHEMA)
    blocks = signal_engine.sessions(signal_engine.page_flags(signal_engine.marked(df))).orderBy("session").collect()
    assert [(r.session, r.page_start, r.page_end, r.expected) for r in blocks] == [(1, 1, 20, 10), (2, 21, 40, 10), (3, 41, 60, 10), (4, 61, 80, 6), (5, 81, 100, 3)]
    count = {r["session"]: r["count"] for r in signal_engine.boundaries(df).groupBy("session").count().collect()}
    assert [count[k] for k in (1, 2, 3)] == [10, 10, 10]


def test_signals_in_turn(spark):
    """A cover after an end, a hint of its questions, question pages, and a long topic cut."""
    asked = "1. 클라우드 네이티브 보안 위협과 대응 방안을 설명하시오"
    pages = {
        1: ["I. 토픽 하나의 개요", "본문 하나가 길게 이어지는 문장이다"], 2: ["끝"], 3: ["I. 토픽 둘의 개요"], 4: ["끝"], 5: ["I. 토픽 셋의 개요"], 6: ["끝"],
        7: ["국가기술자격 시험문제", asked, "2. 데이터 품질 관리 체계에 대하여 설명하시오"], 8: ["1. 클라우드 네이티브 보안 위협과 대응은 이렇다"], 9: ["본문이 이어지는 문장"], 10: ["I. 새로운 절의 개요"], 11: ["본문이 더 이어지는 문장"],
        12: ["끝"], 13: ["I. 토픽 다섯의 개요"], 14: ["본문이 계속되는 문장"], 15: ["I. 다른 절의 개요"], 16: ["본문이 또 이어지는 문장"], 17: ["끝"],
    }
    rows = [("d", p, k, "paragraph", c, 1.0, False, None) for p, cs in pages.items() for k, c in enumerate(cs)]
    got = signal_engine.boundaries(spark.createDataFrame(rows, SCHEMA)).orderBy("num", "page_start").collect()
    topics = [(r.page_start, r.page_end) for r in got if r.fmt == "topic"]
    assert topics == sorted(topics) and topics[:3] == [(1, 2), (3, 4), (5, 7)] and (8, 9) in topics
    assert [(r.page_start, r.page_end, r.num, r.title) for r in got if r.fmt == "question_pages"] == [(7, 7, 0, "문제지")]
    assert topics[-1][1] == 17 and all(a[1] < b[0] for a, b in zip(topics, topics[1:]))


def test_format_ladder_and_intervals(spark):
    rows = element_rows(10)
    assert formats.detect_format(spark.createDataFrame(rows, SCHEMA)).first()["format"] == "ITPE"
    got = signal_engine.formatted(spark.createDataFrame(rows, SCHEMA)).orderBy("page_start").collect()
    assert [(r.page_start, r.page_end) for r in got] == [(2 * k - 1, 2 * k) for k in range(1, 11)] and got[0].confidence == 0.85


def by_format(spark, pages, blocks=()):
    """pages: {page: [(type, text, is_table_cell) or text]}; blocks: [(session, start, end)]."""
    cells = [(p, k, (x if isinstance(x, tuple) else ("paragraph", x, False))) for p, xs in pages.items() for k, x in enumerate(xs)]
    df = spark.createDataFrame([("d", p, k, t, c, 1.0, cell, None) for p, k, (t, c, cell) in cells], SCHEMA)
    known = spark.createDataFrame([("d", s, a, b, 6) for s, a, b in blocks or [(0, 1, max(pages))]], "doc_id string, session int, page_start int, page_end int, expected int")
    found = formats.by_format(titles.marked(df), known).orderBy("page_start", "num").collect()
    return [(r.session, r.num, r.page_start, r.page_end, r.title, r.fmt) for r in found]


def test_kpc_noise_with_a_sign_is_kept(spark):
    """The frequency stands in every topic's data: pages with a title or stars are topics all the same."""
    pages = {}
    for k in range(6):
        pages[2 * k + 1] = [f"제 {k + 1}. 여섯 가운데 {k} 번 제목", "출제빈도: 미출제"]
        pages[2 * k + 2] = ["본문이 길게 이어지는 문장", "기 출 풀 이 의 견"]
    assert by_format(spark, pages) == [(0, k + 1, 2 * k + 1, 2 * k + 2, f"여섯 가운데 {k} 번 제목", "KPC") for k in range(6)]


def test_kpc_sessions_have_their_question_pages(spark):
    pages = {1: ["국 가 기 술 자 격 기술사 시험문제"], 2: ["문제를 선택하여 답하시오"], 13: ["기술사 시험문제"], 14: ["출제 경향"]}
    for k, (a, b) in enumerate([(3, 4), (5, 6), (7, 8), (9, 10), (11, 12), (15, 17), (18, 20)]):
        pages |= {p: [f"본문 {p} 쪽의 문장이 이어진다"] for p in range(a, b + 1)}
        pages[a].insert(0, f"{k + 1}. 여러 낱말의 제목 {k}")
        pages[b].append("기출풀이 의견")
    pages |= {21: ["본문 21 쪽의 문장이 이어진다"], 22: ["본문 22 쪽의 문장이 이어진다"]}
    got = by_format(spark, pages, [(1, 1, 12), (2, 13, 22)])
    assert [(g[0], *g[2:]) for g in got if g[1] == 0] == [(1, 1, 2, "문제지_1교시", "question_pages"), (2, 13, 14, "문제지_2교시", "question_pages")]
    assert [g[:4] for g in got if g[1]] == [(1, 1, 3, 4), (1, 2, 5, 6), (1, 3, 7, 8), (1, 4, 9, 10), (1, 5, 11, 12), (2, 6, 15, 17), (2, 7, 18, 20), (2, 8, 21, 22)]
    assert [g[4] for g in got if g[1] in (1, 8)] == ["여러 낱말의 제목 0", "본문 21 쪽의 문장이 이어진다"]


def test_itpe_titles_look_ahead(spark):
    """The cell after "M 번" is the title, unless a label of the question's data comes first; a cover page between an end and the next cluster is skipped."""
    pages = {}
    for k in range(6):
        cells = [("heading", f"{k + 1} 번", False), ("paragraph", "셀", True), ("paragraph", f"문제 {k}\n둘째 줄", True)] if k != 2 else [("heading", "3 번", False), ("paragraph", "도메인", True), ("paragraph", "문제 아닌 셀", True), ("heading", "셋째의 긴 머리글 제목이다", False)]
        pages[3 * k + 1] = [*cells, ("paragraph", "도 메 인", True), ("paragraph", "난이도", True)]
        pages[3 * k + 2] = ["본문이 이어지는 문장", "끝." if k == 5 else "끝"]
        pages[3 * k + 3] = [("heading", "선택 문제 안내", False)]
    got = by_format(spark, pages)
    assert [g[2:5] for g in got] == [(1, 2, "문제 0"), (4, 5, "문제 1"), (7, 8, "셋째의 긴 머리글 제목이다"), (10, 11, "문제 3"), (13, 14, "문제 4"), (16, 17, "문제 5")]


def test_airipo_sessions_cover_and_original(spark):
    pages = {1: ["실전 모의고사 문제"], 2: ["실전 모의고사 문제"]}
    for p in range(3, 15):
        pages[p] = [f"관리-{1 if p < 9 else 2}교시" if p not in (8, 11) else "머리글 없음", f"{p}. 여러 낱말의 제목 {p}", "뒷페이지에 계속" if p in (5, 9) else "끝"]
    pages |= {15: ["원본 시험 문제지"], 16: ["끝"]}
    got = by_format(spark, pages)
    assert got[0] == (0, 0, 1, 2, "표지", "question_pages") and got[-1] == (0, 0, 15, 16, "시험문제_원본", "question_pages")
    assert [(g[0], g[2], g[3]) for g in got[1:-1]] == [(1, 3, 3), (1, 4, 4), (1, 5, 6), (1, 7, 7), (1, 8, 8), (2, 9, 10), (2, 11, 11), (2, 12, 12), (2, 13, 13), (2, 14, 14)]
    assert got[3][4] == "여러 낱말의 제목 5"


def test_elements_from_parser_answer(spark):
    answer = {"success": True, "totalPages": 1, "blocks": [
        {"type": "heading", "text": " 제목 ", "pageNumber": 1, "level": 1, "style": {"fontSize": 20.0}},
        {"type": "table", "text": "", "pageNumber": 1, "style": {"fontSize": 10.0}, "table": {"rows": 1, "cols": 2, "cells": [[{"text": "셀 하나"}, {"text": "x"}]]}},
        {"type": "list", "text": "- 항목 하나\n- y", "pageNumber": 1, "style": {"fontSize": 10.0}},
        {"type": "paragraph", "text": "z", "pageNumber": 1, "style": {"fontSize": 10.0}},
    ]}
    raw = spark.createDataFrame([("d", "log line\n" + json.dumps(answer, ensure_ascii=False))], "doc_id string, value string")
    got = E.elements(E.parsed(raw)).orderBy("elem_idx").collect()
    assert [(r.type, r.content) for r in got] == [("heading", "제목"), ("paragraph", "셀 하나"), ("table_marker", ""), ("paragraph", "항목 하나")]
    assert got[0].font_ratio == 2.0 and got[1].is_table_cell
    assert E.page_blocks(E.parsed(raw)).where("type = 'table'").first().text == "셀 하나 | x"


def test_manifest(spark):
    df = spark.createDataFrame([("d.pdf", 1, 1, "A", 1, 2), ("d.pdf", 1, 1, "A", 3, 3)], "doc_id string, session int, num int, title string, page_start int, page_end int")
    chars = spark.createDataFrame([("d.pdf", 1, 10), ("d.pdf", 2, 500), ("d.pdf", 3, 500)], "doc_id string, page int, n_chars int")
    got = E.manifest(df, chars).orderBy("page_start").collect()
    assert [(r.filename, r.pages, r.image_pages) for r in got] == [("d_1_01_A.pdf", 2, 1), ("d_1_01_A_2.pdf", 1, 0)]


def test_coverage(spark):
    topics = spark.createDataFrame([(1, "g", "1", "1", "S", "클라우드 보안", "137회 출제, 미출제", "", "내용"), (2, "g", "2", "1", "S", "기타", "", "", "양자 컴퓨팅 암호")], "topic_id int, gen string, week string, session string, subject string, q_title string, intent string, approach string, content string")
    words = spark.createDataFrame([("137", 1, 1, ["클라우드"], "a"), ("137", 1, 2, ["양자", "암호"], "b"), ("137", 1, 3, ["없음"], "c"), ("137", 1, 4, [], "d")], "exam string, session int, q_num int, terms array<string>, label string")
    found = coverage.matches(topics, words)
    hits = coverage.hit_table(words, found).first()
    assert (hits.scorable, hits.direct, hits.indirect, hits.missed, hits.skipped, hits.percent) == (3, 1, 1, 1, 1, 66)
    assert [r.q_num for r in coverage.gaps(words, found).collect()] == [3]
    assert coverage.exam_references(topics).first().number == 137
    assert "| 137 | 3 |" in coverage.report(coverage.hit_table(words, found), coverage.gaps(words, found), coverage.generation_stats(topics))


def test_coverage_report_lists_every_gap(spark):
    hits = spark.createDataFrame([], "exam string, scorable long, direct long, indirect long, missed long, percent long")
    stats = spark.createDataFrame([], "gen string, topics long, weeks long")
    gaps = spark.createDataFrame([(str(100 + e), s, q, f"label {e}") for e in range(10) for s in range(1, 5) for q in range(1, 8)], "exam string, session int, q_num int, label string")
    lines = coverage.report(hits, gaps, stats).splitlines()
    assert [line for line in lines if line.startswith("- ")] == [f"- {100 + e} {s}-{q} label {e}" for e in range(10) for s in range(1, 5) for q in range(1, 8)]


def test_streams(spark, tmp_path):
    from pagestrata.streaming.jobs import fixed_windows, unseen

    rows = spark.createDataFrame([(1, "a", "2024-01-01 00:00:01"), (2, "a", "2024-01-01 00:00:30"), (3, "b", "2024-01-01 00:02:00")], "id long, k string, ts string").withColumn("ts", F.to_timestamp("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = fixed_windows(stream, "ts", "1 minute", ["k"]).writeStream.outputMode("complete").format("memory").queryName("w").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.k, r.n) for r in spark.sql("select * from w").collect()) == [("a", 2), ("b", 1)]
    assert sorted(r.id for r in unseen(rows, "k", "ts").collect()) == [1, 3]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert signal_engine.boundaries(empty).count() == 0 and signal_engine.formatted(empty).count() == 0
    assert folds.greedy_covers(pages(spark, []), ["doc_id"], "page", 10).count() == 0
