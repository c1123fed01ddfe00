"""Mock papers: page kinds, sessions and questions on hand-made pages."""

from __future__ import annotations

from pagestrata.operators import mock_papers as M


def test_line_questions(spark):
    def ask(n, topic):
        return [f"{n:02d}", "분야", "문제", topic, "도메인", "값"]

    pages = [["표지 글"], ["제 1 교시(시험시간: 100 분)"], ["시험지 본문"], ask(1, "첫 토픽"), ["이어지는 본문"], ask(2, "둘째"), ["제 2 교시(시험시간: 100 분)"], ask(1, "셋째"), ["끝 글", *ask(2, "넷째")], ask(1, "다섯째"), ["07", "분야", "문제", "미완"]]
    df = spark.createDataFrame([("d", p, b) for p, b in enumerate(pages, 1)], "doc_id string, page int, body array<string>")
    kinds = {r.page: r.kind for r in M.line_sessions(M.classify_lines(df)).collect()}
    assert [kinds[p] for p in (1, 2, 3, 4, 5, 11)] == ["COVER", "SESSION_HDR", "EXAM_PAPER", "Q_START", "Q_BODY", "Q_START_PARTIAL"]
    got = [(r.session, r.number, r.topic, r.page_start, r.page_end) for r in M.line_questions(df).orderBy("page_start").collect()]
    assert got == [(1, 1, "첫 토픽", 4, 5), (1, 2, "둘째", 6, 6), (2, 1, "셋째", 8, 8), (2, 2, "넷째", 9, 9), (3, 1, "다섯째", 10, 10), (3, 7, "미완", 11, 11)]


def test_block_kinds(spark):
    rows = [("d", 1, k, "list", f"{k}. 문제", 13.0) for k in range(1, 6)]
    rows += [("d", 2, 1, "heading", "3. 클라우드", 13.0), ("d", 2, 2, "paragraph", "보안 아키텍처", 13.0), ("d", 2, 3, "paragraph", "본문", 10.5)]
    rows += [("d", 3, 1, "paragraph", "★★★☆☆", 10.0), ("d", 3, 2, "paragraph", "글", 10.0), ("d", 4, 1, "paragraph", "글", 10.0), ("d", 5, 1, "paragraph", "글", 10.0), ("d", 5, 2, "paragraph", "글", 10.0)]
    df = spark.createDataFrame(rows, "doc_id string, page int, idx int, type string, text string, font_size double")
    got = {r.page: (r.kind, r.number, r.title) for r in M.classify_blocks(df).collect()}
    assert got == {1: ("SESSION_PAPER", None, None), 2: ("Q_START", 3, "클라우드 보안 아키텍처"), 3: ("Q_START", None, None), 4: ("EMPTY_PAGE", None, None), 5: ("Q_BODY", None, None)}
    assert M.block_sessions(M.classify_blocks(df)).where("paper = 1").count() == 1


def test_problem_list(spark):
    lines = ["1. 앞의 줄", "다음 문제 중 선택", "1. 첫째", "x", "12. 둘째"]
    df = spark.createDataFrame([("d", 1, k, x) for k, x in enumerate(lines)], "doc_id string, page int, line_idx int, line string")
    assert [(r.number, r.title) for r in M.problem_list(df).orderBy("number").collect()] == [(1, "첫째"), (12, "둘째")]


def test_sub_split(spark):
    intervals = spark.createDataFrame([("d", 1, "A", 1, 10, 6, 1.0), ("d", 1, "B", 11, 12, 6, 0.5)], "doc_id string, session int, title string, page_start int, page_end int, expected int, confidence double")
    pages = spark.createDataFrame([("d", p, p in (4, 8), f"t{p}") for p in range(1, 13)], "doc_id string, page int, opens boolean, sub_title string")
    got = [(r.title, r.page_start, r.page_end, r.confidence) for r in M.sub_split(intervals, pages).orderBy("page_start").collect()]
    assert got == [("A", 1, 3, 0.8), ("t4", 4, 7, 0.8), ("t8", 8, 10, 0.8), ("B", 11, 12, 0.5)]
