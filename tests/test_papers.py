"""Papers, splitters and small functions against plain Python or known results."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from pagestrata.functions import text as T
from pagestrata.operators import order as O
from pagestrata.operators import papers as P
from pagestrata.operators import splitters as S
from pagestrata.sources import elements as E

STOPS = ("출", "난", "키", "참")


def gather(body, start, most):
    out = []
    for x in body[start : start + most]:
        if x.startswith(STOPS):
            break
        out.append(x)
    return " ".join(out).strip()


def kind_of(body):
    """A page's kind, told line by line."""
    if not body:
        return "EMPTY", None, None
    if any(re.search(r"제\s*[1-4]\s*교시\s*\(\s*시험시간|\[\s*(?:관리|응용)\s*선택\s*\]", x) for x in body[:8]):
        return "SESSION_PAPER", None, None
    if len(body) <= 2 and any(re.search(r"(?i)Copyright\s*ⓒ.*Korea\s*Productivity\s*Center", x) for x in body):
        return "EMPTY_PAGE", None, None
    at = next((i for i, x in enumerate(body[:5]) if x == "문" or re.match(r"^문\s+제$", x)), None)
    if at is None:
        return "Q_BODY", None, None

    def numbered(first, last):
        for k in range(first, min(len(body), last)):
            if m := re.match(r"^(\d{1,2})\.\s*(.+)$", body[k]):
                return int(m[1]), (m[2].strip() + " " + gather(body, k + 1, 5)).strip()
            if m := re.match(r"^(\d{1,2})\.\s*$", body[k]):
                return int(m[1]), gather(body, k + 1, 18)
        return None

    if body[at] != "문":
        found = numbered(at + 1, at + 5)
        return ("Q_START", *found) if found else ("Q_BODY", None, None)
    if at + 1 >= len(body):
        return "Q_BODY", None, None
    if m := re.match(r"^제\s+(\d{1,2})\.\s*(.*)$", body[at + 1]):
        if m[2].strip():
            return "Q_START", int(m[1]), (m[2].strip() + " " + gather(body, at + 2, 4)).strip()
        return "Q_START", int(m[1]), gather(body, at + 2, 18)
    if body[at + 1].startswith("제") and (found := numbered(at + 2, at + 7)):
        return ("Q_START", *found)
    return "Q_BODY", None, None


def test_pages_of_lines_by_kind(spark):
    rng = random.Random(4)
    pool = ["문", "제", "문 제", "문   제", "3. 토픽", "12.", "7. 둘째 토픽", "제 4. 셋째", "제 5.", "출제영역 보안", "난이도", "낱말", "둘", "제 2 교시 (시험시간", "[ 관리 선택 ]", "Copyright ⓒ 2026 Korea Productivity Center", "본문 문장"]
    weights = [6, 6, 3, 1, 5, 4, 3, 3, 3, 2, 2, 5, 5, 0.3, 0.3, 1, 4]
    pages = [(f"d{i % 9}", i, rng.choices(pool, weights, k=rng.choice((0, 1, 2, 5, 9)))) for i in range(400)]
    got = {r.page: (r.kind, r.number, r.topic) for r in P.classify_kpc(spark.createDataFrame(pages, "doc_id string, page int, body array<string>")).collect()}
    want = {p: kind_of(b) for _, p, b in pages}
    assert got == want and len({k for k, _, _ in want.values()}) >= 5


def test_heads_of_pages(spark):
    rows = [
        (["ICT의 가치", " 3. 토픽", "본문"], ["3. 토픽", "본문"], ["ICT의 가치", "3. 토픽", "본문"]),
        (["제 27회 ITPE 실전 명품 모의고사 해설집", "Copyright ⓒ ITPE", "PAGE 4", "본문"], ["제 27회 ITPE 실전 명품 모의고사 해설집", "Copyright ⓒ ITPE", "PAGE 4", "본문"], ["본문"]),
        (["제27회 ITPE 실전 명품 모의고사 해설집", "12", "", "문"], ["문"], ["문"]),
        (["", "  "], [], []),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, lines array<string>")
    got = {r.i: (r.k, r.t) for r in df.select("i", P.kpc_body(F.col("lines")).alias("k"), P.itpe_body(F.col("lines")).alias("t")).collect()}
    assert got == {i: (r[1], r[2]) for i, r in enumerate(rows)}


def test_runs_of_papers_are_sessions(spark):
    topics = spark.createDataFrame([("d", 1, 0, 1, "short"), ("d", 2, 0, 1, "a longer one"), ("d", 2, 1, 2, "two"), ("d", 9, 0, 1, "of the second")], "doc_id string, page int, idx int, number int, topic string")
    papers = spark.createDataFrame([("d", p) for p in (1, 2, 5, 9)], "doc_id string, page int")
    got = {(r.session, r.number): r.topic for r in P.session_masters(topics, papers).collect()}
    assert got == {(1, 1): "a longer one", (1, 2): "two", (2, 1): "of the second"}


def test_promotion_needs_the_question_due(spark):
    kinds = [(1, "SESSION_PAPER"), (2, "Q_START"), (3, "Q_BODY"), (5, "Q_BODY"), (8, "Q_BODY"), (9, "SESSION_PAPER"), (10, "EMPTY_PAGE"), (11, "Q_BODY")]
    opener = [3, 5, 8, 10, 11]
    match = [(3, 1, 2), (5, 1, 2), (8, 1, 4), (10, 2, 1), (11, 2, 2)]  # 3: too near; 5: due; 8: not due; 10: first of the second session; 11: too near
    df = spark.createDataFrame([("d", p, k) for p, k in kinds], "doc_id string, page int, kind string")
    got = P.promote(df, spark.createDataFrame([("d", p) for p in opener], "doc_id string, page int"), spark.createDataFrame([("d", *m) for m in match], "doc_id string, page int, session int, number int"))
    assert [(r.page, r.due) for r in got.where("promoted").orderBy("page").collect()] == [(5, 2), (10, 1)]


def test_numbers_of_questions(spark):
    rows = [
        (1, "Q_START", "topic_list", 1, None), (2, "Q_START", "star_only", None, None), (3, "Q_START", "promoted", 2, None), (4, "Q_START", "promoted", 3, None), (5, "SESSION_PAPER", None, None, None),
        (6, "Q_START", "topic_list", 1, None), (7, "Q_START", "topic_list", 5, None), (8, "Q_START", "topic_list", 2, None), (9, "Q_BODY", None, None, None),
    ]
    df = spark.createDataFrame([("d", *r) for r in rows], "doc_id string, page int, kind string, signal string, number int, forced int")
    got = [(r.kind, r.session, r.number) for r in P.number_questions(df).orderBy("page").collect()]
    assert got == [("Q_START", 1, 1), ("Q_START", 1, 2), ("Q_BODY", 1, None), ("Q_START", 1, 3), ("SESSION_PAPER", 1, None), ("Q_START", 2, 1), ("Q_START", 2, 5), ("Q_START", 3, 2), ("Q_BODY", 3, None)]
    forced = spark.createDataFrame([("d", p, "Q_START", "topic_list", 9, s) for p, s in ((1, 1), (2, 1), (3, 2))], "doc_id string, page int, kind string, signal string, number int, forced int")
    assert [(r.session, r.number) for r in P.number_questions(forced).orderBy("page").collect()] == [(1, 1), (1, 2), (2, 1)]


def test_pages_matched_to_topics(spark):
    blocks = spark.createDataFrame([("d", 1, 0, "paragraph", "오늘의 AI-RAN 구조", 10.0), ("d", 2, 0, "paragraph", "프로젝트 위험관리의 절차와 품질계획", 10.0), ("d", 3, 0, "paragraph", "다른 이야기", 10.0)], "doc_id string, page int, idx int, type string, text string, font_size double")
    masters = spark.createDataFrame([("d", 1, 1, "AI-RAN(지능형 무선망)"), ("d", 1, 2, "위험관리와 품질계획을 설명하시오")], "doc_id string, session int, number int, topic string")
    assert {(r.page, r.number) for r in P.master_matches(blocks, masters).collect()} == {(1, 1), (2, 2)}
    asked = spark.createDataFrame([("d", 1, "AI-RAN 구조"), ("d", 3, "AI-RAN 구조")], "doc_id string, page int, topic string")
    assert [r.page for r in P.holds_anchor(blocks, asked).collect()] == [1]


TITLES = [
    ("짧은  제목", "짧은 제목"),
    ("최근 DevSecOps 기술이 널리 쓰이고 있는 가운데 많은 기업이 이를 도입하고 있다. 다음에 대하여 설명하시오. 가. 개념 나. 구성요소 다. 적용 방안", "DevSecOps: 개념 · 구성요소 · 적용 방안"),
    ("클라우드 네이티브 환경에서의 보안 위협과 이에 대한 대응 방안을 포함한 전반적인 관리 체계 다음에 대하여 설명하시오 그리고 사례를 제시하시오", "클라우드 네이티브 환경에서의 보안 위협과 이에 대한 대응 방안을 포함한 전반적인 관리 체계"),
    ("공공 부문 데이터 개방이 계속 늘어나는 추세이다. 데이터 품질 관리 체계를 다음에 대하여 설명하시오 그리고 적용 사례를 들어 비교하시오", "데이터 품질 관리 체계를 다음에 대하여"),  # the end of a sentence looks like a part
    ("공공 부문 데이터 개방이 계속 늘어나는 추세이다. 데이터 품질 관리 체계를 다음에 대하여 설명하시오 그리고 적용 사례를 들어 비교하시오 또한 그 한계와 앞으로의 발전 방향도 함께 쓰시오", "데이터 품질 관리 체계"),
    ("조직의 정보 자산을 안전하게 지키기 위하여 필요한 접근 통제의 여러 모형과 그 적용에 대하여 다음에 답하시오 그리고 사례도 쓰시오", "조직의 정보 자산을 안전하게 지키기 위하여 필요한 접근 통제의 여러 모형과 그 적용"),
    ("긴 물음이 앞에 길게 서 있고 여러 조건이 그 뒤를 따르는 경우 다음을 설명하시오. 가. 서비스 수준 관리의 정의, 그리고 여러 측정 지표의 선정 기준 나. 절차", "서비스 수준 관리의 정의 · 절차"),
    ("SDN 제어기와 관련한 물음이 앞에 길게 서 있고 여러 조건이 그 뒤를 따르는 경우이니 다음을 보시오. 가. 스물두 글자쯤 되는 꽤 긴 첫째 부분의 이름 나. 스물두 글자쯤 되는 꽤 긴 둘째 부분의 이름", "SDN: 스물두 글자쯤 되는 꽤 긴 첫째 부분의 · 스물두 글자쯤 되는 꽤 긴 둘째 부분의"),
    ("API AND 그리고 흔한 약어만 있는 매우 긴 제목이 계속해서 이어지고 또 이어져서 예순 글자를 훌쩍 넘기게 되는 그런 경우의 제목이라고 할 것", "API AND 그리고 흔한 약어만 있는 매우 긴 제목이 계속해서 이어지고 또 이어져서 예순 글자를 훌쩍 넘기"),
    (None, None),
    ("", ""),
]


def test_short_titles(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(TITLES)], "k int, t string")
    got = [r.s for r in df.select("k", T.short_label("t").alias("s")).orderBy("k").collect()]
    assert got == [want for _, want in TITLES]
    assert all(s is None or len(s) <= 60 for s in got)


def test_names_of_files(spark):
    names = ["모의_ITPE41-2603-합.pdf", "모의_KPC129_2604_합.pdf", "ITPE 138관-합.pdf", "합숙_ITPE138_1일_1.pdf"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select(T.round_id("n").alias("g"), T.round_id("n", "kpc").alias("k"), T.round_id("n", "itpe").alias("i"), T.file_source("n").alias("s"), T.file_exam("n").alias("e"), T.material_name("n", F.lit("합숙")).alias("m")).collect()
    assert [r.g for r in got] == ["ITPE41-2603", "KPC129-2604", "ITPE-138관", "합숙-ITPE138-1일-1"]
    assert got[1].k == "KPC129-2604" and got[0].i == "ITPE41-2603" and got[1].i == "KPC129_2604"
    assert [r.s for r in got] == ["ITPE", "KPC", "ITPE", "ITPE"] and got[2].e == "관" and got[0].e == "?"
    assert got[3].m == "ITPE138_1일_1"
    assert df.limit(1).select(T.escaped(F.lit("<a href=\"x\">&'")).alias("h")).first().h == "&lt;a href=&quot;x&quot;&gt;&amp;&#39;"


def test_even_spacing_of_hangul(spark):
    rows = [("기 출 풀 이", "기출풀이"), ("1. 기 출 풀 이", "1. 기 출 풀 이"), ("ㄱ ㄴ ㄷ", "ㄱㄴㄷ"), ("가. 나 다 라", "가. 나 다 라"), ("• 가 나 다 라", "•가나다라"), ("가 나", "가 나"), ("I.x 가 나 다 라 마", "I.x 가 나 다 라 마")]
    df = spark.createDataFrame(rows, "x string, want string")
    assert all(r.got == r.want for r in df.select("want", T.collapse_spacing(F.col("x")).alias("got")).collect())


def test_files_by_place_and_name(spark):
    paths = ["/r/30기/1주차_DS/FB_DS 1교시 리뷰.pdf", "/r/30기/2주차/bak/AI 리뷰.pdf", "/r/30기/x/보안 특강/리뷰.pdf", "/r/30기/1주차/리뷰 복사본.pdf", "/r/30기/1주차/글.pdf"]
    files = spark.createDataFrame([(p, p.rsplit("/", 1)[1]) for p in paths], "path string, name string")
    got = {r.name: (r.gen, r.week, r.subject, r.session) for r in E.reviews(files, ("30기",)).collect()}
    assert got == {"FB_DS 1교시 리뷰.pdf": ("30기", "1주차_DS", "DS", "1교시"), "AI 리뷰.pdf": ("30기", "2주차", "AI", "0교시"), "리뷰.pdf": ("30기", "보안 특강", "SE", "0교시")}
    assert E.reviews(files, ("30기",), old=False).count() == 2
    names = ["KPC122관-1.pdf", "ITPE 138관-1교시_v1.pdf", "KPC137관-합.pdf", "x.pdf", "kpc122관-1.PDF"]
    make = lambda ns, d: spark.createDataFrame([(f"/{d}/{n}", n) for n in ns], "path string, name string")
    got = {(r.path, r.source, r.exam, r.session) for r in E.exam_files(make(names[:4], "m"), make(names[4:] + names[3:4], "b")).collect()}
    assert got == {("/m/KPC122관-1.pdf", "KPC", "관", 1), ("/m/ITPE 138관-1교시_v1.pdf", "ITPE", "관", 1), ("/m/KPC137관-합.pdf", "KPC", "관", None)}
    places = ["/m/ITPE/모의_A.pdf", "/m/KPC/bak_B.pdf", "/m/아이리포/C.pdf", "/m/ITPE/deep/D.pdf", "/m/kpc/E.PDF"]
    files = spark.createDataFrame([(p, p.rsplit("/", 1)[1]) for p in places], "path string, name string")
    assert [(r.folder, r.source_name) for r in E.material_files(files, "/m", "모의고사").collect()] == [("ITPE", "A"), ("kpc", "E.PDF")]
    places = ["/c/A.pdf", "/c/A 4교시.pdf", "/c/A-답1.pdf", "/c/A-2.pdf", "/c/bak/B.pdf", "/c/x_split/B.pdf", "/c/총평.pdf"]
    files = spark.createDataFrame([(p, p.rsplit("/", 1)[1]) for p in places], "path string, name string")
    assert [r.path for r in E.corpus_files(files).collect()] == ["/c/A.pdf"]
    books = spark.createDataFrame([("/t/3_DB_600제_통합본_v4.0.pdf", "3_DB_600제_통합본_v4.0.pdf"), ("/t/z보안 600제.pdf", "z보안 600제.pdf")], "path string, name string")
    assert {r.subject: r.path for r in S.textbook_files(books).collect()} == {"DB": "/t/3_DB_600제_통합본_v4.0.pdf", "보안": "/t/z보안 600제.pdf"}
    ups = spark.createDataFrame([("a.pdf", 5, b"%PDF-", 3), ("a.pdf", 5, b"%PDF-", 501), ("a.pdf", 5, b"xxxxx", 1), ("a.txt", 5, b"%PDF-", 1)], "name string, length long, content binary, n_pages int")
    assert sorted(str(r.refused) for r in E.valid_uploads(ups).collect()) == ["None", "extension", "magic", "pages"]


def test_keywords_of_a_textbook(spark):
    text = "\n".join(["x" * 60, "정규화", "문제", "정규화를 설명하시오.", "도메인", "DB", "키워드", "함수종속", "이상현상", "출제배경", "y"])
    got = S.textbook_questions(spark.createDataFrame([("d", 4, text), ("d", 6, "z")], "doc_id string, page long, text string")).collect()
    assert [(r.title, r.question, r.domain, r.keywords, r.page_start, r.page_end) for r in got] == [("정규화", "정규화를 설명하시오.", "DB", "함수종속, 이상현상", 4, 6)]


def test_reviews_of_other_layouts(spark):
    inline = "다음 문제 중 1문제를 선택\n1. 첫째 제목\n3. 건너뛴\n2. 둘째 제목\n출제의도\n뒤"
    menti = "문 제 1. 하나\n출제영역 난이도 ★\n본문"
    rows = [("i", 1, inline), ("i", 2, "1. 첫째 제목\n출제의도 " + "x" * 60), ("i", 3, "2. 둘째 제목\n작성방안 " + "x" * 60), ("m", 1, menti), ("m", 2, "문 제 2. 둘\n출제 " + "x" * 40), ("m", 3, "끝" + "x" * 90)]
    merged = [("g", 1, "다음 문제 중 1문제를 선택\n" + "\n".join(f"{k}. 제목{k}" for k in range(1, 6)) + "x" * 200), ("g", 2, "1. 제목1\n출제의도 " + "x" * 40), ("g", 3, "2. 제목2\n출제의도 " + "x" * 40), ("g", 4, "아이리포 대비 " + "x" * 40), ("g", 5, "x" * 60)]
    pages = spark.createDataFrame(rows + merged, "doc_id string, page long, text string")
    formats = S.review_format(pages)
    assert {r.doc_id: (r.format, r.cut) for r in formats.collect()} == {"i": ("inline", None), "m": ("menti", None), "g": ("merged", 4)}
    left, formats = S.own_part(pages, formats)
    problems = S.review_problems(left, formats)
    assert sorted((r.doc_id, r.number) for r in problems.collect()) == [("g", k) for k in range(1, 6)] + [("i", 1), ("i", 2), ("m", 1), ("m", 2)]
    got = sorted((r.doc_id, r.number, r.score, r.page_start, r.page_end) for r in S.review_topics(left, formats, problems).collect())
    assert got == [("g", 1, 18, 2, 2), ("g", 2, 18, 3, 3), ("i", 1, 18, 1, 1), ("i", 2, 18, 1, 3), ("m", 1, 15, 1, 1), ("m", 2, 15, 2, 3)]


def test_exams_with_footers_and_heads(spark):
    body = "x" * 60
    rows = [(1, f"1교시 {body}"), (2, f"1교시 {body}"), (3, ""), (4, f"2교시 {body}"), (5, " ")]
    got = S.footer_sessions(spark.createDataFrame([("d", *r) for r in rows], "doc_id string, page long, text string")).orderBy("session").collect()
    assert [(r.session, r.start, r.end) for r in got] == [(1, 1, 2), (2, 4, 4)]
    rows = [(1, f"1교시\n3번\n문제\n토픽 하나\n도메인 {body}"), (2, body), (3, ""), (4, f"2교시\n9번\n{body}"), (5, f"1교시 x 2교시\n8번\n{body}"), (6, f"1교시\n3번\n{body}")]
    got = S.numbered_exam(spark.createDataFrame([("d", *r) for r in rows], "doc_id string, page long, text string")).orderBy("page_start").collect()
    assert [(r.session, r.number, r.title, r.page_start, r.page_end) for r in got] == [(1, 3, "토픽 하나", 1, 2), (2, 9, "Q9", 4, 4), (1, 8, "Q8", 5, 6)]


def test_lists_and_orders(spark):
    df = spark.createDataFrame([(["a"] * 7,), (["a"],)], "x array<string>").select(O.limited(F.col("x")).alias("x"))
    assert sorted(len(r.x) for r in df.collect()) == [1, 6] and df.where("size(x) = 6").first().x[-1] == "… 외 2건"
    rows = spark.createDataFrame([("topic", 1), ("question_pages", 1)], "fmt string, page_start int")
    assert [r.fmt for r in rows.orderBy("page_start", O.questions_first()).collect()] == ["question_pages", "topic"]


def test_jobs_after_a_restart(spark):
    jobs = spark.createDataFrame([(1, "processing", None), (2, "done", 5.0)], "job int, status string, finished_at double")
    assert sorted((r.job, r.status, r.finished_at) for r in E.recovered(jobs, F.lit(9.0)).collect()) == [(1, "error", 9.0), (2, "done", 5.0)]


def test_diagnosis_of_odd_rows(spark):
    """Nulls, falling ranges, gaps and missing sessions; a document's rows meet its pages once, without windows or rows for each page of a question."""
    rows = [(1, 1, 1, 1, 2), (1, 1, 2, 3, 3), (1, 2, 1, 6, 5), (2, 1, 2, 1, 1), (2, 1, 1, 2, 2), (2, 2, 3, 3, 3), (3, 1, None, 1, None), (3, 2, 1, 2, 2), (3, 2, None, 3, 3), (4, 1, None, 1, 1), (5, 1, 1, 1, 1), (5, None, 2, 2, 2), (5, None, 1, 3, 3), (None, 1, 1, 1, 1)]
    questions = spark.createDataFrame(rows, "doc_id long, session int, number int, page_start int, page_end int")
    kinds = [(1, p, "Q_BODY") for p in range(1, 7)] + [(1, 4, "COVER"), (1, 8, None), (2, 1, "Q_START_PARTIAL"), (2, 9, "Q_BODY"), (3, 1, "Q_BODY"), (3, None, "Q_BODY"), (4, 1, "Q_BODY"), (5, 1, "Q_BODY"), (6, 1, "Q_BODY"), (None, 1, "Q_BODY")]
    found = P.diagnosis(questions, spark.createDataFrame(kinds, "doc_id long, page int, kind string"), {1: (1, 2), 2: (1, 2)})
    got = {r[0]: tuple(r)[1:] for r in found.select("doc_id", "n_partial", "n_outside", "counts_ok", "rising", "continuous", "ok").collect()}
    assert got == {
        1: (0, 1, True, True, True, False), 2: (1, 1, True, False, False, False), 3: (0, 2, True, True, True, False), 4: (0, 0, False, True, False, False),
        5: (0, 0, False, False, True, False), 6: (0, 1, False, False, False, False), None: (0, 1, False, False, False, False),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin") <= 2
