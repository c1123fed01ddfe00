"""Publishers' formats over the documents' own pages.

What stands on a page beside its own lines follows from its text's length: an
end, a start, a cover, noise, a title of some kind, or nothing. So topics,
tails, covers and titles of every format occur in any order, and SQL works them
out from the lengths alone; the pages' own lines have to leave that as it is.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import signal_engine, titles
from ..sources.stages import staged
from ..sources.tables import text_pages
from .registry import query
from .text_queries import PAGES

ROLES = 12


def page_elements(spark, sf_dir, marks: dict, always=(), roles: int = ROLES):
    """Elements of all pages: `always` on every page, the marks by role ({roles: [(type, text, is_table_cell, font_ratio)]}; {pg} stands for the page), a first sentence, the page's own lines. Texts of `always` may be columns of pg, n and role."""
    pages = text_pages(spark, sf_dir).withColumn("role", F.length("text") % roles).withColumn("n", F.max("pg").over(Window.partitionBy("doc")))

    def element(kind, text, cell=False, font=1.0):
        content = F.replace(F.lit(text), F.lit("{pg}"), F.col("pg").cast("string")) if isinstance(text, str) else text
        return F.struct(F.lit(kind).alias("type"), content.alias("content"), F.lit(cell).alias("cell"), F.lit(font).alias("font"))

    none = F.filter(F.array(element("paragraph", "")), lambda x: F.lit(False))
    shown = [F.when(F.col("role").isin(*of), F.array(*[element(*e) for e in es])).otherwise(none) for of, es in marks.items()]
    own = F.transform(F.split("text", "\n", -1), lambda x: F.struct(F.lit("paragraph").alias("type"), F.concat(F.lit("· "), x, F.lit(" ·")).alias("content"), F.lit(False).alias("cell"), F.lit(1.0).alias("font")))
    first = [F.array(element("paragraph", t)) for t in always]
    rows = pages.select(F.col("doc").alias("doc_id"), F.col("pg").cast("int").alias("page"), F.posexplode(F.concat(*first, *shown, F.array(element("paragraph", "본문 첫 문장 {pg} 쪽이 이어진다")), own)).alias("elem_idx", "e"))
    return rows.select("doc_id", "page", "elem_idx", "e.type", "e.content", F.col("e.font").alias("font_ratio"), F.col("e.cell").alias("is_table_cell"), F.lit(None).cast("string").alias("source"))


def told(found):
    longs = [F.col(c).cast("long").alias(c) for c in ("session", "num", "session_q", "page_start", "page_end")]
    return found.select("doc_id", *longs, "title", "confidence", "fmt")


def roles(end: str, start: str, skip: str) -> str:
    """SQL: each page with its role and flags, and the runs that ends cut: a_ with mark (its first start), op (its first page from there that isn't skipped), free and n_free."""
    return f"""{PAGES},
k_ AS (SELECT doc, pg, length(text) % {ROLES} AS r, max(pg) OVER (PARTITION BY doc) AS n FROM pages_),
f_ AS (SELECT *, {end} AS e, {start} AS s, {skip} AS sk FROM k_),
p_ AS (SELECT *, coalesce(max(CASE WHEN e THEN pg END) OVER (PARTITION BY doc ORDER BY pg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM f_),
m_ AS (SELECT *, min(CASE WHEN s THEN pg END) OVER (PARTITION BY doc, prev) AS mark FROM p_),
a_ AS (SELECT doc, n, prev, max(CASE WHEN e THEN pg END) AS en, max(pg) AS last, any_value(mark) AS mark, coalesce(bool_or(sk AND pg = mark), false) AS skipped,
       min(CASE WHEN NOT sk AND pg >= coalesce(mark, prev + 1) THEN pg END) AS op, min(CASE WHEN NOT sk THEN pg END) AS free, count(CASE WHEN NOT sk THEN 1 END) AS n_free FROM m_ GROUP BY doc, n, prev)"""


#: SQL: topics t_ (doc, n, a, b, c, session, title) and question pages q_ (doc, session, a, b, title) of the documents kept_, numbered.
RESULT = """okay_ AS (SELECT t.doc FROM t_ t JOIN kept_ USING (doc) GROUP BY t.doc, t.n HAVING count(*) >= greatest(5, t.n // 10)),
all_ AS (SELECT doc, session, a, b, c, title, 1 AS topic, {fmt} AS fmt FROM t_ UNION ALL SELECT doc, session, a, b, 0.95, title, 0, 'question_pages' FROM q_)
SELECT doc AS doc_id, CAST(session AS BIGINT) AS session, CAST(topic * sum(topic) OVER (PARTITION BY doc ORDER BY a, topic, b ROWS UNBOUNDED PRECEDING) AS BIGINT) AS num,
       CAST(topic * sum(topic) OVER (PARTITION BY doc, session ORDER BY a, topic, b ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_q, a AS page_start, b AS page_end, title, CAST(c AS DOUBLE) AS confidence, fmt
FROM all_ WHERE doc IN (SELECT doc FROM okay_)"""

ITPE_MARKS = {
    (2, 7): [("paragraph", "도메인", True), ("paragraph", "난이도", True)],
    (3, 7): [("paragraph", "시험시간: 100분")],
    (4,): [("heading", "3 번"), ("paragraph", "문제 {pg} 번의 셀", True), ("paragraph", "키워드", True)],
    (5,): [("heading", "제목이 되는 긴 머리글 {pg}")],
    (6,): [("paragraph", "1. 첫 번호의 제목 {pg}")],
    (8,): [("heading", "4 번"), ("paragraph", "키워드", True), ("paragraph", "라벨 뒤의 셀 {pg}", True)],
    (0, 1): [("paragraph", "“끝”")],
}


@query(f"""WITH {roles("r IN (0, 1)", "r IN (2, 7)", "r IN (3, 7)")},
kept_ AS (SELECT doc FROM f_ GROUP BY doc HAVING (count(CASE WHEN e THEN 1 END) >= 5 AND count(CASE WHEN s THEN 1 END) * 2 + count(CASE WHEN r IN (4, 8) THEN 1 END) >= 3) OR count(CASE WHEN e THEN 1 END) >= 10),
i_ AS (SELECT doc, n, coalesce(op, en) AS a, en AS b, 0.85 AS c FROM a_ WHERE en IS NOT NULL UNION ALL SELECT doc, n, mark, last, 0.60 FROM a_ WHERE en IS NULL AND prev > 0 AND mark IS NOT NULL AND NOT skipped),
t_ AS (SELECT i.*, 0 AS session, CASE k.r WHEN 4 THEN '문제 ' || a || ' 번의 셀' WHEN 5 THEN '제목이 되는 긴 머리글 ' || a WHEN 6 THEN '첫 번호의 제목 ' || a ELSE '토픽_p' || a END AS title FROM i_ i JOIN k_ k ON k.doc = i.doc AND k.pg = i.a),
v_ AS (SELECT doc, coalesce(min(CASE WHEN s AND NOT sk THEN pg END), min(CASE WHEN e THEN pg END)) AS first, min(CASE WHEN sk THEN pg END) AS cover FROM f_ GROUP BY doc),
q_ AS (SELECT doc, 0 AS session, 1 AS a, first - 1 AS b, '문제지_0교시' AS title FROM v_ WHERE first > 1 AND (cover < first OR first > 2)),
{RESULT.format(fmt="'ITPE'")}""")
def format_itpe(spark, sf_dir):
    """Ends close, clusters of labels open, covers are skipped and stand in front; titles by the cell after a numbered heading, a long heading or a first number."""
    return told(signal_engine.formatted(page_elements(spark, sf_dir, ITPE_MARKS)))


KPC_MARKS = {
    (2, 7): [("paragraph", "★★★☆☆")],
    (3, 7): [("paragraph", "시험시간 100분")],
    (4, 5): [("paragraph", "출제 빈도")],
    (5,): [("paragraph", "제 3. 자료를 나누는 제목 {pg}")],
    (6,): [("paragraph", "3. 번호가 붙은 제목 {pg}")],
    (8,): [("paragraph", "14. 너무 큰 번호의 문장 {pg}")],
}
#: SQL: titles of KPC's topics i_, by the first two pages: a title with its label, else a small number, else the first sentence.
KPC_TITLES = """w_ AS (SELECT i.doc, i.a, i.b, min(CASE WHEN k.r = 5 THEN pg END) AS je, min(CASE WHEN k.r = 6 THEN pg END) AS no FROM i_ i JOIN k_ k ON k.doc = i.doc AND k.pg BETWEEN i.a AND least(i.a + 1, i.b) GROUP BY i.doc, i.a, i.b),
t_ AS (SELECT i.*, 0 AS session, CASE WHEN je IS NOT NULL THEN '자료를 나누는 제목 ' || je WHEN no IS NOT NULL THEN '번호가 붙은 제목 ' || no WHEN k.r = 8 THEN '14. 너무 큰 번호의 문장 ' || a ELSE '본문 첫 문장 ' || a || ' 쪽이 이어진다' END AS title FROM i_ i JOIN w_ USING (doc, a, b) JOIN k_ k ON k.doc = i.doc AND k.pg = i.a)"""


@query(f"""WITH {roles("r IN (0, 1)", "r IN (2, 7)", "r IN (3, 4, 7)")},
kept_ AS (SELECT doc FROM f_ WHERE e GROUP BY doc HAVING count(*) >= 5),
i_ AS (SELECT doc, n, coalesce(op, en) AS a, en AS b, 0.85 AS c FROM a_ WHERE en IS NOT NULL UNION ALL SELECT doc, n, free, last, 0.60 FROM a_ WHERE en IS NULL AND prev > 0 AND n_free >= 2),
{KPC_TITLES},
v_ AS (SELECT doc, min(CASE WHEN s AND NOT sk THEN pg END) AS star, min(CASE WHEN NOT sk THEN pg END) AS free, min(CASE WHEN e THEN pg END) AS ended FROM f_ GROUP BY doc),
q_ AS (SELECT doc, 0 AS session, 1 AS a, coalesce(star, free) - 1 AS b, '문제지_0교시' AS title FROM v_ WHERE ended IS NOT NULL AND (star > 1 OR (star IS NULL AND free > 1 AND free <= ended))),
{RESULT.format(fmt="'KPC'")}""")
def format_kpc(spark, sf_dir):
    """Opinions close, stars open; covers, and noise on pages without a topic's sign, are skipped."""
    return told(signal_engine.formatted(page_elements(spark, sf_dir, KPC_MARKS | {(0, 1): [("paragraph", "기출 풀이 의견")]})))


@query(f"""WITH {roles("false", "r IN (0, 2, 7)", "r IN (3, 4, 7)")},
kept_ AS (SELECT doc FROM f_ WHERE s GROUP BY doc HAVING count(*) >= 5),
o_ AS (SELECT *, max(CASE WHEN s THEN pg END) OVER (PARTITION BY doc ORDER BY pg ROWS UNBOUNDED PRECEDING) AS opened FROM f_),
i_ AS (SELECT doc, n, opened AS a, max(CASE WHEN NOT sk THEN pg END) AS b, 0.80 AS c FROM o_ WHERE opened IS NOT NULL GROUP BY doc, n, opened HAVING NOT bool_or(pg = opened AND sk)),
{KPC_TITLES},
q_ AS (SELECT doc, 0 AS session, 1 AS a, 1 AS b, '' AS title FROM f_ WHERE false),
{RESULT.format(fmt="'KPC'")}""")
def format_kpc_stars(spark, sf_dir):
    """Without opinions every star page opens a topic, which ends before the next one; skipped pages at its end go."""
    return told(signal_engine.formatted(page_elements(spark, sf_dir, KPC_MARKS | {(0,): [("paragraph", "★★☆☆☆")]}, always=("KPC 기술사",))))


def _headed(spark, sf_dir):
    session = F.least(F.lit(4), F.lit(1) + F.floor((F.col("pg") - 3) / 8)).cast("string")
    headed = (F.col("pg") >= 3) & (F.col("pg") <= F.col("n") - 2) & (F.col("role") != 9)
    marks = {
        (0, 1): [("paragraph", "끝")],
        (5,): [("paragraph", "- 뒷페이지에 계속 -")],
        (6,): [("paragraph", "3. 번호가 붙은 제목 {pg}")],
        (8,): [("heading", "출제영역"), ("paragraph", "IT trends 그리고 나머지 낱말")],
    }
    return page_elements(spark, sf_dir, marks, always=(F.when(F.col("pg") <= 2, "실전 모의고사 문제").otherwise(""), F.when(headed, F.concat(F.lit("관리 - "), session, F.lit(" 교시"))).otherwise("")))


@query(f"""WITH {PAGES},
k_ AS (SELECT doc, pg, length(text) % {ROLES} AS r, max(pg) OVER (PARTITION BY doc) AS n FROM pages_),
h_ AS (SELECT doc, n, pg, least(4, 1 + (pg - 3) // 8) AS s FROM k_ WHERE pg >= 3 AND pg <= n - 2 AND r <> 9),
b_ AS (SELECT doc, s, min(pg) AS x, greatest(max(pg), coalesce(lead(min(pg)) OVER (PARTITION BY doc ORDER BY s) - 1, max(pg))) AS y FROM h_ GROUP BY doc, s),
d_ AS (SELECT k.doc, any_value(k.n) AS n, coalesce(any_value(c.x), 1) AS opening, coalesce(any_value(c.y), any_value(k.n)) + 1 AS cut FROM k_ k LEFT JOIN (SELECT doc, min(x) AS x, max(y) AS y FROM b_ GROUP BY doc) c USING (doc) GROUP BY k.doc),
kept_ AS (SELECT doc FROM d_ WHERE n >= 2),
e_ AS (SELECT k.doc, k.pg, d.n, d.opening, d.cut, coalesce(lag(k.pg) OVER (PARTITION BY k.doc ORDER BY k.pg), 0) AS prev FROM k_ k JOIN d_ d USING (doc) WHERE r IN (0, 1) AND pg < cut),
i_ AS (SELECT doc, n, greatest(prev + 1, opening) AS a, pg AS b, 0.85 AS c FROM e_ WHERE greatest(prev + 1, opening) <= pg UNION ALL SELECT doc, n, max(pg) + 1, cut - 1, 0.60 FROM e_ GROUP BY doc, n, cut HAVING max(pg) + 1 < cut),
t_ AS (SELECT i.*, coalesce(b.s, 0) AS session, CASE WHEN k.r = 6 THEN '번호가 붙은 제목 ' || i.a ELSE '본문 첫 문장 ' || i.a || ' 쪽이 이어진다' END AS title FROM i_ i JOIN k_ k ON k.doc = i.doc AND k.pg = i.a LEFT JOIN b_ b ON b.doc = i.doc AND i.a BETWEEN b.x AND b.y),
q_ AS (SELECT doc, 0 AS session, 1 AS a, opening - 1 AS b, '표지' AS title FROM d_ WHERE opening > 1 UNION ALL SELECT doc, 0, cut, n, '시험문제_원본' FROM d_ WHERE cut <= n),
{RESULT.format(fmt="'AIRIPO'")}""")
def format_airipo(spark, sf_dir):
    """Sessions by headers with gaps closed; a cover in front, the original paper behind the cut."""
    return told(signal_engine.formatted(_headed(spark, sf_dir)))


NOISE_MARKS = {
    (0,): [("paragraph", "출제 빈도 {pg}")],
    (1, 2): [("paragraph", "1. 무엇인가를 길게 설명하시오 {pg}"), ("paragraph", "2. 그것과 이것을 비교하시오 {pg}")],
    (2, 5): [("paragraph", "I. 여는 절의 개요 {pg}")],
    (3,): [("table_marker", ""), ("table_marker", "")],
    (4,): [("paragraph", f"줄 {k} {{pg}}") for k in range(8)],
}


#: A page's own lines stand between "· " and " ·": long from 27 characters on, short up to 6. Of the first ten pages statistics reach on to the first page with a sign.
@query(f"""WITH {PAGES}, k_ AS (SELECT doc, pg, length(text) % {ROLES} AS r, max(pg) OVER (PARTITION BY doc) AS n, string_split(text, chr(10)) AS ls FROM pages_),
c_ AS (SELECT doc, pg, r, len(list_filter(ls, lambda x: length(x) > 26)) AS n_long, len(list_filter(ls, lambda x: length(x) <= 6)) + CASE r WHEN 4 THEN 8 WHEN 3 THEN 2 ELSE 0 END AS n_short FROM k_),
f_ AS (SELECT *, r = 0 AS stat, r IN (2, 5) AS sign, r = 1 AS listed, (r = 3 AND n_long = 0) OR (n_short >= 8 AND n_long <= 1) AS tab FROM c_),
w_ AS (SELECT *, max(CASE WHEN stat AND pg - 1 < 10 THEN pg END) OVER d AS early, min(CASE WHEN sign THEN pg END) OVER d AS first_sign FROM f_ WINDOW d AS (PARTITION BY doc))
SELECT doc AS doc_id, pg AS page FROM w_ WHERE stat OR listed OR tab OR coalesce(first_sign > early AND pg < first_sign, false)""")
def noise_blocks(spark, sf_dir):
    """A5: pages of statistics, lists of questions and tables."""
    p = staged(signal_engine.page_flags(titles.marked(page_elements(spark, sf_dir, NOISE_MARKS)).withColumn("repeated", F.lit(False))))  # lines of one page are on others, too
    return signal_engine.noise_pages(signal_engine.in_blocks(p, signal_engine.sessions(p))).where("noise").select("doc_id", F.col("page").cast("long").alias("page"))


SIGNS = {
    (0,): [("paragraph", "국가기술자격 시험문제")],
    (1,): [("paragraph", "끝")],
    (2,): [("paragraph", "기출풀이 의견")],
    (3,): [("paragraph", "I. 로마 절의 제목 {pg}")],
    (4,): [("paragraph", "II. 다음 절의 제목 {pg}")],
    (5,): [("paragraph", "문 제 3. 카드의 제목 {pg}\n둘째 줄")],
    (6,): [("heading", "1. 첫 번호의 머리글 {pg}")],
    (7,): [("paragraph", "4. 보안 위협을 설명하시오 {pg}")],
    (8,): [("heading", "큰 글자로 쓴 여러 제목 {pg}", False, 1.6)],
    (9,): [("paragraph", "■ 표시가 붙은 제목 {pg}")],
    (10,): [("paragraph", "★★★☆☆")],
    (11,): [("paragraph", "2교시: 3번 문제의 글 {pg}")],
    (12,): [("paragraph", "3교시", True), ("paragraph", "5 번", True)],
    (13,): [("paragraph", "IT trends 클라우드 | PM 그 밖의 글 {pg}")],
    (14,): [("paragraph", "나. 둘째 소제목의 글 {pg}")],
    (15,): [("paragraph", "가. 첫째 소제목의 글 {pg}")],
    (16,): [("paragraph", "3일차 과정의 글 {pg}")],
    (17,): [("paragraph", "기술사 제 137 회 제 2 교시 글 {pg}")],
    (18,): [("paragraph", "출제 빈도 {pg}")],
    (19,): [("table_marker", ""), ("table_marker", "")],
}
FLAGS = ["cover", "end", "topic_end", "roman_beyond", "asks", "asks_numbered", "answers", "sign", "split_cells", "stat_noise"]
COUNTS = ["n_roman", "n_menti", "n_first", "n_questions", "n_font", "n_mark", "n_star", "n_session_topic", "n_tables"]
NUMBERS = ["heading_number", "any_number", "kr", "session_no", "day_no", "caption_no"]
TEXTS = ["roman_title", "menti_title", "question_title", "opening", "said", "font_title", "mark_title", "keyword", "kr_title"]


#: Short lines that many pages of a document share count as its headers, and not as answers.
@query(f"""WITH {PAGES}, k_ AS (SELECT doc, pg, length(text) % 20 AS r, max(pg) OVER (PARTITION BY doc) AS n FROM pages_), x_ AS (SELECT *, count(*) OVER (PARTITION BY doc, r) >= greatest(3.0, 0.15 * n) AS header FROM k_)
SELECT doc AS doc_id, pg AS page, r = 0 AS cover, r = 1 AS "end", r = 2 AS topic_end, r = 4 AS roman_beyond, r = 7 AS asks, r = 7 AS asks_numbered, r = 3 OR (r IN (1, 10) AND NOT header) AS answers, r IN (3, 5, 11, 17) AS sign, r = 12 AS split_cells, r = 18 AS stat_noise,
  CAST(r = 3 AS BIGINT) AS n_roman, CAST(r = 5 AS BIGINT) AS n_menti, CAST(r = 6 AS BIGINT) AS n_first, CAST(r = 7 AS BIGINT) AS n_questions, CAST(r = 8 AS BIGINT) AS n_font, CAST(r = 9 AS BIGINT) AS n_mark, CAST(r = 10 AS BIGINT) AS n_star, CAST(r = 11 AS BIGINT) AS n_session_topic, 2 * CAST(r = 19 AS BIGINT) AS n_tables,
  CASE r WHEN 6 THEN 1 END AS heading_number, CASE r WHEN 6 THEN 1 WHEN 7 THEN 4 END AS any_number, CASE r WHEN 14 THEN 1 WHEN 15 THEN 0 END AS kr, CASE r WHEN 11 THEN 2 WHEN 12 THEN 3 WHEN 17 THEN 2 END AS session_no, CASE r WHEN 16 THEN 3 END AS day_no, CASE r WHEN 17 THEN 2 END AS caption_no,
  CASE r WHEN 3 THEN '로마 절의 제목 ' || pg END AS roman_title, CASE r WHEN 5 THEN '카드의 제목 ' || pg END AS menti_title, CASE r WHEN 7 THEN '4. 보안 위협을 설명하시오 ' || pg END AS question_title, CASE r WHEN 3 THEN '로마 절의 제목 ' || pg WHEN 5 THEN '카드의 제목 ' || pg END AS opening,
  CASE r WHEN 3 THEN '로마 절의 제목 ' || pg WHEN 5 THEN '카드의 제목 ' || pg WHEN 6 THEN '첫 번호의 머리글 ' || pg WHEN 8 THEN '큰 글자로 쓴 여러 제목 ' || pg END AS said, CASE r WHEN 8 THEN '큰 글자로 쓴 여러 제목 ' || pg END AS font_title, CASE r WHEN 9 THEN '■ 표시가 붙은 제목 ' || pg END AS mark_title,
  CASE r WHEN 13 THEN '클라우드' END AS keyword, CASE r WHEN 14 THEN '둘째 소제목의 글 ' || pg WHEN 15 THEN '첫째 소제목의 글 ' || pg END AS kr_title FROM x_""")
def page_signs(spark, sf_dir):
    """What each of twenty marks says of its page: the flags, counts, numbers and titles that all signals are made of."""
    p = signal_engine.page_flags(titles.marked(page_elements(spark, sf_dir, SIGNS, roles=20)))
    return p.select("doc_id", F.col("page").cast("long").alias("page"), *FLAGS, *[F.col(c).cast("long").alias(c) for c in COUNTS], *NUMBERS, *TEXTS)
