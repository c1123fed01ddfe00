"""The topic engines over the documents' own lines.

The tables hold no Korean exam text, so marks of that profile stand among the
lines of each page: a page opens a topic, the next one ends it. Topics then
follow from ids alone, and SQL can say what has to come out; the pages' own
lines have to leave that as it is.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cascade, line_engine, postprocess, signal_engine
from ..sources.tables import text_pages
from .registry import query
from .text_queries import PAGES

#: Stands before a page's own lines, so that none is short enough for a header or a table's cell.
OWN = "이 쪽에 그대로 있는 본문의 한 줄: "


def marked_elements(spark, sf_dir):
    """Pages as elements: odd pages open a topic, even ones end it; between stand all of the page's own lines."""
    pages = text_pages(spark, sf_dir)
    odd = F.col("pg") % 2 == 1
    own = F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit(OWN), x))
    marks = F.concat(F.array(F.when(odd, F.concat(F.lit("I. 토픽 "), F.col("pg").cast("string"), F.lit(" 개요"))).otherwise(F.lit("본문이 이어지는 문장이다"))), own, F.array(F.when(odd, F.lit("설명이 길게 이어지는 문장이다")).otherwise(F.lit("끝"))))
    rows = pages.select(F.col("doc").alias("doc_id"), F.col("pg").cast("int").alias("page"), F.posexplode(marks).alias("elem_idx", "content"))
    return rows.select("doc_id", "page", "elem_idx", F.lit("paragraph").alias("type"), "content", F.lit(1.0).alias("font_ratio"), F.lit(False).alias("is_table_cell"), F.lit(None).cast("string").alias("source"))


#: Topics of two pages; the end of the text closes an odd last page.
PAIRS = f"WITH {PAGES}, n_ AS (SELECT doc, max(pg) AS n FROM pages_ GROUP BY doc), p_ AS (SELECT doc, n, unnest(range(1, n + 1, 2)) AS s FROM n_)"


#: The first topic follows no end: its one signal counts for six tenths. Documents have six pages or more, and at most 31 topics.
@query(f"""{PAIRS}, c_ AS (SELECT doc, n, s, (n + 1) // 2 AS starts, n // 2 AS ends FROM p_), w_ AS (SELECT *, least(ends / 10.0, 1.0) / least(starts / 10.0, 1.0) AS w FROM c_)
SELECT doc AS doc_id, (s + 1) // 2 AS num, s AS page_start, least(s + 1, n) AS page_end, CAST(round(CASE WHEN s = 1 THEN 6.0 / (10 * w + 10) ELSE 1.0 END, 6) AS DOUBLE) AS confidence, '토픽 ' || CAST(s AS VARCHAR) || ' 개요' AS title FROM w_""")
def signal_boundaries(spark, sf_dir):
    """Weighted signals, at most the expected number of topics a document."""
    return signal_engine.boundaries(marked_elements(spark, sf_dir)).select("doc_id", F.col("num"), F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"), "confidence", "title")


#: By format where a document has ten ends, else by signals: page for page the same topics.
@query(f"{PAIRS} SELECT doc AS doc_id, s AS page_start, least(s + 1, n) AS page_end, CASE WHEN n // 2 >= 10 THEN 'ITPE' ELSE 'topic' END AS fmt FROM p_ WHERE n // 2 < 10 OR s + 1 <= n")
def detected_topics(spark, sf_dir):
    found = signal_engine.detect(marked_elements(spark, sf_dir))
    return found.select("doc_id", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"), "fmt")


def marked_lines(spark, sf_dir):
    pages = text_pages(spark, sf_dir)
    number = (F.floor((F.col("pg") - 1) / 2) % 12 + 1).cast("string")
    opens = F.array(F.lit("누구나 ICT"), F.lit("문제"), F.concat(number, F.lit(". 토픽 제목입니다")), F.lit("도메인"), F.lit("본문"))
    marks = F.when(F.col("pg") % 2 == 1, opens).otherwise(F.array(F.lit("누구나 ICT"), F.lit("본문 내용입니다"), F.lit("계속")))
    lines = F.concat(marks, F.split("text", "\n", -1))
    return pages.select(F.col("doc").alias("doc_id"), F.col("pg").cast("int").alias("page"), lines.alias("lines"))


#: Numbers run from 1 to 12 and start again: that is the next session, which has no numbers above 8.
@query(f"""{PAIRS}, k_ AS (SELECT doc, n, s, (s - 1) // 2 % 12 + 1 AS num, (s - 1) // 24 + 1 AS session FROM p_), t_ AS (SELECT * FROM k_ WHERE session = 1 OR num <= 8)
SELECT doc AS doc_id, CAST(session AS INTEGER) AS session, CAST(num AS INTEGER) AS num, '토픽 제목입니다' AS title, s AS page_start, coalesce(lead(s) OVER (PARTITION BY doc ORDER BY s) - 1, n) AS page_end FROM t_""")
def line_topics(spark, sf_dir):
    """Line signals to rising numbers, session by session."""
    found = line_engine.topics(marked_lines(spark, sf_dir))
    return found.select("doc_id", "session", "num", "title", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"))


@query(f"{PAIRS}, g_ AS (SELECT doc, n, s, (s - 1) // 2 AS k FROM p_) SELECT doc AS doc_id, min(s) AS page_start, max(least(s + 1, n)) AS page_end FROM g_ GROUP BY doc, k // 3")
def merged_titles(spark, sf_dir):
    """Intervals of one title join where they are near; every three in a row share one."""
    pages = text_pages(spark, sf_dir)
    last = pages.groupBy("doc").agg(F.max("pg").alias("n"))
    starts = pages.where("pg % 2 = 1").join(last, "doc")
    k = F.floor((F.col("pg") - 1) / 2)
    table_ = starts.select(F.col("doc").alias("doc_id"), (k + 1).cast("int").alias("num"), F.concat((F.floor(k / 3) + 1000).cast("string"), F.lit(" topic (x)")).alias("title"), F.col("pg").cast("int").alias("page_start"), F.least(F.col("pg") + 1, F.col("n")).cast("int").alias("page_end"), F.lit(1).alias("session"), F.lit(1.0).alias("confidence"))
    return postprocess.merge_titles(table_).select("doc_id", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"))


#: SQL: what a document is by its name, 0 to 4, and its pages that open a topic, s, numbered k from 0.
KINDS = f"{PAIRS}, kinds_ AS (SELECT doc, n, s, (s - 1) // 2 AS k, (unicode(right(split_part(doc, '#', 1), 1)) + CAST(split_part(doc, '#', 2) AS BIGINT)) % 5 AS kind FROM p_)"


def segmented(spark, sf_dir):
    """Documents of five kinds: mock papers of two publishers, numbered lines, none of these, and a past exam whose numbers don't fit its counts."""
    pages = text_pages(spark, sf_dir)
    name = F.split("doc", "#")
    kind = (F.ascii(F.substring(name[0], -1, 1)) + name[1].cast("long")) % 5
    odd, k = F.col("pg") % 2 == 1, F.floor((F.col("pg") - 1) / 2)
    number = lambda n: (k % n + 1).cast("string")
    page, text = F.col("pg").cast("string"), lambda *xs: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    title = F.concat(F.lit("토픽 제목 "), page)
    itpe = F.concat(text("제 41 회 ITPE 실전 명품 모의고사 해설집", page), F.when(odd, text(number(12), "분야", "문제", title, "도메인")).otherwise(text("본문이 이어진다")))
    kpc = F.concat(text("KPC 기술사 IMPACT 실전 모의고사"), F.when(odd, text("문", "제", F.concat(number(12), F.lit(". "), title), "출제영역")).otherwise(text("본문이 이어진다")))
    numbered = lambda head, n: F.concat(text(head), F.when(odd, text("문제", F.concat(number(n), F.lit(". 토픽 제목입니다")), "도메인", "본문")).otherwise(text("본문 내용입니다", "계속")))
    marks = F.when(kind == 0, itpe).when(kind == 1, kpc).when(kind == 2, numbered("누구나 ICT", 12)).when(kind == 3, text("본문 내용입니다")).otherwise(numbered("ITPE 실전 명품 기출문제", 5))
    own = F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit(OWN), x))
    lines = pages.select(F.col("doc").alias("doc_id"), F.col("pg").cast("int").alias("page"), F.concat(marks, own).alias("lines"))
    return cascade.segmented(lines, marked_elements(spark, sf_dir))


#: Sessions start where numbers do; the last one takes all that follow. Numbered lines drop what a later session has no room for. Too few numbered topics, and the other kinds, are left to the elements.
@query(f"""{KINDS}, e_ AS (SELECT *, lead(s) OVER (PARTITION BY doc ORDER BY s) AS nxt FROM kinds_),
few_ AS (SELECT doc FROM kinds_ WHERE kind = 2 GROUP BY doc HAVING count(*) < 5),
a_ AS (SELECT doc, CASE kind WHEN 0 THEN 'itpe_mock' ELSE 'kpc_mock' END AS engine, least(k // 12 + 1, 4) AS session, k % 12 + 1 AS num, '토픽 제목 ' || s AS title, s AS page_start, coalesce(nxt - 1, n) AS page_end FROM e_ WHERE kind <= 1),
l_ AS (SELECT doc, 'lines' AS engine, k // 12 + 1 AS session, k % 12 + 1 AS num, '토픽 제목입니다' AS title, s AS page_start, coalesce(lead(s) OVER (PARTITION BY doc ORDER BY s) - 1, n) AS page_end FROM e_ WHERE kind = 2 AND doc NOT IN (SELECT doc FROM few_) AND (k < 12 OR k % 12 + 1 <= 8)),
v_ AS (SELECT doc, 'elements' AS engine, 0 AS session, k + 1 AS num, '토픽 ' || s || ' 개요' AS title, s AS page_start, least(s + 1, n) AS page_end FROM e_ WHERE (kind >= 3 OR doc IN (SELECT doc FROM few_)) AND (n // 2 < 10 OR s + 1 <= n))
SELECT doc AS doc_id, engine, CAST(session AS INTEGER) AS session, CAST(num AS INTEGER) AS num, title, page_start, page_end FROM (SELECT * FROM a_ UNION ALL SELECT * FROM l_ UNION ALL SELECT * FROM v_)""")
def engine_cascade(spark, sf_dir):
    """Each document by the first of four engines that takes it."""
    found, _ = segmented(spark, sf_dir)
    return found.select("doc_id", "engine", "session", "num", "title", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"))


@query(f"""{KINDS}, d_ AS (SELECT doc, any_value(kind) AS kind, count(*) AS t FROM kinds_ GROUP BY doc), s_ AS (SELECT unnest([1, 2, 3, 4]) AS s, unnest([13, 6, 6, 6]) AS want),
c_ AS (SELECT doc, s, want, greatest(0, least(5, t - 5 * (s - 1))) AS have FROM d_, s_ WHERE kind = 4),
w_ AS (SELECT doc, 'counts ' || string_agg(CAST(s AS VARCHAR) || ':' || have || '/' || want, ' ' ORDER BY s) AS reason FROM c_ WHERE have > 0 AND abs(have - want) > 2 GROUP BY doc),
r_ AS (SELECT d.doc, kind, t, CASE WHEN kind = 2 AND t < 5 THEN 'few topics ' || t WHEN kind = 2 THEN '' WHEN kind = 3 THEN 'no candidates' ELSE reason END AS said FROM d_ d LEFT JOIN w_ USING (doc)),
all_ AS (SELECT doc, 1 AS step, 'itpe_mock' AS engine, CASE kind WHEN 0 THEN '' ELSE 'not admitted' END AS reason FROM r_ UNION ALL SELECT doc, 2, 'kpc_mock', CASE kind WHEN 1 THEN '' ELSE 'not admitted' END FROM r_ WHERE kind <> 0
  UNION ALL SELECT doc, 3, 'lines', said FROM r_ WHERE kind >= 2 UNION ALL SELECT doc, 4, 'elements', '' FROM r_ WHERE kind >= 2 AND said <> '')
SELECT doc AS doc_id, CAST(step AS INTEGER) AS step, engine, reason = '' AS ok, reason FROM all_""")
def engine_verdicts(spark, sf_dir):
    """What each engine said of the documents that were left to it."""
    return segmented(spark, sf_dir)[1]
