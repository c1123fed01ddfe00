"""Splitters and paper operators over the documents' own lines.

The tables hold no Korean exam text, so a line's length says which mark of that
profile stands in its place; lines of other lengths stay as they are. Operators
and SQL read the same lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import order as O
from ..operators import papers as P
from ..operators import splitters as S
from ..sources.tables import table, text_pages
from .registry import query
from .text_queries import LINES

#: Length modulo 16 to a mark; {a} is a number below 16, {b} the line's beginning.
MARKS = {0: "문제", 1: "{nn}", 2: "도메인", 3: "{q}. {b}", 4: "출제의도", 5: "제 {s} 교시 (시험시간", 6: "문", 7: "제 {q}. {b}", 8: "제", 9: "다음 문제 중 10문제를 선택"}
MARKED = LINES + """, marked_ AS (SELECT doc, pg, elem_idx - 1 AS idx, CASE length(line) % 16 WHEN 0 THEN '문제' WHEN 1 THEN lpad(CAST(length(line) // 16 % 16 + 1 AS VARCHAR), 2, '0') WHEN 2 THEN '도메인'
WHEN 3 THEN CAST(length(line) // 16 % 13 + 1 AS VARCHAR) || '. ' || trim(substring(line, 1, 20)) WHEN 4 THEN '출제의도' WHEN 5 THEN '제 ' || CAST(length(line) // 16 % 4 + 1 AS VARCHAR) || ' 교시 (시험시간' WHEN 6 THEN '문'
WHEN 7 THEN '제 ' || CAST(length(line) // 16 % 13 + 1 AS VARCHAR) || '. ' || trim(substring(line, 1, 20)) WHEN 8 THEN '제' WHEN 9 THEN '다음 문제 중 10문제를 선택' ELSE trim(line) END AS line FROM lines_),
size_ AS (SELECT doc, pg, sum(length(line)) + count(*) - 1 AS chars FROM marked_ GROUP BY doc, pg), end_ AS (SELECT doc, max(pg) AS last FROM pages_ GROUP BY doc)"""
ON_PAGE = "PARTITION BY doc, pg ORDER BY idx"


def marked_line(x):
    n = F.length(x)
    k, d = n % 16, F.floor(n / 16)
    begin = F.trim(F.substring(x, 1, 20))
    fill = {"nn": F.lpad((d % 16 + 1).cast("string"), 2, "0"), "q": (d % 13 + 1).cast("string"), "s": (d % 4 + 1).cast("string"), "b": begin}
    out = F.trim(x)
    for at, mark in MARKS.items():
        parts = [fill[p] if p in fill else F.lit(p) for p in mark.replace("{", "\0").replace("}", "\0").split("\0") if p]
        out = F.when(k == at, F.concat(*parts)).otherwise(out)
    return out


def marked_pages(spark, sf_dir):
    """text_pages with marks for lines: doc_id, page, text."""
    text = F.array_join(F.transform(F.split("text", "\n", -1), marked_line), "\n")
    return text_pages(spark, sf_dir).select(F.col("doc").alias("doc_id"), F.col("pg").alias("page"), text.alias("text"))


FITS = "length({c}) BETWEEN 2 AND 120 AND NOT starts_with({c}, '-') AND NOT regexp_matches({c}, '^[0-9]+$')"


@query(f"""WITH {MARKED}, w_ AS (SELECT m.*, lag(line, 1) OVER ({ON_PAGE}) AS one, lag(line, 2) OVER ({ON_PAGE}) AS two, list(line) OVER ({ON_PAGE} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS ahead,
list(line) OVER ({ON_PAGE} ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS ctx FROM marked_ m JOIN size_ USING (doc, pg) WHERE pg > 3 AND chars >= 50),
t_ AS (SELECT *, array_to_string(ctx, chr(10)) AS context, list_transform(ahead, lambda x: starts_with(x, '도메인') OR starts_with(x, '출제영역')) AS stops, CASE WHEN {FITS.format(c="one")} AND NOT starts_with(one, '•') THEN one WHEN {FITS.format(c="two")} THEN two END AS title FROM w_ WHERE line = '문제'),
q_ AS (SELECT * FROM t_ WHERE title IS NOT NULL AND (contains(context, '도메인') OR contains(context, '출제영역')))
SELECT doc AS doc_id, title, coalesce(substring(array_to_string(CASE WHEN list_contains(stops, true) THEN list_slice(ahead, 1, list_position(stops, true) - 1) ELSE ahead END, ' '), 1, 200), '') AS question,
trim(regexp_extract(context, '(?:도메인|출제영역)\\s*\\n\\s*(.+)', 1)) AS domain, pg AS page_start, CASE WHEN lead(pg) OVER v IS NULL THEN last ELSE greatest(lead(pg) OVER v - 1, pg) END AS page_end
FROM q_ JOIN end_ USING (doc) WINDOW v AS (PARTITION BY doc ORDER BY pg, idx)""")
def textbook_questions(spark, sf_dir):
    return S.textbook_questions(marked_pages(spark, sf_dir)).select("doc_id", "title", "question", "domain", "page_start", "page_end")


@query(f"""WITH {MARKED}, w_ AS (SELECT m.*, list(line) OVER ({ON_PAGE} ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) AS ahead, array_to_string(list(line) OVER ({ON_PAGE} ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), chr(10)) AS context FROM marked_ m JOIN size_ USING (doc, pg) WHERE chars >= 30),
t_ AS (SELECT *, TRY_CAST(line AS INTEGER) AS number, list_filter(ahead, lambda x: length(x) > 1 AND NOT regexp_matches(x, '^[0-9]+$')) AS topics FROM w_ WHERE idx < 25 AND regexp_matches(line, '^[0-9][0-9]$')),
f_ AS (SELECT *, row_number() OVER ({ON_PAGE}) AS rn FROM t_ WHERE number BETWEEN 1 AND 16 AND len(topics) > 0 AND contains(context, '도메인'))
SELECT doc AS doc_id, number, topics[1] AS topic, trim(regexp_extract(context, '도메인\\s*[:\\n]\\s*(.+)', 1)) AS domain, pg AS page_start, CASE WHEN lead(pg) OVER v IS NULL THEN last ELSE greatest(lead(pg) OVER v - 1, pg) END AS page_end
FROM f_ JOIN end_ USING (doc) WHERE rn = 1 WINDOW v AS (PARTITION BY doc ORDER BY pg)""")
def mock_questions(spark, sf_dir):
    return S.mock_questions(marked_pages(spark, sf_dir)).select("doc_id", "number", "topic", "domain", "page_start", "page_end")


SESSIONS = MARKED + """, page_ AS (SELECT doc, pg, string_agg(line, chr(10) ORDER BY idx) AS text FROM marked_ GROUP BY doc, pg),
named_ AS (SELECT doc, pg, TRY_CAST(regexp_extract(text, '([0-9])\\s*교시', 1) AS INTEGER) AS session, text FROM page_),
first_ AS (SELECT doc, session, min(pg) AS s FROM named_ WHERE session IS NOT NULL AND (contains(text, '문제 중') OR contains(text, '선택')) GROUP BY doc, session),
sessions_ AS (SELECT doc, session, s, coalesce(lead(s) OVER (PARTITION BY doc ORDER BY session) - 1, last) AS e FROM first_ JOIN end_ USING (doc))"""


@query(f"WITH {SESSIONS} SELECT doc AS doc_id, session, s AS start, e AS \"end\" FROM sessions_")
def exam_sessions(spark, sf_dir):
    return S.exam_sessions(marked_pages(spark, sf_dir))


PROBLEMS = SESSIONS + """, asked_ AS (SELECT doc, pg, idx, line, session, contains(line, '문제 중') OR contains(line, '선택') AS marker, coalesce(bool_or(contains(line, '문제 중') OR contains(line, '선택')) OVER (PARTITION BY doc, pg ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS after
  FROM marked_ JOIN sessions_ USING (doc) WHERE pg = s),
listed_ AS (SELECT doc, session, idx, TRY_CAST(regexp_extract(line, '^([0-9]{1,2})\\.\\s+(.+)', 1) AS INTEGER) AS number, trim(regexp_extract(line, '^([0-9]{1,2})\\.\\s+(.+)', 2)) AS title FROM asked_ WHERE after AND NOT marker),
found_ AS (SELECT doc, session, number, arg_max(title, idx) AS title FROM listed_ WHERE number IS NOT NULL AND length(title) > 1 GROUP BY doc, session, number),
expected_ AS (SELECT doc, session, CAST(unnest(range(1, CASE WHEN session = 1 THEN 14 ELSE 7 END)) AS INTEGER) AS number FROM sessions_),
problems_ AS (SELECT doc, session, number, coalesce(title, 'Q' || CAST(number AS VARCHAR)) AS title FROM expected_ FULL JOIN found_ USING (doc, session, number))"""


@query(f"WITH {PROBLEMS} SELECT doc AS doc_id, session, number, title FROM problems_")
def exam_problems(spark, sf_dir):
    pages = marked_pages(spark, sf_dir)
    return S.exam_problems(pages, S.exam_sessions(pages))


IN_SESSION = "JOIN sessions_ s_ USING (doc) WHERE pg > s_.s AND pg <= s_.e"
CLOSED = "closed_ AS (SELECT doc, session, number, title, pg, coalesce(lead(pg) OVER (PARTITION BY doc, session ORDER BY pg, idx) - 1, e) AS page_end FROM starts_) SELECT doc AS doc_id, session, number, title, pg AS page_start, page_end FROM closed_ WHERE page_end >= pg"


@query(f"""WITH {PROBLEMS}, l_ AS (SELECT *, list(line) OVER ({ON_PAGE} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS prev FROM marked_),
n_ AS (SELECT doc, pg, idx, CASE WHEN regexp_matches(line, '^제\\s*[0-9]{{1,2}}\\.\\s+.+') THEN TRY_CAST(regexp_extract(line, '^제\\s*([0-9]{{1,2}})\\.', 1) AS INTEGER)
  WHEN list_contains(prev, '문제') OR len(list_filter(range(1, len(prev)), lambda i: prev[i] = '문' AND starts_with(prev[i + 1], '제'))) > 0 THEN TRY_CAST(regexp_extract(line, '^([0-9]{{1,2}})\\.\\s+.+', 1) AS INTEGER) END AS number FROM l_ WHERE idx < 20),
m_ AS (SELECT n_.*, s_.session, s_.e FROM n_ {IN_SESSION} AND number IS NOT NULL),
starts_ AS (SELECT m_.doc, m_.session, m_.number, p.title, pg, idx, e FROM (SELECT *, row_number() OVER (PARTITION BY doc, session, number ORDER BY pg, idx) AS rn FROM m_) m_ JOIN problems_ p ON p.doc = m_.doc AND p.session = m_.session AND p.number = m_.number WHERE rn = 1), {CLOSED}""")
def kpc_exam(spark, sf_dir):
    pages = marked_pages(spark, sf_dir)
    sessions = S.exam_sessions(pages)
    # Two questions of one page stand in the order of their lines.
    return S.kpc_exam(pages, sessions, S.exam_problems(pages, sessions))


@query(f"""WITH {PROBLEMS}, l_ AS (SELECT *, list(line) OVER ({ON_PAGE} ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) AS nxt FROM marked_),
n_ AS (SELECT doc, pg, idx, TRY_CAST(line AS INTEGER) AS number, coalesce(list_filter(list_slice(nxt, 1, 3), lambda x: length(x) > 3 AND x <> '문제')[1], '') AS title FROM l_ WHERE idx < 10 AND regexp_matches(line, '^[0-9][0-9]$') AND list_contains(nxt, '문제')),
m_ AS (SELECT n_.*, s_.session, s_.e FROM n_ {IN_SESSION}), o_ AS (SELECT m_.* FROM m_ SEMI JOIN problems_ USING (doc, session, number)),
b_ AS (SELECT doc, session, e, pg, arg_max(number, idx) AS number, arg_max(title, idx) AS title FROM o_ GROUP BY doc, session, e, pg),
r_ AS (SELECT *, count(*) OVER (PARTITION BY doc, session) = CASE WHEN session = 1 THEN 13 ELSE 6 END AS whole, row_number() OVER (PARTITION BY doc, session ORDER BY pg) AS place, row_number() OVER (PARTITION BY doc, session, number ORDER BY pg) AS again FROM b_),
k_ AS (SELECT doc, session, e, pg, whole, title, CAST(CASE WHEN whole THEN place ELSE number END AS INTEGER) AS number FROM r_ WHERE whole OR again = 1),
starts_ AS (SELECT k_.doc, k_.session, k_.number, CASE WHEN whole THEN coalesce(p.title, k_.title) ELSE k_.title END AS title, pg, 0 AS idx, e FROM k_ LEFT JOIN problems_ p ON p.doc = k_.doc AND p.session = k_.session AND p.number = k_.number), {CLOSED}""")
def itpe_exam(spark, sf_dir):
    pages = marked_pages(spark, sf_dir)
    sessions = S.exam_sessions(pages)
    return S.itpe_exam(pages, sessions, S.exam_problems(pages, sessions))


FORMATS = MARKED + """, page_ AS (SELECT doc, pg, string_agg(line, chr(10) ORDER BY idx) AS text FROM marked_ GROUP BY doc, pg),
one_ AS (SELECT doc, regexp_replace(text, '\\s+', '', 'g') AS flat, len(regexp_extract_all(text, '(?m)^[0-9]{1,2}\\.\\s+')) AS numbers FROM page_ WHERE pg = 1),
sum_ AS (SELECT doc, max(pg) AS pages, sum(CASE WHEN pg <= 5 THEN length(trim(text)) ELSE 0 END) AS chars FROM page_ GROUP BY doc),
formats_ AS (SELECT doc, pages, CASE WHEN pages = 1 THEN 'problem_only' WHEN chars < 200 AND pages > 3 THEN 'sparse' WHEN contains(flat, '문제중') AND contains(flat, '선택') AND numbers >= 4 THEN 'standard'
WHEN contains(flat, '문제중') AND contains(flat, '선택') AND contains(flat, '출제의도') THEN 'inline' WHEN contains(flat, '문제중') AND contains(flat, '선택') THEN 'standard' ELSE 'bare' END AS format FROM sum_ JOIN one_ USING (doc))"""


@query(f"WITH {FORMATS} SELECT doc AS doc_id, pages, format FROM formats_")
def review_format(spark, sf_dir):
    return S.review_format(marked_pages(spark, sf_dir)).select("doc_id", "pages", "format")


LISTED = FORMATS + """, num_ AS (SELECT m.doc, m.pg, m.idx, f.format, chars, contains(line, '문제 중') AND contains(line, '선택') AS marker, TRY_CAST(regexp_extract(line, '^([0-9]{1,2})\\.\\s+(.+)', 1) AS INTEGER) AS number, trim(regexp_extract(line, '^([0-9]{1,2})\\.\\s+(.+)', 2)) AS title,
  coalesce(bool_or(contains(line, '문제 중') AND contains(line, '선택')) OVER (PARTITION BY m.doc, m.pg ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS after, line FROM marked_ m JOIN formats_ f USING (doc) JOIN size_ USING (doc, pg)),
ctx_ AS (SELECT *, coalesce(bool_or(contains(line, '출제의도') AND after AND NOT marker) OVER (PARTITION BY doc, pg ORDER BY idx), false) AS intent, array_to_string(list(line) OVER (PARTITION BY doc, pg ORDER BY idx ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), chr(10)) AS context FROM num_),
std_ AS (SELECT *, min(pg) OVER (PARTITION BY doc) AS fp FROM ctx_ WHERE format = 'standard' AND pg <= 2 AND after AND NOT marker AND number IS NOT NULL),
steps_ AS (SELECT doc, number, title, row_number() OVER (PARTITION BY doc ORDER BY idx) AS rn FROM ctx_ WHERE format = 'inline' AND pg = 1 AND after AND NOT marker AND NOT intent AND number IS NOT NULL),
walk_ AS (SELECT doc, rn, number AS last, true AS kept FROM steps_ WHERE rn = 1 UNION ALL SELECT s.doc, s.rn, CASE WHEN s.number = w.last + 1 THEN s.number ELSE w.last END, s.number = w.last + 1 FROM walk_ w JOIN steps_ s ON s.doc = w.doc AND s.rn = w.rn + 1),
inline_ AS (SELECT s.doc, s.number, s.title FROM walk_ w JOIN steps_ s USING (doc, rn) WHERE kept),
bare_ AS (SELECT * FROM ctx_ WHERE format <> 'standard' AND doc NOT IN (SELECT doc FROM inline_) AND chars >= 30 AND idx < 8 AND number IS NOT NULL AND length(title) > 3 AND (contains(context, '출제의도') OR contains(context, '회 ') OR contains(context, 'Keyword') OR contains(context, '풀이'))),
probs_ AS (SELECT doc, number, arg_max(title, idx) AS title FROM std_ WHERE pg = fp GROUP BY doc, number UNION ALL SELECT doc, number, title FROM inline_ UNION ALL SELECT doc, number, arg_min(title, pg * 100000 + idx) FROM bare_ GROUP BY doc, number)"""


@query(f"WITH RECURSIVE {LISTED} SELECT doc AS doc_id, number, title FROM probs_")
def review_problems(spark, sf_dir):
    """the problems that each review lists, by its format; an inline list as far as its numbers follow each other."""
    pages = marked_pages(spark, sf_dir)
    return S.review_problems(pages, S.review_format(pages))


@query(f"""WITH RECURSIVE {LISTED}, s_ AS (SELECT c.doc, c.number, p.title, c.pg, c.idx, CASE WHEN contains(context, '출제의도') OR contains(context, '작성방안') THEN 10 ELSE 0 END + CASE WHEN c.idx < 10 THEN 3 ELSE 0 END
+ CASE WHEN trim(regexp_replace(p.title, '[(\\[（].*?[)\\]）]', '', 'g')) <> '' AND substring(trim(regexp_replace(p.title, '[(\\[（].*?[)\\]）]', '', 'g')), 1, 5) = substring(trim(regexp_replace(c.title, '[(\\[（].*?[)\\]）]', '', 'g')), 1, 5) THEN 5 ELSE 0 END AS score
FROM ctx_ c JOIN probs_ p ON p.doc = c.doc AND p.number = c.number WHERE c.chars >= 30 AND (c.pg > 1 OR c.format IN ('inline', 'bare'))),
b_ AS (SELECT *, row_number() OVER (PARTITION BY doc, number ORDER BY score DESC, pg, idx) AS rn FROM s_ WHERE score >= 3),
k_ AS (SELECT b_.*, lead(pg) OVER (PARTITION BY doc ORDER BY pg, idx) AS nxt FROM b_ WHERE rn = 1),
e_ AS (SELECT k_.*, coalesce(CASE WHEN nxt > pg THEN nxt - 1 ELSE nxt END, last) AS pe FROM k_ JOIN end_ USING (doc))
SELECT e_.doc AS doc_id, number, title, score, e_.pg AS page_start, pe - CASE WHEN contains(page_.text, '다음 문제 중') AND pe > e_.pg THEN 1 ELSE 0 END AS page_end FROM e_ JOIN page_ ON page_.doc = e_.doc AND page_.pg = pe""")
def review_topics(spark, sf_dir):
    pages = marked_pages(spark, sf_dir)
    formats = S.review_format(pages)
    return S.review_topics(pages, formats, S.review_problems(pages, formats))


# Blocks of pages: a line's length gives its type, size and text.
BLOCKS = LINES + """, blocks_ AS (SELECT doc, pg, elem_idx AS idx, CASE length(line) % 5 WHEN 0 THEN 'table' WHEN 1 THEN 'list' WHEN 2 THEN 'heading' ELSE 'paragraph' END AS type, CAST(CASE length(line) % 7 WHEN 0 THEN 20 WHEN 1 THEN 9 WHEN 2 THEN 11 ELSE 13 END AS DOUBLE) AS font_size,
CASE length(line) % 11 WHEN 0 THEN 'kpc' WHEN 1 THEN CAST(length(line) // 11 % 16 + 1 AS VARCHAR) || '. ' || trim(substring(line, 1, 25)) WHEN 2 THEN '12 , 4' WHEN 3 THEN '[정보관리기술사 선택문제]' WHEN 4 THEN '[컴퓨터시스템응용기술사 선택문제]' WHEN 5 THEN '1. 개념 ' || trim(substring(line, 1, 9))
WHEN 6 THEN '2. one two | x | ' || CAST(length(line) // 11 % 16 + 1 AS VARCHAR) || '. ' || trim(substring(line, 1, 15)) ELSE trim(substring(line, 1, 30)) END AS text FROM lines_),
noisy_ AS (SELECT *, text = '' OR regexp_matches(text, '(?i)""" + "|".join(f"(?:{p})" for p in P.HEADER_NOISE) + """') AS noise, font_size >= 18 AND (length(text) <= 15 OR regexp_matches(text, '^[\\s0-9.,]+$')) AS mark FROM blocks_),
body_ AS (SELECT * FROM noisy_ WHERE type = 'table' OR NOT noise AND NOT mark)"""


def blocks(spark, sf_dir):
    pages = text_pages(spark, sf_dir).select(F.col("doc").alias("doc_id"), F.col("pg").alias("page"), F.posexplode(F.split("text", "\n", -1)).alias("i", "x"))
    n = F.length("x")
    number = (F.floor(n / 11) % 16 + 1).cast("string")
    begin = lambda k: F.trim(F.substring("x", 1, k))
    text = (
        F.when(n % 11 == 0, "kpc").when(n % 11 == 1, F.concat(number, F.lit(". "), begin(25))).when(n % 11 == 2, "12 , 4").when(n % 11 == 3, "[정보관리기술사 선택문제]").when(n % 11 == 4, "[컴퓨터시스템응용기술사 선택문제]")
        .when(n % 11 == 5, F.concat(F.lit("1. 개념 "), begin(9))).when(n % 11 == 6, F.concat(F.lit("2. one two | x | "), number, F.lit(". "), begin(15))).otherwise(begin(30))
    )
    kind = F.when(n % 5 == 0, "table").when(n % 5 == 1, "list").when(n % 5 == 2, "heading").otherwise("paragraph")
    size = F.when(n % 7 == 0, 20.0).when(n % 7 == 1, 9.0).when(n % 7 == 2, 11.0).otherwise(13.0)
    return pages.select("doc_id", "page", (F.col("i") + 1).cast("long").alias("idx"), kind.alias("type"), text.alias("text"), size.alias("font_size"))


@query(f"WITH {BLOCKS} SELECT doc AS doc_id, pg AS page, idx, type, text, font_size FROM body_ WHERE type <> 'table'")
def body_blocks(spark, sf_dir):
    """P5, P6, P7."""
    return P.body_blocks(blocks(spark, sf_dir))


@query(f"""WITH {BLOCKS}, f_ AS (SELECT *, type <> 'table' AND font_size BETWEEN 12 AND 14.5 AS sized FROM body_), o_ AS (SELECT *, sized AND regexp_matches(text, '^[0-9]{{1,2}}\\.') AS opens, sized AND type IN ('heading', 'paragraph') AND NOT regexp_matches(text, '^[0-9]{{1,2}}\\.') AS more FROM f_),
r_ AS (SELECT *, sum(CASE WHEN more THEN 0 ELSE 1 END) OVER ({ON_PAGE}) AS run FROM o_),
l_ AS (SELECT doc, pg, arg_min(opens, idx) AS opens, min(idx) AS idx, arg_min(text, idx) AS head, string_agg(text, ' ' ORDER BY idx) AS whole FROM r_ WHERE type <> 'table' GROUP BY doc, pg, run),
c_ AS (SELECT doc, pg, idx, trim(unnest(string_split(text, ' | '))) AS x FROM body_ WHERE type = 'table')
SELECT doc AS doc_id, pg AS page, idx, CAST(regexp_extract(head, '^([0-9]{{1,2}})\\.', 1) AS INTEGER) AS number, trim(regexp_replace(whole, '^[0-9]{{1,2}}\\.\\s*', '')) AS topic FROM l_ WHERE opens
UNION ALL SELECT doc, pg, idx, CAST(regexp_extract(x, '^([0-9]{{1,2}})\\.', 1) AS INTEGER), trim(regexp_replace(x, '^[0-9]{{1,2}}\\.\\s*', '')) FROM c_ WHERE regexp_matches(x, '^[0-9]{{1,2}}\\.')""")
def paper_topics(spark, sf_dir):
    """F21."""
    return P.paper_topics(blocks(spark, sf_dir))


TRACKS = BLOCKS + """, m_ AS (SELECT *, CASE WHEN contains(text, '[정보관리기술사 선택문제]') THEN 'jeonggwan' WHEN contains(text, '[컴퓨터시스템응용기술사 선택문제]') THEN 'compeung' END AS switch FROM body_),
t_ AS (SELECT *, coalesce(last_value(switch IGNORE NULLS) OVER (PARTITION BY doc, pg ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'common') AS track FROM m_),
p_ AS (SELECT doc, pg, idx, track, i, trim(parts[i]) AS x FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT *, CASE WHEN type = 'table' THEN string_split(text, ' | ') ELSE [text] END AS parts FROM t_ WHERE switch IS NULL))),
n_ AS (SELECT doc, pg, track, idx, i, TRY_CAST(regexp_extract(x, '^([0-9]{1,2})\\.\\s+(.{4,})$', 1) AS INTEGER) AS number, trim(regexp_extract(x, '^([0-9]{1,2})\\.\\s+(.{4,})$', 2)) AS topic FROM p_),
masters_ AS (SELECT doc, pg, track, number, topic FROM (SELECT *, row_number() OVER (PARTITION BY doc, pg, track, number ORDER BY length(topic) DESC, idx, i) AS rn FROM n_ WHERE number BETWEEN 1 AND 16) WHERE rn = 1)"""


@query(f"WITH {TRACKS} SELECT doc AS doc_id, pg AS page, track, number, topic FROM masters_")
def track_topics(spark, sf_dir):
    """F21, A19."""
    return P.track_topics(blocks(spark, sf_dir))


@query(f"""WITH {BLOCKS}, r_ AS (SELECT *, row_number() OVER ({ON_PAGE}) AS rn FROM body_ WHERE type <> 'table'), f_ AS (SELECT *, trim(regexp_extract(text, '^1\\.\\s+(.+)$', 1)) AS topic FROM r_ WHERE rn <= 15 AND type IN ('list', 'paragraph') AND font_size BETWEEN 10.5 AND 12)
SELECT doc AS doc_id, pg AS page, arg_min(topic, idx) AS topic FROM f_ WHERE length(topic) >= 3 AND topic NOT IN ('개요', '정의', '개념') GROUP BY doc, pg""")
def opener_topics(spark, sf_dir):
    """F20."""
    return P.opener_topics(blocks(spark, sf_dir))


@query(f"""WITH {BLOCKS}, r_ AS (SELECT *, row_number() OVER ({ON_PAGE}) AS rn FROM body_)
SELECT DISTINCT doc AS doc_id, pg AS page FROM r_ WHERE rn <= 8 AND (type IN ('list', 'paragraph') AND font_size BETWEEN 10.5 AND 12 AND regexp_matches(text, '^1\\.\\s+[가-힣A-Za-z]') OR type = 'table' AND len(list_filter(string_split(text, ' | '), lambda x: regexp_matches(trim(x), '^1\\.\\s+[가-힣A-Za-z]'))) > 0)""")
def opener_pages(spark, sf_dir):
    """P23."""
    return P.has_opener(blocks(spark, sf_dir))


# Order lines as questions: an order is a document, its lines have sessions and numbers; parts' names are titles.
QUESTIONS = """l_ AS (SELECT l_orderkey AS doc_id, CAST(l_linenumber % 4 + 1 AS INTEGER) AS session, CAST(l_partkey % 5 + 1 AS INTEGER) AS number, p_name AS topic, CAST(l_suppkey AS INTEGER) AS page_start, CAST(l_suppkey + l_quantity % 3 AS INTEGER) AS page_end FROM lineitem JOIN part ON p_partkey = l_partkey),
q_ AS (SELECT doc_id, session, number, page_start, max(topic) AS topic, max(page_end) AS page_end FROM l_ GROUP BY doc_id, session, number, page_start)"""


def questions(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
    rows = lines.select(
        F.col("l_orderkey").alias("doc_id"), (F.col("l_linenumber") % 4 + 1).cast("int").alias("session"), (F.col("l_partkey") % 5 + 1).cast("int").alias("number"), F.col("p_name").alias("topic"),
        F.col("l_suppkey").cast("int").alias("page_start"), (F.col("l_suppkey") + F.col("l_quantity") % 3).cast("int").alias("page_end"),
    )
    return rows.groupBy("doc_id", "session", "number", "page_start").agg(F.max("topic").alias("topic"), F.max("page_end").alias("page_end"))


@query(f"""WITH {QUESTIONS}, o_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, session, number ORDER BY page_start, page_end) AS occurrence FROM q_),
m_ AS (SELECT o_orderkey AS doc_id, CAST(o_orderkey % 4 + 1 AS INTEGER) AS session, CAST(o_custkey % 5 + 1 AS INTEGER) AS number, CASE o_orderkey % 3 WHEN 0 THEN 'common' WHEN 1 THEN 'jeonggwan' ELSE 'compeung' END AS track, CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus || ' 3. mixed titles of two questions' ELSE o_orderstatus || ' the whole title of this question' END AS topic FROM orders),
t_ AS (SELECT doc_id, session, number, max(topic) FILTER (track = 'common') AS c, max(topic) FILTER (track = 'jeonggwan') AS j, max(topic) FILTER (track = 'compeung') AS k FROM m_ GROUP BY doc_id, session, number),
b_ AS (SELECT o_.*, CASE WHEN occurrence = 1 THEN coalesce(c, j) ELSE k END AS found FROM o_ LEFT JOIN t_ USING (doc_id, session, number))
SELECT doc_id, session, number, occurrence, page_start, page_end, CASE WHEN length(found) > length(topic) + 4 AND NOT regexp_matches(found, '[0-9]{{1,2}}\\.\\s+[A-Za-z(]') THEN found ELSE topic END AS topic FROM b_""")
def enrich_titles(spark, sf_dir):
    """J5, P22."""
    o = table(spark, sf_dir, "orders")
    title = F.when(F.col("o_custkey") % 2 == 0, F.concat("o_orderstatus", F.lit(" 3. mixed titles of two questions"))).otherwise(F.concat("o_orderstatus", F.lit(" the whole title of this question")))
    track = F.when(F.col("o_orderkey") % 3 == 0, "common").when(F.col("o_orderkey") % 3 == 1, "jeonggwan").otherwise("compeung")
    masters = o.select(F.col("o_orderkey").alias("doc_id"), (F.col("o_orderkey") % 4 + 1).cast("int").alias("session"), (F.col("o_custkey") % 5 + 1).cast("int").alias("number"), track.alias("track"), title.alias("topic"))
    return P.enrich_titles(questions(spark, sf_dir), masters)


@query(f"WITH {QUESTIONS} SELECT doc_id, session, number, count(*) AS n, string_agg(topic, '|' ORDER BY page_start) AS topics FROM q_ GROUP BY doc_id, session, number HAVING count(*) > 1")
def duplicate_numbers(spark, sf_dir):
    """A25."""
    return P.duplicate_numbers(questions(spark, sf_dir)).withColumn("topics", F.array_join("topics", "|"))


@query(f"""WITH {QUESTIONS}, u_ AS (SELECT *, coalesce(number >= lag(number) OVER (PARTITION BY doc_id, session ORDER BY page_start, page_end, number), true) AS up FROM q_),
s_ AS (SELECT doc_id, session, count(*) AS n, bool_and(up) AS up, count(DISTINCT number) = max(number) AS whole FROM u_ GROUP BY doc_id, session),
d_ AS (SELECT doc_id, count(*) FILTER (n BETWEEN 1 AND 2) = 4 AS counts_ok, bool_and(up) AS rising, bool_and(whole) AS continuous FROM s_ GROUP BY doc_id),
k_ AS (SELECT o_orderkey AS doc_id, unnest(range(1, 6)) AS page, CASE o_orderkey % 7 WHEN 0 THEN 'Q_START_PARTIAL' WHEN 1 THEN 'COVER' ELSE 'Q_BODY' END AS kind FROM orders),
c_ AS (SELECT DISTINCT doc_id, unnest(range(page_start, page_end + 1)) AS page FROM q_),
p_ AS (SELECT k_.doc_id, count(*) FILTER (kind = 'Q_START_PARTIAL') AS n_partial, count(*) FILTER (c_.page IS NULL AND kind <> 'COVER') AS n_outside FROM k_ LEFT JOIN c_ ON c_.doc_id = k_.doc_id AND c_.page = k_.page GROUP BY k_.doc_id)
SELECT doc_id, n_partial, n_outside, coalesce(counts_ok, false) AS counts_ok, coalesce(rising, false) AS rising, coalesce(continuous, false) AS continuous, coalesce(counts_ok AND rising AND continuous AND n_partial = 0 AND n_outside = 0, false) AS ok FROM p_ LEFT JOIN d_ USING (doc_id)""")
def paper_diagnosis(spark, sf_dir):
    """A24, with one to two questions expected in each session."""
    kind = F.when(F.col("o_orderkey") % 7 == 0, "Q_START_PARTIAL").when(F.col("o_orderkey") % 7 == 1, "COVER").otherwise("Q_BODY")
    kinds = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("page"), kind.alias("kind"))
    return P.diagnosis(questions(spark, sf_dir), kinds, {s: (1, 2) for s in (1, 2, 3, 4)})


@query(f"""WITH {QUESTIONS}, c_ AS (SELECT doc_id, page_start, min(CASE WHEN page_start % 3 = 0 THEN 'abc' ELSE left(topic, 12) END) AS category FROM q_ GROUP BY doc_id, page_start),
n_ AS (SELECT q_.*, category, 'R_M' || CAST(session AS VARCHAR) || '_Q' || lpad(CAST(number AS VARCHAR), 2, '0') || '_' || CASE WHEN length(category) BETWEEN 4 AND 60 THEN category ELSE topic END AS base FROM q_ JOIN c_ USING (doc_id, page_start)),
k_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY page_start, page_end) AS k FROM n_)
SELECT doc_id, session, number, page_start, page_end, base || CASE WHEN k > 1 THEN '_' || chr(CAST(k + 96 AS INTEGER)) ELSE '' END AS name FROM k_""")
def file_labels(spark, sf_dir):
    """J17, W9, F13 on short titles."""
    q = questions(spark, sf_dir)
    category = F.when(F.col("page_start") % 3 == 0, "abc").otherwise(F.substring("topic", 1, 12))
    kinds = q.groupBy("doc_id", F.col("page_start").alias("page")).agg(F.min(category).alias("category")).withColumn("kind", F.lit("Q_START")).withColumn("topic", F.lit(None).cast("string"))
    return P.file_labels(q, kinds, F.lit("R")).select("doc_id", "session", "number", "page_start", "page_end", "name")


@query(f"WITH {LINES}, r_ AS (SELECT *, row_number() OVER (PARTITION BY doc, pg ORDER BY elem_idx) AS rn FROM lines_ WHERE trim(line) <> '') SELECT doc, pg, string_agg(substring(trim(line), 1, 80), ' / ' ORDER BY elem_idx) AS summary FROM r_ WHERE rn <= 5 GROUP BY doc, pg")
def page_summary(spark, sf_dir):
    """T4."""
    from ..sources.tables import text_lines

    return O.summaries(text_lines(spark, sf_dir), ["doc", "pg"], ["elem_idx"], "line")


@query("""WITH k_ AS (SELECT l_orderkey, list(l_returnflag || ' ' || CAST(l_linenumber AS VARCHAR) ORDER BY l_returnflag, l_linenumber) AS items FROM (SELECT DISTINCT l_orderkey, l_returnflag, l_linenumber FROM lineitem) GROUP BY l_orderkey)
SELECT l_orderkey, array_to_string(CASE WHEN len(items) > 5 THEN list_concat(list_slice(items, 1, 5), ['… 외 ' || CAST(len(items) - 5 AS VARCHAR) || '건']) ELSE items END, '; ') AS items FROM k_""")
def limited_list(spark, sf_dir):
    """T8."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat_ws(" ", "l_returnflag", F.col("l_linenumber").cast("string")).alias("x"), "l_returnflag", "l_linenumber").distinct()
    items = F.transform(F.array_sort(F.collect_list(F.struct("l_returnflag", "l_linenumber", "x"))), lambda r: r["x"])
    return rows.groupBy("l_orderkey").agg(items.alias("items")).select("l_orderkey", F.array_join(O.limited(F.col("items")), "; ").alias("items"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority ORDER BY n DESC, o_orderpriority LIMIT 5")
def top_subjects(spark, sf_dir):
    """T10."""
    return A.most_frequent(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type")
def mean_timings(spark, sf_dir):
    """A29."""
    return A.mean_by(table(spark, sf_dir, "events").select("event_type", "value"), ["event_type"], "value")


@query(f"WITH {QUESTIONS} SELECT session, number, count(*) AS n, CAST(sum(page_end - page_start + 1) AS BIGINT) AS pages FROM q_ GROUP BY ROLLUP (session, number)")
def subject_totals(spark, sf_dir):
    """A31."""
    return S.subject_totals(questions(spark, sf_dir), "session", "number")


@query(f"""WITH {QUESTIONS}, m_ AS (SELECT doc_id, page_start, arg_max(session, number * 10 + session) AS session FROM q_ GROUP BY doc_id, page_start), s_ AS (SELECT doc_id, session, min(page_start) AS s, max(page_start) AS l FROM m_ GROUP BY doc_id, session)
SELECT doc_id, session, s AS page_start, greatest(l, coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY session) - 1, l)) AS page_end, CASE WHEN session = 1 THEN 13 ELSE 6 END AS expected FROM s_""")
def session_ranges(spark, sf_dir):
    """A10."""
    marks = questions(spark, sf_dir).withColumn("at", F.col("number") * 10 + F.col("session"))
    return A.session_ranges(marks.withColumnRenamed("page_start", "page"), ["doc_id"], "page", "at", "session")


@query("""WITH l_ AS (SELECT l_orderkey, l_linenumber, bool_or(l_returnflag = 'N') AS noise, bool_or(l_linestatus = 'F') AS sign FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT l_orderkey, l_linenumber FROM l_ WHERE noise AND NOT sign""")
def unsigned_noise(spark, sf_dir):
    """A8, U3."""
    return A.unsigned_noise(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "N", F.col("l_linestatus") == "F")


@query(f"""WITH {QUESTIONS}, n_ AS (SELECT session, page_end - page_start + 1 + number AS pages FROM q_)
SELECT session, pages, CASE WHEN session = 1 AND pages > 4 THEN 'bad' WHEN session = 1 AND pages > 3 THEN 'warn' WHEN session = 1 THEN '' WHEN pages > 8 OR pages < 2 THEN 'bad' WHEN pages > 6 OR pages < 3 THEN 'warn' ELSE '' END AS class, count(*) AS n FROM n_ GROUP BY session, pages""")
def length_classes(spark, sf_dir):
    """P24."""
    n = questions(spark, sf_dir).withColumn("pages", F.col("page_end") - F.col("page_start") + 1 + F.col("number"))
    return n.withColumn("class", A.length_class(F.col("session"), F.col("pages"))).groupBy("session", "pages", "class").agg(F.count("*").alias("n"))


@query(f"""WITH {QUESTIONS}, a_ AS (SELECT doc_id, page_start, page_end, 'topic' AS fmt FROM q_ WHERE session < 4 UNION ALL SELECT doc_id, page_start, page_end, 'question_pages' FROM q_ WHERE session = 4)
SELECT doc_id, page_start, page_end, fmt, row_number() OVER (PARTITION BY doc_id ORDER BY page_start, CASE WHEN fmt = 'topic' THEN 0 ELSE 1 END, page_end) AS place FROM a_""")
def merged_order(spark, sf_dir):
    """U4."""
    q = questions(spark, sf_dir).select("doc_id", "session", "page_start", "page_end")
    return O.merged_order(q.where("session < 4").drop("session"), q.where("session = 4").drop("session"), ["doc_id"]).select("doc_id", "page_start", "page_end", "fmt", "place")
