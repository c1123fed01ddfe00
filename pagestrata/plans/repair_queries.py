"""Repairs of topics over the documents' pages: what is proposed for a page follows from its text's length."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import postprocess
from ..sources.tables import text_pages
from .registry import query
from .text_queries import PAGES

#: SQL: topics that start on all pages but those of three length classes; every ten pages are a session.
TOPICS = f"""{PAGES}, r_ AS (SELECT doc, pg, length(text) % 16 AS r, max(pg) OVER (PARTITION BY doc) AS n FROM pages_),
s_ AS (SELECT *, (pg - 1) // 10 + 1 AS session FROM r_ WHERE pg = 1 OR r NOT IN (5, 6, 7) OR pg % 10 = 1),
i_ AS (SELECT doc, session, pg AS a, coalesce(lead(pg) OVER (PARTITION BY doc ORDER BY pg) - 1, n) AS b, CASE WHEN r < 4 THEN 0.3 WHEN r < 8 THEN 0.5 WHEN r < 12 THEN 0.85 ELSE 0.95 END AS c, row_number() OVER (PARTITION BY doc ORDER BY pg) AS num FROM s_)"""


def page_topics(spark, sf_dir):
    pages = text_pages(spark, sf_dir)
    role = F.length("text") % 16
    starts = pages.withColumn("n", F.max("pg").over(Window.partitionBy("doc"))).where((F.col("pg") == 1) | ~role.isin(5, 6, 7) | (F.col("pg") % 10 == 1))
    w = Window.partitionBy("doc").orderBy("pg")
    confidence = F.when(role < 4, 0.3).when(role < 8, 0.5).when(role < 12, 0.85).otherwise(0.95)
    ints = {"num": F.row_number().over(w), "page_start": F.col("pg"), "page_end": F.coalesce(F.lead("pg").over(w) - 1, F.col("n")), "session": F.floor((F.col("pg") - 1) / 10) + 1}
    return starts.select(F.col("doc").alias("doc_id"), F.lit("topic").alias("title"), confidence.alias("confidence"), *[v.cast("int").alias(k) for k, v in ints.items()])


def spans(df):
    return df.select("doc_id", "session", "num", *[F.col(c).cast("long").alias(c) for c in ("page_start", "page_end")], "confidence")


#: Every third session expects 13 topics and merges none. Short ones at a session's start are put before the first that is long enough with them; the last one stays.
@query(f"""WITH {TOPICS}, f_ AS (SELECT *, min(a) OVER w AS s1, row_number() OVER (w ORDER BY a) AS i, count(*) OVER w AS k, session % 3 = 0 AS many FROM i_ WINDOW w AS (PARTITION BY doc, session)),
h_ AS (SELECT *, NOT many AND ((b - s1 + 1 <= 1 AND c < 0.9) OR (b - s1 + 1 <= 2 AND c < 0.4)) AS led, NOT many AND ((b - a + 1 <= 1 AND c < 0.9) OR (b - a + 1 <= 2 AND c < 0.4)) AS short FROM f_),
m_ AS (SELECT *, coalesce(min(CASE WHEN NOT led THEN i END) OVER (PARTITION BY doc, session), k) AS first FROM h_),
g_ AS (SELECT *, sum(CASE WHEN i = first OR (i > first AND NOT short) THEN 1 ELSE 0 END) OVER (PARTITION BY doc, session ORDER BY a) AS g FROM m_ WHERE i >= first)
SELECT doc AS doc_id, CAST(session AS INTEGER) AS session, CAST(min(num) AS INTEGER) AS num, min(CASE WHEN i = first THEN s1 ELSE a END) AS page_start, max(b) AS page_end, CAST(min_by(c, i) AS DOUBLE) AS confidence FROM g_ GROUP BY doc, session, g""")
def short_topics(spark, sf_dir):
    """Short and doubtful topics join the one before, or open the one after."""
    topics = page_topics(spark, sf_dir)
    sessions = topics.select("doc_id", "session").distinct().where("session % 3 < 2").withColumn("expected", F.when(F.col("session") % 3 == 0, 13).otherwise(6))
    return spans(postprocess.merge_short(topics, sessions))


@query(f"""WITH {TOPICS}, j_ AS (SELECT *, coalesce(a = b AND session IN (2, 3, 4) AND lag(session) OVER w = session AND lag(b) OVER w + 1 = a, false) AS joins FROM i_ WINDOW w AS (PARTITION BY doc ORDER BY a)),
g_ AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY a) AS g FROM j_)
SELECT doc AS doc_id, CAST(min(session) AS INTEGER) AS session, CAST(min(num) AS INTEGER) AS num, min(a) AS page_start, max(b) AS page_end, CAST(min_by(c, a) AS DOUBLE) AS confidence FROM g_ GROUP BY doc, g""")
def single_pages(spark, sf_dir):
    """Single pages of three sessions join the topic that ends right before them."""
    return spans(postprocess.merge_single_pages(page_topics(spark, sf_dir)))


WORDS = ("Alpha", "Bravo", "Delta", "Gamma", "Omega", "Sigma")
#: SQL: what is proposed for each page: ranges partly outside or turned round, wide ones that hold others, titles with numbers or a longer wording. Every fifth document only has topics on its first pages; every other one's sessions are certain.
PROPOSED = f"""{PAGES}, r_ AS (SELECT doc, pg, length(text) % 16 AS r, max(pg) OVER (PARTITION BY doc) AS n, unicode(right(split_part(doc, '#', 1), 1)) + CAST(split_part(doc, '#', 2) AS BIGINT) AS d FROM pages_),
x_ AS (SELECT *, CASE WHEN d % 5 = 0 THEN 1 + pg % 3 WHEN r = 1 THEN pg + n ELSE pg + r % 3 - 1 END AS a0, [{", ".join(f"'{w}'" for w in WORDS)}][(pg // 3) % 6 + 1] AS word FROM r_),
y_ AS (SELECT doc, n, d, pg AS num, 1 + (pg - 1) * 4 // n AS session, a0 AS a1, CASE WHEN d % 5 = 0 THEN a0 WHEN r = 9 THEN a0 - 3 WHEN r = 10 AND (pg + 7) * 4 // n = (pg - 1) * 4 // n THEN a0 + 8 ELSE a0 + r % 2 END AS b1, CASE r WHEN 3 THEN '3. ' || word WHEN 4 THEN word || ' and more' ELSE word END AS title, lower(word) AS key FROM x_)"""


@query(f"""WITH RECURSIVE {PROPOSED}, p_ AS (SELECT *, a1 AS a, CASE WHEN b1 < a1 OR b1 > n THEN a1 ELSE b1 END AS b FROM y_ WHERE a1 BETWEEN 1 AND n),
o_ AS (SELECT * FROM p_ p WHERE (SELECT count(*) FROM p_ q WHERE q.doc = p.doc AND q.session = p.session AND q.a >= p.a AND q.b <= p.b AND q.b - q.a < p.b - p.a) < 2),
q_ AS (SELECT *, row_number() OVER (PARTITION BY doc, session, key ORDER BY a, b, num) AS i FROM o_),
w_ AS (SELECT doc, n, d, session, key, i, a, b, title, num FROM q_ WHERE i = 1
  UNION ALL SELECT w.doc, w.n, w.d, w.session, w.key, q.i, w.a, CASE WHEN q.a - w.b <= 2 THEN greatest(w.b, q.b) ELSE w.b END, CASE WHEN q.a - w.b <= 2 AND length(w.title) > length(q.title) THEN q.title ELSE w.title END, w.num FROM w_ w JOIN q_ q ON q.doc = w.doc AND q.session = w.session AND q.key = w.key AND q.i = w.i + 1),
t_ AS (SELECT doc, n, d, session, key, any_value(a) AS a, max(b) AS b, max_by(title, i) AS title, any_value(num) AS num FROM w_ GROUP BY doc, n, d, session, key),
e_ AS (SELECT *, coalesce(a < max(b) OVER (PARTITION BY doc, session ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 2, false) AS back FROM t_),
f_ AS (SELECT doc, session, bool_or(back) AS back, min(a) AS a, max(b) AS b FROM e_ GROUP BY doc, session),
c_ AS (SELECT doc, bool_or(back) AS back, bool_or(crossed) AS crossed FROM (SELECT doc, back, coalesce(a < lag(b) OVER (PARTITION BY doc ORDER BY session) - 2, false) AS crossed FROM f_) GROUP BY doc),
v_ AS (SELECT doc, n, count(DISTINCT p) AS covered FROM (SELECT doc, n, unnest(range(a, b + 1)) AS p FROM t_) GROUP BY doc, n),
good_ AS (SELECT doc FROM v_ JOIN c_ USING (doc) WHERE NOT back AND NOT crossed AND covered >= 0.2 * n),
j_ AS (SELECT *, coalesce(d % 2 = 0 AND a = b AND session IN (2, 3, 4) AND lag(session) OVER w = session AND lag(b) OVER w + 1 = a, false) AS joins FROM t_ WHERE doc IN (SELECT doc FROM good_) WINDOW w AS (PARTITION BY doc ORDER BY session, a, b, num)),
g_ AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY session, a, b, num ROWS UNBOUNDED PRECEDING) AS g, row_number() OVER (PARTITION BY doc ORDER BY session, a, b, num) AS k FROM j_),
z_ AS (SELECT doc, min(session) AS session, min_by(a, k) AS a, max_by(b, k) AS b, min_by(title, k) AS title, min_by(num, k) AS num, min(k) AS k FROM g_ GROUP BY doc, g)
SELECT doc AS doc_id, CAST(row_number() OVER (PARTITION BY doc ORDER BY k) AS INTEGER) AS num, CAST(num AS INTEGER) AS session_q, CASE WHEN starts_with(title, '3. ') THEN substr(title, 4) ELSE title END AS title, a AS page_start, b AS page_end,
       CAST(CASE WHEN min(session) OVER d = max(session) OVER d THEN 1 ELSE session END AS INTEGER) AS session FROM z_ WINDOW d AS (PARTITION BY doc)""")
def cleaned_topics(spark, sf_dir):
    """The whole chain of repairs: ranges, containers, similar titles, coherence, single pages, labels."""
    topics, _ = proposed(spark, sf_dir)
    return topics.select("doc_id", "num", "session_q", "title", F.col("page_start").cast("long").alias("page_start"), F.col("page_end").cast("long").alias("page_end"), "session")


def proposed(spark, sf_dir):
    name = F.split("doc", "#")
    pages = text_pages(spark, sf_dir).withColumns({"r": F.length("text") % 16, "n": F.max("pg").over(Window.partitionBy("doc")), "d": F.ascii(F.substring(name[0], -1, 1)) + name[1].cast("long")})
    pg, r, n, d = F.col("pg"), F.col("r"), F.col("n"), F.col("d")
    start = F.when(d % 5 == 0, 1 + pg % 3).when(r == 1, pg + n).otherwise(pg + r % 3 - 1)
    end = F.when(d % 5 == 0, start).when(r == 9, start - 3).when((r == 10) & (F.floor((pg + 7) * 4 / n) == F.floor((pg - 1) * 4 / n)), start + 8).otherwise(start + r % 2)
    word = F.get(F.array(*[F.lit(w) for w in WORDS]), (F.floor(pg / 3) % 6).cast("int"))
    title = F.when(r == 3, F.concat(F.lit("3. "), word)).when(r == 4, F.concat(word, F.lit(" and more"))).otherwise(word)
    ints = {"num": pg, "page_start": start, "page_end": end, "session": 1 + F.floor((pg - 1) * 4 / n)}
    topics = pages.select(F.col("doc").alias("doc_id"), title.alias("title"), F.lit(0.9).alias("confidence"), *[v.cast("int").alias(k) for k, v in ints.items()])
    docs = pages.groupBy(F.col("doc").alias("doc_id")).agg(F.max("n").cast("int").alias("n_pages"), (F.max("d") % 2 == 0).alias("multi"))
    return postprocess.cleaned(topics, docs)


@query(f"""WITH {TOPICS}, v_ AS (SELECT i.*, r_.r, i.c < 0.7 AND r_.r % 2 = 1 AS named, coalesce(i.c < 0.6 AND r_.r % 3 = 0, false) AS gone FROM i_ i JOIN r_ ON r_.doc = i.doc AND r_.pg = i.a),
g_ AS (SELECT *, sum(CASE WHEN gone AND num > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY a) AS g FROM v_)
SELECT doc AS doc_id, CAST(min(session) AS INTEGER) AS session, CAST(min(num) AS INTEGER) AS num, min(a) AS page_start, max(b) AS page_end, CAST(min_by(c, a) AS DOUBLE) AS confidence, min_by(CASE WHEN named THEN 'named ' || a ELSE 'topic' END, a) AS title FROM g_ GROUP BY doc, g""")
def enhanced_topics(spark, sf_dir):
    """Verdicts on doubtful topics: some get a title, some continue the one before."""
    pages = text_pages(spark, sf_dir)
    r = F.length("text") % 16
    verdicts = pages.select(F.col("doc").alias("doc_id"), F.col("pg").cast("int").alias("page_start"), (r % 3 == 0).alias("same_topic"), F.when(r % 2 == 1, F.concat(F.lit("named "), F.col("pg").cast("string"))).alias("title"))
    found = postprocess.enhance(page_topics(spark, sf_dir), verdicts)
    return found.select("doc_id", "session", "num", *[F.col(c).cast("long").alias(c) for c in ("page_start", "page_end")], "confidence", "title")
