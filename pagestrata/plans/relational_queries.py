"""Joins, aggregates and set operations over the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import coverage as C
from ..operators import joins as J
from ..operators import order as O
from ..sources import elements as E
from ..sources.tables import event_pages, table
from ..streaming import jobs
from .registry import query
from .window_queries import EV


@query(f"""WITH {EV}, k AS (SELECT user_id, pg, CASE WHEN pg - lag(pg) OVER (PARTITION BY user_id ORDER BY pg) <= 1 THEN 0 ELSE 1 END AS new FROM ev WHERE event_type NOT IN ('error', 'view')),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY pg) AS session FROM k), n AS (SELECT user_id, session, min(pg) AS page_start, max(pg) AS page_end FROM g GROUP BY user_id, session)
SELECT e.user_id, e.pg, CAST(coalesce((SELECT arg_min(n.session, n.page_start) FROM n WHERE n.user_id = e.user_id AND e.pg BETWEEN n.page_start AND n.page_end), (SELECT max(n.session) FROM n WHERE n.user_id = e.user_id), 1) AS BIGINT) AS session FROM ev e""")
def range_lookup_session(spark, sf_dir):
    """Runs of pages are sessions; pages outside all of them belong to the last."""
    ev = event_pages(spark, sf_dir)
    runs = O.island_ranges(ev.where("event_type not in ('error', 'view')"), ["user_id"], "pg", 1)
    sessions = runs.select("user_id", "page_start", "page_end", F.col("island").alias("session"))
    return J.session_of(ev, sessions, ["user_id"], "pg").select("user_id", "pg", "session")


@query("""WITH i AS (SELECT l_orderkey, min(l_suppkey) AS s, max(l_suppkey) AS e, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber), d AS (SELECT DISTINCT l_orderkey, s, e FROM i)
SELECT d.l_orderkey, d.s AS page_start, d.e AS page_end FROM d WHERE (SELECT count(*) FROM d o WHERE o.l_orderkey = d.l_orderkey AND o.s >= d.s AND o.e <= d.e AND (o.s > d.s OR o.e < d.e)) < 2""")
def containment_anti(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("page_start"), F.max("l_suppkey").alias("page_end"))
    return J.drop_containers(lines.select("l_orderkey", "page_start", "page_end").distinct(), ["l_orderkey"], "page_start", "page_end").select("l_orderkey", "page_start", "page_end")


@query("""WITH a AS (SELECT o_custkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS occurrence FROM orders WHERE o_orderstatus <> 'P'),
b AS (SELECT o_custkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS occurrence FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, coalesce(a.occurrence, b.occurrence) AS occurrence,
CASE WHEN b.o_custkey IS NULL THEN 'only_a' WHEN a.o_custkey IS NULL THEN 'only_b' WHEN a.o_totalprice = b.o_totalprice THEN 'same' ELSE 'differs' END AS status
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus AND a.occurrence = b.occurrence""")
def full_outer_diff(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    diff = J.engine_diff(orders.where("o_orderstatus <> 'P'"), orders.where("o_orderpriority <> '5-LOW'"), ["o_custkey", "o_orderstatus"], ["o_orderkey"], ["o_totalprice"])
    return diff.select("o_custkey", "o_orderstatus", "occurrence", "status")


@query("""WITH b AS (SELECT c_nationkey, arg_max(c_mktsegment, c_custkey) AS found FROM customer WHERE c_acctbal >= 0 GROUP BY c_nationkey)
SELECT c.c_custkey, CASE WHEN b.found IS NULL THEN 'missing' WHEN b.found = c.c_mktsegment THEN 'match' ELSE 'differs' END AS status FROM customer c LEFT JOIN b ON b.c_nationkey = c.c_nationkey""")
def left_last_wins(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return J.left_last_wins(customers, customers.where("c_acctbal >= 0"), ["c_nationkey"], ["c_custkey"], "c_mktsegment").select("c_custkey", "status")


@query("SELECT user_id, CAST(day(ts) AS BIGINT) AS day FROM events GROUP BY user_id, day(ts) HAVING bool_or(event_type = 'purchase') AND bool_or(event_type = 'error')")
def semi_both_pages(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts").cast("long"))
    return J.both_flags(ev, ["user_id", "day"], F.col("event_type") == "purchase", F.col("event_type") == "error")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_missing(spark, sf_dir):
    found = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.missing(table(spark, sf_dir, "customer"), found, ["c_custkey"]).select("c_custkey", "c_name")


@query("""WITH x AS (SELECT l_orderkey, max(l_linenumber) AS m FROM lineitem GROUP BY l_orderkey), e AS (SELECT l_orderkey, unnest(range(1, m + 1)) AS number FROM x), f AS (SELECT l_orderkey, l_linenumber, min(l_returnflag || '-' || l_linestatus) AS title FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT e.l_orderkey, CAST(e.number AS BIGINT) AS number, coalesce(f.title, 'Q' || e.number) AS title FROM e LEFT JOIN f ON f.l_orderkey = e.l_orderkey AND f.l_linenumber = e.number""")
def default_fill(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    found = lines.groupBy("l_orderkey", F.col("l_linenumber").alias("number")).agg(F.min(F.concat_ws("-", "l_returnflag", "l_linestatus")).alias("title"))
    return J.fill_expected(found, lines.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("m")), ["l_orderkey"], "number", "m", "title")


@query("""WITH s AS (SELECT l_orderkey, l_linenumber FROM lineitem), x AS (SELECT l_orderkey, max(l_linenumber) AS m FROM s GROUP BY l_orderkey), e AS (SELECT l_orderkey, unnest(range(1, m + 1)) AS k FROM x)
SELECT e.l_orderkey, string_agg(CAST(e.k AS VARCHAR), ',' ORDER BY e.k) AS missing FROM e WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = e.l_orderkey AND s.l_linenumber = e.k) GROUP BY e.l_orderkey""")
def number_gaps(spark, sf_dir):
    return A.number_gaps(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY o_orderpriority""")
def subject_pivot(spark, sf_dir):
    """A12."""
    topics = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("subject"), F.col("o_orderstatus").alias("gen"))
    wide = C.subject_matrix(topics, ["F", "O", "P"])
    return wide.select(F.col("subject").alias("o_orderpriority"), *[F.col(c).alias(c.lower()) for c in ("F", "O", "P")])


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n, CAST(grouping(o_orderpriority) * 2 + grouping(o_orderstatus) AS BIGINT) AS level FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)")
def subject_rollup(spark, sf_dir):
    topics = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("subject"), F.col("o_orderstatus").alias("gen"))
    return C.subject_totals(topics).select(F.col("subject").alias("o_orderpriority"), F.col("gen").alias("o_orderstatus"), "n", "level")


@query("SELECT event_type AS gen, count(*) AS topics, count(DISTINCT day(ts)) AS weeks, count(DISTINCT user_id) AS sessions, count(*) FILTER (trim(coalesce(props, '')) <> '') AS with_intent, count(*) FILTER (value > 50) AS with_approach, count(*) AS with_content FROM events GROUP BY event_type")
def gen_stats(spark, sf_dir):
    """A13, A18."""
    ev = table(spark, sf_dir, "events")
    topics = ev.select(F.col("event_type").alias("gen"), F.dayofmonth("ts").alias("week"), F.col("user_id").alias("session"), F.col("props").alias("intent"), F.when(F.col("value") > 50, "x").otherwise(" ").alias("approach"), F.lit("x").alias("content"))
    return C.generation_stats(topics)


@query("SELECT o_orderpriority AS exam, o_orderstatus AS session, o_custkey % 100 AS q_num, arg_min(CAST(o_totalprice AS VARCHAR), o_orderkey) AS q_title FROM orders GROUP BY ALL")
def first_titles(spark, sf_dir):
    """A15."""
    o = table(spark, sf_dir, "orders")
    q = o.select(F.col("o_orderpriority").alias("exam"), F.col("o_orderstatus").alias("session"), (F.col("o_custkey") % 100).alias("q_num"), F.col("o_totalprice").cast("string").alias("q_title"), "o_orderkey")
    return C.first_titles(q, "o_orderkey")


@query("""WITH c AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS found, count(*) // 5 AS expected, count(*) FILTER (event_type = 'error') AS warnings FROM events GROUP BY user_id),
s AS (SELECT *, round(greatest(CASE WHEN expected = 0 THEN 0.5 ELSE least(CAST(found AS DOUBLE) / nullif(expected, 0), 1.0) END - 0.02 * warnings, 0.1), 4) AS score FROM c)
SELECT user_id, found, CAST(expected AS BIGINT) AS expected, CAST(score AS DOUBLE) AS score, CASE WHEN score >= 0.95 THEN '우수' WHEN score >= 0.8 THEN '양호' WHEN score >= 0.6 THEN '보통' ELSE '낮음' END AS grade FROM s""")
def quality_score(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.expr("event_type = 'purchase'")).alias("found"), F.expr("count(*) div 5").alias("expected"), F.count_if(F.expr("event_type = 'error'")).alias("warnings"))
    return A.quality(counts, "found", "expected", "warnings").select("user_id", "found", "expected", "score", "grade")


@query(f"""WITH {EV}, i AS (SELECT user_id, pg AS s, pg + 2 AS e FROM ev WHERE event_type = 'purchase'), n AS (SELECT user_id, max(pg) AS n FROM ev GROUP BY user_id), p AS (SELECT DISTINCT user_id, unnest(range(s, e + 1)) AS k FROM i), c AS (SELECT user_id, count(*) AS c FROM p GROUP BY user_id)
SELECT n.user_id, n.n AS n_pages, coalesce(c.c, 0) AS covered, round(coalesce(c.c, 0) / CAST(greatest(n.n, 1) AS DOUBLE), 6) AS share FROM n LEFT JOIN c ON c.user_id = n.user_id""")
def coverage_pages(spark, sf_dir):
    ev = event_pages(spark, sf_dir)
    intervals = ev.where("event_type = 'purchase'").select("user_id", F.col("pg").alias("s"), (F.col("pg") + 2).alias("e"))
    return A.coverage(intervals, ["user_id"], "s", "e", ev.groupBy("user_id").agg(F.max("pg").alias("n_pages")), "n_pages")


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, round(l_quantity / median(l_quantity) OVER (PARTITION BY l_orderkey), 6) AS ratio FROM lineitem")
def median_ratio(spark, sf_dir):
    found = A.font_ratio(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_quantity", "ratio")
    return found.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_quantity", F.round("ratio", 6).alias("ratio"))


@query("""WITH a AS (SELECT o_orderpriority AS publisher, o_orderstatus AS kind, o_orderkey % 4 AS expected, o_custkey % 4 AS a_count, o_orderkey % 3 AS b_count FROM orders)
SELECT publisher, kind, count(*) AS total, count(*) FILTER (a_count = expected) AS a_match, count(*) FILTER (b_count = expected) AS b_match, count(*) FILTER (a_count = expected AND b_count = expected) AS both_, count(*) FILTER (a_count = expected AND b_count <> expected) AS only_a, count(*) FILTER (b_count = expected AND a_count <> expected) AS only_b FROM a GROUP BY ROLLUP (publisher, kind)""")
def corpus_accuracy(spark, sf_dir):
    """A26."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("publisher"), F.col("o_orderstatus").alias("kind"), (F.col("o_orderkey") % 4).alias("expected"), (F.col("o_custkey") % 4).alias("a_count"), (F.col("o_orderkey") % 3).alias("b_count"))
    return A.accuracy(rows, ["publisher", "kind"]).withColumnRenamed("both", "both_")


@query("""WITH u_ AS (SELECT o_orderkey AS path, 'F' || CAST(o_custkey % 300 AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '.pdf' ELSE '.PDF' END AS name, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS main FROM orders)
SELECT path, name FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY main DESC, path) AS rn FROM u_) WHERE rn = 1""")
def last_writer_wins(spark, sf_dir):
    """Of files with one name the one of the later source, the first path of several."""
    name = F.concat(F.lit("F"), (F.col("o_custkey") % 300).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".pdf").otherwise(".PDF"))
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), name.alias("name"), "o_orderstatus")
    return E.last_of_name(files.where("o_orderstatus <> 'O'").drop("o_orderstatus"), files.where("o_orderstatus = 'O'").drop("o_orderstatus"))


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def latest_rows(spark, sf_dir):
    """A user's last event; users whose last event is an error are deleted."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", (F.col("event_type") == "error").alias("gone"))
    return E.latest_rows(ev, "user_id", "ts", "gone").select("user_id", "event_id", "event_type")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def job_states(spark, sf_dir):
    """The last state of each job."""
    found = jobs.job_states(table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id")), "user_id", "at", "event_type")
    return found.select("user_id", "event_type")


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id, CAST(floor(epoch(ts) / 86400) AS BIGINT) HAVING count(*) > 1")
def over_limit(spark, sf_dir):
    """Keys over the limit of a day's window."""
    return jobs.over_limit(table(spark, sf_dir, "events"), "ts", "1 day", ["event_type", "user_id"], 1).select("event_type", "user_id", "n")


@query("SELECT arg_min(event_id, (ts, event_id)) AS event_id, user_id FROM events GROUP BY user_id")
def unseen_content(spark, sf_dir):
    """Rows whose key did not come before."""
    ev = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return jobs.unseen(ev, "user_id", "at").select("event_id", "user_id")


@query("""SELECT r.r_name, n.n_name, count(*) AS n_customers, coalesce(CAST(sum(CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT), 0) AS n_negative FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY r.r_name, n.n_name""")
def expected_lookup(spark, sf_dir):
    """Small tables looked up by key."""
    nations = J.lookup(table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, sf_dir, "region"), ["r_regionkey"], "r_name", "?").withColumnRenamed("n_nationkey", "c_nationkey")
    customers = table(spark, sf_dir, "customer").join(J.checked_broadcast(nations), "c_nationkey")
    return customers.groupBy("r_name", "n_name").agg(F.count("*").alias("n_customers"), F.count_if(F.expr("c_acctbal < 0")).alias("n_negative"))


@query("""SELECT event_type, window_start AS minute_key, count(*) AS n FROM (SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS window_start FROM events) GROUP BY event_type, window_start""")
def rate_windows(spark, sf_dir):
    """Fixed-window counts, as the rate limits take them; the same plan runs on a stream."""
    from ..streaming.jobs import fixed_windows

    counted = fixed_windows(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"])
    return counted.select("event_type", F.floor(F.unix_timestamp("window_start") / 3600).alias("minute_key"), "n")
