"""Queries over ordered events, orders and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import folds
from ..operators import order as O
from ..sources.tables import event_pages, table
from .registry import query

EV = "ev AS (SELECT user_id, event_id, ts, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pg FROM events)"
BEFORE = "PARTITION BY user_id ORDER BY pg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
AFTER = "PARTITION BY user_id ORDER BY pg ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"


def is_(kind):
    return F.col("event_type") == kind



USER = ["user_id"]


def _last(ev):
    return ev.groupBy("user_id").agg(F.max("pg").alias("last"))


@query(f"""WITH {EV}, l AS (SELECT user_id, max(pg) AS last FROM ev GROUP BY user_id)
SELECT e.user_id, e.pg AS page_start, greatest(coalesce(lead(e.pg) OVER (PARTITION BY e.user_id ORDER BY e.pg) - 1, l.last), e.pg) AS page_end FROM ev e JOIN l ON l.user_id = e.user_id WHERE event_type = 'purchase'""")
def interval_close(spark, sf_dir):
    ev = event_pages(spark, sf_dir)
    starts = ev.where(is_("purchase")).join(_last(ev), "user_id")
    return O.close_intervals(starts, USER, "pg", F.col("last")).select("user_id", F.col("pg").alias("page_start"), "page_end")


@query(f"""WITH {EV}, w AS (SELECT *, min(CASE WHEN event_type = 'purchase' THEN pg END) OVER ({AFTER}) AS nxt, min(CASE WHEN event_type = 'error' THEN pg END) OVER ({AFTER}) AS stop, max(pg) OVER (PARTITION BY user_id) AS last FROM ev)
SELECT user_id, pg AS page_start, coalesce(least(nxt, stop) - 1, last) AS page_end FROM w WHERE event_type = 'purchase'""")
def interval_close_early_stop(spark, sf_dir):
    ev = event_pages(spark, sf_dir)
    joined = ev.join(_last(ev), "user_id")
    return O.close_at_blocker(joined, USER, "pg", is_("purchase"), is_("error"), F.col("last")).select("user_id", "page_start", "page_end")


@query(f"""WITH {EV}, m AS (SELECT *, coalesce(max(CASE WHEN event_type = 'purchase' THEN pg END) OVER ({BEFORE}), 0) AS prev FROM ev),
s AS (SELECT user_id, prev, min(CASE WHEN event_type = 'signup' THEN pg END) AS st FROM m GROUP BY user_id, prev)
SELECT m.user_id, coalesce(s.st, m.prev + 1) AS page_start, m.pg AS page_end FROM m JOIN s ON s.user_id = m.user_id AND s.prev = m.prev WHERE event_type = 'purchase'""")
def end_marker_intervals(spark, sf_dir):
    return O.forward_intervals(event_pages(spark, sf_dir), USER, "pg", is_("purchase"), is_("signup")).select("user_id", "page_start", "page_end")


@query(f"""WITH {EV}, w AS (SELECT *, max(CASE WHEN event_type = 'purchase' THEN pg END) OVER ({BEFORE}) AS near FROM ev)
SELECT user_id, event_id, pg, CASE WHEN pg - near <= 3 THEN near END AS marker FROM w WHERE pg - near <= 3""")
def nearest_previous_marker(spark, sf_dir):
    return O.nearest_before(event_pages(spark, sf_dir), USER, ["pg"], "pg", is_("purchase"), 3).where("marker is not null").select("user_id", "event_id", "pg", "marker")


LINEITEM = "l AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) AS pg FROM lineitem)"


def _lines(spark, sf_dir):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax"]
    return O.page_axis(table(spark, sf_dir, "lineitem"), ["l_suppkey"], order).select("l_suppkey", "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey", "pg")


@query(f"WITH {LINEITEM}, w AS (SELECT *, lag(l_linenumber) OVER (PARTITION BY l_suppkey ORDER BY pg) AS p FROM l) SELECT l_suppkey, l_orderkey, pg FROM w WHERE l_linenumber = 1 AND p > 1")
def number_restart(spark, sf_dir):
    return O.restarts(_lines(spark, sf_dir), ["l_suppkey"], ["pg"], "l_linenumber").select("l_suppkey", "l_orderkey", "pg")


@query("WITH w AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations WHERE role IS NOT NULL) SELECT conv_id, turn, previous, role FROM w WHERE previous IS NOT NULL AND previous <> role")
def value_change(spark, sf_dir):
    return O.changes(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "role").select("conv_id", "turn", "previous", "role")


@query(f"WITH {LINEITEM}, w AS (SELECT *, max(l_linenumber - 1) OVER (PARTITION BY l_suppkey ORDER BY pg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM l) SELECT l_suppkey, pg, l_orderkey FROM w WHERE l_linenumber = 1 AND m >= 1")
def running_max_restart(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumn("rank", F.col("l_linenumber") - 1)
    return O.running_max_restarts(lines, ["l_suppkey"], ["pg"], "rank").select("l_suppkey", "pg", "l_orderkey")


@query(f"""WITH {EV}, n AS (SELECT *, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 END AS sn FROM ev),
p AS (SELECT *, lag(sn) OVER (PARTITION BY user_id ORDER BY pg) AS b FROM n WHERE sn IS NOT NULL), c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pg) AS i FROM p WHERE b IS NULL OR b <> sn),
f AS (SELECT *, coalesce(max(CASE WHEN sn = 1 AND i > 1 THEN i END) OVER (PARTITION BY user_id), 1) AS start_ FROM c), k AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM f WHERE i >= start_)
SELECT user_id, pg, CAST(sn AS BIGINT) AS session FROM k WHERE n >= 2""")
def session_transitions(spark, sf_dir):
    ev = event_pages(spark, sf_dir).withColumn("session", F.when(is_("signup"), 1).when(is_("purchase"), 2).when(is_("error"), 3).cast("long"))
    return O.transitions(ev, USER, ["pg"], "session").select("user_id", "pg", "session")


@query(f"""WITH {EV}, d AS (SELECT *, CAST(day(ts) AS BIGINT) AS d FROM ev), p AS (SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY pg) AS b FROM d), c AS (SELECT * FROM p WHERE b IS NULL OR b <> d),
k AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM c) SELECT user_id, pg, d AS day FROM k WHERE n >= 5""")
def day_transitions(spark, sf_dir):
    ev = event_pages(spark, sf_dir).withColumn("day", F.dayofmonth("ts").cast("long"))
    return O.transitions(ev, USER, ["pg"], "day", 5, False).select("user_id", "pg", "day")


@query(f"""WITH {EV}, e AS (SELECT user_id, pg, CASE WHEN pg - lag(pg) OVER (PARTITION BY user_id ORDER BY pg) <= 2 THEN 0 ELSE 1 END AS new FROM ev WHERE event_type = 'view'),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY pg) AS island FROM e)
SELECT user_id, CAST(island AS BIGINT) AS island, min(pg) AS page_start, max(pg) AS page_end, count(*) AS n_pages FROM g GROUP BY user_id, island""")
def islands_gap(spark, sf_dir):
    return O.island_ranges(event_pages(spark, sf_dir).where("event_type = 'view'"), USER, "pg", 2)


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate, o_orderstatus <> 'F' AS topic FROM orders)
SELECT o_custkey, o_orderkey, CASE WHEN topic THEN CAST(sum(CASE WHEN topic THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) ELSE 0 END AS num,
CASE WHEN topic THEN CAST(sum(CASE WHEN topic THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) ELSE 0 END AS session_q FROM o""")
def renumber(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return O.renumber(orders, ["o_custkey"], ["o_orderstatus"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") != "F").select("o_custkey", "o_orderkey", "num", "session_q")


@query("SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS occurrence FROM events")
def occurrence_index(spark, sf_dir):
    return O.occurrence(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type", "occurrence")


@query(f"""WITH {EV}, s AS (SELECT user_id, pg, row_number() OVER (PARTITION BY user_id ORDER BY pg) - 1 AS i, lead(pg) OVER (PARTITION BY user_id ORDER BY pg) - pg AS g FROM ev WHERE event_type IN ('purchase', 'signup')),
t AS (SELECT *, min(CASE WHEN g >= 4 THEN i END) OVER (PARTITION BY user_id) + 1 AS t FROM s)
SELECT user_id, pg, CAST(CASE WHEN t IS NULL OR i < t THEN 1 ELSE least(2 + (i - t) // 8, 4) END AS BIGINT) AS session FROM t""")
def gap_pattern_sessions(spark, sf_dir):
    starts = event_pages(spark, sf_dir).where("event_type in ('purchase', 'signup')")
    return O.gap_sessions(starts, USER, "pg").select("user_id", "pg", "session")


@query(f"""WITH {EV}, n AS (SELECT user_id, pg, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 END AS k FROM ev),
p AS (SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM n)
SELECT user_id, pg, least(CAST(1 + sum(CASE WHEN k < b THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pg) AS BIGINT), 4) AS session FROM p""")
def reset_sessions(spark, sf_dir):
    ev = event_pages(spark, sf_dir).withColumn("k", F.when(is_("signup"), 1).when(F.col("event_type") == "view", 2).when(is_("purchase"), 3))
    return O.reset_sessions(ev, USER, ["pg"], "k").select("user_id", "pg", "session")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice AS s, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn, min(o_totalprice) OVER (PARTITION BY o_custkey) AS mn FROM orders),
k AS (SELECT *, coalesce(max(CASE WHEN rn = 5 THEN s END) OVER (PARTITION BY o_custkey), mn) AS kth FROM r), p AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN s * 0.6 ELSE s END AS s FROM k WHERE s >= kth * 0.5),
q AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY s DESC, o_orderkey) AS rn FROM p) SELECT o_custkey, o_orderkey, round(s, 4) AS score FROM q WHERE rn <= 5""")
def kth_threshold_topk(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_totalprice", "score")
    return O.kth_threshold(orders, ["o_custkey"], "score", ["o_orderkey"], 5, weak=F.col("o_orderstatus") == "F").select("o_custkey", "o_orderkey", F.round("score", 4).alias("score"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 5")
def topk_per_group(spark, sf_dir):
    return O.first_by(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 5).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type")
def first_candidate(spark, sf_dir):
    return O.first_by(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type")
def last_candidate(spark, sf_dir):
    return O.first_by(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id")


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS number, l_extendedprice AS score, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1")
def best_per_key_tiebreak(spark, sf_dir):
    """The best score of each number; of equals the first."""
    best = O.first_by(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc("l_extendedprice"), "l_partkey", "l_suppkey"])
    return best.select("l_orderkey", F.col("l_linenumber").cast("long").alias("number"), F.col("l_extendedprice").alias("score"), "l_partkey")


@query(f"""WITH {EV}, s AS (SELECT user_id, min(pg) AS page_start, max(pg) AS page_end FROM ev GROUP BY user_id, (pg - 1) // 6 HAVING count(*) = 6),
f AS (SELECT user_id, min(page_start) AS lo, max(page_end) AS hi, max(pg_) AS last FROM (SELECT s.user_id, page_start, page_end, e.last AS pg_ FROM s JOIN (SELECT user_id, max(pg) AS last FROM ev GROUP BY user_id) e ON e.user_id = s.user_id) GROUP BY user_id)
SELECT user_id, lo AS page_start, hi + CASE WHEN last - hi BETWEEN 1 AND 4 THEN last - hi ELSE 0 END AS page_end FROM f
UNION ALL SELECT user_id, hi + 1, last FROM f WHERE last - hi > 4""")
def repair_session_gaps(spark, sf_dir):
    """Session ranges that don't reach the last page take it in, or get a block."""
    ev = event_pages(spark, sf_dir)
    blocks = ev.groupBy("user_id", F.expr("(pg - 1) div 6").alias("b")).agg(F.count("*").alias("n"), F.min("pg").alias("lo"), F.max("pg").alias("hi")).where("n = 6")
    whole = blocks.groupBy("user_id").agg(F.min("lo").alias("page_start"), F.max("hi").alias("page_end")).join(_last(ev), "user_id")
    return O.repair_gaps(whole, USER, "page_start", "page_end", F.col("last")).select("user_id", "page_start", "page_end")


@query(f"""WITH {EV}, e AS (SELECT * FROM ev WHERE event_type = 'view'), b AS (SELECT *, CASE WHEN value < 50 THEN NULL ELSE CAST(day(ts) AS BIGINT) END AS number FROM e)
SELECT user_id, pg, coalesce(number, CAST(sum(CASE WHEN number IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pg) AS BIGINT)) AS number FROM b""")
def number_blocks(spark, sf_dir):
    """Rows without a number are numbered within their block."""
    views = event_pages(spark, sf_dir).where("event_type = 'view'").withColumn("number", F.when(~(F.col("value") < 50), F.dayofmonth("ts").cast("long")))
    return O.number_blocks(views, USER, ["pg"], "number").select("user_id", "pg", "number")


@query(f"""WITH RECURSIVE {EV}, s AS (SELECT user_id, pg, row_number() OVER (PARTITION BY user_id ORDER BY pg) AS i FROM ev WHERE event_type = 'view'),
r AS (SELECT user_id, i, pg, pg AS kept, true AS keep FROM s WHERE i = 1 UNION ALL SELECT s.user_id, s.i, s.pg, CASE WHEN s.pg - r.kept > 10 THEN s.pg ELSE r.kept END, s.pg - r.kept > 10 FROM r JOIN s ON s.user_id = r.user_id AND s.i = r.i + 1)
SELECT user_id, pg FROM r WHERE keep""")
def greedy_merge(spark, sf_dir):
    """A page is kept if it is over ten pages after the last kept one."""
    views = event_pages(spark, sf_dir).where("event_type = 'view'")
    return folds.greedy_covers(views, USER, "pg", 10).select("user_id", "pg")


@query(f"""WITH RECURSIVE {EV}, s AS (SELECT user_id, pg, event_id % 16 AS n, row_number() OVER (PARTITION BY user_id ORDER BY pg) AS i FROM ev),
r AS (SELECT user_id, i, pg, n, CASE WHEN n BETWEEN 1 AND 3 THEN n ELSE 0 END AS last, n BETWEEN 1 AND 3 AS keep FROM s WHERE i = 1
UNION ALL SELECT s.user_id, s.i, s.pg, s.n, CASE WHEN s.n > r.last AND s.n - r.last <= 3 THEN s.n WHEN s.n = 1 AND r.last >= 5 THEN 1 ELSE r.last END, (s.n > r.last AND s.n - r.last <= 3) OR (s.n = 1 AND r.last >= 5) FROM r JOIN s ON s.user_id = r.user_id AND s.i = r.i + 1)
SELECT user_id, pg, n AS number FROM r WHERE keep""")
def monotone_select(spark, sf_dir):
    """Rising numbers with steps of three at most, or a restart at 1 after five."""
    ev = event_pages(spark, sf_dir).withColumn("number", F.col("event_id") % 16)
    return folds.promote_rising(ev, USER, ["pg"], "number").select("user_id", "pg", "number")
