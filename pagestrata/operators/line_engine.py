"""Topics from page lines: header trim, line signals, candidates, sessions, rising numbers, intervals.

Input is one row a page: doc_id, page (from 1), lines. Everything up to the
choice of rising numbers is expressions and windows; that choice is a state
machine over a document's candidates, a fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import catalog as C
from ..functions.text import U, has, let, strip
from ..sources.stages import staged
from . import folds, order


def body(lines: Column, most: int = C.LINES_SEEN) -> Column:
    """Lines with text from the first that is neither brand nor the one page number; all if the first `most` have none."""
    return let(F.filter(F.transform(lines, strip), lambda x: x != ""), lambda cleaned: _without_head(cleaned, most))


def _without_head(cleaned: Column, most: int) -> Column:
    head = F.transform(F.slice(cleaned, 1, most), lambda x, i: F.struct(x.alias("x"), i.alias("i")))

    def step(a, r):
        x = r["x"]
        number = has(x, C.NUM_ONLY)
        in_range = F.regexp_extract(x, U + C.NUM_ONLY, 1).try_cast("int").between(1, 30)
        anchor = has(x, C.NUM_TOPIC) | has(x, C.NUM_BUN) | has(x, C.PROBLEM_LINE) | has(x, C.SESSION_LINE) | has(x, C.SELECT_LINE)
        brand = has(x, C.BRAND) | has(x, C.BRAND_PIECE)
        page = has(x, C.PAGE_NUMBER)
        stop = F.struct(r["i"].alias("start"), a["used"].alias("used"), F.lit(True).alias("done"))
        use = F.struct(a["start"].alias("start"), F.lit(True).alias("used"), F.lit(False).alias("done"))
        return (
            F.when(a["done"], a)
            .when(number & in_range & a["used"], stop)
            .when(number & ~a["used"], use)
            .when(number | anchor, stop)
            .when(brand, a)
            .when(page & ~a["used"], use)
            .otherwise(stop)
        )

    start = F.struct(F.lit(0).alias("start"), F.lit(False).alias("used"), F.lit(False).alias("done"))
    return F.aggregate(head, start, step, lambda a: F.slice(cleaned, a["start"] + 1, F.greatest(F.size(cleaned) - a["start"], F.lit(0))))


def first_anchor(lines: Column, anchor, most: int = 16) -> Column:
    """Lines from the first of the first `most` that `anchor` holds for; all if there is none."""
    at = F.filter(F.transform(F.slice(lines, 1, most), lambda x, i: F.when(anchor(x), i)), lambda i: i.isNotNull())
    return F.when(F.size(at) > 0, F.slice(lines, F.get(at, F.lit(0)) + 1, F.size(lines))).otherwise(lines)


def page_kind(body_: Column) -> Column:
    """P10, P11."""
    head = F.slice(body_, 1, 14)
    paper = F.exists(head, lambda x: has(x, C.SELECT_LINE)) | (F.exists(head, lambda x: has(x, C.SESSION_LINE)) & F.exists(head, lambda x: has(x, C.PAPER_WORDS)))
    empty = (F.size(body_) == 0) | ((F.size(body_) <= 2) & F.exists(body_, lambda x: has(x, C.COPYRIGHT)))
    return F.when(empty, "EMPTY_PAGE").when(paper, "SESSION_PAPER").otherwise("BODY")


def line_signals(pages: DataFrame) -> DataFrame:
    """doc_id, page, line_idx, type, num, session, text; the first rule that fits a line. pages has body."""
    x, j = F.col("x"), F.col("line_idx")
    at = pages.select("doc_id", "page", F.posexplode(F.slice("body", 1, C.LINES_SEEN)).alias("line_idx", "x"))

    def num(pattern: str) -> Column:
        return F.regexp_extract(x, U + pattern, 1).try_cast("int")

    session = F.coalesce(F.nullif(F.regexp_extract(x, U + C.SESSION_LINE, 1), F.lit("")), F.nullif(F.regexp_extract(x, U + C.SESSION_SHORT, 1), F.lit(""))).cast("int")
    kind = (
        F.when(has(x, C.NUM_ONLY) & num(C.NUM_ONLY).between(0, 30), "qnum_only")
        .when(has(x, C.NUM_TOPIC) & num(C.NUM_TOPIC).between(1, 30), "qnum_topic")
        .when(has(x, C.NUM_BUN) & num(C.NUM_BUN).between(1, 30), "qnum_bun")
        .when(session.isNotNull(), "session")
        .when((j <= 3) & has(x, C.PROBLEM_LINE), "problem")
        .when(has(x, C.DOMAIN_LINE), "domain")
        .when(has(x, C.SELECT_LINE), "select")
        .when(has(x, C.ROMAN_LINE), "roman")
    )
    out = at.withColumn("type", kind).where("type is not null")
    number = F.when(F.col("type") == "qnum_only", num(C.NUM_ONLY)).when(F.col("type") == "qnum_topic", num(C.NUM_TOPIC)).when(F.col("type") == "qnum_bun", num(C.NUM_BUN))
    text = F.when(F.col("type") == "qnum_topic", strip(F.regexp_extract(x, U + C.NUM_TOPIC, 2))).otherwise(x)
    return out.select("doc_id", "page", "line_idx", "type", number.alias("num"), F.when(F.col("type") == "session", session).alias("session"), text.alias("text"))


def candidates(signals: DataFrame, pages: DataFrame) -> DataFrame:
    """Scored pages of WEAK or more: doc_id, page, score, num, session, title, dan, strong."""
    near = signals.where(F.col("line_idx") < C.LINES_SCORED)
    nums = ("qnum_only", "qnum_topic", "qnum_bun")
    counted = sum((F.when(F.bool_or(F.col("type") == t), w).otherwise(0.0) if t in nums else F.count_if(F.col("type") == t) * w for t, w in C.LINE_WEIGHTS.items()), F.lit(0.0))
    saw = lambda t: F.bool_or(F.col("type") == t)
    by = lambda c, cond: F.min_by(c, F.when(cond, F.col("line_idx")))
    agg = near.groupBy("doc_id", "page").agg(
        counted.alias("score"),
        (saw("session") & (saw("qnum_bun") | saw("qnum_only")) & saw("roman")).alias("dgh"),
        (saw("problem") & saw("domain") & F.bool_or((F.col("type") == "problem") & (F.col("line_idx") <= 1))).alias("dan"),
        by("num", F.col("num").isNotNull()).alias("num"),
        by("session", F.col("session").isNotNull()).alias("session"),
        by("text", F.col("type").isin("qnum_topic", "qnum_bun") & (F.length("text") > 3)).alias("t1"),
        F.array_sort(F.collect_list(F.when(F.col("type") == "problem", F.col("line_idx")))).alias("problems"),
        by("text", F.length("text") > 1).alias("t3"),
    )
    scored = agg.withColumn("score", F.col("score") + F.when(F.col("dgh"), 1.0).otherwise(0.0) + F.when(F.col("dan"), 0.5).otherwise(0.0)).where(F.col("score") >= C.WEAK)
    joined = scored.join(pages.select("doc_id", "page", "body"), ["doc_id", "page"])
    after = F.filter(F.transform("problems", lambda j: strip(F.get("body", j + 1))), lambda x: x.isNotNull() & (F.length(x) > 3) & ~has(x, C.DOMAIN_LABEL))
    title = F.coalesce(F.col("t1"), F.get(after, F.lit(0)), F.col("t3"), F.lit(""))
    return joined.select("doc_id", "page", "score", "num", "session", title.alias("title"), "dan", (F.col("score") >= C.STRONG).alias("strong"))


def promote(cands: DataFrame) -> DataFrame:
    """Weak candidates that rise count where a document has under five strong ones."""
    n = F.count_if("strong").over(Window.partitionBy("doc_id"))
    known = cands.withColumn("_n", n)
    weak = known.where(~F.col("strong") & (F.col("_n") < 5) & F.col("num").isNotNull())
    rising = folds.promote_rising(weak, ["doc_id"], ["page"], "num").select("doc_id", "page")
    return known.where("strong").drop("_n").unionByName(known.join(rising, ["doc_id", "page"], "left_semi").drop("_n"))


def paper_sessions(cands: DataFrame, pages: DataFrame) -> DataFrame:
    """Sessions by the papers before a page; candidates of the short pattern without a number are numbered in their session."""
    papers = folds.greedy_covers(pages.where(F.col("kind") == "SESSION_PAPER"), ["doc_id"], "page", 3).groupBy("doc_id").agg(F.array_sort(F.collect_list("page")).alias("_p"))
    joined = cands.join(papers, "doc_id", "left")
    before = F.size(F.filter("_p", lambda p: p < F.col("page")))
    session = F.when(F.col("_p").isNull(), F.col("session")).when(before < F.size("_p"), F.least(F.greatest(before, F.lit(1)), F.lit(4))).otherwise(F.least(F.size("_p") + 1, F.lit(4)))
    out = joined.withColumn("session", session.cast("int"))
    open_ = F.col("num").isNull() & F.col("dan") & F.col("_p").isNotNull()
    w = Window.partitionBy("doc_id", "session").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    numbered = out.withColumn("_i", F.sum(F.when(open_, 1).otherwise(0)).over(w))
    return numbered.withColumn("num", F.when(open_, F.col("_i")).otherwise(F.col("num")).cast("int")).drop("_p", "_i")


def select_rising(cands: DataFrame) -> DataFrame:
    """Candidates whose numbers rise by three at most, session by session: doc_id, page, score, num, session, title.

    Sessions are the given ones where a document has some; else one follows the
    other where a number falls to a third of the last one, of five or more. A number counts once a
    session, up to what the session has room for. Where fewer than five candidates have
    numbers, those without are numbered in order. The last number and the numbers
    seen of each session are the fold's state, one place a session and one
    bit a number.
    """
    document = Window.partitionBy("doc_id")
    bare = F.sum(F.when(F.col("num").isNull(), 1).otherwise(0)).over(document.orderBy("page"))
    known = cands.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), "score", F.col("num").cast("int").alias("num"), F.col("session").cast("int").alias("session"), "title")
    known = known.withColumns({"_few": F.count("num").over(document) < 5, "_bare": bare, "given": F.count("session").over(document) > 0})
    numbered = known.withColumn("num", F.coalesce("num", F.when(F.col("_few"), F.col("_bare"))).cast("int")).drop("_few", "_bare").where("num is not null")
    places = max(C.NUMBER_CAP) + 1
    zeros = F.array(*[F.lit(0)] * places)
    state = {"current": F.lit(1), "last": zeros, "seen": zeros, "session": F.lit(None).cast("int"), "took": F.lit(False)}
    put = lambda values, at, v: F.transform(values, lambda x, i: F.when(i == at, v).otherwise(x))

    def step(s, r):
        n = r["num"]
        own = F.when(r["given"], F.coalesce(r["session"], F.lit(1))).otherwise(s["current"])
        last = F.get(s["last"], own)
        room = n <= F.element_at(F.create_map(*[F.lit(x) for kv in C.NUMBER_CAP.items() for x in kv]), own)
        turn = room & ~r["given"] & (last >= 5) & (n <= F.greatest(F.lit(2), F.floor(last / 3)))
        seen = F.get(s["seen"], own).bitwiseAND(_bit(n)) != 0
        fits = room & ~(seen & (last != n)) & (n - last).between(0, 3)
        took = turn | fits
        to = F.when(turn, F.least(s["current"] + 1, F.lit(places - 1))).otherwise(own)
        return {
            "current": F.when(turn, to).otherwise(s["current"]),
            "last": F.when(took, put(s["last"], to, n)).otherwise(s["last"]),
            "seen": F.when(took, put(s["seen"], to, F.get(s["seen"], to).bitwiseOR(_bit(n)))).otherwise(s["seen"]),
            "session": F.when(took, to),
            "took": took,
        }

    out = folds.fold(numbered, ["doc_id"], ["page"], ["score", "num", "session", "title", "given"], state, step)
    return out.where("state.took").select("doc_id", "page", "score", "num", F.when(F.col("given"), F.col("session")).otherwise(F.col("state.session")).alias("session"), "title")


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.least(n, F.lit(30)))


def topics(pages: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """doc_id, session, num, title, page_start, page_end of every document. Of each page its kind and the lines that are looked at are written on the way: five steps read them."""
    pages = pages.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("page").cast("int").alias("page"), F.slice(body(F.col("lines")), 1, C.LINES_SEEN + 1).alias("body"))
    pages = staged(pages.withColumn("kind", page_kind(F.col("body"))))
    found = select_rising(paper_sessions(promote(candidates(line_signals(pages.where("kind = 'BODY'")), pages)), pages))
    last = pages.groupBy("doc_id").agg(F.max("page").alias("last"))
    marked = pages.select("doc_id", "page", "kind").join(found, ["doc_id", "page"], "left").join(last, "doc_id")
    closed = order.close_at_blocker(marked, ["doc_id"], "page", F.col("num").isNotNull(), F.col("kind") != "BODY", F.col("last"))
    return closed.select("doc_id", "session", "num", "title", "page_start", F.greatest("page_end", "page_start").alias("page_end"))
