"""Mock exam papers: what each page is, which session it is in, and each question's pages.

Pages of lines are told apart by expressions; sessions follow a document's pages
in order, where a printed session forgets the numbers before it, so they are a
fold. Pages of blocks (with font sizes) need counts only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import U, has, strip
from . import folds, order

# Marks of the papers.
SESSION_HEAD = r"제\s*([1-4])\s*교시\s*\(\s*시험시간"
SELECT_HEAD = r"\[\s*컴퓨터시스템응용기술사\s*선택문제\s*\]"
SELECT_BLOCK = r"\[\s*(?:관리|응용)\s*선택\s*\]"
NUMBERED = r"^(\d{1,2})\.\s*(.*)$"
STARS = r"^[★☆]{2,5}"
TOPIC_FONT = (12.0, 14.5)


def classify_lines(pages: DataFrame) -> DataFrame:
    """doc_id, page, body to kind, number, category, topic. A question opens with its number; the label of the problem follows two to five lines later, the label of the domain after that."""
    b = F.col("body")
    head = F.slice(b, 1, 8)
    header = F.get(F.filter(F.transform(head, lambda x: F.nullif(F.regexp_extract(x, U + SESSION_HEAD, 1), F.lit(""))), lambda x: x.isNotNull()), F.lit(0)).cast("int")
    starts = F.filter(
        F.transform(F.slice(b, 1, 30), lambda x, i: F.when(has(x, r"^\d{1,2}$") & (F.array_position(F.slice(b, i + 3, 4), "문제") > 0), i)),
        lambda i: i.isNotNull(),
    )
    t = pages.withColumn("at", F.get(starts, F.lit(0))).withColumn("header", header)
    label = F.col("at") + 2 + F.array_position(F.slice(b, F.col("at") + 3, 4), "문제") - 1  # index from 0
    t = t.withColumn("label", F.when(F.col("at").isNotNull(), label).cast("int"))
    rest = F.slice(b, F.col("label") + 2, F.size(b))
    domain = F.array_position(rest, "도메인")  # from 1, 0 for none
    topic = F.when(F.col("domain") > 0, F.when(F.col("domain") <= 3, F.array_join(F.slice(rest, F.lit(1), F.greatest(F.col("domain") - 1, F.lit(0)).cast("int")), " ")).otherwise(F.get(rest, F.lit(0)))).otherwise(F.coalesce(F.get(rest, F.lit(0)), F.lit("")))
    t = t.withColumn("domain", F.when(F.col("label").isNotNull(), domain))
    kind = (
        F.when(F.size(b) == 0, "EMPTY")
        .when(F.col("header").isNotNull(), "SESSION_HDR")
        .when(F.exists(head, lambda x: has(x, SELECT_HEAD)), "SELECT_HDR")
        .when(F.col("at").isNull(), "Q_BODY")
        .when(F.col("domain") > 0, "Q_START")
        .otherwise("Q_START_PARTIAL")
    )
    t = t.withColumn("kind", kind)
    asks = F.col("kind").startswith("Q_START")
    category = F.array_join(F.slice(b, F.col("at") + 2, F.greatest(F.col("label") - F.col("at") - 1, F.lit(0))), " ")
    return t.select("doc_id", "page", "kind", "header", F.when(asks, F.get(b, F.col("at")).cast("int")).alias("number"), F.when(asks, category).alias("category"), F.when(asks, strip(topic)).alias("topic"))


def line_sessions(kinds: DataFrame) -> DataFrame:
    """A printed session counts and forgets the last number; a number 1 after a larger one is the next session (4 at most); bodies before a session's first question are its paper, before any session the cover."""
    state = {"session": F.lit(None).cast("int"), "last": F.lit(None).cast("int"), "asked": F.lit(False)}

    def step(s, r):
        printed = r["kind"] == "SESSION_HDR"
        asks = r["kind"].startswith("Q_START")
        again = F.coalesce((r["number"] == 1) & (s["last"] > 1), F.lit(False))
        nxt = F.when(s["session"].isNull(), 1).when(again, F.least(s["session"] + 1, F.lit(4))).otherwise(s["session"])
        return {
            "session": F.when(printed, r["header"]).when(asks, nxt).otherwise(s["session"]),
            "last": F.when(printed, None).when(asks, r["number"]).otherwise(s["last"]),
            "asked": F.when(printed, False).when(asks, True).otherwise(s["asked"]),
        }

    out = folds.fold(kinds, ["doc_id"], ["page"], ["kind", "header", "number", "category", "topic"], state, step)
    body = F.col("kind") == "Q_BODY"
    kind = F.when(body & F.col("state.session").isNull(), "COVER").when(body & ~F.col("state.asked"), "EXAM_PAPER").otherwise(F.col("kind"))
    return out.select("doc_id", "page", kind.alias("kind"), F.col("state.session").alias("session"), "number", "category", "topic")


def line_questions(pages: DataFrame) -> DataFrame:
    """doc_id, session, number, topic, page_start, page_end: a question reaches to the next one or to a session's or selection's page."""
    found = line_sessions(classify_lines(pages))
    last = found.groupBy("doc_id").agg(F.max("page").alias("last"))
    joined = found.join(last, "doc_id")
    closed = order.close_at_blocker(joined, ["doc_id"], "page", F.col("kind").startswith("Q_START"), F.col("kind").isin("SESSION_HDR", "SELECT_HDR"), F.col("last"))
    return closed.select("doc_id", "session", "number", "topic", "page_start", F.greatest("page_end", "page_start").alias("page_end"))


def classify_blocks(blocks: DataFrame) -> DataFrame:
    """doc_id, page, kind, number, title from body blocks (doc_id, page, idx, type, text, font_size)."""
    text, size = strip(F.coalesce("text", F.lit(""))), F.col("font_size")
    b = blocks.withColumn("x", text).where("x != ''")
    listed = F.col("type").isin("list", "heading", "paragraph") & F.coalesce(size.between(*TOPIC_FONT), F.lit(False)) & has(F.col("x"), NUMBERED)
    goes_on = F.col("type").isin("heading", "paragraph") & F.coalesce(size.between(*TOPIC_FONT), F.lit(False)) & ~has(F.col("x"), NUMBERED)
    paper = has(F.col("x"), SESSION_HEAD) | has(F.col("x"), SELECT_BLOCK)
    b = b.withColumns({"listed": listed, "goes_on": goes_on, "paper": paper, "star": has(F.col("x"), STARS)})
    rows = F.array_sort(F.collect_list(F.struct("idx", "x", "listed", "goes_on")))
    g = b.groupBy("doc_id", "page").agg(F.bool_or("paper").alias("paper"), F.count_if("listed").alias("n_listed"), F.bool_or("star").alias("star"), F.count("*").alias("n"), F.min(F.when(F.col("listed"), F.col("idx"))).alias("first"), rows.alias("rows"))
    after = F.slice(F.filter("rows", lambda r: r["idx"] > F.col("first")), 1, 7)
    run = F.aggregate(after, F.struct(F.lit("").alias("t"), F.lit(True).alias("on")), lambda a, r: F.when(a["on"] & r["goes_on"], F.struct(F.concat(a["t"], F.lit(" "), r["x"]).alias("t"), F.lit(True).alias("on"))).otherwise(F.struct(a["t"].alias("t"), F.lit(False).alias("on"))), lambda a: a["t"])
    opening = F.get(F.filter("rows", lambda r: r["idx"] == F.col("first")), F.lit(0))["x"]
    kind = F.when(F.col("paper") | (F.col("n_listed") >= 4), "SESSION_PAPER").when((F.col("n_listed") >= 1) | F.col("star"), "Q_START").when(F.col("n") <= 1, "EMPTY_PAGE").otherwise("Q_BODY")
    asks = (kind == "Q_START") & (F.col("n_listed") >= 1)
    return g.select("doc_id", "page", kind.alias("kind"), F.when(asks, F.regexp_extract(opening, U + NUMBERED, 1).cast("int")).alias("number"), F.when(asks, F.trim(F.concat(F.regexp_extract(opening, U + NUMBERED, 2), run))).alias("title"))


def block_sessions(kinds: DataFrame) -> DataFrame:
    """Sessions rise when numbers fall; runs of papers are numbered."""
    found = order.reset_sessions(kinds, ["doc_id"], ["page"], "number")
    papers = order.islands(found.where("kind = 'SESSION_PAPER'"), ["doc_id"], "page", 1, "paper").select("doc_id", "page", "paper")
    return found.join(papers, ["doc_id", "page"], "left")


def problem_list(lines: DataFrame, marker: str = r"문제\s*중|선택") -> DataFrame:
    """numbered lines after the line that asks to choose: doc_id, page, number, title. lines: doc_id, page, line_idx, line."""
    w = Window.partitionBy("doc_id", "page").orderBy("line_idx").rowsBetween(Window.unboundedPreceding, -1)
    x = strip("line")
    mark = has(x, marker)
    after = lines.withColumn("x", x).withColumn("open", F.coalesce(F.max(mark.cast("int")).over(w), F.lit(0)) == 1).where(F.col("open") & ~mark)
    n = F.regexp_extract("x", U + r"^(\d{1,2})\.\s+(.+)", 1)
    return after.where((n != "") & (F.length(F.regexp_extract("x", U + r"^(\d{1,2})\.\s+(.+)", 2)) > 1)).select("doc_id", "page", n.cast("int").alias("number"), F.regexp_extract("x", U + r"^(\d{1,2})\.\s+(.+)", 2).alias("title"))


def sub_split(intervals: DataFrame, pages: DataFrame, share: float = 0.8) -> DataFrame:
    """Long intervals (over 3 pages where ten or more topics are expected, else over 6) are cut at pages that open a section again; their confidence falls to `share`. pages: doc_id, page, opens, sub_title."""
    span = F.col("page_end") - F.col("page_start") + 1
    long_ = span > F.when(F.col("expected") >= 10, 3).otherwise(6)
    inside = intervals.where(long_).withColumn("page", F.explode(F.sequence("page_start", "page_end"))).join(pages.where("opens"), ["doc_id", "page"])
    key = ["doc_id", "session", "page_start", "page_end"]
    cuts = inside.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("page", "sub_title"))).alias("cuts")).where(F.size("cuts") > 1)
    joined = intervals.join(cuts, key, "left")
    whole = F.array(F.struct(F.col("page_start").alias("page"), F.col("title").alias("sub_title")))
    lead = F.when(F.get("cuts", F.lit(0))["page"] > F.col("page_start"), F.concat(whole, F.col("cuts"))).otherwise(F.col("cuts"))
    parts = joined.withColumn("parts", F.when(F.col("cuts").isNull(), whole).otherwise(lead))
    out = parts.select("*", F.posexplode("parts").alias("k", "p"))
    nxt = F.get("parts", F.col("k") + 1)["page"] - 1
    return out.select("doc_id", "session", F.col("p.sub_title").alias("title"), F.col("p.page").alias("page_start"), F.coalesce(nxt, F.col("page_end")).alias("page_end"), F.when(F.col("cuts").isNull(), F.col("confidence")).otherwise(F.col("confidence") * share).alias("confidence"))
