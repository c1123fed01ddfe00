"""Publishers' formats: which one a document has, and its intervals by that format's end and start marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import catalog as C
from ..functions.text import flat_group, flat_has, has, strip
from ..sources.stages import staged
from . import aggregates, joins, order, titles


def format_counts(elements: DataFrame) -> DataFrame:
    c = F.trim(F.coalesce("content", F.lit("")))
    cell = F.coalesce("is_table_cell", F.lit(False))
    text = F.col("type").isin("heading", "paragraph")
    return elements.groupBy("doc_id").agg(
        F.max("page").alias("pages"),
        F.count_if(cell & (F.length(c) < 10) & flat_has(c, C.KPC_PROBLEM)).alias("problem"),
        F.count_if(flat_has(c, C.KPC_OPINION)).alias("opinion"),
        F.count_if(flat_has(c, C.KPC_HEADER)).alias("kpc_header"),
        F.count_if(has(c, C.STAR)).alias("stars"),
        F.count_if(has(c, C.ITPE_END)).alias("ends"),
        F.count_if(cell & flat_has(c, C.ITPE_META)).alias("meta"),
        F.count_if(text & has(c, C.SESSION_TOPIC)).alias("session_topic"),
        F.count_if(cell & flat_has(c, C.INFOLEVER)).alias("infolever"),
        F.count_if(flat_has(c, C.AIRIPO_MOCK)).alias("mock"),
        F.count_if(flat_has(c, C.AIRIPO_MORE)).alias("more"),
        F.count_if((cell | (F.col("type") == "paragraph")) & has(c, C.BRACKET)).alias("bracket"),
    )


def detect_format(elements: DataFrame) -> DataFrame:
    """A1: the first rule of the ladder that a document's counts meet."""
    n = F.col
    rules = [
        ((n("problem") >= 5) | ((n("opinion") >= 5) & (n("opinion") >= n("ends"))) | ((n("kpc_header") >= 0.5 * n("pages")) & (n("stars") >= 5)), "KPC"),
        (n("session_topic") >= 5, "DONGKIHOE"),
        ((n("ends") >= 5) & (n("meta") >= 3), "ITPE"),
        (n("infolever") >= F.greatest(F.lit(5.0), 0.3 * n("pages")), "INFOLEVER"),
        ((n("mock") >= 2) | (n("more") >= 5) | ((n("infolever") >= 5) & (n("more") >= 1)), "AIRIPO"),
        (n("bracket") >= 5, "DONGKIHOE"),
        (n("ends") >= 10, "ITPE"),
    ]
    return aggregates.ladder(format_counts(elements), rules, "FALLBACK")


def format_pages(elements: DataFrame) -> DataFrame:
    """One row for every page from 1 to the document's last: its marks, false where a page has no elements, and the number of its session header."""
    c = strip(F.coalesce("content", F.lit("")))
    cell = F.coalesce("is_table_cell", F.lit(False))
    header = flat_group(c, C.AIRIPO_SESSION).cast("int")
    marks = elements.groupBy("doc_id", "page").agg(
        F.bool_or(has(c, C.END)).alias("end"),
        (F.count_if(cell & flat_has(c, C.ITPE_LABEL)) >= 2).alias("meta"),
        F.bool_or(has(c, C.ITPE_COVER) | ((F.col("type") == "heading") & has(c, C.ITPE_SELECT))).alias("itpe_cover"),
        F.bool_or(flat_has(c, C.KPC_OPINION)).alias("opinion"),
        F.bool_or(has(c, C.STAR_START)).alias("star"),
        F.bool_or(flat_has(c, C.FORMAT_COVER)).alias("cover"),
        F.bool_or(flat_has(c, C.KPC_NOISE)).alias("noise"),
        F.bool_or(has(c, C.STAR_START) | has(c, C.JE_NUM)).alias("signed"),
        F.max_by(header, F.when(header.isNotNull(), F.col("elem_idx"))).alias("header"),
    )
    every = elements.groupBy("doc_id").agg(F.max("page").alias("n_pages")).select("doc_id", "n_pages", F.explode(F.sequence(F.lit(1), "n_pages")).alias("page"))
    flags = [f.name for f in marks.schema if f.dataType.typeName() == "boolean"]
    return every.join(joins.grown(marks), ["doc_id", "page"], "left").na.fill(False, flags)


def runs(pages: DataFrame, end: Column, start: Column, skip: Column) -> DataFrame:
    """One row for each end page, and one for what is left behind the last: doc_id, prev (the end before, 0 for none), page_start, end (null for the rest), last, and of its pages mark (the first start mark), mark_skipped, free (the first that isn't skipped) and n_free.

    It starts at the first start mark, else right after the end before, then
    at the first page from there on that isn't skipped, its end at the latest.
    """
    earlier = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    run = Window.partitionBy("doc_id", "prev")
    page = F.col("page")
    t = pages.withColumns({"_e": end, "_s": start, "_skip": skip}).withColumn("prev", F.coalesce(F.max(F.when(F.col("_e"), page)).over(earlier), F.lit(0)))
    t = t.withColumn("_mark", F.min(F.when(F.col("_s"), page)).over(run))
    g = t.groupBy("doc_id", "prev").agg(
        F.max(F.when(F.col("_e"), page)).alias("end"),
        F.max("page").alias("last"),
        F.min("_mark").alias("mark"),
        F.coalesce(F.bool_or(F.col("_skip") & (page == F.col("_mark"))), F.lit(False)).alias("mark_skipped"),
        F.min(F.when(~F.col("_skip"), page)).alias("free"),
        F.count_if(~F.col("_skip")).alias("n_free"),
        F.min(F.when(~F.col("_skip") & (page >= F.coalesce("_mark", F.col("prev") + 1)), page)).alias("_open"),
    )
    return g.withColumn("page_start", F.coalesce("_open", "end", "free", F.col("prev") + 1)).drop("_open")


def _intervals(closed: DataFrame, tails: DataFrame, tail_start: Column) -> DataFrame:
    one = closed.select("doc_id", "page_start", F.col("end").alias("page_end"), F.lit(0.85).alias("confidence"))
    return one.unionByName(tails.select("doc_id", tail_start.alias("page_start"), F.col("last").alias("page_end"), F.lit(0.60).alias("confidence")))


def fronts(pages: DataFrame, blocks: DataFrame, first_topic: Column, wanted: Column | None = None) -> DataFrame:
    """The pages of each session before its first topic: doc_id, session, title, page_start, page_end, confidence, fmt. first_topic and wanted are aggregates over a session's pages, which have block_start and block_end."""
    spread = blocks.select("doc_id", F.col("session").cast("long").alias("session"), F.col("page_start").alias("block_start"), F.col("page_end").alias("block_end"), F.explode(F.sequence("page_start", "page_end")).alias("page"))
    g = pages.join(joins.grown(spread), ["doc_id", "page"]).groupBy("doc_id", "session", "block_start").agg(first_topic.alias("_first"), F.sort_array(F.collect_list(F.when(wanted if wanted is not None else F.lit(True), F.col("page")))).alias("_pages"))
    before = g.where(F.col("_first") > F.col("block_start"))
    if wanted is not None:
        before = before.where((F.get("_pages", F.lit(0)) < F.col("_first")) | (F.col("_first") > F.col("block_start") + 1))
    title = F.concat(F.lit("문제지_"), F.col("session").cast("string"), F.lit("교시"))
    return before.select("doc_id", "session", title.alias("title"), F.col("block_start").alias("page_start"), (F.col("_first") - 1).alias("page_end"), F.lit(0.95).alias("confidence"), F.lit("question_pages").alias("fmt"))


COLUMNS = ["doc_id", "session", "title", "page_start", "page_end", "confidence", "fmt"]


def _named(topics: DataFrame, titles_: DataFrame, rules: list[str], fmt: str, pages: int = 2) -> DataFrame:
    found = titles.range_titles(topics, titles_, rules, pages)
    return found.withColumn("title", F.coalesce("title", titles.placeholder(F.col("page_start")))).withColumn("fmt", F.lit(fmt)).select(*COLUMNS)


def _in_sessions(topics: DataFrame, blocks: DataFrame, by: str = "page_start") -> DataFrame:
    return joins.session_of(topics.repartition("doc_id", "page_start"), blocks, ["doc_id"], "page_start", by)


def itpe(pages: DataFrame, blocks: DataFrame, titles_: DataFrame) -> DataFrame:
    """Topics close at the word for the end and open at a cluster of labels; covers are skipped. What is left behind the last end is a topic where it opens with a cluster."""
    found = runs(pages, F.col("end"), F.col("meta"), F.col("itpe_cover"))
    tails = found.where("end is null and prev > 0 and mark is not null and not mark_skipped")
    topics = _in_sessions(_intervals(found.where("end is not null"), tails, F.col("mark")), blocks)
    first = F.coalesce(F.min(F.when(F.col("meta") & ~F.col("itpe_cover"), F.col("page"))), F.min(F.when(F.col("end"), F.col("page"))))
    return _named(topics, titles_, ["own"], "ITPE", 1).unionByName(fronts(pages, blocks, first, F.col("itpe_cover")).select(*COLUMNS))


def kpc(pages: DataFrame, blocks: DataFrame, titles_: DataFrame) -> DataFrame:
    """Topics close at opinions and open at stars, where a document has opinions; else each star page opens one. Covers, and noise on pages without a topic's sign (A8), are skipped."""
    known = pages.withColumn("skip", F.col("cover") | (F.col("noise") & ~F.col("signed"))).withColumn("opinions", F.count_if("opinion").over(Window.partitionBy("doc_id")))
    by_opinion, by_star = known.where("opinions > 0"), known.where("opinions = 0")
    found = runs(by_opinion, F.col("opinion"), F.col("star"), F.col("skip"))
    main = _intervals(found.where("end is not null"), found.where("end is null and prev > 0 and n_free >= 2"), F.col("free"))
    upto = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    opened = by_star.withColumn("_at", F.max(F.when(F.col("star"), F.col("page"))).over(upto)).where("_at is not null")
    stars = opened.groupBy("doc_id", F.col("_at").alias("page_start")).agg(F.max(F.when(~F.col("skip"), F.col("page"))).alias("page_end"), F.bool_or((F.col("page") == F.col("_at")) & F.col("skip")).alias("_skip"))
    both = main.unionByName(stars.where("not _skip").select("doc_id", "page_start", "page_end", F.lit(0.80).alias("confidence")))
    topics = _in_sessions(both, blocks)
    free = F.when(~F.col("skip"), F.col("page"))
    ends = F.min(F.when(F.col("opinion"), F.col("page")))
    first = F.coalesce(F.min(F.when(F.col("star"), free)), F.when(F.min(free) <= ends, F.min(free)))
    return _named(topics, titles_, ["je", "numbered", "plain"], "KPC").unionByName(fronts(by_opinion, blocks, first).select(*COLUMNS))


def airipo(pages: DataFrame, titles_: DataFrame) -> DataFrame:
    """Sessions by their headers (A10; without any one block); topics close at the word for the end, up to the last session's end. In front of the first session stands the cover, behind the last one the original paper."""
    headed = aggregates.session_ranges(pages.where("header is not null").select("doc_id", "page", "header"), ["doc_id"], "page", "page", "header")
    whole = pages.groupBy("doc_id").agg(F.max("n_pages").alias("n_pages"))
    single = whole.join(joins.grown(headed), "doc_id", "left_anti").select("doc_id", F.lit(0).alias("header"), F.lit(1).alias("page_start"), F.col("n_pages").alias("page_end"))
    blocks = headed.select("doc_id", "header", "page_start", "page_end").unionByName(single).repartition("doc_id", "header")
    span = whole.join(joins.grown(blocks.groupBy("doc_id").agg(F.min("page_start").alias("front"), (F.max("page_end") + 1).alias("cut"), F.min_by("page_start", "header").alias("opening"))), "doc_id")
    inside = pages.join(joins.grown(span.select("doc_id", "cut", "opening")), "doc_id").where(F.col("page") < F.col("cut"))
    found = runs(inside, F.col("end"), F.lit(False), F.lit(False)).join(joins.grown(span.select("doc_id", "opening")), "doc_id")
    closed = found.where("end is not null").withColumn("page_start", F.greatest(F.col("prev") + 1, F.col("opening"))).where("page_start <= end")
    cut = _intervals(closed, found.where("end is null and prev > 0"), F.col("prev") + 1)
    topics = _in_sessions(cut, blocks.withColumnRenamed("header", "session"), "session")
    named = titles.range_titles(topics, titles_, ["airipo"]).where("title is not null or confidence > 0.6")
    own = named.withColumn("title", F.coalesce("title", titles.placeholder(F.col("page_start")))).withColumn("fmt", F.lit("AIRIPO")).select(*COLUMNS)

    def paper(rows: DataFrame, title: str, start: Column, end: Column) -> DataFrame:
        return rows.select("doc_id", F.lit(0).cast("long").alias("session"), F.lit(title).alias("title"), start.alias("page_start"), end.alias("page_end"), F.lit(0.95).alias("confidence"), F.lit("question_pages").alias("fmt"))

    cover = paper(span.where("front > 1"), "표지", F.lit(1), F.col("front") - 1)
    return own.unionByName(cover).unionByName(paper(span.where("cut <= n_pages"), "시험문제_원본", F.col("cut"), F.col("n_pages")))


def by_format(e: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each document's topics and question pages by its own format, numbered; taken only with max(5, pages / 10) topics or more: doc_id, session, num, session_q, title, page_start, page_end, confidence, fmt. e as titles.marked() gives it, blocks its sessions."""
    kinds = detect_format(e).select("doc_id", "pages", "format")
    pages = staged(format_pages(e).join(joins.grown(kinds.select("doc_id", "format")), "doc_id"))
    shown = staged(titles.page_titles(e.join(kinds.where("format in ('ITPE', 'KPC', 'AIRIPO')"), "doc_id", "left_semi")))
    of = lambda name: pages.where(F.col("format") == name).drop("format")
    found = staged(itpe(of("ITPE"), blocks, shown).unionByName(kpc(of("KPC"), blocks, shown)).unionByName(airipo(of("AIRIPO"), shown)))
    topic = F.col("fmt") != "question_pages"
    n = found.groupBy("doc_id").agg(F.count_if(topic).alias("_n")).join(joins.grown(kinds), "doc_id").where(F.col("_n") >= F.greatest(F.lit(5), F.floor(F.col("pages") / 10)))
    kept = found.join(joins.grown(n.select("doc_id")), "doc_id", "left_semi").withColumn("_q", order.questions_first())
    numbered = order.renumber(kept, ["doc_id"], ["session"], ["page_start", "_q", "page_end"], topic)
    return numbered.select("doc_id", "session", "num", "session_q", "title", "page_start", "page_end", "confidence", "fmt")
