"""Topics from page elements by weighted signals.

Elements (doc_id, page, elem_idx, type, content, font_ratio, is_table_cell,
source) become one row of flags a page; sessions, calibrated weights and the
order-dependent scores are columns on that table, so the elements are read and
shuffled by document once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import catalog as C
from ..functions.text import group, has, strip
from ..sources.stages import staged
from . import aggregates, folds, formats, joins, order, postprocess
from .titles import marked, numbered_cells, said


def pages_in_order():
    return Window.partitionBy("doc_id").orderBy("page")


def document():
    return Window.partitionBy("doc_id")


def shown(e: DataFrame) -> DataFrame:
    """Elements with what each pattern says of them; every pattern is looked for once. Texts are there only where something may take its title from them."""
    c = F.col("c")
    heading, para = F.col("type") == "heading", F.col("type") == "paragraph"
    plain = ~F.col("repeated") & ~F.col("ignored")
    found = e.select(
        "doc_id", "page", F.col("elem_idx").alias("i"), "type", "repeated", "ignored", "font_ratio", "c", plain.alias("plain"), heading.alias("heading"), para.alias("para"), (plain & (heading | para)).alias("spoken"),
        F.coalesce("is_table_cell", F.lit(False)).alias("cell"), F.coalesce(F.col("source") == "ocr", F.lit(False)).alias("ocr"), F.length("c").alias("chars"),
        *[has(c, pattern).alias(k) for k, pattern in {"is_cover": C.COVER, "is_end": C.END, "is_topic_end": C.TOPIC_END, "is_roman": C.ROMAN_I, "is_beyond": C.ROMAN_BEYOND, "is_question": C.QUESTION, "is_star": C.STAR, "is_session_topic": C.SESSION_TOPIC, "is_mark": C.MARKER, "is_noise": C.NOISE}.items()],
        group(c, C.STD_NUM).cast("int").alias("number"), group(c, C.KR_SUB).alias("kr_sign"), F.substring(strip(group(c, C.KR_SUB, 2)), 1, 70).alias("kr_text"),
        group(c, C.MENTI, 2).alias("menti"), group(c, C.SESSION).cast("int").alias("session_said"), group(c, C.DAY).cast("int").alias("day_said"), group(c, C.COVER_CAPTION).cast("int").alias("caption"), group(c, C.HEADER_KW).alias("keyword"),
    )
    told = found.withColumns({"is_menti": F.col("menti").isNotNull(), "asks": F.col("number").isNotNull() & F.col("is_question"), "kr": F.instr(F.lit(C.KR_ORDER), F.col("kr_sign")) - 1})
    told = told.withColumns({
        "roman_text": F.when(F.col("is_roman"), F.substring(strip(F.substring(c, 4, 1 << 20)), 1, 70)),
        "menti_text": F.substring(F.split(strip("menti"), "\n")[0], 1, 70),
        "says": F.when(F.col("plain") & (F.col("chars") >= 5) & ~F.col("is_end") & (F.col("is_menti") | F.col("is_roman") | (F.col("number") == 1) | (heading & (F.col("chars") > 10))), said(c, heading)),
        "story": F.when(F.col("plain") & heading & (F.col("chars") >= 25) & F.col("number").isNull() & F.col("kr_sign").isNull() & ~F.col("is_roman") & ~F.col("is_end"), F.substring(c, 1, 70)),
        "head": F.when((F.col("spoken") & F.col("asks")) | (F.col("plain") & (F.col("is_mark") | ((F.col("font_ratio") >= 1.3) & (F.col("chars") >= 5)))), F.substring(c, 1, 70)),
        "hint": F.when(F.col("is_question") & (F.col("chars") > 20), F.substring(c, 1, 15)),
        "half": F.when(F.col("cell") & (F.col("chars") <= 6), F.when(has(c, r"^\d\s*교시$"), 1).when(has(c, r"^\d+\s*번$"), 2)),
        "figures": (F.col("chars") <= 10) | has(c, r"^[\d%.,\s\-~()]+$"),
    })
    return told.drop("c", "menti", "kr_sign")


def page_flags(e: DataFrame) -> DataFrame:
    """One row a page: what its elements show, with titles by the first or longest element. Elements are written with their marks on the way; flags and counts are hashed, only elements with a title to give are sorted."""
    s = staged(shown(e))
    col, i = F.col, F.col("i")
    plain, spoken = col("plain"), col("spoken")
    any_ = lambda cond: F.bool_or(F.coalesce(cond, F.lit(False)))
    first = lambda v, cond: F.min_by(v, F.when(cond, i))
    longest = lambda v, cond: F.max_by(v, F.when(cond, F.struct(F.length(v), -i)))
    font, mark = plain & (col("font_ratio") >= 1.3) & (col("chars") >= 5), plain & col("is_mark")
    number, kr = col("number"), col("kr")
    flags = s.groupBy("doc_id", "page").agg(
        any_(col("is_cover")).alias("cover"),
        any_(col("is_end") & ~col("ocr")).alias("end"),
        any_(col("is_end")).alias("end_or_ocr"),
        F.count_if(col("is_end") & ~col("ocr")).alias("n_end"),
        any_(col("is_topic_end")).alias("topic_end"),
        F.count_if("is_topic_end").alias("n_topic_end"),
        F.count_if(plain & col("is_roman")).alias("n_roman"),
        F.count_if("is_roman").alias("all_roman"),
        any_(col("is_beyond")).alias("roman_beyond"),
        F.count_if("is_menti").alias("n_menti"),
        first(number, spoken & col("heading") & ~col("is_question") & number.isNotNull()).alias("heading_number"),
        first(number, spoken & number.isNotNull()).alias("any_number"),
        F.count_if(col("heading") & (number == 1)).alias("n_first"),
        any_(spoken & col("is_question")).alias("asks"),
        F.count_if(plain & col("asks")).alias("n_questions"),
        any_(spoken & col("asks")).alias("asks_numbered"),
        any_(plain & (col("is_roman") | col("is_end") | col("is_star"))).alias("answers"),
        any_(plain & (col("chars") >= 5) & (col("is_roman") | col("is_menti") | col("is_session_topic") | col("session_said").isNotNull())).alias("sign"),
        F.count_if(plain & number.isNotNull() & (col("chars") > 10)).alias("n_numbered"),
        first(col("font_ratio"), font).alias("font_size"),
        F.count_if(~col("ignored") & (col("font_ratio") >= 1.3) & (col("chars") > 5)).alias("n_font"),
        F.count_if(mark).alias("n_mark"),
        F.count_if(col("para") & col("is_star")).alias("n_star"),
        F.count_if("is_session_topic").alias("n_session_topic"),
        (any_(col("half") == 1) & any_(col("half") == 2)).alias("split_cells"),
        first(kr, plain & (kr >= 0)).alias("kr"),
        first(col("session_said"), col("session_said").isNotNull()).alias("session_no"),
        first(col("day_said"), col("day_said").isNotNull()).alias("day_no"),
        first(col("caption"), col("caption").isNotNull()).alias("caption_no"),
        any_(~col("repeated") & col("is_noise")).alias("stat_noise"),
        F.count_if(~col("repeated") & (col("type") == "table_marker")).alias("n_tables"),
        F.count_if(~col("repeated") & (col("type") != "table_marker") & (col("chars") > 30) & ~col("is_question")).alias("n_long"),
        F.count_if(~col("repeated") & col("figures")).alias("n_short"),
        any_(plain & ~col("is_cover") & (col("chars") >= 5)).alias("has_content"),
        F.min(F.when(plain & (col("chars") >= 5), i)).alias("_first"),
    )
    titled = ["roman_text", "menti_text", "says", "story", "head", "hint", "keyword", "kr_text"]
    texts = s.where(F.coalesce(*titled).isNotNull()).groupBy("doc_id", "page").agg(
        longest(col("roman_text"), plain & col("is_roman")).alias("roman_title"),
        longest(col("menti_text"), col("is_menti")).alias("menti_title"),
        first(col("head"), spoken & col("asks")).alias("question_title"),
        first(F.coalesce("menti_text", "roman_text"), plain & (col("is_roman") | col("is_menti"))).alias("opening"),
        first(col("says"), col("says").isNotNull()).alias("said"),
        F.min(F.when(col("story").isNotNull(), F.struct("i", "story"))).alias("_story"),
        F.array_sort(F.collect_list("hint")).alias("hints"),
        first(col("head"), font).alias("font_title"),
        first(col("head"), mark).alias("mark_title"),
        first(col("keyword"), col("keyword").isNotNull()).alias("keyword"),
        first(col("kr_text"), plain & (kr >= 0)).alias("kr_title"),
    )
    p = flags.join(joins.grown(texts), ["doc_id", "page"], "left").join(joins.grown(numbered_cells(e)), ["doc_id", "page"], "left")
    own = F.when(F.col("_story.i") == F.col("_first"), F.col("_story.story"))
    out = p.withColumns({"said": F.coalesce("cell_title", "said"), "story": F.when(F.col("_first").isNotNull(), F.struct(own.alias("t"))), "hints": F.coalesce("hints", F.array().cast("array<string>"))})
    return out.drop("cell_title", "_story", "_first")


def block():
    return Window.partitionBy("doc_id", "session")


def noise_pages(t: DataFrame) -> DataFrame:
    """A5: statistics, question lists and tables of each block; statistics in a block's first ten pages extend to its first page with a topic's sign. Adds noise."""
    listed = (F.col("n_questions") >= 2) & (F.col("all_roman") == 0)
    only_tables = (F.col("n_tables") >= 2) & (F.col("n_long") == 0)
    table = only_tables | ((F.col("n_short") >= 8) & (F.col("n_long") <= 1))
    start = F.min(F.when(F.col("filled"), F.col("page"))).over(block())
    early = F.max(F.when(F.col("stat_noise") & (F.col("page") - start < 10), F.col("page"))).over(block())
    first_sign = F.min(F.when(F.col("sign"), F.col("page"))).over(block())
    front = F.coalesce((first_sign > early) & (F.col("page") < first_sign), F.lit(False))
    return t.withColumn("noise", F.col("stat_noise") | listed | table | front)


def sessions(p: DataFrame) -> DataFrame:
    """Blocks (doc_id, session, page_start, page_end, expected): by covers, else changes of session, else of day, else one. A11: a day expects its own count of end pages, or a third of its pages."""
    last = p.groupBy("doc_id").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    beside = lambda shift, by: F.when(shift("page").over(pages_in_order()) == F.col("page") + by, shift("session_no").over(pages_in_order()))
    near = F.when(F.col("cover"), F.coalesce(beside(F.lag, -1), "session_no", beside(F.lead, 1))).otherwise(F.col("caption_no"))
    shown = p.withColumn("near", near).where(F.col("cover") | F.col("caption_no").isNotNull())
    covers = folds.greedy_covers(shown, ["doc_id"], "page", 10, fill="near").select("doc_id", "page", F.coalesce("near", F.row_number().over(pages_in_order())).alias("no"))
    covers = covers.withColumn("_n", F.count("*").over(document())).where("_n >= 2")
    changes = order.transitions(p, ["doc_id"], ["page"], "session_no").select("doc_id", "page", F.col("session_no").alias("no"))
    ended = F.col("end_or_ocr").cast("int")
    counted = p.withColumn("_s", F.max("session_no").over(document())).withColumn("_all", F.sum(ended).over(document())).withColumn("_ends", F.sum(ended).over(pages_in_order()) - ended)
    days = order.transitions(counted.where("_s is not null"), ["doc_id"], ["page"], "day_no", 2, False).select("doc_id", "page", F.col("day_no").alias("no"), "_ends", "_all")
    none = [F.lit(None).cast("long").alias(c) for c in ("_ends", "_all")]
    points = reduce(DataFrame.unionByName, [df.withColumn("way", F.lit(k)) for k, df in ((1, covers.select("doc_id", "page", "no", *none)), (2, changes.select("*", *none)), (3, days))])
    best = points.repartition("doc_id", "page").withColumn("_w", F.min("way").over(document())).where("way = _w")
    i = F.row_number().over(pages_in_order())
    ordered = F.coalesce(F.bool_and(F.coalesce(F.col("no") > F.col("_b"), F.lit(True)) & F.col("no").isNotNull()).over(document()), F.lit(False))
    numbered = best.withColumn("_b", F.lag("no").over(pages_in_order())).withColumn("session", F.when(ordered, F.col("no")).otherwise(i).cast("int"))
    closed = order.close_intervals(numbered.join(joins.grown(last), "doc_id"), ["doc_id"], "page", F.col("last"))
    n_ends = F.coalesce(F.lead("_ends").over(pages_in_order()), F.col("_all")) - F.col("_ends")
    third = F.greatest(F.floor((F.col("page_end") - F.col("page") + 1) / 3), F.lit(3))
    by_day = F.when(n_ends >= 2, n_ends).otherwise(third)
    expected = F.when(F.col("way") == 3, by_day).when(F.col("session") == 1, 13).otherwise(6).cast("int")
    found = closed.select("doc_id", "session", F.col("page").alias("page_start"), "page_end", expected.alias("expected"))
    single = last.join(joins.grown(found.select("doc_id").distinct()), "doc_id", "left_anti").select("doc_id", F.lit(0).alias("session"), F.col("first").alias("page_start"), F.col("last").alias("page_end"), F.lit(31).alias("expected"))
    return found.unionByName(single)


def weights(p: DataFrame) -> DataFrame:
    """A calibrated weight for each signal of a document."""
    kw = Window.partitionBy("doc_id").orderBy("page")
    changed = p.where("keyword is not null").withColumn("_b", F.lag("keyword").over(kw))
    kw_n = changed.groupBy("doc_id").agg(F.count("*").alias("_pages"), F.count_if(F.col("_b").isNotNull() & (F.col("_b") != F.col("keyword"))).alias("_chg"))
    counts = p.groupBy("doc_id").agg(
        F.sum("n_end").alias("end"), F.sum("n_topic_end").alias("topic_end"), F.sum("all_roman").alias("roman_i"), F.sum("n_menti").alias("menti"), F.sum("n_first").alias("num_restart"),
        F.sum("n_font").alias("font_heading"), F.sum("n_mark").alias("marker_heading"), F.sum("n_star").alias("star_rating"),
        F.when(F.sum("n_session_topic") >= 3, F.sum("n_session_topic")).otherwise(F.count_if("split_cells")).alias("session_topic"),
    )
    joined = counts.join(joins.grown(kw_n), "doc_id", "left").withColumn("header_kw", F.when(F.col("_pages") >= 5, F.col("_chg")).otherwise(0)).drop("_pages", "_chg")
    return aggregates.calibrate(joined, C.FULL_COUNTS)


def in_blocks(p: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every page of every block, with its flags; pages without elements have none."""
    by_page = blocks.select("doc_id", "session", "expected", F.col("page_start").alias("block_start"), F.col("page_end").alias("block_end"), F.explode(F.sequence("page_start", "page_end")).alias("page"))
    t = by_page.join(joins.grown(p.withColumn("filled", F.lit(True))), ["doc_id", "page"], "left")
    flags = [f.name for f in t.schema if f.dataType.typeName() == "boolean"]
    counts = [f.name for f in p.schema if f.name.startswith("n_") or f.name == "all_roman"]
    return t.na.fill(False, flags).na.fill(0, counts)


def hinted(t: DataFrame, elements: DataFrame) -> DataFrame:
    """Pages (doc_id, session, page) that first hold the beginning of a question of their block's covers. t: doc_id, session, page, in_cover, hints, content_start."""
    asked = t.where("in_cover").select("doc_id", "session", "block_end", "content_start", F.explode(F.array_distinct("hints")).alias("hint"))
    covers = t.where("in_cover").select("doc_id", "page")
    body = elements.join(covers, ["doc_id", "page"], "left_anti").select("doc_id", "page", F.coalesce("content", F.lit("")).alias("content"))
    both = joins.contained(body, asked, ["doc_id"], "content", "hint").where(F.col("page").between(F.col("content_start"), F.col("block_end")))
    return both.groupBy("doc_id", "session", "hint").agg(F.min("page").alias("page")).select("doc_id", "session", "page").distinct().withColumn("hint_page", F.lit(True))


def scores(p: DataFrame, blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """Candidates with scores, signals and titles: doc_id, session, expected, block_end, page, score, n_signals, title, strong_kind.

    Later signals look at what earlier ones found on the page, so they are
    columns in turn. A cover counts at its block's start and right after an end.
    """
    t = noise_pages(in_blocks(p, blocks)).join(joins.grown(weights(p)), "doc_id")
    s = Window.partitionBy("doc_id", "session").orderBy("page")
    before, after = s.rowsBetween(Window.unboundedPreceding, -1), s.rowsBetween(1, Window.unboundedFollowing)
    w = lambda k: F.col(f"w_{k}")
    end_weight = F.greatest(w("end"), w("topic_end"))
    t = t.withColumn("ends", F.col("end_or_ocr") | F.col("topic_end"))
    t = t.withColumn("after_end", F.coalesce(F.lag("ends").over(s), F.lit(False)))
    t = t.withColumn("end_cover", F.col("cover") & F.col("after_end") & (end_weight > 0))
    t = t.withColumn("in_cover", F.col("cover") & (F.col("page") == F.col("block_start")) | F.col("end_cover"))
    last_cover = F.last(F.when(F.col("end_cover"), F.col("page")), ignorenulls=True).over(before)
    last_content = F.coalesce(F.last(F.when(F.col("has_content"), F.col("page")), ignorenulls=True).over(before), F.lit(0))
    more_content = F.coalesce(F.max(F.col("has_content").cast("int")).over(s.rowsBetween(0, Window.unboundedFollowing)), F.lit(0)) == 1
    from_cover = F.when(more_content, F.col("has_content") & (last_cover > last_content)).otherwise(last_cover == F.col("page") - 1)
    first_after = F.min(F.when(F.col("has_content") & (F.col("page") > F.col("block_start")), F.col("page"))).over(block())
    starts_cover = F.bool_or((F.col("page") == F.col("block_start")) & F.col("cover")).over(block())
    t = t.withColumn("content_start", F.when(starts_cover, F.coalesce(first_after, F.col("block_start") + 1)).otherwise(F.col("block_start")))
    t = t.withColumn("s_end", (F.col("after_end") & ~F.col("cover") | F.coalesce(from_cover, F.lit(False))) & (end_weight > 0) & ~F.col("in_cover"))
    open_ = ~F.col("in_cover")
    t = t.withColumns({"s_roman": open_ & (F.col("n_roman") > 0) & (w("roman_i") > 0), "s_menti": open_ & (F.col("n_menti") > 0) & (w("menti") > 0)})
    number = F.when(open_, F.coalesce("heading_number", "any_number"))
    t = t.withColumn("number", number)
    prior = F.last("number", ignorenulls=True).over(before)
    t = t.withColumn("s_restart", F.coalesce((F.col("number") == 1) & (prior > 1), F.lit(False)) & (w("num_restart") > 0))
    t = t.withColumn("s_asked", open_ & F.col("asks") & F.coalesce(F.col("heading_number") == 1, F.lit(False)) & ~F.col("s_restart") & (w("num_restart") > 0))
    early = F.col("s_end") | F.col("s_roman") | F.col("s_menti") | F.col("s_restart") | F.col("s_asked")
    hints = hinted(t.select("doc_id", "session", "page", "block_end", "in_cover", "hints", "content_start"), elements)
    t = t.join(hints, ["doc_id", "session", "page"], "left").withColumn("s_hint", F.coalesce("hint_page", F.lit(False)) & ~early)
    asked_pages = F.count_if(open_ & F.col("asks_numbered")).over(block())
    text = open_ & F.col("asks_numbered") & (asked_pages >= 3) & ~F.col("s_restart") & ~F.col("s_asked") & ~F.col("s_end") & (w("num_restart") > 0)
    kr_open = F.when(open_, F.col("kr"))
    kr = F.coalesce((kr_open == 0) & (F.max(kr_open).over(before) >= 1), F.lit(False)) & ~F.col("roman_beyond") & ~F.coalesce(F.lag("roman_beyond").over(s), F.lit(False))
    lead = F.col("s_roman") | F.col("s_menti") | F.col("s_end")
    prior_kw = F.last(F.when(open_, F.col("keyword")), ignorenulls=True).over(before)
    t = t.withColumns({
        "s_text": text,
        "s_kr": kr,
        "s_font": open_ & F.col("font_title").isNotNull() & ~lead & (w("font_heading") > 0),
        "s_mark": open_ & F.col("mark_title").isNotNull() & ~lead & (w("marker_heading") > 0),
        "s_star": open_ & (F.col("n_star") > 0) & ~F.col("s_end") & ~F.col("s_roman") & (w("star_rating") > 0),
        "s_topic": open_ & ((F.col("n_session_topic") > 0) | F.col("split_cells")) & (w("session_topic") > 0),
        "s_kw": open_ & F.coalesce(F.col("keyword") != prior_kw, F.lit(False)) & (w("header_kw") > 0),
    })
    on = lambda flag, value: F.when(F.col(flag), value).otherwise(0.0)
    score = (
        on("s_end", 10 * end_weight)
        + on("s_roman", 10 * w("roman_i") * F.col("n_roman"))
        + on("s_menti", 10 * w("menti") * F.col("n_menti"))
        + on("s_restart", w("num_restart") * (8 + F.when(F.col("asks"), 3).otherwise(0)))
        + on("s_asked", 7 * w("num_restart"))
        + on("s_hint", F.lit(3.0))
        + on("s_text", 6 * w("num_restart"))
        + on("s_kr", F.lit(6.0))
        + on("s_font", w("font_heading") * F.when(F.col("font_size") >= 1.5, 8).otherwise(6))
        + on("s_mark", 7 * w("marker_heading"))
        + on("s_star", 10 * w("star_rating"))
        + on("s_topic", 10 * w("session_topic"))
        + on("s_kw", 10 * w("header_kw"))
    )
    flags = ["s_end", "s_roman", "s_menti", "s_restart", "s_asked", "s_hint", "s_text", "s_kr", "s_font", "s_mark", "s_star", "s_topic", "s_kw"]
    t = t.withColumn("score", score).withColumn("n_signals", reduce(lambda a, b: a + b, [F.col(f).cast("int") for f in flags]))
    # The gate: where ends are marked, a page that follows none needs more than one or two signals.
    n_ends = F.count_if("ends").over(block())
    near_end = F.last(F.when(F.col("ends"), F.col("page")), ignorenulls=True).over(before)
    free = F.col("s_end") | F.col("s_topic") | F.col("s_star") | F.col("s_kw") | (F.col("n_signals") >= 3) | (F.col("page") == F.col("content_start")) | F.coalesce(F.col("page") - near_end <= 3, F.lit(False))
    gated = F.when((n_ends >= 3) & ~free, F.col("score") * F.when(F.col("n_signals") <= 1, 0.1).otherwise(0.3)).otherwise(F.col("score"))
    t = t.withColumn("score", gated).withColumn("score", F.when((F.col("page") == F.col("content_start")) & (F.col("score") == 0), 5.0).otherwise(F.col("score")))
    roman, menti = F.when(F.col("s_roman"), F.col("roman_title")), F.when(F.col("s_menti"), F.col("menti_title"))
    led = F.when(F.length(menti) > F.length(F.coalesce(roman, F.lit(""))), menti).otherwise(F.coalesce(roman, menti))
    asked = F.coalesce(F.nullif(led, F.lit("")), F.when(F.col("s_text"), F.col("question_title")))
    better = F.when(F.col("s_kr") & (F.length("kr_title") > F.length(F.coalesce(asked, F.lit("")))), F.col("kr_title")).otherwise(asked)
    font = F.when(open_ & (w("font_heading") > 0), F.col("font_title"))
    mark = F.when(open_ & (w("marker_heading") > 0), F.col("mark_title"))
    title = F.coalesce(F.nullif(better, F.lit("")), font, mark, "said", F.concat(F.lit("토픽_p"), F.col("page").cast("string")))
    kept = t.where((F.col("score") > 0) & ~F.col("in_cover") & ~F.col("noise") & ~F.col("topic_end"))
    return kept.select("doc_id", "session", "expected", "block_end", "page", "score", F.greatest("n_signals", F.lit(1)).alias("n_signals"), title.alias("title"), (F.col("s_topic") | F.col("s_star") | F.col("s_kw")).alias("strong_kind"))


def select(cands: DataFrame) -> DataFrame:
    """Threshold by the expected-th score, single signals at 0.6, the best `expected` of a session."""
    weak = (F.col("n_signals") <= 1) & ~F.col("strong_kind")
    return order.kth_threshold(cands, ["doc_id", "session"], "score", ["page"], F.col("expected"), weak=weak)


def sub_splits(chosen: DataFrame, p: DataFrame) -> DataFrame:
    """Intervals (doc_id, session, expected, title, page_start, page_end, confidence), the long ones cut where a topic opens again.

    Long is over three pages where ten or more topics are expected, else over
    six. Cuts are pages with a section or problem of their own; with at most
    one, and fewer topics than expected, lettered parts that start again; then
    pages that open with a long heading. Parts keep four fifths of the confidence.
    """
    span = F.col("page_end") - F.col("page_start") + 1
    few = F.count("*").over(block()) < F.col("expected")
    known = chosen.withColumn("few", few).withColumn("long", span > F.when(F.col("expected") >= 10, 3).otherwise(6))
    key = ["doc_id", "session", "page_start"]
    inside = known.where("long").select(*key, F.explode(F.sequence("page_start", "page_end")).alias("page")).join(joins.grown(p.select("doc_id", "page", "opening", "kr", "kr_title", "story", "said")), ["doc_id", "page"])
    w = Window.partitionBy(*key).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    again = F.coalesce((F.col("kr") == 0) & (F.max("kr").over(w) >= 1), F.lit(False))
    inside = inside.withColumn("again", again)
    rows = lambda cond, t: F.array_sort(F.collect_list(F.when(cond, F.struct(F.col("page").alias("page"), t.alias("title")))))
    found = inside.groupBy(*key).agg(rows(F.col("opening").isNotNull(), F.col("opening")).alias("one"), rows(F.col("again"), F.col("kr_title")).alias("two"), rows((F.col("page") != F.col("page_start")) & F.col("story.t").isNotNull(), F.col("story.t")).alias("three"), F.max(F.when(F.col("page") == F.col("page_start"), F.col("said"))).alias("said"))
    joined = known.join(joins.grown(found), key, "left")
    head = F.array(F.struct(F.col("page_start").alias("page"), F.coalesce("said", F.concat(F.lit("토픽_p"), F.col("page_start").cast("string"))).alias("title")))
    cuts = F.when(F.size("one") > 1, F.col("one")).when(F.col("few") & (F.size("two") > 0), F.concat(head, F.col("two"))).when(F.col("few") & (F.size("three") > 0), F.concat(head, F.col("three")))
    t = joined.withColumn("cuts", F.when(F.col("long"), cuts))
    t = t.withColumn("cuts", F.when(F.get("cuts", F.lit(0))["page"] > F.col("page_start"), F.concat(head, F.col("cuts"))).otherwise(F.col("cuts")))
    whole = F.array(F.struct(F.col("page_start").alias("page"), F.col("title").alias("title")))
    out = t.withColumn("parts", F.coalesce("cuts", whole)).select("*", F.posexplode("parts").alias("k", "part"))
    nxt = F.get("parts", F.col("k") + 1)["page"] - 1
    return out.select("doc_id", "session", "expected", F.col("part.title").alias("title"), F.col("part.page").alias("page_start"), F.coalesce(nxt, F.col("page_end")).alias("page_end"), F.when(F.col("cuts").isNull(), F.col("confidence")).otherwise(F.col("confidence") * 0.8).alias("confidence"))


def question_pages(t: DataFrame) -> DataFrame:
    """doc_id, session, title, page_start, page_end, confidence, fmt of pages of a block that list questions: two asked or five numbered, and no answer on the page; gaps of two are bridged."""
    q = t.where(((F.col("n_questions") >= 2) | (F.col("n_numbered") >= 5)) & ~F.col("answers"))
    label = F.when(F.col("session") > 0, F.concat(F.col("session").cast("string"), F.lit("교시 문제지"))).otherwise("문제지")
    return order.island_ranges(q, ["doc_id", "session"], "page", 2).select("doc_id", "session", label.alias("title"), "page_start", "page_end", F.lit(0.95).alias("confidence"), F.lit("question_pages").alias("fmt"))


def _weighted(elements: DataFrame, p: DataFrame, blocks: DataFrame) -> DataFrame:
    chosen = select(scores(p, blocks, elements))
    closed = order.close_intervals(chosen, ["doc_id", "session"], "page", F.col("block_end"))
    rated = closed.withColumn("confidence", F.round(F.least(F.col("score") / F.max("score").over(block()), F.lit(1.0)), 6)).withColumnRenamed("page", "page_start")
    topics = sub_splits(staged(rated.select("doc_id", "session", "expected", "title", "page_start", "page_end", "confidence")), p).drop("expected").withColumn("fmt", F.lit("topic"))
    questions = question_pages(in_blocks(p.select("doc_id", "page", "n_questions", "n_numbered", "answers"), blocks))
    both = topics.unionByName(questions.select(*topics.columns)).repartition("doc_id", "page_start")
    w = Window.partitionBy("doc_id").orderBy("page_start", F.when(F.col("fmt") == "topic", 0).otherwise(1), "page_end")
    listed = both.withColumn("num", F.row_number().over(w).cast("int"))
    merged = postprocess.merge_short(listed, blocks)
    return order.renumber(merged, ["doc_id"], ["session"], ["page_start", F.when(F.col("fmt") == "topic", 0).otherwise(1), "num"], F.col("fmt") == "topic").select("doc_id", "session", "num", "session_q", "title", "page_start", "page_end", "confidence", "fmt")


def boundaries(elements: DataFrame) -> DataFrame:
    """doc_id, session, num, session_q, title, page_start, page_end, confidence, fmt of every document by its weighted signals: topics, long ones cut, question pages among them, short ones merged. Marked elements, pages' flags, sessions and the choice are written on the way."""
    e = marked(elements)
    p = staged(page_flags(e))
    return _weighted(e, p, staged(sessions(p)))


def formatted(elements: DataFrame) -> DataFrame:
    """The documents that a publisher's format settles, as formats.by_format."""
    e = marked(elements)
    return formats.by_format(e, staged(sessions(staged(page_flags(e)))))


def detect(elements: DataFrame) -> DataFrame:
    """As boundaries, by the publisher's format where that gives topics enough, else by weighted signals: doc_id, session, title, page_start, page_end, confidence, fmt."""
    e = marked(elements)
    p = staged(page_flags(e))
    blocks = staged(sessions(p))
    own = staged(formats.by_format(e, blocks))
    done = own.select("doc_id").distinct()
    rest = _weighted(e.join(done, "doc_id", "left_anti"), p.join(done, "doc_id", "left_anti"), blocks.join(done, "doc_id", "left_anti"))
    cast = lambda df: df.select("doc_id", F.col("session").cast("int").alias("session"), "title", F.col("page_start").cast("int").alias("page_start"), F.col("page_end").cast("int").alias("page_end"), "confidence", "fmt")
    return cast(own).unionByName(cast(rest))


def checked(found: DataFrame, elements: DataFrame) -> DataFrame:
    """doc_id, session, kind, detail of what looks wrong in the result of detect or boundaries."""
    return postprocess.warnings(found.where("fmt <> 'question_pages'"), sessions(page_flags(marked(elements))))
