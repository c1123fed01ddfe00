"""Splitters for whole kinds of books: reviews, textbooks, mock and camp papers, past exams.

Pages are doc_id, page (from 1), text. Lines are looked at in windows over one
page, so a page's lines meet in one task and nothing else does; first marks,
best scores and intervals are aggregates and windows by document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import U, has, strip
from . import folds, order

# What marks a numbered line, and the words that follow a question.
NUMBERED = r"^(\d{1,2})\.\s+(.+)"
MENTI_PROBLEM = r"(?sUd)문\s*제\s+(\d{1,2})\.\s+(.+?)(?=\n출\s*제|$)"
MENTI_START = r"(?Ud)문\s*\n?\s*제\s+(\d{1,2})\.\s+"
BARE_WORDS = ("출제의도", "작성방안", "회 ", "Keyword", "출제빈도", "출제배경", "풀이", "난이도")
INTENT_WORDS = ("출제의도", "작성방안")
AREAS = ("도메인", "출제영역")
MOCK_AREAS = ("도메인", "예상문제")
EXAM_COUNTS = {1: 13, 2: 6, 3: 6, 4: 6}
BOOKS = {"경영": "1_경영", "소공": "2_소공", "DB": "3_DB", "DS": "4_DS", "NW": "5_NW", "CAOS": "6_CAOS", "보안": "7_보안", "인알통": "8_인알통"}


def lines_of(pages: DataFrame, least_chars: int = 0) -> DataFrame:
    """doc_id, page, idx (from 0), line (stripped) of pages with `least_chars` or more."""
    text = F.coalesce("text", F.lit(""))
    kept = pages.where(F.length(strip(text)) >= least_chars)
    return kept.select("doc_id", "page", F.posexplode(F.split(text, "\n", -1)).alias("idx", "line")).withColumn("line", strip("line"))


def on_page():
    return Window.partitionBy("doc_id", "page").orderBy("idx")


def soon(cond: Column, first: int, last: int) -> Column:
    """Whether the condition holds for a line `first` to `last` lines on."""
    return F.coalesce(F.max(cond.cast("int")).over(on_page().rowsBetween(first, last)), F.lit(0)) == 1


def any_of(c: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def following(cond: Column, first: int, last: int, value: Column | None = None) -> Column:
    """The first line (or value) with the condition, `first` to `last` lines on."""
    return F.first(F.when(cond, F.col("line") if value is None else value), ignorenulls=True).over(on_page().rowsBetween(first, last))


def close_pages(starts: DataFrame, last: DataFrame) -> DataFrame:
    """Each start reaches to the page before the next one, at least its own; the last to its document's last page. last: doc_id, last."""
    nxt = F.lead("page").over(Window.partitionBy("doc_id").orderBy("page", "idx"))
    return starts.join(last, "doc_id").withColumn("page_end", F.when(nxt.isNotNull(), F.greatest(nxt - 1, F.col("page"))).otherwise(F.col("last"))).drop("last").withColumnRenamed("page", "page_start")


def last_pages(pages: DataFrame) -> DataFrame:
    return pages.groupBy("doc_id").agg(F.max("page").alias("last"))


# ---------------------------------------------------------------- textbooks and mock papers


def textbook_files(files: DataFrame, subject: str | None = None) -> DataFrame:
    """The files of the textbooks, by the number and name in front or else by subject: subject, path, name; the first of several."""
    known = [(F.when(F.col("name").startswith(head), F.lit(1)).when(F.col("name").contains(s) & F.col("name").contains("600제"), F.lit(2)), s) for s, head in BOOKS.items()]
    each = F.filter(F.array(*[F.struct(rank.alias("rank"), F.lit(s).alias("subject")) for rank, s in known]), lambda x: x["rank"].isNotNull())
    found = files.select("path", "name", F.explode(each).alias("b")).select("path", "name", "b.*")
    found = found if subject is None else found.where(F.col("subject") == subject)
    return order.first_by(found, ["subject"], ["rank", "path"]).drop("rank")


def textbook_questions(pages: DataFrame, skip: int = 3) -> DataFrame:
    """doc_id, title, question, domain, keywords, page_start, idx, page_end.

    A question is a line that is the label of a problem with an area within
    twelve lines. Its title is the line above, or the one above that; its text
    the lines up to the area, five at most.
    """
    w = on_page()
    t = lines_of(pages.where(F.col("page") > skip), 50)
    x = F.col("line")
    fits = lambda c: (F.length(c) >= 2) & (F.length(c) <= 120) & ~c.startswith("-") & ~has(c, r"^\d+$")
    one, two = F.lag("line", 1).over(w), F.lag("line", 2).over(w)
    t = t.withColumn("title", F.when(fits(one) & ~one.startswith("•"), one).when(fits(two), two))
    ahead = F.collect_list("line").over(w.rowsBetween(1, 5))
    context = F.collect_list("line").over(w.rowsBetween(0, 11))
    t = t.withColumns({"ahead": ahead, "context": F.array_join(context, "\n"), "area": soon(any_of(x, AREAS), 0, 11)}).where((x == "문제") & F.col("area") & F.col("title").isNotNull())
    stop = F.array_position(F.transform("ahead", lambda q: q.startswith(AREAS[0]) | q.startswith(AREAS[1])), F.lit(True)).cast("int")
    asked = F.substring(F.array_join(F.when(stop > 0, F.slice("ahead", F.lit(1), stop - 1)).otherwise(F.col("ahead")), " "), 1, 200)
    domain = strip(F.regexp_extract("context", U + r"(?:도메인|출제영역)\s*\n\s*(.+)", 1))
    words = F.regexp_extract("context", r"(?sUd)키워드\s*\n\s*(.+?)(?=\n\s*(?:목차|출제|참고|해설|난이도|채점)|\n\s*\n)", 1)
    found = t.select("doc_id", "page", "idx", "title", asked.alias("question"), domain.alias("domain"), F.replace(strip(words), F.lit("\n"), F.lit(", ")).alias("keywords"))
    return close_pages(found, last_pages(pages))


def mock_questions(pages: DataFrame) -> DataFrame:
    """doc_id, number, topic, domain, page_start, page_end: the first line of a page among its first 25 that is a number of two digits from 01 to 16, with an area within eight lines and a topic within four."""
    t = lines_of(pages, 30)
    x = F.col("line")
    number = F.regexp_extract(x, r"^([0-9]{2})$", 1).try_cast("int")
    topic = following((F.length(x) > 1) & ~has(x, r"^\d+$"), 1, 4)
    context = F.array_join(F.collect_list("line").over(on_page().rowsBetween(0, 7)), "\n")
    t = t.withColumns({"number": number, "topic": topic, "context": context})
    starts = t.where((F.col("idx") < 25) & F.col("number").between(1, 16) & F.col("topic").isNotNull() & any_of(F.col("context"), MOCK_AREAS))
    domain = strip(F.regexp_extract("context", U + r"도메인\s*[:\n]\s*(.+)", 1))
    first = order.first_by(starts, ["doc_id", "page"], ["idx"]).select("doc_id", "page", "idx", "number", "topic", domain.alias("domain"))
    return close_pages(first, last_pages(pages)).drop("idx")


# ---------------------------------------------------------------- past exams


def exam_sessions(pages: DataFrame) -> DataFrame:
    """doc_id, session, start, end: the first page of each session that names it and asks to choose; sessions end before the next one."""
    text = F.coalesce("text", F.lit(""))
    n = F.regexp_extract(text, U + r"(?:제\s*)?(\d)\s*교시", 1).try_cast("int")
    first = pages.withColumn("session", n).where(F.col("session").isNotNull() & (text.contains("문제 중") | text.contains("선택"))).groupBy("doc_id", "session").agg(F.min("page").alias("start"))
    return _session_ends(first, last_pages(pages))


def footer_sessions(pages: DataFrame, blank: int = 50) -> DataFrame:
    """The same where every page names its session; blank pages at a session's end don't count."""
    text = strip(F.coalesce("text", F.lit("")))
    full = pages.where(F.length(text) >= blank)
    first = full.withColumn("session", F.regexp_extract(text, U + r"(\d)\s*교시", 1).try_cast("int")).where("session is not null").groupBy("doc_id", "session").agg(F.min("page").alias("start"))
    ends = _session_ends(first, last_pages(pages))
    return trimmed(ends, full, "start", "end")


def _session_ends(first: DataFrame, last: DataFrame) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy("session")
    return first.join(last, "doc_id").withColumn("end", F.coalesce(F.lead("start").over(w) - 1, F.col("last"))).drop("last")


def trimmed(intervals: DataFrame, full: DataFrame, start: str, end: str) -> DataFrame:
    """W1d: ends move back to the last page that is among `full`, at most to the start; pages in between are looked up by a window, not by a join of ranges."""
    marks = full.select("doc_id", F.col("page").alias("at"), F.lit(0).alias("kind"), F.col("page").alias("seen"))
    asks = intervals.withColumn("at", F.col(end)).withColumn("kind", F.lit(1)).withColumn("seen", F.lit(None).cast("long"))
    w = Window.partitionBy("doc_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = asks.unionByName(marks, allowMissingColumns=True).withColumn("seen", F.last("seen", ignorenulls=True).over(w)).where("kind = 1")
    return both.withColumn(end, F.when(F.col(end) <= F.col(start), F.col(end)).otherwise(F.greatest(F.col(start), F.coalesce("seen", F.col(start))))).drop("at", "kind", "seen")


def exam_problems(pages: DataFrame, sessions: DataFrame) -> DataFrame:
    """doc_id, session, number, title: numbered lines after the request to choose on a session's first page, the first of each number, and Qn for numbers that are missing."""
    asked = pages.join(sessions.select("doc_id", "session", F.col("start").alias("page")), ["doc_id", "page"])
    t = lines_of(asked).join(sessions.select("doc_id", "session", F.col("start").alias("page")), ["doc_id", "page"])
    marker = F.col("line").contains("문제 중") | F.col("line").contains("선택")
    w = Window.partitionBy("doc_id", "page").orderBy("idx")
    t = t.withColumn("after", F.coalesce(F.max(marker.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1)
    number, title = F.regexp_extract("line", U + NUMBERED, 1).try_cast("int"), strip(F.regexp_extract("line", U + NUMBERED, 2))
    listed = t.where(F.col("after") & ~marker).withColumn("number", number).withColumn("title", title).where(F.col("number").isNotNull() & (F.length("title") > 1))
    found = listed.groupBy("doc_id", "session", "number").agg(F.max_by("title", "idx").alias("title"))
    expected = sessions.select("doc_id", "session", F.explode(F.sequence(F.lit(1), F.when(F.col("session") == 1, EXAM_COUNTS[1]).otherwise(EXAM_COUNTS[2]))).alias("number"))
    return expected.join(found, ["doc_id", "session", "number"], "full").withColumn("title", F.coalesce("title", F.concat(F.lit("Q"), F.col("number").cast("string"))))


def _in_session(lines: DataFrame, sessions: DataFrame) -> DataFrame:
    """Lines of pages after a session's first one; a document has a handful of sessions."""
    pages = sessions.where(F.col("end") > F.col("start")).withColumn("page", F.explode(F.sequence(F.col("start") + 1, "end"))).select("doc_id", "session", "page", F.col("end").alias("session_end"))
    return lines.join(pages, ["doc_id", "page"])


def _end_in_session(starts: DataFrame) -> DataFrame:
    w = Window.partitionBy("doc_id", "session").orderBy("page", "idx")
    closed = starts.withColumn("page_end", F.coalesce(F.lead("page").over(w) - 1, F.col("session_end")))
    return closed.where(F.col("page_end") >= F.col("page")).select("doc_id", "session", "number", "title", F.col("page").alias("page_start"), "page_end")


def kpc_exam(pages: DataFrame, sessions: DataFrame, problems: DataFrame) -> DataFrame:
    """doc_id, session, number, title, page_start, page_end: the first line of each listed number, of a page's first twenty, that is numbered after the label of a problem."""
    x, w = F.col("line"), on_page()
    before = w.rowsBetween(-5, -1)
    pair = (F.lag("line").over(w) == "문") & x.startswith("제")
    t = lines_of(pages).withColumn("pair", pair)
    t = t.withColumn("labels", F.coalesce(F.max((x == "문제").cast("int")).over(before), F.lit(0)))
    t = t.withColumn("pairs", F.coalesce(F.max(F.when(F.col("pair"), 1).otherwise(0)).over(w.rowsBetween(-4, -1)), F.lit(0)))  # both lines of the pair are among the five before
    own = F.regexp_extract(x, U + r"^제\s*(\d{1,2})\.\s+(.+)", 1).try_cast("int")
    plain = F.when((F.col("labels") == 1) | (F.col("pairs") == 1), F.regexp_extract(x, U + NUMBERED, 1).try_cast("int"))
    marked = _in_session(t.where("idx < 20").withColumn("number", F.coalesce(own, plain)).where("number is not null"), sessions)
    listed = marked.join(problems, ["doc_id", "session", "number"])
    return _end_in_session(order.first_by(listed, ["doc_id", "session", "number"], ["page", "idx"]))


def itpe_exam(pages: DataFrame, sessions: DataFrame, problems: DataFrame) -> DataFrame:
    """T5: the last line of a page's first ten that is a listed number of two digits with the label of a problem within four lines; numbers follow the pages where their count is the expected one, else the first of each stays."""
    x = F.col("line")
    number = F.regexp_extract(x, r"^([0-9]{2})$", 1).try_cast("int")
    title = following((F.length(x) > 3) & (x != "문제"), 1, 3)
    t = lines_of(pages).withColumns({"number": number, "title": F.coalesce(title, F.lit("")), "label": soon(x == "문제", 1, 4)})
    marked = _in_session(t.where("idx < 10 and number is not null and label"), sessions)
    listed = marked.join(problems.select("doc_id", "session", "number"), ["doc_id", "session", "number"], "left_semi")
    last = listed.groupBy("doc_id", "session", "session_end", "page").agg(F.max_by(F.struct("number", "title"), "idx").alias("m")).select("doc_id", "session", "session_end", "page", "m.*")
    w = Window.partitionBy("doc_id", "session").orderBy("page")
    n = F.count("*").over(Window.partitionBy("doc_id", "session"))
    whole = n == F.when(F.col("session") == 1, EXAM_COUNTS[1]).otherwise(EXAM_COUNTS[2])
    again = F.row_number().over(Window.partitionBy("doc_id", "session", "number").orderBy("page"))
    t = last.withColumns({"whole": whole, "again": again, "place": F.row_number().over(w)}).where(F.col("whole") | (F.col("again") == 1))
    t = t.withColumn("number", F.when(F.col("whole"), F.col("place")).otherwise(F.col("number")))
    named = t.join(problems.select("doc_id", "session", "number", F.col("title").alias("listed")), ["doc_id", "session", "number"], "left")
    return _end_in_session(named.withColumn("title", F.when(F.col("whole"), F.coalesce("listed", "title")).otherwise(F.col("title"))).withColumn("idx", F.lit(0)))


def numbered_exam(pages: DataFrame, blank: int = 50) -> DataFrame:
    """Pages that name session and number at their head: doc_id, session, number, title, page_start, page_end; a number beyond its session's count takes the session of the page's first words; blank pages at the end don't count."""
    text = F.coalesce("text", F.lit(""))
    head = U + r"(\d)\s*교시\s*\n\s*(\d{1,2})\s*번"
    cap = lambda s: F.when(s == 1, EXAM_COUNTS[1]).when(s.between(2, 4), EXAM_COUNTS[2])
    session, number = F.regexp_extract(F.substring(text, 1, 500), head, 1).try_cast("int"), F.regexp_extract(F.substring(text, 1, 500), head, 2).try_cast("int")
    other = F.regexp_extract(F.substring(text, 1, 80), U + r"(\d)\s*교시", 1).try_cast("int")
    title = F.regexp_extract(F.substring(text, 1, 1200), r"(?sUd)문제\s*\n(.+?)(?:\n도메인|\n난이도|\n출제)", 1)
    t = pages.select("doc_id", "page", session.alias("session"), number.alias("number"), other.alias("other"), F.substring(F.split(strip(title), "\n")[0], 1, 80).alias("title")).where("session is not null")
    fixed = F.when((F.col("number") > F.coalesce(cap(F.col("session")), F.lit(6))) & F.col("other").isNotNull() & (F.col("number") <= F.coalesce(cap(F.col("other")), F.lit(13))), F.col("other")).otherwise(F.col("session"))
    t = t.withColumn("session", fixed).withColumn("title", F.coalesce(F.nullif("title", F.lit("")), F.concat(F.lit("Q"), F.col("number").cast("string"))))
    first = order.first_by(t, ["doc_id", "session", "number"], ["page"]).drop("other")
    w = Window.partitionBy("doc_id").orderBy("page")
    closed = first.join(last_pages(pages), "doc_id").withColumn("page_end", F.coalesce(F.lead("page").over(w) - 1, F.col("last"))).drop("last").withColumnRenamed("page", "page_start")
    return trimmed(closed, pages.where(F.length(strip(text)) >= blank), "page_start", "page_end").where("page_end >= page_start")


# ---------------------------------------------------------------- reviews


def review_format(pages: DataFrame) -> DataFrame:
    """doc_id, pages, format, cut: the layout of a review by its first page, whether it holds next to no text, and the first page of another publisher's part."""
    text = F.coalesce("text", F.lit(""))
    flat = F.regexp_replace(text, r"(?U)\s+", "")
    other = flat.contains("아이리포") & (flat.contains("대비") | flat.contains("기술사회"))
    n = F.size(F.regexp_extract_all(text, F.lit(r"(?mUd)^(\d{1,2})\.\s+"), F.lit(1)))
    first = F.col("page") == 1
    g = pages.groupBy("doc_id").agg(
        F.max("page").alias("pages"),
        F.max(F.when(first, flat)).alias("flat"),
        F.max(F.when(first, text)).alias("text"),
        F.max(F.when(first, n)).alias("numbers"),
        F.sum(F.when(F.col("page") <= 5, F.length(strip(text))).otherwise(0)).alias("chars"),
        F.min(F.when(other & (F.col("page") >= 3), F.col("page"))).alias("cut"),
    )
    t, flat1 = F.col("text"), F.col("flat")
    asks = flat1.contains("문제중") & flat1.contains("선택")
    kind = (
        F.when(F.col("pages") == 1, "problem_only")
        .when((F.col("chars") < 200) & (F.col("pages") > 3), "sparse")
        .when(asks & (F.col("cut") <= 6), "merged")
        .when(flat1.contains("출제영역") & flat1.contains("난이도") & t.contains("★"), "menti")
        .when(asks & (F.col("numbers") >= 4), "standard")
        .when(asks & any_of(flat1, INTENT_WORDS), "inline")
        .when(asks, "standard")
        .otherwise("bare")
    )
    return g.select("doc_id", "pages", F.coalesce(kind, F.lit("bare")).alias("format"), "cut")


def own_part(pages: DataFrame, formats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages before the other publisher's part of merged documents, all pages of the rest, and the formats found anew for the parts. Parts of two pages or less go."""
    merged = formats.where("format = 'merged'").select("doc_id", "cut")
    left = pages.join(merged, "doc_id", "left").where("cut is null or (page < cut and cut > 3)").drop("cut")
    again = review_format(left.join(merged, "doc_id", "left_semi"))
    return left, formats.where("format <> 'merged'").unionByName(again)


def review_problems(pages: DataFrame, formats: DataFrame) -> DataFrame:
    """doc_id, number, title: the problems that a review lists, by its format.

    standard: numbered lines after the request to choose on the first of two
    pages that has some. inline: those of the first page up to its first
    intent, as long as numbers follow each other. menti: labelled problems of
    any page. All others: numbered lines among a page's first eight with words
    of an answer within eight lines; also for an inline page without a list.
    """
    fmt = formats.select("doc_id", "format")
    known = pages.join(fmt, "doc_id")
    t = lines_of(known.where("page <= 2 and format in ('standard', 'inline')").drop("format")).join(fmt, "doc_id")
    number, title = F.regexp_extract("line", U + NUMBERED, 1).try_cast("int"), strip(F.regexp_extract("line", U + NUMBERED, 2))
    marker = F.col("line").contains("문제 중") & F.col("line").contains("선택")
    past = on_page().rowsBetween(Window.unboundedPreceding, -1)
    upto = on_page().rowsBetween(Window.unboundedPreceding, 0)
    active = F.coalesce(F.max(marker.cast("int")).over(past), F.lit(0)) == 1
    t = t.withColumn("active", active & ~marker)
    t = t.withColumn("intent", F.coalesce(F.max((F.col("active") & F.col("line").contains("출제의도")).cast("int")).over(upto), F.lit(0)) == 1)
    listed = t.where("active").withColumn("number", number).withColumn("title", title).where("number is not null")
    first = F.min("page").over(Window.partitionBy("doc_id"))
    standard = listed.where("format = 'standard'").withColumn("first", first).where("page = first").select("doc_id", "page", "idx", "number", "title")
    steps = listed.where("format = 'inline' and page = 1 and not intent").select("doc_id", "page", "idx", "number", "title")
    ok = lambda s, r: s["last"].isNull() | (r["number"] == s["last"] + 1)
    inline = folds.fold(steps, ["doc_id"], ["page", "idx"], ["number", "title"], {"last": F.lit(None).cast("int")}, lambda s, r: {"last": F.when(ok(s, r), r["number"]).otherwise(s["last"])}, keep=ok).drop("state")
    text = F.coalesce("text", F.lit(""))
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(MENTI_PROBLEM), F.lit(1)).alias("n"), F.regexp_extract_all(text, F.lit(MENTI_PROBLEM), F.lit(2)).alias("t"))
    menti = known.where("format = 'menti'").select("doc_id", "page", F.posexplode(pairs).alias("idx", "p")).select("doc_id", "page", "idx", F.col("p.n").cast("int").alias("number"), F.split(strip(F.col("p.t")), "\n")[0].alias("title"))
    plain = known.where("format not in ('standard', 'menti')").join(inline.select("doc_id").distinct(), "doc_id", "left_anti").drop("format")
    context = F.array_join(F.collect_list("line").over(on_page().rowsBetween(0, 7)), "\n")
    bare = lines_of(plain, 30).withColumns({"number": number, "title": title, "context": context}).where((F.col("idx") < 8) & F.col("number").isNotNull() & (F.length("title") > 3) & any_of(F.col("context"), BARE_WORDS)).select("doc_id", "page", "idx", "number", "title")
    last = standard.withColumn("idx", -F.col("idx"))  # of a number that is listed twice the last title counts
    every = last.unionByName(inline).unionByName(menti).unionByName(bare)
    return order.first_by(every, ["doc_id", "number"], ["page", "idx"]).select("doc_id", "number", "title")


def review_topics(pages: DataFrame, formats: DataFrame, problems: DataFrame, least: int = 3) -> DataFrame:
    """doc_id, number, title, score, page_start, page_end.

    A numbered line of a listed number scores ten for words of intent within
    eight lines, three among a page's first ten lines, five if its title begins
    like the listed one; the best of a number stays, the first of equals, with
    `least` or more. In the menti format the first labelled problem counts.
    """
    fmt = formats.select("doc_id", "format")
    body = pages.join(fmt, "doc_id").where("format <> 'menti' and (page > 1 or format in ('inline', 'bare'))").drop("format")
    x = F.col("line")
    number, found = F.regexp_extract(x, U + NUMBERED, 1).try_cast("int"), strip(F.regexp_extract(x, U + NUMBERED, 2))
    t = lines_of(body, 30).withColumns({"intent": soon(any_of(x, INTENT_WORDS), 0, 7), "number": number, "found": found}).where("number is not null")
    bare = lambda c: F.substring(strip(F.regexp_replace(c, r"[(\[（].*?[)\]）]", "")), 1, 5)
    named = t.join(problems, ["doc_id", "number"])
    same = F.coalesce((bare(F.col("title")) != "") & (bare(F.col("title")) == bare(F.col("found"))), F.lit(False))
    score = F.when(F.col("intent"), 10).otherwise(0) + F.when(F.col("idx") < 10, 3).otherwise(0) + F.when(same, 5).otherwise(0)
    best = order.first_by(named.withColumn("score", score).where(F.col("score") >= least), ["doc_id", "number"], [F.desc("score"), "page", "idx"]).select("doc_id", "number", "title", "score", "page", "idx")
    labelled = pages.join(fmt, "doc_id").where("format = 'menti'").select("doc_id", "page", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(MENTI_START), F.lit(1))).alias("n")).select("doc_id", "page", F.col("n").cast("int").alias("number"))
    menti = labelled.groupBy("doc_id", "number").agg(F.min("page").alias("page")).join(problems, ["doc_id", "number"], "left")
    menti = menti.select("doc_id", "number", F.coalesce("title", F.concat(F.lit("문제"), F.col("number").cast("string"))).alias("title"), F.lit(15).alias("score"), "page", F.col("number").alias("idx"))
    starts = best.unionByName(menti)
    w = Window.partitionBy("doc_id").orderBy("page", "idx")
    nxt = F.lead("page").over(w)
    closed = starts.join(last_pages(pages), "doc_id").withColumn("page_end", F.coalesce(F.when(nxt > F.col("page"), nxt - 1).otherwise(nxt), F.col("last")))
    lists = pages.where(F.coalesce("text", F.lit("")).contains("다음 문제 중")).select("doc_id", F.col("page").alias("page_end"), F.lit(1).alias("listed"))
    cut = closed.join(lists, ["doc_id", "page_end"], "left")
    return cut.select("doc_id", "number", "title", "score", F.col("page").alias("page_start"), (F.col("page_end") - F.when(F.col("listed").isNotNull() & (F.col("page_end") > F.col("page")), 1).otherwise(0)).alias("page_end"))


def subject_totals(rows: DataFrame, *keys: str) -> DataFrame:
    """Intervals and pages by source or subject, with a total row of nulls."""
    return rows.rollup(*keys).agg(F.count("*").alias("n"), F.sum(F.col("page_end") - F.col("page_start") + 1).cast("long").alias("pages"))
