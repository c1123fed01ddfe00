"""Mock exams whose papers are bound in with the answers: pages by their lines or blocks, lists of topics from the papers, questions matched to them.

Lines: doc_id, page, body (array of stripped lines). Blocks: doc_id, page, idx,
type, text, font_size. A page's kind comes from expressions over its own lines;
what follows pages in order (runs of papers, promotion of unmarked questions,
numbers) are windows and folds by document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import U, anchors, has, keywords, short_label, strip
from . import folds, joins, order
from .line_engine import first_anchor

# Marks of the papers' lines.
QNUM_TOPIC = r"^(\d{1,2})\.\s*(.+)$"
QNUM_ONLY = r"^(\d{1,2})\.\s*$"
QNUM_ANY = r"^(\d{1,2})\.\s*(.*)$"
INLINE_LABEL = r"^문\s+제$"
NUMBERED_LABEL = r"^제\s+(\d{1,2})\.\s*(.*)$"
SESSION_PAPER = r"제\s*[1-4]\s*교시\s*\(\s*시험시간"
SELECT_BLOCK = r"\[\s*(?:관리|응용)\s*선택\s*\]"
COPYRIGHT_LINE = r"(?i)Copyright\s*ⓒ.*Korea\s*Productivity\s*Center"
TOPIC_STOPS = ("출", "난", "키", "참")
ITPE_BRAND = r"제\s*\d+\s*회\s*ITPE\s*실전\s*명품\s*모의고사\s*해설집"
ITPE_COPYRIGHT = r"Copyright\s*ⓒ.*ITPE"
ITPE_PAGE_NUMBER = r"^(?:PAGE(?:\s+\d{1,3})?|\d{1,3})$"
TRACKS = ((r"\[\s*정보관리기술사\s*선택\s*문제\s*\]", "jeonggwan"), (r"\[\s*컴퓨터시스템응용기술사\s*선택\s*문제\s*\]", "compeung"))
MASTER_LINE = r"^(\d{1,2})\.\s+(.{4,})$"
MIXED_TOPIC = r"\b\d{1,2}\.\s+[가-힣A-Za-z(]"
OPENER = r"^1\.\s+[가-힣A-Za-z]"
OPENER_TEXT = r"^1\.\s+(.+)$"
GENERIC_OPENERS = ("개요", "정의", "개념")
TOPIC_FONT, OPENER_FONT = (12.0, 14.5), (10.5, 12.0)
WATERMARK_FONT, WATERMARK_CHARS, WATERMARK_NUMBERS = 18.0, 15, r"^[\s\d.,]+$"
# Texts that head or foot a page.
HEADER_NOISE = (
    r"^kpc$", r"^한국생산성본부$", r"^ICT의\s*가치를\s*이끄는\s*사람\.?\s*$", r"^들!!?$", r"^!!?$", r"^사람들!!?$", r"^이끄는\s*사람\.?$", r"^ICT의?\s*가치를?$", r"^ICT\s*의?\s*가치.{0,8}$",
    r"^.*이끄는\s*사람.*", r"^\s*인공지능\s*$", r"^\s*누구나\s*ICT\s*전문가가\s*될\s*수\s*있는\s*세상.*", r"^Copyright\s*ⓒ.*Korea\s*Productivity\s*Center.*", r"^Copyright\s*ⓒ.*ITPE.*",
    r"^제\s*\d+\s*회\s*ITPE\s*실전\s*명품\s*모의고사(\s*해설집)?$", r"^KPC\s*기술사\s*IMPACT\s*실전모의고사$", r"^127\s*회\s*:?\s*KPC.*", r"^\d+$", r"^,$", r"^\.\d+$", r"^\d+\s*[,.\s]+\d*$", r"^[\s,.]*$",
)
# Counts of questions by session that pass a diagnosis.
ITPE_RANGE = {1: (13, 14), 2: (6, 7), 3: (6, 7), 4: (6, 7)}
KPC_RANGE = {1: (13, 17), 2: (6, 9), 3: (6, 9), 4: (6, 9)}


def got(c: Column, pattern: str, k: int = 1) -> Column:
    return F.regexp_extract(c, U + pattern, k)


# ---------------------------------------------------------------- lines


def kpc_body(lines: Column) -> Column:
    """Lines with text from the first anchor of a body among the first 16; all if there is none."""
    cleaned = F.filter(F.transform(lines, strip), lambda x: x != "")
    anchor = lambda x: (x == "문") | reduce(lambda a, b: a | b, [has(x, p) for p in (INLINE_LABEL, QNUM_TOPIC, QNUM_ONLY, SESSION_PAPER, SELECT_BLOCK, COPYRIGHT_LINE)])
    return first_anchor(cleaned, anchor)


def itpe_body(lines: Column) -> Column:
    """Without the brand line and, right after it, a copyright line and a page number; all lines if the first is no brand."""
    cleaned = F.filter(F.transform(lines, strip), lambda x: x != "")
    at = lambda k: F.coalesce(F.get(cleaned, k), F.lit(""))
    one = F.lit(1) + has(at(F.lit(1)), ITPE_COPYRIGHT).cast("int")
    start = one + has(at(one), ITPE_PAGE_NUMBER).cast("int")
    return F.when(has(at(F.lit(0)), ITPE_BRAND), F.slice(cleaned, start + 1, F.greatest(F.size(cleaned) - start, F.lit(0)))).otherwise(cleaned)


def gathered(body: Column, start: Column, most: int) -> Column:
    """lines from index `start`, `most` at most, up to a label that ends a topic, joined by blanks."""
    part = F.slice(body, start + 1, F.greatest(F.least(F.size(body) - start, F.lit(most)), F.lit(0)))
    stop = F.array_position(F.transform(part, lambda x: F.substring(x, 1, 1).isin(*TOPIC_STOPS)), F.lit(True)).cast("int")
    return F.trim(F.array_join(F.when(stop > 0, F.slice(part, F.lit(1), stop - 1)).otherwise(part), " "))


def classify_kpc(pages: DataFrame) -> DataFrame:
    """doc_id, page, body to kind, number, topic, variant: label and number in two lines (A), label in one (B), label and number in one (C), topic word by word (D, -frag)."""
    b = F.col("body")
    at = lambda k: F.coalesce(F.get(b, k), F.lit(""))
    head = F.slice(b, 1, 8)
    paper = F.exists(head, lambda x: has(x, SESSION_PAPER) | has(x, SELECT_BLOCK))
    blank = (F.size(b) <= 2) & F.exists(b, lambda x: has(x, COPYRIGHT_LINE))
    label = F.filter(F.transform(F.slice(b, 1, 5), lambda x, i: F.when((x == "문") | has(x, INLINE_LABEL), i)), lambda i: i.isNotNull())
    t = pages.withColumn("m", F.get(label, F.lit(0)))
    m = F.col("m")
    t = t.withColumn("inline", at(m) != "문").withColumn("nxt", at(m + 1))
    scan_from = m + F.when(F.col("inline"), 1).otherwise(2)
    part = F.slice(b, scan_from + 1, F.greatest(F.least(F.size(b) - scan_from, F.when(F.col("inline"), 4).otherwise(5)), F.lit(0)))
    hits = F.filter(F.transform(part, lambda x, i: F.when(has(x, QNUM_ANY), i)), lambda i: i.isNotNull())
    t = t.withColumn("k", F.when(m.isNotNull(), scan_from + F.get(hits, F.lit(0))))
    k, nxt = F.col("k"), F.col("nxt")
    joined = lambda first, more: F.trim(F.concat_ws(" ", first, F.nullif(more, F.lit(""))))
    numbered = strip(got(nxt, NUMBERED_LABEL, 2))
    is_c = ~F.col("inline") & has(nxt, NUMBERED_LABEL) & (numbered != "")
    is_cf = ~F.col("inline") & has(nxt, NUMBERED_LABEL) & (numbered == "")
    topic_k = strip(got(at(k), QNUM_TOPIC, 2))
    whole = has(at(k), QNUM_TOPIC)
    scans = k.isNotNull() & (F.col("inline") | nxt.startswith("제"))
    variant = F.when(m.isNull(), None).when(is_c, "C").when(is_cf, "C-frag").when(scans & F.col("inline"), F.when(whole, "B").otherwise("B-frag")).when(scans, F.when(whole, "A").otherwise("D"))
    t = t.withColumn("variant", F.when(~paper & ~blank & (F.size(b) > 0), variant))
    v = F.col("variant")
    kind = F.when(F.size(b) == 0, "EMPTY").when(paper, "SESSION_PAPER").when(blank, "EMPTY_PAGE").when(v.isNotNull(), "Q_START").otherwise("Q_BODY")
    number = F.when(v.startswith("C"), got(nxt, NUMBERED_LABEL)).when(v.isNotNull(), got(at(k), QNUM_ANY)).try_cast("int")
    topic = F.when(v == "C", joined(numbered, gathered(b, m + 2, 4))).when(v == "C-frag", gathered(b, m + 2, 18)).when(v.isin("A", "B"), joined(topic_k, gathered(b, k + 1, 5))).when(v.isNotNull(), gathered(b, k + 1, 18))
    return t.select("doc_id", "page", kind.alias("kind"), number.alias("number"), topic.alias("topic"), "variant")


# ---------------------------------------------------------------- blocks


def is_noise(text: Column) -> Column:
    """Heads and feet of pages; empty text too."""
    t = strip(F.coalesce(text, F.lit("")))
    return (t == "") | t.rlike("(?iUd)" + "|".join(f"(?:{p})" for p in HEADER_NOISE))


def is_watermark(text: Column, font: Column) -> Column:
    """Large type that is short or only numbers."""
    t = strip(F.coalesce(text, F.lit("")))
    return (F.coalesce(font, F.lit(0.0)) >= WATERMARK_FONT) & ((F.length(t) <= WATERMARK_CHARS) | has(t, WATERMARK_NUMBERS))


def body_blocks(blocks: DataFrame, tables: bool = False) -> DataFrame:
    """P5: blocks that belong to the body; tables only on demand."""
    table = F.col("type") == "table"
    kept = F.lit(tables) & table | ~table & ~is_watermark(F.col("text"), F.col("font_size")) & ~is_noise(F.col("text"))
    return blocks.where(kept).withColumn("text", strip(F.coalesce("text", F.lit(""))))


def in_font(fonts: tuple[float, float]) -> Column:
    return F.coalesce(F.col("font_size").between(*fonts), F.lit(False))


def _leading(body: DataFrame, most: int) -> DataFrame:
    return order.first_by(body, ["doc_id", "page"], ["idx"], most)


def has_opener(blocks: DataFrame) -> DataFrame:
    """Pages whose first eight blocks (tables included) open an answer: doc_id, page."""
    plain = F.col("type").isin("list", "paragraph") & in_font(OPENER_FONT) & has(F.col("text"), OPENER)
    cells = (F.col("type") == "table") & F.exists(F.split("text", r" \| "), lambda x: has(strip(x), OPENER))
    return _leading(body_blocks(blocks, True), 8).where(plain | cells).select("doc_id", "page").distinct()


def opener_topics(blocks: DataFrame) -> DataFrame:
    """the text of the first numbered opener among a page's first fifteen blocks, unless it is a generic one: doc_id, page, topic."""
    topic = strip(got(F.col("text"), OPENER_TEXT))
    fits = F.col("type").isin("list", "paragraph") & in_font(OPENER_FONT) & (F.length(topic) >= 3) & ~topic.isin(*GENERIC_OPENERS)
    return _leading(body_blocks(blocks), 15).where(fits).groupBy("doc_id", "page").agg(F.min_by(topic, "idx").alias("topic"))


def paper_topics(blocks: DataFrame) -> DataFrame:
    """questions listed on a paper: doc_id, page, idx, number, topic. A title goes on through the headings and paragraphs of its size right after it."""
    b = body_blocks(blocks, True).withColumn("table", F.col("type") == "table")
    sized = ~F.col("table") & in_font(TOPIC_FONT)
    opens = sized & F.col("type").isin("list", "heading", "paragraph") & has(F.col("text"), QNUM_ANY)
    goes_on = sized & F.col("type").isin("heading", "paragraph") & ~has(F.col("text"), QNUM_ANY)
    w = Window.partitionBy("doc_id", "page").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    runs = b.withColumn("opens", opens).withColumn("run", F.sum(F.when(goes_on, 0).otherwise(1)).over(w)).where("not table")
    rows = F.array_sort(F.collect_list(F.struct("idx", "text")))
    listed = runs.groupBy("doc_id", "page", "run").agg(F.min_by("opens", "idx").alias("opens"), F.min("idx").alias("idx"), rows.alias("rows")).where("opens")
    first = F.get("rows", F.lit(0))["text"]
    more = F.array_join(F.transform(F.slice("rows", F.lit(2), F.size("rows")), lambda r: r["text"]), " ")
    own = listed.select("doc_id", "page", "idx", got(first, QNUM_ANY).cast("int").alias("number"), F.trim(F.concat_ws(" ", strip(got(first, QNUM_ANY, 2)), more)).alias("topic"))
    pieces = b.where("table").select("doc_id", "page", "idx", F.explode(F.split("text", r" \| ")).alias("x")).withColumn("x", strip("x")).where(has(F.col("x"), QNUM_ANY))
    cells = pieces.select("doc_id", "page", "idx", got(F.col("x"), QNUM_ANY).cast("int").alias("number"), strip(got(F.col("x"), QNUM_ANY, 2)).alias("topic"))
    return own.unionByName(cells)


def track_topics(blocks: DataFrame) -> DataFrame:
    """doc_id, page, track, number, topic: the longest title of each track's question on a page; a track's heading holds for what follows on the page."""
    b = body_blocks(blocks, True)
    mark = reduce(lambda a, p: a.when(has(F.col("text"), p[0]), p[1]), TRACKS[1:], F.when(has(F.col("text"), TRACKS[0][0]), TRACKS[0][1]))
    w = Window.partitionBy("doc_id", "page").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    tracked = b.withColumn("mark", mark).withColumn("track", F.coalesce(F.last("mark", ignorenulls=True).over(w), F.lit("common"))).where("mark is null")
    lines = F.when(F.col("type") == "table", F.split("text", r" \| ")).otherwise(F.split("text", "\n"))
    x = strip("x")
    found = tracked.select("doc_id", "page", "track", "idx", F.posexplode(lines).alias("part", "x")).withColumn("number", got(x, MASTER_LINE).try_cast("int")).withColumn("topic", strip(got(x, MASTER_LINE, 2))).where(F.col("number").between(1, 16))
    return longest_titles(found, ["doc_id", "page", "track", "number"], ["idx", "part"])


def longest_titles(topics: DataFrame, key: list[str], seen: list[str], title: str = "topic") -> DataFrame:
    """The longest title of each key, the first seen of equals."""
    first = [(-F.col(c)).alias(f"n{i}") for i, c in enumerate(seen)]
    return topics.groupBy(*key).agg(F.max_by(title, F.struct(F.length(title).alias("l"), *first)).alias(title))


def session_masters(topics: DataFrame, papers: DataFrame) -> DataFrame:
    """doc_id, session, number, topic. A run of papers is a session; runs without topics don't count. topics: of paper_topics; papers: doc_id, page of all papers."""
    runs = order.islands(papers, ["doc_id"], "page", 1, "run").select("doc_id", "page", "run")
    listed = topics.join(runs, ["doc_id", "page"])
    w = Window.partitionBy("doc_id").orderBy("run")
    sessions = listed.select("doc_id", "run").distinct().withColumn("session", F.row_number().over(w))
    return longest_titles(listed.join(sessions, ["doc_id", "run"]), ["doc_id", "session", "number"], ["page", "idx"])


def is_clean(title: Column) -> Column:
    """A title of up to 200 characters without another question's number in it."""
    return F.coalesce((F.length(title) > 0) & (F.length(title) <= 200) & ~title.rlike(MIXED_TOPIC), F.lit(False))


def enrich_titles(questions: DataFrame, masters: DataFrame) -> DataFrame:
    """doc_id, session, number, topic, page_start, page_end with titles of the papers (doc_id, session, track, number, topic) that are longer by over four characters and clean.

    A question's first occurrence takes the common title, else that of the
    first track; a later one that of the second track.
    """
    n = order.occurrence(questions, ["doc_id", "session", "number"], ["page_start", "page_end"])
    titles = masters.groupBy("doc_id", "session", "number").agg(*[F.max(F.when(F.col("track") == t, F.col("topic"))).alias(t) for t in ("common", "jeonggwan", "compeung")])
    both = n.join(titles, ["doc_id", "session", "number"], "left")
    found = F.when(F.col("occurrence") == 1, F.coalesce("common", "jeonggwan")).otherwise(F.col("compeung"))
    take = is_clean(found) & (F.length(found) > F.length("topic") + 4)
    return both.withColumn("topic", F.when(take, found).otherwise(F.col("topic"))).drop("common", "jeonggwan", "compeung")


def file_labels(questions: DataFrame, kinds: DataFrame, prefix: Column | str = "doc_id") -> DataFrame:
    """Each question's file name: its page's category if it has 4 to 60 characters, else a short form of its title, else Qnn; repeated names get a letter."""
    own = kinds.where(F.col("kind").startswith("Q_START")).select("doc_id", F.col("page").alias("page_start"), "category", F.col("topic").alias("page_topic"))
    both = questions.join(own, ["doc_id", "page_start"], "left")
    n = F.lpad(F.col("number").cast("string"), 2, "0")
    label = F.when(F.length("category").between(4, 60), F.col("category")).otherwise(F.coalesce(F.nullif(short_label("topic"), F.lit("")), F.nullif(short_label("page_topic"), F.lit("")), F.concat(F.lit("Q"), n)))
    head = F.col(prefix) if isinstance(prefix, str) else prefix
    named = both.withColumn("name", F.concat(head, F.lit("_M"), F.col("session").cast("string"), F.lit("_Q"), n, F.lit("_"), label))
    k = order.occurrence(named, ["doc_id", "name"], ["page_start", "page_end"], "k")
    return k.withColumn("name", F.when(F.col("k") > 1, F.concat("name", F.lit("_"), F.chr(F.col("k") + 96))).otherwise(F.col("name"))).drop("k", "page_topic")


def master_matches(blocks: DataFrame, masters: DataFrame, pages: DataFrame | None = None, head: int = 10, least: int = 2) -> DataFrame:
    """doc_id, page, session, number: the paper's topic that a page's first blocks are about.

    The topic with the longest anchor that the text holds, the earliest of
    equals; where none is held, the one with most words in common, `least` or
    more. Anchors are looked up by their first characters, words by equality.
    """
    body = body_blocks(blocks, True)
    body = body if pages is None else body.join(pages.select("doc_id", "page"), ["doc_id", "page"], "left_semi")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda r: r["text"]), " ")
    heads = _leading(body, head).groupBy("doc_id", "page").agg(text.alias("head"))
    asked = masters.select("doc_id", "session", "number", F.explode(anchors("topic")).alias("anchor"))
    held = joins.contained(heads, asked, ["doc_id"], "head", "anchor")
    pair = ["doc_id", "page", "session", "number"]
    best = held.groupBy(*pair).agg(F.min(F.struct((-F.length("anchor")).alias("n"), "anchor", F.instr("head", F.col("anchor")).alias("at"))).alias("b"))
    first = best.select(*pair, F.struct(F.lit(0).alias("way"), F.col("b.n").alias("n"), F.col("b.at").alias("at"), "number").alias("rank"))
    words = heads.select("doc_id", "page", F.explode(F.array_distinct(keywords("head"))).alias("word"))
    terms = masters.select("doc_id", "session", "number", "topic", F.explode(F.array_distinct(keywords("topic"))).alias("word"))
    common = words.join(terms, ["doc_id", "word"]).groupBy(*pair, "topic").agg(F.count("*").alias("c")).where(F.col("c") >= least)
    second = common.select(*pair, F.struct(F.lit(1).alias("way"), (-F.col("c")).cast("int").alias("n"), F.lit(0).alias("at"), "number").alias("rank"))
    return first.union(second).groupBy("doc_id", "page", "session").agg(F.min("rank")["number"].alias("number"))


def holds_anchor(blocks: DataFrame, topics: DataFrame, head: int = 10) -> DataFrame:
    """Rows of topics (doc_id, page, topic) whose page has an anchor of the topic in its first blocks."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda r: r["text"]), " ")
    heads = _leading(body_blocks(blocks), head).groupBy("doc_id", "page").agg(text.alias("head"))
    return topics.join(heads, ["doc_id", "page"]).where(F.exists(anchors("topic"), lambda a: F.contains(F.col("head"), a))).drop("head")


def promote(kinds: DataFrame, openers: DataFrame, matches: DataFrame) -> DataFrame:
    """Pages in order; a page that opens an answer and is about the question due next becomes its start: kinds plus promoted, number due.

    kinds: doc_id, page, kind. openers: of has_opener. matches: of
    master_matches. A question starts a new session after a paper; the page has
    to be three pages after the last start unless it follows a paper.
    """
    found = matches.groupBy("doc_id", "page").agg(*[F.max(F.when(F.col("session") == s, F.col("number"))).cast("int").alias(f"q{s}") for s in (1, 2, 3, 4)])
    joined = kinds.join(openers.withColumn("opener", F.lit(True)), ["doc_id", "page"], "left").join(found, ["doc_id", "page"], "left").withColumn("opener", F.coalesce("opener", F.lit(False))).withColumn("page", F.col("page").cast("int"))
    state = {"session": F.lit(0), "last": F.lit(0), "start": F.lit(-10), "paper": F.lit(False), "hit": F.lit(False)}

    def step(s, r):
        is_paper, starts = r["kind"] == "SESSION_PAPER", r["kind"] == "Q_START"
        nxt = F.least(s["session"] + 1, F.lit(4))
        due_session = F.when(s["paper"], nxt).otherwise(s["session"])
        due = F.when(s["paper"], 0).otherwise(s["last"]) + 1
        match = F.when(due_session == 1, r["q1"]).when(due_session == 2, r["q2"]).when(due_session == 3, r["q3"]).when(due_session == 4, r["q4"])
        far = s["paper"] | (r["page"] - s["start"] >= 3)
        hit = F.coalesce(r["kind"].isin("Q_BODY", "EMPTY_PAGE") & r["opener"] & far & (match == due), F.lit(False))
        session = F.when(starts & (s["session"] == 0), 1).when(starts & s["paper"], nxt).when(hit & s["paper"], nxt).otherwise(s["session"])
        last = F.when(starts, F.when((s["session"] != 0) & s["paper"], 1).otherwise(s["last"] + 1)).when(hit, due).otherwise(s["last"])
        return {"session": session, "last": last, "start": F.when(starts | hit, r["page"]).otherwise(s["start"]), "paper": F.when(is_paper, True).when(starts | hit, False).otherwise(s["paper"]), "hit": hit}

    out = folds.fold(joined, ["doc_id"], ["page"], ["kind", "opener", "q1", "q2", "q3", "q4"], state, step)
    return out.select("doc_id", "page", F.when(F.col("state.hit"), "Q_START").otherwise(F.col("kind")).alias("kind"), F.col("state.hit").alias("promoted"), F.when(F.col("state.hit"), F.col("state.last")).alias("due"))


def number_questions(kinds: DataFrame) -> DataFrame:
    """W21, final pass: sessions and numbers of question starts: doc_id, page, kind, session, number.

    kinds: doc_id, page, kind, signal (topic_list, star_only or promoted),
    number, forced (a session, where there are no papers). A forced session or
    a star alone takes the number after the last one; a printed number counts; a
    promoted one that doesn't rise, or was used in its session, is no start.
    """
    state = {"session": F.lit(None).cast("int"), "last": F.lit(None).cast("int"), "paper": F.lit(False), "used": F.array().cast("array<int>"), "ok": F.lit(True), "number": F.lit(None).cast("int")}

    def step(s, r):
        starts = r["kind"] == "Q_START"
        star = r["forced"].isNotNull() | (r["signal"] == "star_only")
        nxt = F.least(s["session"] + 1, F.lit(4))
        falls = F.coalesce((r["signal"] == "topic_list") & (r["number"] < s["last"]), F.lit(False))
        session = F.when(r["forced"].isNotNull(), r["forced"]).when(s["session"].isNull(), 1).when(s["paper"] | falls, nxt).otherwise(s["session"])
        fresh = F.when(r["forced"].isNotNull(), ~r["forced"].eqNullSafe(s["session"])).otherwise(s["session"].isNotNull() & (s["paper"] | falls))
        last = F.when(~fresh, s["last"])
        number = F.when(star, F.coalesce(last, F.lit(0)) + 1).otherwise(r["number"])
        code = session * 100 + number
        bad = F.coalesce((r["signal"] == "promoted") & ~star & (number.isNull() | F.coalesce(number <= last, F.lit(False)) | F.array_contains(s["used"], code)), F.lit(False))
        counts = starts & ~bad
        return {
            "session": F.when(starts, session).otherwise(s["session"]),
            "last": F.when(counts, F.coalesce(number, last)).when(starts, last).otherwise(s["last"]),
            "paper": F.when(r["kind"] == "SESSION_PAPER", True).when(counts, False).otherwise(s["paper"]),
            "used": F.when(counts & number.isNotNull(), F.array_append(s["used"], code)).otherwise(s["used"]),
            "ok": ~starts | ~bad,
            "number": F.when(counts, number),
        }

    k = kinds.select("doc_id", F.col("page").cast("int").alias("page"), "kind", "signal", F.col("number").cast("int").alias("number"), F.col("forced").cast("int").alias("forced"))
    out = folds.fold(k, ["doc_id"], ["page"], ["kind", "signal", "number", "forced"], state, step)
    return out.select("doc_id", "page", F.when(F.col("state.ok"), F.col("kind")).otherwise("Q_BODY").alias("kind"), F.col("state.session").alias("session"), F.col("state.number").alias("number"))


# ---------------------------------------------------------------- diagnosis


def duplicate_numbers(questions: DataFrame) -> DataFrame:
    """Session and number of a document that occur more than once, with their titles in page order."""
    titles = F.transform(F.array_sort(F.collect_list(F.struct("page_start", "topic"))), lambda s: s["topic"])
    return questions.groupBy("doc_id", "session", "number").agg(F.count("*").alias("n"), titles.alias("topics")).where("n > 1")


def diagnosis(questions: DataFrame, kinds: DataFrame, ranges: dict[int, tuple[int, int]] = ITPE_RANGE) -> DataFrame:
    """One row a document: counts in range, numbers rising and without gaps, no partial start, no page outside; and whether all hold.

    questions: doc_id, session, number, page_start, page_end. kinds: doc_id,
    page, kind of every page; covers, papers and empty pages need no question.
    """
    rows = F.array_sort(F.collect_list(F.struct("session", "page_start", "page_end", "number")))
    docs = questions.groupBy("doc_id").agg(rows.alias("rows"))
    q = F.col("rows")
    falls = F.exists(F.zip_with(F.slice(q, 1, F.size(q) - 1), F.slice(q, 2, F.size(q) - 1), lambda x, y: x["session"].eqNullSafe(y["session"]) & (y["number"] < x["number"])), lambda x: F.coalesce(x, F.lit(False)))
    sessions = F.array_distinct(F.transform(q, lambda x: x["session"]))
    numbers = lambda s: F.array_distinct(F.filter(F.transform(F.filter(q, lambda x: x["session"].eqNullSafe(s)), lambda x: x["number"]), lambda n: n.isNotNull()))
    whole = F.transform(sessions, lambda s: F.size(numbers(s)) == F.array_max(numbers(s)))
    count = lambda s: F.size(F.filter(q, lambda x: x["session"] == s))
    fits = [count(s).between(max(lo, 1), hi) for s, (lo, hi) in ranges.items()]
    told = docs.select("doc_id", "rows", reduce(lambda x, y: x & y, fits, F.lit(True)).alias("counts_ok"), (~falls).alias("rising"), F.when(F.exists(whole, lambda x: x.isNotNull()), F.forall(whole, lambda x: F.coalesce(x, F.lit(True)))).alias("continuous"))
    free = F.col("kind").isin("SESSION_HDR", "SELECT_HDR", "COVER", "EXAM_PAPER", "EMPTY")
    page = F.col("page")
    inside = F.coalesce(F.exists("rows", lambda x: page.between(x["page_start"], x["page_end"]) | page.between(x["page_end"], x["page_start"])), F.lit(False))
    # Pages and flags meet once: neither a document's questions nor its pages are made into rows of their own.
    pages = kinds.join(told, "doc_id", "left").groupBy("doc_id", "counts_ok", "rising", "continuous").agg(F.count_if(F.col("kind") == "Q_START_PARTIAL").alias("n_partial"), F.count_if(~inside & ~free).alias("n_outside"))
    out = pages.select("doc_id", "n_partial", "n_outside", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("counts_ok", "rising", "continuous")])
    return out.withColumn("ok", F.col("counts_ok") & F.col("rising") & F.col("continuous") & (F.col("n_partial") == 0) & (F.col("n_outside") == 0))
