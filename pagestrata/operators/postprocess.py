"""Repairs of a table of intervals: doc_id, num, title, page_start, page_end, session, confidence.

Merges follow a document's intervals in order and change the one they kept
before, so they are folds (folds.kept_rows); further columns are handed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, strip_title_prefix, title_key
from ..sources.stages import staged
from . import folds
from .joins import drop_containers, grown

INTERVALS = "doc_id string, num int, title string, page_start int, page_end int, session int, confidence double"


def in_order(df: DataFrame) -> list[str]:
    """Intervals in page order; those of several formats in the order of their numbers."""
    return ["num"] if "fmt" in df.columns else ["page_start", "page_end", "num"]


def repair_ranges(df: DataFrame, last: str = "n_pages") -> DataFrame:
    """Intervals that start outside the document go; one that ends before its start or outside is its first page alone."""
    inside = df.where(F.col("page_start").between(1, F.col(last)))
    off = F.col("page_end").isNull() | (F.col("page_end") < F.col("page_start")) | (F.col("page_end") > F.col(last))
    return inside.withColumn("page_end", F.when(off, F.col("page_start")).otherwise(F.col("page_end")))


def without_containers(df: DataFrame) -> DataFrame:
    """J10."""
    return drop_containers(df, ["doc_id", "session"], "page_start", "page_end")


def merge_short(df: DataFrame, expected: DataFrame) -> DataFrame:
    """One page under 0.9, or up to two under 0.4, joins the topic before it in its session, else the one after, which it then opens; not where ten or more are expected."""
    known = df.join(grown(expected.select("doc_id", "session", "expected")), ["doc_id", "session"], "left").withColumn("expected", F.coalesce("expected", F.lit(6)).cast("int")).select(*df.columns, "expected")
    kinds = folds.kinds_of(known)

    def step(kept, row, after, state):
        start = F.coalesce(state["start"], row["page_start"])  # of the short ones right before it
        pages = row["page_end"] - start + 1
        short = (row["expected"] < 10) & (((pages <= 1) & (row["confidence"] < 0.9)) | ((pages <= 2) & (row["confidence"] < 0.4)))
        last = folds.last_of(kept)
        back = short & F.coalesce(last["session"] == row["session"], F.lit(False))
        on = short & ~back & F.coalesce(after["session"] == row["session"], F.lit(False))
        joined = folds.with_last(kept, folds.amended(last, kinds, page_end=row["page_end"]))
        own = F.concat(kept, F.array(folds.amended(row, kinds, page_start=start)))
        return F.when(back, joined).when(on, kept).otherwise(own), {"start": F.when(on, start)}

    return folds.kept_rows(known, ["doc_id"], in_order(df), step, {"start": F.lit(None).cast("int")}).drop("expected")


def merge_titles(df: DataFrame, near: int = 2, head: int = 4) -> DataFrame:
    """Of similar titles in a session the first stays, with the shorter title; one within `near` pages extends it, a far one goes. Similar are equal keys, keys with the same first `head` characters, and keys that hold one another."""
    keyed = df.withColumn("_key", title_key("title"))
    kinds = folds.kinds_of(keyed)

    def step(kept, row, after, state):
        def similar(k: Column) -> Column:
            a, b = k["_key"], row["_key"]
            heads = (F.length(a) >= head) & (F.substring(a, 1, head) == F.substring(b, 1, head))
            return ((a != "") & (a == b)) | heads | ((a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a)))

        at = F.get(F.filter(F.transform(kept, lambda k, i: F.when(similar(k), i)), lambda i: i.isNotNull()), F.lit(0))

        def extended(k: Column) -> Column:
            shorter = (F.length(k["title"]) > F.length(row["title"])) & (strip(row["title"]) != "")
            take = lambda c: F.when(shorter, row[c]).otherwise(k[c])
            new = folds.amended(k, kinds, page_end=F.greatest(k["page_end"], row["page_end"]), page_start=F.least(k["page_start"], row["page_start"]), title=take("title"), _key=take("_key"))
            return F.when(row["page_start"] - k["page_end"] <= near, new).otherwise(k)

        changed = F.transform(kept, lambda k, i: F.when(i == at, extended(k)).otherwise(k))
        return F.when(at.isNull(), F.concat(kept, F.array(row))).otherwise(changed), {}

    return folds.kept_rows(keyed, ["doc_id", "session"], ["page_start", "page_end", "num"], step).drop("_key")


def merge_single_pages(df: DataFrame, sessions: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """A page alone joins the topic that ends right before it; merged topics take in further ones."""
    kinds = folds.kinds_of(df)

    def step(kept, row, after, state):
        last = folds.last_of(kept)
        alone = (row["page_start"] == row["page_end"]) & row["session"].isin(*sessions)
        joins = F.coalesce(alone & (last["session"] == row["session"]) & (last["page_end"] + 1 == row["page_start"]), F.lit(False))
        return F.when(joins, folds.with_last(kept, folds.amended(last, kinds, page_end=row["page_end"]))).otherwise(F.concat(kept, F.array(row))), {}

    return folds.kept_rows(df, ["doc_id"], ["session", "page_start", "page_end", "num"], step)


def coherent(df: DataFrame, pages: DataFrame, least: float = 0.2, slack: int = 2) -> DataFrame:
    """doc_id, ok, reason of every document of pages (doc_id, n_pages): in a session no topic starts more than `slack` pages before the furthest end so far, nor a session before the end of the one before it, and `least` of the pages are covered."""
    earlier = Window.partitionBy("doc_id", "session").orderBy("page_start", "page_end").rowsBetween(Window.unboundedPreceding, -1)
    back = F.coalesce(F.col("page_start") < F.max("page_end").over(earlier) - slack, F.lit(False))
    per = df.withColumn("_b", back).groupBy("doc_id", "session").agg(F.bool_or("_b").alias("_b"), F.min("page_start").alias("_s"), F.max("page_end").alias("_e"))
    s = Window.partitionBy("doc_id").orderBy("session")
    crossed = F.coalesce(F.col("_s") < F.lag("_e").over(s) - slack, F.lit(False))
    order = per.withColumn("_c", crossed).groupBy("doc_id").agg(F.bool_or("_b").alias("_b"), F.bool_or("_c").alias("_c"))
    covered = df.select("doc_id", F.explode(F.sequence("page_start", "page_end")).alias("p")).groupBy("doc_id").agg(F.count_distinct("p").alias("covered"))
    joined = pages.select("doc_id", "n_pages").join(order, "doc_id", "left").join(covered, "doc_id", "left")
    reason = F.when(F.col("covered").isNull(), "no topics").when(F.col("_b"), "topics go back").when(F.col("_c"), "sessions go back").when(F.col("covered") < least * F.col("n_pages"), "few pages").otherwise("")
    return joined.select("doc_id", reason.alias("reason")).withColumn("ok", F.col("reason") == "")


def cleaned(df: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Proposed intervals (INTERVALS; num may be null) made fit for use, and the verdict on each document of pages (doc_id, n_pages, multi: its four sessions cover it): doc_id, ok, reason.

    Ranges are repaired, containers go, similar titles merge; what is then
    not coherent is refused as a whole. Single pages merge where sessions are
    certain. A document of one session has session 1, as has a session beyond 1 to
    4; titles lose their numbers and have 80 characters at most; num counts
    the document's topics, session_q is the proposed number or else num.
    """
    within = repair_ranges(df.join(pages.select("doc_id", "n_pages", "multi"), "doc_id")).drop("n_pages")
    merged = staged(merge_titles(without_containers(within)))
    verdict = coherent(merged, pages)
    good = merged.join(verdict.where("ok").select("doc_id"), "doc_id", "left_semi")
    shaped = merge_single_pages(good.where("multi")).unionByName(good.where("not multi"))
    document = Window.partitionBy("doc_id")
    single = F.min("session").over(document) == F.max("session").over(document)
    i = F.row_number().over(document.orderBy("session", "page_start", "page_end", "num")).cast("int")
    title = F.nullif(F.substring(strip_title_prefix("title"), 1, 80), F.lit(""))
    numbered = shaped.withColumn("_i", i).withColumn("_one", single)
    session = F.when(F.col("_one") | ~F.col("session").between(1, 4), 1).otherwise(F.col("session")).cast("int")
    out = numbered.select(
        "doc_id", F.col("_i").alias("num"), F.coalesce(F.nullif("num", F.lit(0)), "_i").alias("session_q"), F.coalesce(title, F.concat(F.lit("토픽_p"), F.col("page_start").cast("string"))).alias("title"),
        "page_start", "page_end", session.alias("session"), F.lit(0.95).alias("confidence"), F.lit("llm").alias("fmt"),
    )
    return out, verdict


def enhance(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Verdicts (doc_id, page_start, same_topic, title) count for intervals under 0.7: titles are taken over; one under 0.6 that continues its predecessor joins it."""
    v = verdicts.select("doc_id", "page_start", "same_topic", F.col("title").alias("new_title"))
    joined = df.join(v, ["doc_id", "page_start"], "left")
    asked = F.col("confidence") < 0.7
    titled = joined.withColumn("title", F.when(asked & (F.length("new_title") > 0), F.col("new_title")).otherwise(F.col("title")))
    gone = titled.withColumn("_gone", F.coalesce(F.col("same_topic") & (F.col("confidence") < 0.6), F.lit(False))).select(*df.columns, "_gone")
    kinds = folds.kinds_of(gone)

    def step(kept, row, after, state):
        last = folds.last_of(kept)
        joins = row["_gone"] & (F.size(kept) > 0)
        return F.when(joins, folds.with_last(kept, folds.amended(last, kinds, page_end=F.greatest(last["page_end"], row["page_end"])))).otherwise(F.concat(kept, F.array(row))), {}

    return folds.kept_rows(gone, ["doc_id"], in_order(df), step).drop("_gone")


def to_split(df: DataFrame) -> DataFrame:
    """Intervals that an enhancer is asked to cut: under 0.5 and four pages or more."""
    return df.where((F.col("confidence") < 0.5) & (F.col("page_end") - F.col("page_start") + 1 >= 4))


def warnings(df: DataFrame, expected: DataFrame) -> DataFrame:
    """doc_id, session, kind, detail of counts off the expected ones, very long, empty and single-page topics."""
    n = expected.join(df.groupBy("doc_id", "session").agg(F.count("*").alias("n")), ["doc_id", "session"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    counts = n.where("n != expected").select("doc_id", "session", F.lit("count").alias("kind"), F.concat_ws("/", F.col("n").cast("string"), F.col("expected").cast("string")).alias("detail"))
    size = F.col("page_end") - F.col("page_start") + 1
    kind = F.when(size >= 10, "long").when(size <= 0, "empty").when((size == 1) & F.col("session").between(2, 4), "single")
    pages = df.withColumn("kind", kind).where("kind is not null").select("doc_id", "session", "kind", F.col("page_start").cast("string").alias("detail"))
    return counts.unionByName(pages)
