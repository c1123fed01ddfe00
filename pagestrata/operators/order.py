"""Operators on an ordered axis: one partition per document, pages in order.

All take the partition and order columns by name; the order has to end in a
column that is unique within a partition. Plain windows only: each is one
shuffle by the partition columns, shared by all operators on the same axis.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Names = Sequence[str]


def axis(part: Names, order: Names):
    return Window.partitionBy(*part).orderBy(*order)


def before(part: Names, order: Names):
    return axis(part, order).rowsBetween(Window.unboundedPreceding, -1)


def after(part: Names, order: Names):
    return axis(part, order).rowsBetween(1, Window.unboundedFollowing)


def upto(part: Names, order: Names):
    return axis(part, order).rowsBetween(Window.unboundedPreceding, 0)


def page_axis(df: DataFrame, part: Names, order: Names, name: str = "pg") -> DataFrame:
    """Numbers the rows of each partition from 1."""
    return df.withColumn(name, F.row_number().over(axis(part, order)).cast("long"))


def close_intervals(starts: DataFrame, part: Names, start: str, last: Column, end: str = "page_end", least: int = 0) -> DataFrame:
    """Each start reaches to the page before the next one, the last to `last`; never below start + least."""
    nxt = F.lead(start).over(axis(part, [start])) - 1
    return starts.withColumn(end, F.greatest(F.coalesce(nxt, last), F.col(start) + least))


def close_at_blocker(pages: DataFrame, part: Names, page: str, is_start: Column, is_blocker: Column, last: Column) -> DataFrame:
    """As close_intervals, but a blocking page between ends the interval before it. pages: every page once."""
    w = after(part, [page])
    nxt = F.first(F.when(is_start, F.col(page)), ignorenulls=True).over(w)
    stop = F.first(F.when(is_blocker, F.col(page)), ignorenulls=True).over(w)
    end = F.coalesce(F.least(nxt, stop) - 1, last)
    return pages.withColumn("page_end", end).where(is_start).withColumnRenamed(page, "page_start")


def restarts(df: DataFrame, part: Names, order: Names, number: str) -> DataFrame:
    """Numbered pages that start at 1 again after a larger number."""
    numbered = df.where(F.col(number).isNotNull())
    return numbered.withColumn("_p", F.lag(number).over(axis(part, order))).where((F.col(number) == 1) & (F.col("_p") > 1)).drop("_p")


def changes(df: DataFrame, part: Names, order: Names, value: str) -> DataFrame:
    """Rows whose value differs from the value before (nulls don't count)."""
    known = df.where(F.col(value).isNotNull())
    return known.withColumn("previous", F.lag(value).over(axis(part, order))).where(F.col("previous").isNotNull() & (F.col("previous") != F.col(value)))


def running_max_restarts(df: DataFrame, part: Names, order: Names, value: str, first: int = 0, beyond: int = 1, veto: Column | None = None) -> DataFrame:
    """Rows at `first` after any row at `beyond` or more; the maximum is never reset."""
    fires = (F.col(value) == first) & (F.max(value).over(before(part, order)) >= beyond)
    marked = df.withColumn("_fires", fires)
    return marked.where(F.col("_fires") & (~veto if veto is not None else F.lit(True))).drop("_fires")


def transitions(df: DataFrame, part: Names, order: Names, number: str, least: int = 2, last_cycle: bool = True) -> DataFrame:
    """Change points of a running number; with `last_cycle` only from the last point at 1 that isn't the first; partitions with `least` or more."""
    w = axis(part, order)
    points = df.where(F.col(number).isNotNull()).withColumn("_p", F.lag(number).over(w)).where(F.col("_p").isNull() | (F.col("_p") != F.col(number))).drop("_p")
    points = points.withColumn("_i", F.row_number().over(w))
    whole = Window.partitionBy(*part)
    if last_cycle:
        points = points.withColumn("_from", F.coalesce(F.max(F.when((F.col(number) == 1) & (F.col("_i") > 1), F.col("_i"))).over(whole), F.lit(1))).where(F.col("_i") >= F.col("_from")).drop("_from")
    return points.withColumn("_n", F.count("*").over(whole)).where(F.col("_n") >= least).drop("_i", "_n")


def first_by(df: DataFrame, part: Names, order: Sequence[Column | str], k: int = 1) -> DataFrame:
    """The first k rows of each partition in the given order."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def renumber(df: DataFrame, part: Names, session: Names, order: Names, is_topic: Column) -> DataFrame:
    """Running numbers over the document and over the session; rows that are no topic get 0."""
    one = F.when(is_topic, 1).otherwise(0)
    num = F.sum(one).over(upto(part, order))
    own = F.sum(one).over(upto([*part, *session], order))
    return df.withColumn("num", F.when(is_topic, num).otherwise(0).cast("long")).withColumn("session_q", F.when(is_topic, own).otherwise(0).cast("long"))


def occurrence(df: DataFrame, keys: Names, order: Names, name: str = "occurrence") -> DataFrame:
    """Which occurrence of its key a row is, from 1."""
    return df.withColumn(name, F.row_number().over(axis(keys, order)).cast("long"))


def islands(df: DataFrame, part: Names, page: str, gap: int, name: str = "island") -> DataFrame:
    """Pages at most `gap` apart are one island, numbered from 1."""
    w = axis(part, [page])
    new = F.when(F.col(page) - F.lag(page).over(w) <= gap, 0).otherwise(1)
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(upto(part, [page])).cast("long")).drop("_new")


def island_ranges(df: DataFrame, part: Names, page: str, gap: int) -> DataFrame:
    return islands(df, part, page, gap).groupBy(*part, "island").agg(F.min(page).alias("page_start"), F.max(page).alias("page_end"), F.count("*").alias("n_pages"))


def reset_sessions(df: DataFrame, part: Names, order: Names, number: str, cap: int = 4) -> DataFrame:
    """The session rises by one when the number falls, up to `cap`; rows without a number keep the last session."""
    last = F.last(number, ignorenulls=True).over(before(part, order))
    falls = F.when(F.col(number) < last, 1).otherwise(0)
    marked = df.withColumn("_f", falls)
    return marked.withColumn("session", F.least(F.lit(1) + F.sum("_f").over(upto(part, order)), F.lit(cap)).cast("long")).drop("_f")


def gap_sessions(starts: DataFrame, part: Names, page: str, gap: int = 4, size: int = 8, cap: int = 4) -> DataFrame:
    """Starts up to the first gap of `gap` or more (itself included) are session 1; the rest blocks of `size`, up to `cap`."""
    w = axis(part, [page])
    numbered = starts.withColumn("_i", F.row_number().over(w) - 1).withColumn("_g", F.lead(page).over(w) - F.col(page))
    first = F.min(F.when(F.col("_g") >= gap, F.col("_i"))).over(Window.partitionBy(*part))
    cut = numbered.withColumn("_t", first + 1)
    session = F.when(F.col("_t").isNull() | (F.col("_i") < F.col("_t")), 1).otherwise(F.least(F.lit(2) + F.floor((F.col("_i") - F.col("_t")) / size), F.lit(cap)))
    return cut.withColumn("session", session.cast("long")).drop("_i", "_g", "_t")


def kth_threshold(df: DataFrame, part: Names, score: str, tie: Names, expected: Column | int, share: float = 0.5, weak: Column | None = None, weak_factor: float = 0.6) -> DataFrame:
    """Keep scores of `share` of the expected-th largest (or of the smallest if there are fewer); weak ones then lose; the first `expected` stay."""
    expected = F.lit(expected) if isinstance(expected, int) else expected
    by = Window.partitionBy(*part).orderBy(F.col(score).desc(), *tie)
    whole = Window.partitionBy(*part)
    ranked = df.withColumn("_r", F.row_number().over(by)).withColumn("_k", F.coalesce(F.max(F.when(F.col("_r") == expected, F.col(score))).over(whole), F.min(score).over(whole)))
    kept = ranked.where(F.col(score) >= F.col("_k") * share)
    if weak is not None:
        kept = kept.withColumn(score, F.when(weak, F.col(score) * weak_factor).otherwise(F.col(score)))
    return kept.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= expected).drop("_r", "_k")


def running_cut(df: DataFrame, part: Names, order: Names, size: Column, most: int) -> DataFrame:
    """Rows until the sizes before them reach `most`."""
    return df.withColumn("_b", F.coalesce(F.sum(size).over(before(part, order)), F.lit(0))).where(F.col("_b") < most).drop("_b")


def forward_intervals(df: DataFrame, part: Names, page: str, is_end: Column, is_start: Column) -> DataFrame:
    """Each end page closes an interval that starts at the first start marker after the end before, else right after it."""
    w = axis(part, [page])
    previous = F.coalesce(F.max(F.when(is_end, F.col(page))).over(before(part, [page])), F.lit(0))
    tagged = df.withColumn("_prev", previous).withColumn("_start", F.when(is_start, F.col(page)))
    group = Window.partitionBy(*part, "_prev")
    found = tagged.withColumn("page_start", F.coalesce(F.min("_start").over(group), F.col("_prev") + 1))
    return found.where(is_end).withColumnRenamed(page, "page_end").drop("_prev", "_start")


def nearest_before(df: DataFrame, part: Names, order: Names, page: str, is_marker: Column, within: int | None = None) -> DataFrame:
    """The nearest marked page strictly before, if within reach."""
    near = F.last(F.when(is_marker, F.col(page)), ignorenulls=True).over(before(part, order))
    return df.withColumn("marker", near if within is None else F.when(F.col(page) - near <= within, near))


def number_blocks(df: DataFrame, part: Names, order: Names, number: str) -> DataFrame:
    """Rows without a number are numbered in order within their block; others keep theirs."""
    missing = F.when(F.col(number).isNull(), 1).otherwise(0)
    return df.withColumn(number, F.coalesce(F.col(number), F.sum(missing).over(upto(part, order))).cast("long"))


def repair_gaps(sessions: DataFrame, part: Names, start: str, end: str, last: Column, absorb: int = 4, least: int = 5) -> DataFrame:
    """A gap in front or behind of up to `absorb` pages is taken in, a larger one is a block; a block under `least` pages voids the partition's."""
    w = axis(part, [start])
    whole = Window.partitionBy(*part)
    first, final = F.row_number().over(w) == 1, F.lead(start).over(w).isNull()
    front, back = F.col(start) - 1, last - F.col(end)
    span = sessions.withColumn("_first", first).withColumn("_final", final)
    grown = span.withColumn("_s", F.when(F.col("_first") & front.between(1, absorb), F.lit(1)).otherwise(F.col(start))).withColumn("_e", F.when(F.col("_final") & back.between(1, absorb), last).otherwise(F.col(end)))
    own = F.struct(F.col("_s").cast("long").alias("page_start"), F.col("_e").cast("long").alias("page_end"))
    extra = F.array_compact(
        F.array(
            F.when(F.col("_first") & (front > absorb), F.struct(F.lit(1).cast("long").alias("page_start"), (F.col(start) - 1).cast("long").alias("page_end"))),
            own,
            F.when(F.col("_final") & (back > absorb), F.struct((F.col(end) + 1).cast("long").alias("page_start"), last.cast("long").alias("page_end"))),
        )
    )
    blocks = grown.select(*part, F.inline(extra))
    return blocks.withColumn("_short", F.min(F.col("page_end") - F.col("page_start") + 1).over(whole)).where(F.col("_short") >= least).drop("_short")


def questions_first(fmt: str = "fmt") -> Column:
    """A sort key that puts question pages before topics that start on the same page."""
    return F.when(F.col(fmt) == "question_pages", 0).otherwise(1)


def merged_order(topics: DataFrame, questions: DataFrame, part: Names, start: str = "page_start") -> DataFrame:
    """Topics and question pages as one list numbered in order, `place` from 1: by start; on the same page the topic first."""
    both = topics.withColumn("fmt", F.lit("topic")).unionByName(questions.withColumn("fmt", F.lit("question_pages")), allowMissingColumns=True)
    w = Window.partitionBy(*part).orderBy(start, F.when(F.col("fmt") == "topic", 0).otherwise(1), "page_end")
    return both.withColumn("place", F.row_number().over(w).cast("long"))


def summaries(lines: DataFrame, part: Names, order: Names, text: str, most: int = 5, chars: int = 80, between: str = " / ") -> DataFrame:
    """T4: of each partition the first `most` lines with text, cut and joined."""
    kept = first_by(lines.where(F.trim(text) != ""), part, order, most)
    rows = F.array_sort(F.collect_list(F.struct(*order, F.substring(F.trim(text), 1, chars).alias("_t"))))
    return kept.groupBy(*part).agg(F.array_join(F.transform(rows, lambda r: r["_t"]), between).alias("summary"))


def limited(items: Column, most: int = 5) -> Column:
    """The first `most` of a list, and how many more there are."""
    more = F.size(items) - most
    return F.when(more > 0, F.concat(F.slice(items, 1, most), F.array(F.concat(F.lit("… 외 "), more.cast("string"), F.lit("건"))))).otherwise(items)
