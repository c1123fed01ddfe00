"""Joins of intervals, keywords and engines' results.

Point and interval lookups explode the interval side into pages when both are
keyed by document, so they are equi joins that shuffle by document; keyword
matches scan each text once for all terms (terms.py). Tables are broadcast only
after their rows and bytes are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .terms import term_hits

#: Rows and bytes up to which a dictionary is sent to every task; a larger one is joined in a shuffle.
DICTIONARY_ROWS, DICTIONARY_BYTES = 50_000, 8 << 20


def checked_broadcast(df: DataFrame, rows: int = DICTIONARY_ROWS, most_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows and about `most_bytes` bytes."""
    size = df.limit(rows + 1).agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("b")).first()
    return F.broadcast(df) if size["n"] <= rows and (size["b"] or 0) <= most_bytes else df


def grown(df: DataFrame) -> DataFrame:
    """df as a side of a join that grows with the corpus: both sides are shuffled and merged, and neither goes whole to the driver and to every task.

    Without it Spark judges a table by the bytes of its Parquet files, a few for
    a row of flags and page numbers, and doesn't see how many rows explode makes.
    A union is dealt out by other columns first: taken as dealt out like its parts,
    it can come with more partitions than the other side (Spark 4.1).
    """
    return df.hint("merge")


def session_of(pages: DataFrame, sessions: DataFrame, part: Sequence[str], page: str = "page", by: str = "page_start") -> DataFrame:
    """The first session (by start, or by `by`) that holds the page; else the last session; else 1. sessions: part, session, page_start, page_end."""
    per = sessions.groupBy(*part).agg(F.sort_array(F.collect_list(F.struct(F.col(by).alias("_by"), "page_start", "page_end", "session"))).alias("_s"))
    joined = pages.join(grown(per), list(part), "left")
    inside = F.filter("_s", lambda s: (F.col(page) >= s["page_start"]) & (F.col(page) <= s["page_end"]))
    last = F.element_at(F.transform(F.array_sort(F.transform("_s", lambda s: s["session"])), lambda x: x), -1)
    return joined.withColumn("session", F.coalesce(F.get(inside, F.lit(0))["session"], last, F.lit(1)).cast("long")).drop("_s")


def keyword_matches(topics: DataFrame, keywords: DataFrame, topic_id: str, title: str, content: str, key: Sequence[str], term: str, min_chars: int = 2) -> DataFrame:
    """Per topic and question, terms in the title (3 each) or else in the content (1 each); kept with a title hit or two content hits. Texts are scanned once for all terms; only hits are joined."""
    words = keywords.where(F.length(term) >= min_chars).select(*key, term)
    found = term_hits(topics, topic_id, {"in_title": F.col(title), "in_content": F.col(content)}, words, term)
    hits = found.join(words, term).groupBy(topic_id, *key).agg(F.count_if("in_title").alias("title_hits"), F.count_if(~F.col("in_title")).alias("content_hits"))
    scored = hits.withColumn("score", 3 * F.col("title_hits") + F.col("content_hits"))
    return scored.where((F.col("title_hits") >= 1) | (F.col("content_hits") >= 2)).withColumn("match", F.when(F.col("title_hits") >= 1, "direct").otherwise("indirect"))


def engine_diff(a: DataFrame, b: DataFrame, key: Sequence[str], order: Sequence[str], value: Sequence[str]) -> DataFrame:
    """Full outer by key and occurrence; only_a, only_b, differs or same."""
    w = Window.partitionBy(*key).orderBy(*order)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("occurrence", F.row_number().over(w).cast("long")).select(*key, "occurrence", F.struct(*value).alias(name))

    both = side(a, "a").join(side(b, "b"), [*key, "occurrence"], "full")
    status = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").when(F.col("a") == F.col("b"), "same").otherwise("differs")
    return both.withColumn("status", status)


def left_last_wins(a: DataFrame, b: DataFrame, key: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Each row of a with the last row of b for its key."""
    last = b.groupBy(*key).agg(F.max_by(value, F.struct(*order)).alias("found"))
    status = F.when(F.col("found").isNull(), "missing").when(F.col("found") == F.col(value), "match").otherwise("differs")
    return a.join(last, list(key), "left").withColumn("status", status)


def contained(texts: DataFrame, keys: DataFrame, part: Sequence[str], text: str, key: str, most: int = 8) -> DataFrame:
    """Rows of texts, each with every row of keys of its partition whose key its text holds; empty keys are held by none.

    A key is looked up by a hash of its first `most` characters (all of a
    shorter one): runs of that length in a text are hashed and only those that some
    key of the partition has are joined, by equality; what they bring is
    checked. A partition's keys are few (the questions of a document).
    """
    size = F.least(F.length(key), F.lit(most))
    known = keys.where(F.length(key) > 0).withColumn("_h", F.xxhash64(size, F.substring(F.col(key), F.lit(1), size)))
    asked = known.groupBy(*part).agg(F.collect_set("_h").alias("_keys"), F.collect_set(size).alias("_sizes"))

    def runs(n: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.xxhash64(n, F.substring(F.col(text), i, n)))

    near = F.array_intersect(F.flatten(F.transform(F.filter("_sizes", lambda n: n <= F.length(text)), runs)), "_keys")
    hits = texts.join(asked, list(part)).withColumn("_h", F.explode(near)).drop("_keys", "_sizes")
    return hits.join(known, [*part, "_h"]).where(F.contains(F.col(text), F.col(key))).drop("_h")


def first_page_with(pages: DataFrame, keys: DataFrame, part: Sequence[str], page: str, text: str, key: str, key_page: str | None = None) -> DataFrame:
    """For each key of a document the first page (of those after key_page) whose text holds it."""
    on = contained(pages.select(*part, page, text), keys.select(*part, key, *([key_page] if key_page else [])).distinct(), part, text, key)
    if key_page:
        on = on.where(F.col(page) > F.col(key_page))
    return on.groupBy(*part, key).agg(F.min(page).alias("found_page"))


def drop_containers(intervals: DataFrame, part: Sequence[str], start: str, end: str, least: int = 2) -> DataFrame:
    """Intervals that strictly hold `least` or more others of the same partition go.

    By falling start and rising end, what an interval holds comes before it, and
    of what comes before it holds whatever doesn't end later. So it goes if the
    `least`-th smallest end before it isn't beyond its own. That end is a chain of
    running minima: what loses against the minimum goes on to the next one. Equal
    intervals don't hold each other; the first of them tells for all.
    """
    earlier = Window.partitionBy(*part).orderBy(F.desc(start), F.asc(end)).rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy(*part, start, end)
    t = intervals.withColumn("_x", F.col(end))
    for _ in range(least):
        t = t.withColumn("_m", F.min("_x").over(earlier)).withColumn("_x", F.when(F.col("_m").isNotNull(), F.greatest("_x", "_m")))
    holds = (F.count_if(F.col("_m").isNull()).over(same) == 0) & (F.max("_m").over(same) <= F.col(end))
    return t.withColumn("_holds", holds).where(~F.col("_holds")).drop("_x", "_m", "_holds")


def interval_text(intervals: DataFrame, lines: DataFrame, part: Sequence[str], page: str, idx: str, text: str, most: int | None = None) -> DataFrame:
    """The text of an interval's pages in order, cut at `most` characters. Intervals are exploded to pages, so the join is by page."""
    pages = intervals.withColumn(page, F.explode(F.sequence("page_start", "page_end")))
    joined = pages.join(lines.select(*part, page, idx, text), [*part, page])
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page, idx, text))), lambda x: x[text]), "\n")
    return joined.groupBy(*part, "page_start", "page_end").agg((F.substring(body, 1, most) if most else body).alias("content"))


def both_flags(df: DataFrame, key: Sequence[str], one: Column, two: Column) -> DataFrame:
    """Keys with a row of either kind, in one aggregate."""
    return df.groupBy(*key).agg(F.bool_or(one).alias("_a"), F.bool_or(two).alias("_b")).where("_a and _b").select(*key)


def lookup(df: DataFrame, table: DataFrame, key: Sequence[str], value: str, default) -> DataFrame:
    """Value by key from a small table, with a default."""
    return df.join(checked_broadcast(table.select(*key, value)), list(key), "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def fill_expected(found: DataFrame, expected: DataFrame, key: Sequence[str], number: str, count: str, title: str) -> DataFrame:
    """Numbers 1..count of each key, with the found title or Qn."""
    every = expected.select(*key, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count).cast("long"))).alias(number))
    named = found.select(*key, F.col(number).cast("long").alias(number), title)
    return every.join(named, [*key, number], "left").withColumn(title, F.coalesce(F.col(title), F.concat(F.lit("Q"), F.col(number).cast("string"))))


def missing(expected: DataFrame, found: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of expected without a row in found."""
    return expected.join(found.select(*key), list(key), "left_anti")
