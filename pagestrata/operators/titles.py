"""Titles of topics, by what stands on their first pages.

Elements are looked at in the order of elem_idx. A title is the first element
that a rule accepts; where rules have an order of their own, each page keeps the
first element for each rule, and a topic takes the first rule that its first two
pages meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import catalog as C
from ..functions.text import flat_has, group, has, norm, strip
from ..sources.stages import staged
from . import aggregates, joins


def line(c: Column, most: int = 70) -> Column:
    """The first line, without blanks around it."""
    return F.substring(strip(F.split(strip(c), "\n")[0]), 1, most)


def marked(elements: DataFrame) -> DataFrame:
    """Elements with normalised text c, whether it is a repeated header, and whether it is ignored. Elements are written with their text on the way, so that they are made once, and so is the result: all that follows reads it several times."""
    e = staged(elements.withColumn("c", norm(F.coalesce("content", F.lit("")))).withColumn("font_ratio", F.coalesce("font_ratio", F.lit(1.0))))
    wanted = (F.col("type") == "heading") | ((F.col("type") == "paragraph") & (F.length("c") <= 15))
    headers = aggregates.repeated_headers(e, ["doc_id"], "page", "c", wanted & (F.col("c") != ""))
    # A document's headers are few: one row a document joins.
    sets = headers.groupBy("doc_id").agg(F.collect_set("c").alias("_headers"))
    out = e.join(sets, "doc_id", "left")
    return staged(out.withColumn("repeated", F.coalesce(F.array_contains("_headers", F.col("c")), F.lit(False))).withColumn("ignored", has(F.col("c"), C.IGNORE_NUMBER) | has(F.col("c"), C.IGNORE_WORDS)).drop("_headers"))


def said(c: Column, heading: Column) -> Column:
    """what a line says if it is a question's, a section's or a first number's line, or a long heading; null for others."""
    number = group(c, C.STD_NUM).cast("int")
    return (
        F.when(has(c, C.MENTI), F.substring(F.split(strip(group(c, C.MENTI, 2)), "\n")[0], 1, 70))
        .when(has(c, C.ROMAN_I), F.substring(strip(F.substring(c, 4, 1 << 20)), 1, 70))
        .when(number == 1, F.substring(strip(group(c, C.STD_NUM, 2)), 1, 70))
        .when(heading & (F.length(c) > 10), F.substring(c, 1, 70))
    )


def numbered_cells(e: DataFrame) -> DataFrame:
    """F18, its first rule: doc_id, page, cell_title of pages where a heading "M 번" is followed by a table cell of four characters or more, before any cell with a label of the question's data. e as marked() gives it."""
    numbered = (F.col("type") == "heading") & has(F.col("c"), C.NUMBER_HEADING)
    cell = F.coalesce("is_table_cell", F.lit(False)) & ~numbered
    few = e.where(numbered | cell).withColumn("_at", F.min(F.when(numbered, F.col("elem_idx"))).over(Window.partitionBy("doc_id", "page")))
    after = few.where(cell & (F.col("elem_idx") > F.col("_at")))
    label = has(F.col("c"), C.QUESTION_META)
    first = after.groupBy("doc_id", "page").agg(F.min(F.when(label, F.col("elem_idx"))).alias("_stop"), F.min(F.when(~label & (F.length("c") >= 4), F.struct("elem_idx", line(F.col("c"), 80).alias("t")))).alias("_t"))
    return first.where("_t is not null and (_stop is null or _t.elem_idx < _stop)").select("doc_id", "page", F.col("_t.t").alias("cell_title"))


def page_titles(e: DataFrame) -> DataFrame:
    """doc_id, page and the page's first element for each rule: own (ITPE), je, numbered and plain (KPC), airipo. e as marked() gives it."""
    c, i = F.col("c"), F.col("elem_idx")
    usable = ~F.col("repeated") & ~F.col("ignored") & (F.length(c) >= 5)
    number = group(c, C.STD_NUM).cast("int")
    own = F.when(~has(c, C.END), said(c, F.col("type") == "heading"))
    kpc = ~flat_has(c, C.KPC_BRAND)
    je = F.when(has(c, C.JE_NUM) & kpc, line(group(c, C.JE_NUM, 2)))
    numbered = F.when((number <= C.KPC_NUMBERS) & kpc, line(group(c, C.STD_NUM, 2)))
    plain = F.when((F.length(c) >= 10) & kpc & ~has(c, C.STAR_START) & ~has(c, C.KPC_META), line(c))
    none = flat_has(c, C.AIRIPO_BRAND) | flat_has(c, C.AIRIPO_SESSION) | has(c, C.END) | flat_has(c, C.AIRIPO_CONTINUED) | has(c, C.AIRIPO_BAR) | flat_has(c, C.AIRIPO_LABEL)
    airipo = F.when(~none, F.coalesce(line(group(c, C.STD_NUM, 2)), F.when(F.length(c) > 10, line(c))))
    rules = {"own": own, "je": je, "numbered": numbered, "plain": plain, "airipo": airipo}
    told = e.where(usable).select("doc_id", "page", i.alias("i"), *[v.alias(k) for k, v in rules.items()])
    first = told.groupBy("doc_id", "page").agg(*[F.min_by(k, F.when(F.col(k).isNotNull(), F.col("i"))).alias(k) for k in rules])
    cells = numbered_cells(e)
    return first.join(cells, ["doc_id", "page"], "full").withColumn("own", F.coalesce("cell_title", "own")).drop("cell_title")


def placeholder(page: Column) -> Column:
    return F.concat(F.lit("토픽_p"), page.cast("string"))


def range_titles(topics: DataFrame, titles: DataFrame, rules: list[str], pages: int = 2) -> DataFrame:
    """topics (doc_id, page_start, page_end) with title: the first of `rules` that their first `pages` pages meet, on the first of these; null without any."""
    key = ["doc_id", "page_start", "page_end"]
    at = topics.select(*key, F.explode(F.sequence("page_start", F.least(F.col("page_start") + (pages - 1), F.col("page_end")))).alias("page"))
    found = at.join(joins.grown(titles.select("doc_id", "page", *rules)), ["doc_id", "page"]).groupBy(*key).agg(*[F.min_by(r, F.when(F.col(r).isNotNull(), F.col("page"))).alias(f"_{r}") for r in rules])
    return topics.join(joins.grown(found), key, "left").withColumn("title", F.coalesce(*[F.col(f"_{r}") for r in rules])).drop(*[f"_{r}" for r in rules])
