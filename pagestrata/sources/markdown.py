"""Topics from Markdown: numbered headings, cards and rows of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip

# How each method finds a number and its title; methods in the order in which they count.
METHODS = (
    ("heading", r"(?md)^#{1,4}\s+(\d{1,2})\.\s+(.+)"),
    ("menti_card", r"(?d)문\s*제\s+(\d{1,2})\.\s+(.+)"),
    ("table_cell", r"(?md)^\|(\d{1,2})\|([^|]+)\|"),
)
CELL_CHARS = 4


def found(text: Column, turn: int, method: str, pattern: str, least: int) -> Column:
    """Numbers and titles that one method finds, with its turn and their place in the text."""
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("num"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("title"))
    rows = F.transform(pairs, lambda p, i: F.struct(p["num"].cast("int").alias("num"), strip(p["title"]).alias("title"), F.lit(method).alias("method"), F.lit(turn).alias("turn"), i.alias("place")))
    return F.filter(rows, lambda r: F.length(r["title"]) >= least)


def markdown_topics(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, num, title, method): of each number the first title, by method, then by place. A cell has to have four characters; a null text has no topics."""
    every = [found(F.col(text_col), k, m, p, CELL_CHARS if m == "table_cell" else 0) for k, (m, p) in enumerate(METHODS)]
    rows = texts.select(id_col, F.explode(F.concat(*every)).alias("_x")).select(id_col, "_x.*")
    w = Window.partitionBy(id_col, "num").orderBy("turn", "place")
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(id_col, "num", "title", "method")


def text_or_image(pages: DataFrame, second: DataFrame, least: int = 50) -> DataFrame:
    """(doc_id, content): a document's pages in order, of a page with `least` characters or fewer what the second source (doc_id, page, text) read, marked with its page; pages of which neither has anything are left out. pages: doc_id, page, text."""
    own = strip(F.coalesce("text", F.lit("")))
    both = pages.select("doc_id", "page", own.alias("own")).join(second.select("doc_id", "page", F.col("text").alias("read")), ["doc_id", "page"], "left")
    read = F.concat(F.lit("[OCR p"), F.col("page").cast("string"), F.lit("]\n"), F.col("read"), F.lit("\n\n"))
    part = F.when(F.length("own") > least, F.concat(F.col("own"), F.lit("\n\n"))).when(F.length("read") > 0, read)
    rows = F.array_sort(F.collect_list(F.when(part.isNotNull(), F.struct("page", part.alias("t")))))
    return both.groupBy("doc_id").agg(F.array_join(F.transform(rows, lambda r: r["t"]), "").alias("content"))
