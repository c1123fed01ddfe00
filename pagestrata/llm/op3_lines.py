"""Line dedup: repeated lines stay only in the smallest document that holds them.

Lines are exploded with their normalised key's 128-bit hash, documents are
counted per hash, and the dropped positions go back to their document, which
is put together again by position. Nothing but hashes and positions is
exploded; each text is moved once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_view, written

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    """Blanks off both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept_text, and with `carry` the row itself as the struct `row`.

    A line whose key has `min_chars` code points or more and stands in
    `min_docs` or more documents (distinct ids; a null id counts as one id,
    after all others) is dropped everywhere but in the smallest id. A null or
    empty text is one empty line. Rows with one id are one document; repeated
    lines inside the document that keeps them all stay.
    """
    view = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row")) if carry else doc_view(docs, id_col, text_col)
    base = view.withColumn("_th", F.xxhash64("text"))
    who = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"))
    lines = (
        base.select("doc_id", "_th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "_th", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc_id", "_th", "pos", F.unhex(F.md5("key")).alias("h"))
    )
    if min_docs == 2:  # two ids differ exactly if the smallest and the largest do
        held = lines.groupBy("h").agg(F.min(who).alias("first"), F.max(who).alias("other")).where(F.col("first") != F.col("other"))
    else:
        held = lines.select("h", who.alias("who")).distinct().groupBy("h").agg(F.min("who").alias("first"), F.count("*").alias("n")).where(F.col("n") >= min_docs)
    # A written table, so that a line held by a third of all documents can be split over tasks in the join.
    held = written(held.select("h", "first"))
    drops = (
        lines.join(held, "h")
        .where(who != F.col("first"))
        .groupBy("doc_id", "_th")
        .agg(F.sort_array(F.collect_set("pos")).alias("drop"))
    )
    b, d = base.alias("b"), drops.alias("d")
    joined = b.join(d, F.col("b.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("b._th") == F.col("d._th")), "left")
    split = F.split("b.text", "\n", -1)
    kept = F.when(F.col("d.drop").isNull(), F.col("b.text")).otherwise(
        F.array_join(
            F.transform(
                F.filter(F.arrays_zip(split.alias("line"), _mask(F.size(split), F.col("d.drop")).alias("gone")), lambda x: ~x["gone"]),
                lambda x: x["line"],
            ),
            "\n",
        )
    )
    return joined.select(
        F.col("b.doc_id").alias("doc_id"),
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("d.drop"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
        *([F.col("b.row").alias("row")] if carry else []),
    )


def _mask(size, drop):
    """true at the positions in the ascending list drop; linear, by the gaps between drops."""
    ends = F.concat(F.array(F.lit(-1)), drop)
    gaps = F.transform(drop, lambda p, i: F.concat(F.array_repeat(F.lit(False), p - F.get(ends, i) - 1), F.array(F.lit(True))))
    return F.concat(F.flatten(gaps), F.array_repeat(F.lit(False), size - 1 - F.element_at(drop, -1)))
