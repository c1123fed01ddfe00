"""Documents to packed training sequences: five stages, each written and read again.

Every stage takes any columns beside doc_id and text (a null text is empty),
repeated rows and ids, texts of any length and empty tables, and hands on the
columns it got; only packing returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.llm import op3_lines, op6_decontaminate, op7_quality, op8_neardup, op9_packing
from pagestrata.llm.common import delete, read_table, shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the forest reject go; null and empty texts fail the rules."""
    return op7_quality.good_documents(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a smaller document holds; n_chars follows. A document that loses lines and has no word left goes; blank ones that lose nothing stay."""
    kept = op3_lines.dedup_lines(docs, carry=True).where((F.col("n_dropped") == 0) | F.col("kept_text").rlike(op8_neardup.WORDY))
    columns = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest id; documents without words are no copies of each other."""
    return op8_neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; a null text holds none."""
    return op6_decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their ids, dealt out to sequences; a null or empty text is its end token."""
    return op9_packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Neither the forest nor the ids can be had in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table goes once the next one is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        out = shared_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(out)
        if before is not None:
            delete(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
