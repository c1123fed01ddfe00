"""Readers for the tables the engine runs on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Ids that one document of text_pages spans, so that no document grows with the corpus.
DOC_IDS = 500


def text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as pages: ids of one source and one run of DOC_IDS ids are a document, the rank of an id there its page."""
    doc = F.concat_ws("#", "source", F.expr(f"doc_id div {DOC_IDS}").cast("string"))
    docs = table(spark, sf_dir, "documents").select(doc.alias("doc"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs.withColumn("pg", F.row_number().over(Window.partitionBy("doc").orderBy("doc_id")).cast("long"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text_pages: doc, pg, elem_idx (from 1), line."""
    return text_pages(spark, sf_dir).select("doc", "pg", F.posexplode(F.split("text", "\n", -1)).alias("_i", "line")).select("doc", "pg", (F.col("_i") + 1).cast("long").alias("elem_idx"), "line")


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as pages of their user: user_id, pg, event_id, ts, event_type, value."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value").withColumn("pg", F.row_number().over(w).cast("long"))
