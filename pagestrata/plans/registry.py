"""Every registered query of the engine, with reference SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of (spark, sf_dir) under its name."""

    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return add


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["topic_intervals"](spark, sf_dir)


from . import engine_queries, format_queries, function_queries, paper_queries, relational_queries, repair_queries, source_queries, text_queries, window_queries  # noqa: E402, F401
