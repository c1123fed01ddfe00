"""Tables that a plan writes on its way, so that steps that share them don't compute them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_path(spark: SparkSession) -> str:
    """A new folder below the one that spark.checkpoint.dir names (without one, as in tests, below the warehouse)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.stages"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """df as a Parquet table in a stage's folder: it outlives executors, and needs no unpersist."""
    spark, path = df.sparkSession, stage_path(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
