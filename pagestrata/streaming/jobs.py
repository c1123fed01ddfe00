"""Streams: fixed windows, jobs' last state, and work that was seen already.

Each function takes a DataFrame and works on a batch as on a stream; a stream
gets its watermark first, so state is dropped once it is late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed_windows(df: DataFrame, ts: str, width: str, keys: Sequence[str] = (), late: str = "10 minutes") -> DataFrame:
    """Rows per key and tumbling window: keys, window_start, n."""
    df = df.withWatermark(ts, late) if df.isStreaming else df
    return df.groupBy(*keys, F.window(ts, width).alias("_w")).agg(F.count("*").alias("n")).select(*keys, F.col("_w.start").alias("window_start"), "n")


def over_limit(df: DataFrame, ts: str, width: str, keys: Sequence[str], most: int) -> DataFrame:
    """Windows in which a key came more often than allowed."""
    return fixed_windows(df, ts, width, keys).where(F.col("n") > most)


def unseen(df: DataFrame, key: str, ts: str, within: str = "30 minutes") -> DataFrame:
    """Rows whose content key didn't come before (on a stream: within the watermark)."""
    if df.isStreaming:
        return df.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])
    return df.groupBy(key).agg(F.min_by(F.struct(*df.columns), F.struct(ts)).alias("_r")).select("_r.*")


def job_states(df: DataFrame, job: str, ts: str, state: str) -> DataFrame:
    """The last state of each job; as a stream in update or complete mode."""
    return df.groupBy(job).agg(F.max_by(state, ts).alias(state), F.max(ts).alias("updated_at"))


def expired(states: DataFrame, now, minutes: int = 30) -> DataFrame:
    """Finished jobs older than `minutes`."""
    return states.where(F.col("updated_at") < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {minutes} MINUTES"))
