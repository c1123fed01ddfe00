"""Jobs' states that end by themselves: keyed state with timers.

A job's changes arrive in any order. The last one by its time counts; a
finished job is evicted a fixed time after it finished unless a later change
takes it up again. As a stream the state is in the state store and survives a
restart from the checkpoint; `live_jobs` says the same of a finished log.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import Row

#: States of a job that has finished, and minutes until it goes.
FINISHED = ("done", "error")
TTL_MINUTES = 30
CHANGES = "job_id string, status string, changed_at timestamp, evicted boolean"
#: What transformWithState needs of the session.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class JobStates(StatefulProcessor):
    """One value a job: its last status and when that changed. A timer stands at the end of a finished job's time."""

    def __init__(self, minutes: int = TTL_MINUTES, finished: Sequence[str] = FINISHED):
        self.minutes, self.finished = minutes, tuple(finished)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("job", "status string, changed_ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.state.get() if self.state.exists() else None
        best = (last[1], last[0]) if last else None
        for row in rows:
            told = (row.changed_ms, row.status)
            if best is None or told > best:
                best = told
        if last is not None and best == (last[1], last[0]):
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        ends = best[0] + self.minutes * 60_000
        if best[1] in self.finished and ends <= timerValues.getCurrentWatermarkInMs():  # came when its time was over
            self.state.clear()
            if last is not None:
                yield self.row(key, best, True)
            return
        self.state.update((best[1], best[0]))
        if best[1] in self.finished:
            self.handle.registerTimer(ends)
        yield self.row(key, best, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        status, changed = self.state.get()
        self.state.clear()
        yield self.row(key, (changed, status), True)

    def row(self, key, told, evicted: bool) -> Row:
        return Row(job_id=key[0], status=told[1], changed_ms=told[0], evicted=evicted)

    def close(self) -> None:
        pass


def job_changes(jobs: DataFrame, late: str = "10 minutes", minutes: int = TTL_MINUTES, finished: Sequence[str] = FINISHED) -> DataFrame:
    """A stream of jobs (job_id, status, changed_at) to one of changes of their states: a new last status, or evicted, when the watermark passes the end of a finished job's time. Changes that are later than `late` are dropped."""
    timed = jobs.select("job_id", "status", "changed_at", F.unix_millis("changed_at").alias("changed_ms")).withWatermark("changed_at", late)
    out = timed.groupBy("job_id").transformWithState(statefulProcessor=JobStates(minutes, finished), outputStructType="job_id string, status string, changed_ms long, evicted boolean", outputMode="Update", timeMode="EventTime")
    return out.select("job_id", "status", F.timestamp_millis("changed_ms").alias("changed_at"), "evicted")


def live_jobs(jobs: DataFrame, now: Column, minutes: int = TTL_MINUTES, finished: Sequence[str] = FINISHED, job: str = "job_id", status: str = "status", at: str = "changed_at", tie: Sequence[str] = ()) -> DataFrame:
    """The jobs that are left at `now`, with their last status: finished ones go once their time is over."""
    w = Window.partitionBy(job).orderBy(F.desc(at), *[F.desc(c) for c in (*tie, status)])
    last = jobs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    over = F.col(status).isin(*finished) & (F.col(at) <= now - F.expr(f"INTERVAL {minutes} MINUTES"))
    return last.where(~over)
