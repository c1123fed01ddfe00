"""Job states as a stream that is stopped and started again, and the keyed table."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from pagestrata.sources import elements as E
from pagestrata.sources.keyed import KeyedTable
from pagestrata.streaming import job_store

START = dt.datetime(2024, 5, 1, 12, 0)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def test_jobs_are_evicted_across_a_restart(spark, tmp_path):
    for k, v in job_store.STATE_STORE.items():
        spark.conf.set(k, v)
    schema = "job_id string, status string, changed_at timestamp"
    batches = [
        [("a", "processing", at(0)), ("b", "processing", at(1)), ("c", "processing", at(2))],
        [("a", "done", at(5)), ("b", "error", at(6)), ("a", "processing", at(3))],  # the last one is late, but not too late
        [("b", "processing", at(20)), ("c", "processing", at(30))],  # b is taken up again
        [("d", "done", at(34)), ("c", "done", at(44))],
        [("e", "processing", at(60))],  # a's time is over once the watermark is past 35 minutes
        [("f", "processing", at(100))],
    ]
    log = []

    def collect(df, epoch):
        log.extend((r.job_id, r.status, int((r.changed_at - START).total_seconds() // 60), r.evicted) for r in df.collect())

    def turn(rows):
        """Every batch is a query of its own, started from the checkpoint."""
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        query = job_store.job_changes(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(collect).trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None

    try:
        for rows in batches:
            turn(rows)
    finally:
        for k in job_store.STATE_STORE:
            spark.conf.unset(k)
    evicted = {(j, s, m) for j, s, m, e in log if e}
    assert evicted == {("a", "done", 5), ("d", "done", 34), ("c", "done", 44)}
    state = {}
    for j, s, m, e in log:
        state.pop(j, None)
        if not e:
            state[j] = (s, m)
    rows = spark.createDataFrame([r for b in batches for r in b], schema)
    live = job_store.live_jobs(rows, F.lit(at(90))).collect()  # the last watermark
    assert state == {r.job_id: (r.status, int((r.changed_at - START).total_seconds() // 60)) for r in live} == {"b": ("processing", 20), "e": ("processing", 60), "f": ("processing", 100)}


COLUMNS = "k string, seq long, writer string, value string"
BATCHES = {
    "w1-1": [("a", 1, "w1", "a1", False), ("b", 2, "w1", "b2", False)],
    "w2-1": [("a", 3, "w2", "a3", False), ("c", 1, "w2", "c1", False)],
    "w1-2": [("b", 4, "w1", None, True), ("c", 1, "w1", "other", False)],
    "w2-2": [("b", 3, "w2", "b3", False), ("d", 9, "w2", "d9", False)],
}
WANT = {("a", 3, "a3"), ("c", 1, "c1"), ("d", 9, "d9")}


def keyed(spark, path):
    return KeyedTable(spark, str(path), spark.createDataFrame([], COLUMNS).schema, ["k"], ["seq", "writer"])


def rows(table):
    return {(r.k, r.seq, r.value) for r in table.read().collect()}


@pytest.mark.parametrize("order", list(itertools.permutations(BATCHES))[::5])
def test_batches_in_any_order_give_one_table(spark, tmp_path, order):
    table = keyed(spark, tmp_path / "t")
    assert rows(table) == set()
    for k, name in enumerate(order):
        table.write(spark.createDataFrame(BATCHES[name], COLUMNS + ", deleted boolean"), name)
        if k == 1:
            assert table.compact()
    assert rows(table) == WANT
    table.write(spark.createDataFrame(BATCHES[order[0]], COLUMNS + ", deleted boolean"), order[0])  # run again
    assert table.compact() and rows(table) == WANT
    table.vacuum()
    assert rows(table) == WANT and rows(keyed(spark, tmp_path / "t")) == WANT
    table.write(spark.createDataFrame([("b", 3, "w9", "too late"), ("d", 10, "w1", "d10")], COLUMNS), "w9-1")  # the deletion of b is remembered
    assert rows(table) == {*(WANT - {("d", 9, "d9")}), ("d", 10, "d10")}


def test_of_two_compactions_one_wins(spark, tmp_path):
    one, two = keyed(spark, tmp_path / "t"), keyed(spark, tmp_path / "t")
    one.write(spark.createDataFrame(BATCHES["w1-1"], COLUMNS + ", deleted boolean"), "w1-1")
    state = one._state(True)
    two._state = lambda deleted: state  # has read before the other one published
    assert one.compact() and not two.compact()
    assert rows(one) == {("a", 1, "a1"), ("b", 2, "b2")}


def test_streams_write_it_and_parsers_read_it(spark, tmp_path):
    """The cache of parser results as a keyed table: only files of which it holds nothing are parsed."""
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "content_key string, n_elements long, at long").schema, ["content_key"], ["at"])
    files = spark.createDataFrame([(f"f{k}", bytearray(c.encode())) for k, c in enumerate(["one", "two", "one", "three", "four"])], "path string, content binary")
    parsed = files.where("path in ('f0', 'f1', 'f4')").select(E.content_key(F.col("content"), "v1").alias("content_key"), F.when(F.col("path") == "f4", 0).otherwise(7).cast("long").alias("n_elements"), F.lit(1).cast("long").alias("at"))
    parsed.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(parsed.schema).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(table.sink("parser")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert {r.path for r in E.to_parse(files, table.read(), "v1").collect()} == {"f3", "f4"}  # an empty result is no result
    assert E.to_parse(files, table.read(), "v2").count() == 5
