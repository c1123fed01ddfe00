"""A keyed table in plain Parquet files: changes are appended, the last one of a key counts.

Below the table's folder, log/<batch> holds one folder for each written batch, base/<id>
what a compaction made of several, and manifest/<n> names the base that counts and
the batches in it. A batch written again replaces itself. Batches may
come in any order, before or after a compaction: a key's row is the one with the
largest version, and deletions are rows with a version of their own. A
manifest is made by renaming a finished file to a number that doesn't exist yet,
so readers see either the table before or after, and of two compactions one
wins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class KeyedTable:
    """schema: all columns but `deleted`. key: its key columns. version: the columns that order a key's changes; they have to differ between changes of a key that differ."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], version: Sequence[str]):
        self.spark, self.path, self.key, self.version = spark, path.rstrip("/"), list(key), list(version)
        self.schema = StructType(list(schema.fields)).add("deleted", "boolean")

    def write(self, changes: DataFrame, batch: str) -> None:
        """Appends a batch; `deleted` is false where changes doesn't have it. The same name again replaces the batch (of a stream that is run again after a failure)."""
        rows = changes if "deleted" in changes.columns else changes.withColumn("deleted", F.lit(False))
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.mode("overwrite").parquet(f"{self.path}/log/{batch}")

    def sink(self, name: str):
        """For foreachBatch: every micro-batch is a batch of its own."""
        return lambda df, epoch: self.write(df, f"{name}-{epoch}")

    def read(self, deleted: bool = False) -> DataFrame:
        """One row a key, its last; without the keys whose last change deletes them, unless `deleted`."""
        return self._state(deleted)[0]

    def compact(self) -> bool:
        """Writes what counts as a new base. False if another compaction was faster; its result stands."""
        rows, number, batches = self._state(True)
        base = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/base/{base}")
        return self._publish(number + 1, {"base": base, "batches": batches})

    def vacuum(self) -> None:
        """Deletes the batches and bases that the last manifest has taken in. Not while another compaction or read of an earlier state runs."""
        manifest, _ = self._manifest()
        if manifest is None:
            return
        for batch in set(manifest["batches"]) & set(self._list("log")):
            self._fs().delete(self._file(f"log/{batch}"), True)
        for base in set(self._list("base")) - {manifest["base"]}:
            self._fs().delete(self._file(f"base/{base}"), True)

    def _state(self, deleted: bool) -> tuple[DataFrame, int, list[str]]:
        manifest, number = self._manifest()
        covered = set(manifest["batches"]) if manifest else set()
        logs = self._list("log")
        paths = [f"{self.path}/log/{b}" for b in logs if b not in covered] + ([f"{self.path}/base/{manifest['base']}"] if manifest else [])
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        rest = [f.name for f in self.schema if f.name not in self.key]
        last = rows.groupBy(*self.key).agg(F.max_by(F.struct(*rest), F.struct(*self.version, "deleted")).alias("_r")).select(*self.key, "_r.*").select(*self.schema.names)
        return (last if deleted else last.where(~F.col("deleted")).drop("deleted")), number, sorted(covered | set(logs))

    # Files of the table, by Hadoop's file systems: the folder may be on any of them.

    def _file(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._file("log").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, name: str) -> list[str]:
        folder = self._file(name)
        return sorted(s.getPath().getName() for s in self._fs().listStatus(folder)) if self._fs().exists(folder) else []

    def _manifest(self) -> tuple[dict | None, int]:
        numbers = [int(n) for n in self._list("manifest") if n.isdigit()]
        if not numbers:
            return None, 0
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/manifest/{max(numbers)}").first()[0]
        return json.loads(text), max(numbers)

    def _publish(self, number: int, manifest: dict) -> bool:
        fs, draft, name = self._fs(), self._file(f"manifest/.{uuid.uuid4().hex}"), self._file(f"manifest/{number}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        done = not fs.exists(name) and fs.rename(draft, name)
        if not done:
            fs.delete(draft, False)
        return done
