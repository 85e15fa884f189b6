"""A table with one row for each key that grows by batches, in files by ranges of the key."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.sources.staging import stage

_COMMITS = "_commits"


class KeyedTable:
    """(key, pos, value): for each key the position of its first row and the value of its last one, over all batches merged so far.

    Keys are cut into ranges at bounds taken from the first batch. A merge reads and writes only the ranges that
    the batch has keys in, under new names; a commit file then names the folder of each range. Readers see
    the last commit, so a failed merge changes nothing. First and last position are both kept, so batches may come in
    any order, and one that comes again changes nothing; its id is also remembered, and it is not even read. Positions must be unique.
    Of merges at the same time one wins and the others are errors.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, value: str, pos: str, ranges: int = 64):
        self.spark, self.path, self.names, self.ranges = spark, path.rstrip("/"), (key, value, pos), ranges

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def commits(self) -> list[int]:
        path, fs = self._file(_COMMITS)
        names = [entry.getPath().getName() for entry in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def state(self) -> dict:
        """The last commit: batches, bounds of the ranges, folder of each range, and the schema of the files."""
        numbers = self.commits()
        if not numbers:
            return {"number": 0, "batches": [], "bounds": None, "folders": {}, "schema": None}
        path, _ = self._file(f"{_COMMITS}/{numbers[-1]:010d}.json")
        return json.loads(self.spark.read.option("wholetext", True).text(path.toString()).first()[0])

    def _commit(self, state: dict) -> None:
        target, fs = self._file(f"{_COMMITS}/{state['number']:010d}.json")
        draft, _ = self._file(f"{_COMMITS}/{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"another merge has written commit {state['number']} of {self.path}")

    def _bounds(self, rows: DataFrame) -> list:
        """The largest key of each range but the last; one row a range is collected."""
        if self.ranges == 1:
            return []
        ranged = rows.select("key").filter("key is not null").repartitionByRange(self.ranges, "key")
        largest = ranged.groupBy(F.spark_partition_id()).agg(F.max("key").alias("key")).select("key").collect()
        return sorted(r["key"] for r in largest)[:-1]

    @staticmethod
    def _range(bounds: list) -> Column:
        """The number of bounds below the key; a null key is in the first range."""
        if not bounds:
            return F.lit(0)
        return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("key")))

    def merge(self, batch: DataFrame, batch_id: str) -> list[int]:
        """Merge a batch; return the ranges that were written, none if this batch has been merged before."""
        state = self.state()
        if batch_id in state["batches"]:
            return []
        key, value, pos = (F.col(f"`{name}`") for name in self.names)
        rows = batch.select(key.alias("key"), value.alias("value"), pos.alias("first"), pos.alias("last"))
        rows = stage(self._combined(rows), "batch")
        bounds = self._bounds(rows) if state["bounds"] is None else state["bounds"]
        rows = rows.withColumn("range", self._range(bounds))
        # At most as many values as there are ranges.
        touched = sorted(r["range"] for r in rows.select("range").distinct().collect())
        old = [f"{self.path}/{state['folders'][str(r)]}" for r in touched if str(r) in state["folders"]]
        if old:
            known = self.spark.read.schema(state["schema"]).parquet(*old).withColumn("range", self._range(bounds))
            rows = rows.unionByName(known)
        folder = f"data-{uuid.uuid4().hex}"
        merged = self._combined(rows).withColumn("range", self._range(bounds))
        merged.repartitionByRange("range", "key").write.partitionBy("range").parquet(f"{self.path}/{folder}")
        folders = state["folders"] | {str(r): f"{folder}/range={r}" for r in touched}
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in merged.drop("range").schema)
        self._commit({"number": state["number"] + 1, "batches": [*state["batches"], batch_id], "bounds": bounds, "folders": folders, "schema": schema})
        return touched

    @staticmethod
    def _combined(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.max_by("value", "last").alias("value"), F.min("first").alias("first"), F.max("last").alias("last"))

    def rows(self) -> DataFrame:
        """The table under its own names, as of the last commit."""
        state, (key, value, pos) = self.state(), self.names
        if not state["folders"]:
            raise ValueError(f"{self.path} has no rows yet")
        rows = self.spark.read.schema(state["schema"]).parquet(*[f"{self.path}/{f}" for f in state["folders"].values()])
        return rows.select(F.col("key").alias(key), F.col("first").alias(pos), F.col("value").alias(value))

    def vacuum(self) -> int:
        """Delete folders that the last commit does not name; not while others read or merge. Returns how many."""
        path, fs = self._file("")
        kept = {f"{self.path}/{f}" for f in self.state()["folders"].values()}
        gone = 0
        for entry in fs.listStatus(path):
            if not entry.getPath().getName().startswith("data-"):
                continue
            for part in fs.listStatus(entry.getPath()):
                name = part.getPath().getName()
                if name.startswith("range=") and f"{self.path}/{entry.getPath().getName()}/{name}" not in kept:
                    gone += bool(fs.delete(part.getPath(), True))
        return gone
