"""Parquet tables clustered by their key, of which a change rewrites the touched partitions only.

Rows lie in partitions by a hash of the key. A merge reads the partitions that its
changes fall into, applies a mutation (operators.mutations) to these, writes their new
versions beside the table and then swaps folder by folder. What is to be swapped is
noted before, so a crash leaves either nothing or something that recover() completes.
One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.sources.store import ObjectStore, written

SHARD = "shard"


class ClusteredTable:
    """A table at a path, clustered by a column into a fixed number of partitions."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._store = ObjectStore(spark, self.path)
        self._fs, self._at = self._store._fs, self._store._at
        about = json.loads(self._store.read("_clustered") or b"null")
        if about is None:
            raise FileNotFoundError(f"no clustered table at {path}")
        self.key, self.shards, self.columns = about["key"], about["shards"], about["columns"]
        self.recover()

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: str = "id", shards: int = 256) -> ClusteredTable:
        """A new table of rows; choose shards so that a partition is some hundred MB."""
        _write(rows.withColumn(SHARD, _shard(key, shards)), f"{path}/_stage-new")
        store = ObjectStore(rows.sparkSession, path)
        for k in _shards_in(store, "_stage-new"):
            store._fs.rename(store._at(f"_stage-new/{SHARD}={k}"), store._at(f"{SHARD}={k}"))
        store._fs.delete(store._at("_stage-new"), True)
        store.write("_clustered", json.dumps({"key": key, "shards": shards, "columns": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)}).encode())
        return cls(rows.sparkSession, path)

    def read(self, shards: list[int] | None = None) -> DataFrame:
        """The rows, of some partitions only where they are named: the others' files aren't read."""
        rows = self.spark.read.schema(f"{self.columns}, {SHARD} int").parquet(self.path)
        return (rows if shards is None else rows.where(F.col(SHARD).isin(shards))).drop(SHARD)

    def of_keys(self, keys: list) -> DataFrame:
        """The rows of some keys, from their partitions."""
        one = self.spark.range(1).select(F.explode(F.array(*[F.lit(k).cast(self.read().schema[self.key].dataType) for k in keys])).alias(self.key))
        shards = [r[0] for r in one.select(_shard(self.key, self.shards)).distinct().collect()]
        return self.read(shards).where(F.col(self.key).isin(keys))

    def merge(self, changes: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], key: str | None = None) -> list[int]:
        """Replace the partitions that the changes' keys fall into by how(their rows, changes); returns their numbers.

        how must give rows whose keys are in these partitions, as all mutations by key do.
        """
        changes = written(changes.withColumn(SHARD, _shard(key or self.key, self.shards)))
        touched = sorted(r[0] for r in changes.select(SHARD).distinct().collect())  # shards at most
        if not touched:
            return []
        new = how(self.read(touched), changes.drop(SHARD)).withColumn(SHARD, _shard(self.key, self.shards))
        strange = F.raise_error(F.lit("a row of a partition that the changes don't touch"))
        new = new.withColumn(SHARD, F.when(F.col(SHARD).isin(touched), F.col(SHARD)).otherwise(strange).cast("int"))
        stage = f"_stage-{uuid.uuid4().hex}"
        _write(new, f"{self.path}/{stage}")
        self._store.write(f"{stage}/_swap", json.dumps({"touched": touched, "written": _shards_in(self._store, stage)}).encode())
        self._swap(stage)
        return touched

    def _swap(self, stage: str) -> None:
        """Old partitions out, new ones in; done again after a crash, it goes on where that was."""
        plan = json.loads(self._store.read(f"{stage}/_swap"))
        there = self._fs.exists
        self._fs.mkdirs(self._at(f"{stage}/_old"))
        for k in plan["touched"]:
            name = f"{SHARD}={k}"
            new, now, old = self._at(f"{stage}/{name}"), self._at(name), self._at(f"{stage}/_old/{name}")
            waits = there(new) if k in plan["written"] else not there(old)
            if waits and there(now):
                self._fs.rename(now, old)
            if waits and k in plan["written"]:
                self._fs.rename(new, now)
        self._fs.delete(self._at(stage), True)

    def recover(self) -> None:
        """Complete a swap that a crash has left, and remove what was written but not yet to be swapped."""
        for found in self._fs.globStatus(self._at("_stage-*")) or []:
            stage = found.getPath().getName()
            if self._store.exists(f"{stage}/_swap"):
                self._swap(stage)
            else:
                self._fs.delete(found.getPath(), True)


def _shard(key: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).cast("int").alias(SHARD)


def _write(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", SHARD).write.partitionBy(SHARD).option("compression", "zstd").parquet(path)


def _shards_in(store: ObjectStore, folder: str) -> list[int]:
    found = store._fs.globStatus(store._at(f"{folder}/{SHARD}=*")) or []
    return sorted(int(f.getPath().getName().split("=")[1]) for f in found)
