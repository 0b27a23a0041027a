"""Keyed tables written by micro-batches: a snapshot and a tail.

A batch appends its rows to ``tail/batch_id=<id>`` (overwritten when it is
replayed).  A fold writes ``snapshot/upto=<id>`` -- the combined rows of the snapshot
before it and of the tail up to that batch -- and the folder's ``_SUCCESS`` marker commits it: a
reader takes the newest committed snapshot and only the tail folders after it,
so a read does not grow with the number of batches ever written.

``combine`` reduces rows of equal keys to one (earliest, latest); it must give
the same table however the rows were grouped before.  Batch ``b`` may be replayed until the
next one starts, so running it folds at most up to ``b - 1`` and never
removes the snapshot that a replay of ``b`` reads.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Combine = Callable[[DataFrame], DataFrame]


def _children(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers n of the folders ``<name>=n`` below ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found = (re.fullmatch(f"{name}=(\\d+)", s.getPath().getName()) for s in fs.listStatus(p))
    return sorted(int(m[1]) for m in found if m)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@dataclass
class KeyedStore:
    """A keyed table at ``path``; ``schema`` is that of the appended rows."""

    path: str
    schema: str
    combine: Combine
    #: Tail folders after which ``append`` folds.
    fold_every: int = 16

    def _tail(self, batch_id: int) -> str:
        return f"{self.path.rstrip('/')}/tail/batch_id={batch_id}"

    def _snapshot(self, upto: int) -> str:
        return f"{self.path.rstrip('/')}/snapshot/upto={upto}"

    def snapshots(self, spark: SparkSession) -> list[int]:
        """Batch ids that committed snapshots reach, ascending."""
        return [n for n in _children(spark, f"{self.path.rstrip('/')}/snapshot", "upto")
                if _exists(spark, f"{self._snapshot(n)}/_SUCCESS")]

    def batches(self, spark: SparkSession, after: int = -1) -> list[int]:
        """Batch ids of the tail, ascending."""
        return [n for n in _children(spark, f"{self.path.rstrip('/')}/tail", "batch_id") if n > after]

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The table, of the batches below ``before`` if that is given."""
        base = max((n for n in self.snapshots(spark) if before is None or n < before), default=-1)
        folders = [self._tail(n) for n in self.batches(spark, base) if before is None or n < before]
        if base >= 0:
            folders.insert(0, self._snapshot(base))
        if not folders:
            return spark.createDataFrame([], self.schema)
        return self.combine(spark.read.schema(self.schema).parquet(*folders))

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch's rows under its id, then fold what no replay can change any more."""
        spark = batch.sparkSession
        self.combine(batch).write.mode("overwrite").parquet(self._tail(batch_id))
        done = max(self.snapshots(spark), default=-1)
        if len([n for n in self.batches(spark, done) if n < batch_id]) >= self.fold_every:
            self.fold(spark, batch_id - 1)

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Commit the table of the batches up to ``upto`` as a snapshot, and remove what the
        snapshot before it made superfluous.  Safe to repeat after a crash at any step."""
        known = self.snapshots(spark)
        if upto in known:
            return
        self.read(spark, before=upto + 1).write.mode("overwrite").parquet(self._snapshot(upto))
        # the newest older snapshot stays for readers that have just picked it
        old = max((n for n in known if n < upto), default=-1)
        for n in self.batches(spark):
            if n <= old:
                _delete(spark, self._tail(n))
        for n in known:
            if n < old:
                _delete(spark, self._snapshot(n))
