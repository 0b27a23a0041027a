"""Streaming record persistence (the reference's RecordToMongoDB /
RecordToMysql jobs): wire lines -> decoded records -> result tables.

* F1 ``record_log_stream``: stateless append.
* F4 ``unique_records_batch`` + ``read_unique_records``: keyed insert; each
  micro-batch appends its earliest row per (user, item) under its batch id
  (idempotent on replay) to a ``KeyedStore``, whose snapshot and tail keep the earliest of all.  There is no
  watermark: a late event is inserted like any other.
* F2 ``consumed_pairs_batch`` + ``read_user_consumed``: each micro-batch
  appends its distinct (user, kind, value, first-seen) pairs under its batch
  id (idempotent on replay); the per-user ordered sets are built on read.
  No shared document is rewritten per event or per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import format_time
from ..operators.sinks import CONSUMED_CHUNK, chunked, consumed_pairs, record_log
from .store import KeyedStore


def record_log_stream(records: DataFrame) -> DataFrame:
    return record_log(records)


def unique_store(path: str) -> KeyedStore:
    """Per (user, item) the earliest event."""
    def earliest(df: DataFrame) -> DataFrame:
        return df.groupBy("user", "item").agg(F.min("first").alias("first"))
    return KeyedStore(path, "user long, item int, first struct<ts:timestamp,event_id:bigint>", earliest)


def unique_records_batch(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        unique_store(path).append(batch.select(
            F.col("user_id").cast("long").alias("user"), F.col("item_id").alias("item"),
            F.struct("ts", "event_id").alias("first")), batch_id)
    return write


def read_unique_records(spark: SparkSession, path: str) -> DataFrame:
    first = unique_store(path).read(spark)
    return first.select("user", "item", format_time(F.unix_millis("first.ts")).alias("time"))


def consumed_store(path: str) -> KeyedStore:
    """Per (user, kind, value) the earliest event."""
    def earliest(df: DataFrame) -> DataFrame:
        return df.groupBy("user_id", "kind", "value").agg(F.min("first").alias("first"))
    return KeyedStore(path, "user_id long, kind string, value string, first struct<ts:timestamp,event_id:bigint>", earliest)


def consumed_pairs_batch(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        pairs = consumed_pairs(batch.withColumn("user_id", F.col("user_id").cast("long")))
        consumed_store(path).append(pairs.select("user_id", "kind", "value", "first"), batch_id)
    return write


def read_consumed_chunks(spark: SparkSession, path: str, size: int = CONSUMED_CHUNK) -> DataFrame:
    """F2 from the stream's store, in rows of at most ``size`` values."""
    return chunked(consumed_store(path).read(spark), size)


def read_user_consumed(spark: SparkSession, path: str) -> DataFrame:
    pairs = consumed_store(path).read(spark)
    sets = pairs.groupBy("user_id", "kind").agg(
        F.array_sort(F.collect_list(F.struct("first", "value"))).alias("_s"))
    sets = sets.select("user_id", "kind", F.transform("_s", lambda x: x["value"]).alias("vals"))
    items = sets.where(F.col("kind") == "item").select(
        F.col("user_id").alias("user"), F.col("vals").cast("array<int>").alias("consumed"))
    times = sets.where(F.col("kind") == "time").select(F.col("user_id").alias("user"),
                                                       F.col("vals").alias("time"))
    return items.join(times, "user", "full")
