"""Ordered scans per key that split a hot key: ``segmented_lag``, ``positions``.

A key (the shared OOV id, one window end) may hold half of all rows, so an
ordered pass must not run a key in one task.  Rows are range-partitioned by
(keys, order): a hot key spans several chunks of even size.  Every chunk is
scanned once in order; what its first row of a key misses is the value that the
key's last earlier chunk ends with, found on the table of chunk tails, which has one row
per (chunk, key) at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Rows of one chunk; more rows make more chunks.
CHUNK_ROWS = 250_000


def _same_as_before(column: pa.Array) -> pa.Array:
    """Whether each row but the first has the value of the row before (nulls are equal)."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    return pc.if_else(pc.or_(pc.is_null(a), pc.is_null(b)), pc.and_(pc.is_null(a), pc.is_null(b)),
                      pc.fill_null(pc.equal(a, b), False))


def _scan(keys: list[str], value: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, tail = TaskContext.get().partitionId(), None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            # the last row of the batch before, then this one's rows
            rows = b if tail is None else pa.Table.from_batches([tail, b]).combine_chunks().to_batches()[0]
            same = None
            for k in keys:
                eq = _same_as_before(rows[k])
                same = eq if same is None else pc.and_(same, eq)
            if tail is None:
                same = pa.concat_arrays([pa.array([False]), same])
            at = pa.array(range(-1, n - 1) if tail is None else range(n), pa.int64())
            prev = rows[value].take(pc.if_else(same, at, pa.scalar(None, pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, prev, pa.array([chunk] * n, pa.int32()), pc.invert(same)],
                [*b.schema.names, "_prev", "_chunk", "_first"])
            tail = b.slice(n - 1)
    return run


def scan_chunks(df: DataFrame, keys: list[str], order: list[str], value: str, chunks: int | None = None) -> DataFrame:
    """``df`` in even ordered chunks, written once: with ``_chunk``, ``_prev`` (the value of the
    key's row before in the chunk) and ``_first`` (the key's first row of its chunk)."""
    if chunks is None:
        floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunks = max(floor, -(-df.count() // CHUNK_ROWS))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    kind = df.schema[value].dataType.simpleString()
    ordered = df.repartitionByRange(chunks, *keys, *order).sortWithinPartitions(*keys, *order)
    return materialize(ordered.mapInArrow(_scan(keys, value), f"{fields}, _prev {kind}, _chunk int, _first boolean"),
                       "chunks")


def segmented_lag(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "prev",
                  chunks: int | None = None) -> DataFrame:
    """``df`` with ``out``: the ``value`` of the row before, per ``keys`` in ``order``.

    Rows of equal keys and order stay in one chunk, in no defined order; null keys
    are a key of their own.
    """
    rows = scan_chunks(df, keys, order, value, chunks)
    tails = rows.groupBy("_chunk", *keys).agg(F.max_by(F.struct(value), F.struct(*order)).alias("_tail"))
    carry = tails.select("_chunk", *keys, F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_tail"))
    # only a key's first row of a chunk needs the carry
    heads = rows.where("_first").alias("r").join(
        carry.alias("c"), (F.col("r._chunk") == F.col("c._chunk"))
        & F.expr(" AND ".join(f"r.`{k}` <=> c.`{k}`" for k in keys)), "left")
    heads = heads.select(*[F.col(f"r.{c}") for c in df.columns], F.col(f"c._tail.{value}").alias(out))
    rest = rows.where(~F.col("_first")).select(*df.columns, F.col("_prev").alias(out))
    return rest.unionByName(heads)


def positions(df: DataFrame, keys: list[str], order: list[str], out: str = "pos", chunks: int | None = None) -> DataFrame:
    """``df`` with ``out``: a row's place (from 0) in its key's ``order``, by the place in its chunk
    and the key's rows in the chunks before; null keys are a key of their own."""
    if chunks is None:
        floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunks = max(floor, -(-df.count() // CHUNK_ROWS))
    rows = (df.repartitionByRange(chunks, *keys, *order).sortWithinPartitions(*keys, *order)
            .withColumn("_at", F.monotonically_increasing_id()))
    rows = materialize(rows.withColumn("_chunk", F.shiftright("_at", 33)), "positions")
    runs = rows.groupBy("_chunk", *keys).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_c"), "_from",
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    on = F.expr("_chunk = _c AND " + " AND ".join(f"`{k}` <=> _k{i}" for i, k in enumerate(keys)))
    return rows.join(runs, on).select(*df.columns, (F.col("_at") - F.col("_from") + F.col("_before")).alias(out))
