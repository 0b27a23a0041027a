"""Helpers shared by the training-data operators.

Every operator reads a table of rows with an integer id and a text column,
writes reused intermediates to the shared folder that ``spark.checkpoint.dir``
names, and runs its per-document work in Arrow batches inside Spark tasks.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplerec.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows in one Arrow batch.  Texts may be very long, so batches stay small.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of an Arrow batch of whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage
    ends there and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path  # for drop()
    return out


def drop(df: DataFrame) -> None:
    """Delete a stored table that no later plan reads."""
    path = getattr(df, "_stored_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def parts(total: float, each: float) -> int:
    """Number of shards of at most ``each`` units on average."""
    return max(1, math.ceil(total / each))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that have rows."""
    return (b for b in batches if b.num_rows)


def texts_of(column: pa.Array) -> list[str]:
    """A text column as Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]
