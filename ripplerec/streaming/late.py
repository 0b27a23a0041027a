"""C6 as rows: which records came later than the watermark.

Spark drops late rows inside its stateful operators and only counts them.  Here a
processor reads the watermark of the micro-batch and marks every record, so the late ones
can be kept in a table of their own and counted.  It holds no state, and records are
dealt by event id: no user's rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import constants as K
from ..operators.windows import with_event_time
from ..session import path_exists

MARKED_OUT = "user_id long, item_id int, ts_us long, event_id long, late boolean"


class LateMarker(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        for pdf in rows:
            yield pdf.assign(late=pdf["ts_us"] < mark)[["user_id", "item_id", "ts_us", "event_id", "late"]]

    def close(self) -> None:
        pass


def marked_stream(records: DataFrame, lateness: str = K.HIST_LATENESS, groups: int = 1024) -> DataFrame:
    """Append stream of (user_id, item_id, ts, event_id, late); late: older than the
    watermark that held when the record's micro-batch began."""
    ev = with_event_time(records.select("user_id", "item_id", "ts", "event_id"), lateness)
    # the time as a number: Spark's own late filter does not see it
    dealt = ev.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("int").alias("item_id"),
                      F.unix_micros("ts").alias("ts_us"), F.col("event_id").cast("long").alias("event_id"),
                      F.pmod(F.xxhash64("event_id"), F.lit(groups)).alias("_group"))
    marked = dealt.groupBy("_group").transformWithStateInPandas(
        statefulProcessor=LateMarker(), outputStructType=MARKED_OUT, outputMode="Append", timeMode="EventTime")
    return marked.select("user_id", "item_id", F.timestamp_micros("ts_us").alias("ts"), "event_id", "late")


def split_late_batch(path: str):
    """``foreachBatch`` body: records in time to ``kept``, late ones to ``late``, under the batch id."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("part", F.when(F.col("late"), "late").otherwise("kept")).drop("late").write.mode(
            "overwrite").partitionBy("part").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return run


def read_split(spark: SparkSession, path: str, part: str) -> DataFrame:
    """The ``kept`` or the ``late`` records (user_id, item_id, ts, event_id)."""
    schema = "user_id long, item_id int, ts timestamp, event_id long"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, batch_id long, part string").parquet(path)
    return rows.where(F.col("part") == part).drop("batch_id", "part")


def late_rows(spark: SparkSession, path: str) -> int:
    """The number of late records so far."""
    return read_split(spark, path, "late").count()
