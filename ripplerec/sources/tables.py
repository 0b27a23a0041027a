"""Reading the driver's Parquet tables and deriving the reference's event shape.

The driver tables stand in for the reference's behaviour log (FIXTURES.md):
``events`` gives user, time and a tie-break id, and the item is the ``k``
field of its ``props`` JSON text.  Nothing here filters or samples rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def records_from_events(events: DataFrame) -> DataFrame:
    """events -> (user_id BIGINT, item_id INT, ts TIMESTAMP, event_id BIGINT).

    ``ts`` is cast from TIMESTAMP_NTZ to TIMESTAMP (UTC session zone) because
    watermarks reject NTZ columns; batch and stream then share one plan.
    Only four columns reach the Parquet scan.
    """
    return events.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").cast("bigint").alias("event_id"),
    )


def read_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from_events(read_table(spark, sf_dir, "events"))
