"""Streaming popular items (the reference's IntervalPopularItems job).

records stream -> ids mapped (stream-static join on the dictionary) ->
ascending event time (C1) -> sliding counts (D1, Spark state store) ->
per-window top N once the window closes (chained append aggregation, C7
needs no timer) -> (window_end, rank, item_id, cnt) rows.

Windows close when the watermark passes their end, so every emitted window
is final; the rows equal the batch ``top_n_items`` for closed windows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, staged
from .. import constants as K
from ..operators.lookup import map_ids
from ..operators.windows import with_event_time
from .store import KeyedStore


def popular_items_stream(records: DataFrame, item_map: DataFrame | None = None,
                         n: int | None = K.TOP_N, lateness: str = K.POP_LATENESS,
                         window: str = K.POP_WINDOW, slide: str = K.POP_SLIDE,
                         buckets: int = 64) -> DataFrame:
    """Append-mode stream of per-window top-N rows.

    The per-window ranking is an aggregate over the closed window's item
    counts, sorted by (count desc, item asc).  With a limit it is taken in
    two exact levels: the top N per (window, item bucket), then the top N of
    the buckets' winners per window -- an item of the window's top N is in
    its bucket's top N -- so no group holds a whole window's items (the
    largest holds items/``buckets`` or ``buckets`` x N entries).
    ``n=None`` ranks every item (D3) in one level.
    """
    ev = records.select("item_id", "ts")
    if item_map is not None:
        ev = map_ids(ev, "item_id", item_map)
    ev = with_event_time(ev, lateness)
    counts = (ev.groupBy(F.window("ts", window, slide).alias("window"), "item_id")
              .agg(F.count(F.lit(1)).alias("cnt")))
    entry = F.struct((-F.col("cnt")).alias("neg"), "item_id")
    if n is None:
        ranked = counts.groupBy("window").agg(F.sort_array(F.collect_list(entry)).alias("_r"))
    else:
        part = (counts.groupBy("window", F.pmod(F.xxhash64("item_id"), F.lit(buckets)).alias("_b"))
                .agg(F.slice(F.sort_array(F.collect_list(entry)), 1, n).alias("_r")))
        ranked = part.groupBy("window").agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("_r"))), 1, n).alias("_r"))
    return ranked.select(F.unix_millis(F.col("window.end")).alias("window_end"),
                         F.posexplode("_r").alias("_pos", "_e")) \
        .select("window_end", (F.col("_pos") + 1).cast("int").alias("rank"),
                F.col("_e.item_id").alias("item_id"), (-F.col("_e.neg")).alias("cnt"))


def hot_store(path: str) -> KeyedStore:
    """per rank the write with the highest window end."""
    def latest(df: DataFrame) -> DataFrame:
        return df.groupBy("rank").agg(F.max_by("item_id", "window_end").alias("item_id"),
                                      F.max("window_end").alias("window_end"))
    return KeyedStore(path, "rank int, item_id int, window_end long", latest)


def publish_hot_batch(path: str):
    """F6 as a ``foreachBatch`` function: each micro-batch appends its last write
    per rank under its batch id; ``read_hot_store`` gives the current list."""
    def write(batch: DataFrame, batch_id: int) -> None:
        hot_store(path).append(batch.select("rank", "item_id", "window_end"), batch_id)
    return write


def read_hot_store(spark: SparkSession, path: str) -> DataFrame:
    """Current rank store.  A store that is not written yet has no ranks."""
    return hot_store(path).read(spark)


DAY_MS = 86_400_000


@dataclass
class RankLog:
    """D5 on a stream: every ranked row, kept by the day of its window end, and per (day,
    rank) the day's last write.

    A reader at times within some days reads these days' rows and, for what
    happened before, the last writes: its work follows the span of its times.
    """

    path: str

    def _last(self) -> KeyedStore:
        def latest(df: DataFrame) -> DataFrame:
            return df.groupBy("day", "rank").agg(F.max_by("item_id", "window_end").alias("item_id"),
                                                 F.max("window_end").alias("window_end"))
        return KeyedStore(f"{self.path.rstrip('/')}/last", "day long, rank int, item_id int, window_end long", latest)

    def publish(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body of ranked rows (window_end, rank, item_id)."""
        ranked = batch.select("window_end", "rank", "item_id", F.floor(F.col("window_end") / DAY_MS).alias("day"))
        with staged(ranked, "ranked") as rows:
            # a replay writes the same days' folders of its id again
            (rows.withColumn("batch_id", F.lit(batch_id)).repartition("day").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(f"{self.path.rstrip('/')}/rows"))
            self._last().append(rows, batch_id)

    def upto(self, spark: SparkSession, times: DataFrame, t: str = "t") -> DataFrame:
        """(window_end, rank, item_id): the writes that answer any of ``times`` as of them."""
        lo, hi = times.agg(F.min(t), F.max(t)).first()
        schema = "window_end long, rank int, item_id int"
        if lo is None:
            return spark.createDataFrame([], schema)
        first, last = int(lo) // DAY_MS, int(hi) // DAY_MS
        rows = f"{self.path.rstrip('/')}/rows"
        days = [f"{rows}/day={d}" for d in range(first, last + 1)]
        days = [d for d in days if path_exists(spark, d)]
        before = (self._last().read(spark).where(F.col("day") < first).groupBy("rank")
                  .agg(F.max_by("item_id", "window_end").alias("item_id"), F.max("window_end").alias("window_end")))
        before = before.select("window_end", "rank", "item_id")
        if not days:
            return before
        during = spark.read.schema(schema).option("basePath", rows).parquet(*days)
        return before.unionByName(during.select("window_end", "rank", "item_id"))
