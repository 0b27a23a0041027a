"""The reference's job entry points as Structured Streaming queries.

* ``start_popular_job``   (IntervalPopularItems): wire lines -> decoded
  records -> per-window top N -> rank store (F6, foreachBatch) and,
  optionally, the ranked rows as files.
* ``start_history_job``   (SeqRecommend, first half): records -> closed windows ->
  foreachBatch history (lists carried in a versioned table), scoring + hot fill ->
  recommendation folder (F7), one sub-folder per micro-batch.
* ``start_reward_job``    (SeqRecommend, second half): recommendation folder
  as a file stream -> last reward (carried in a versioned table) -> result table.
* ``start_persist_job``   (RecordToMongoDB / RecordToMysql): records ->
  record log (F1), keyed records (F4), consumed pairs (F2).
* ``start_publish_job``   (FileToKafka): behaviour file stream -> wire
  messages (F5) to a topic or folder.

Every query takes its checkpoint folder from the caller (a shared folder on
a cluster), so a restarted job resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..operators.sinks import wire_messages
from ..streaming.history import history_batch, recommend_batch, reward_batch, window_events_stream
from ..streaming.persist import consumed_pairs_batch, record_log_stream, unique_records_batch
from ..streaming.popular import RankLog, popular_items_stream, publish_hot_batch
from ..streaming.panes import pane_counts_stream, ranked_batch


def _start(df: DataFrame, ckpt: str, path: str | None = None, fmt: str = "parquet",
           trigger: dict | None = None, foreach=None, mode: str = "append"):
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
    if trigger:
        w = w.trigger(**trigger)
    if foreach is not None:
        return w.foreachBatch(foreach).start()
    return w.format(fmt).option("path", path).start()


def start_popular_job(records: DataFrame, item_map: DataFrame | None, hot_store: str | RankLog, ckpt: str,
                      n: int | None = K.TOP_N, trigger: dict | None = None, panes: bool = True):
    """``hot_store``: the path of the current list's store, or a ``RankLog`` for readers as of a time.
    ``panes``: counts from a ring of panes an item; else from Spark's sliding window."""
    publish = hot_store.publish if isinstance(hot_store, RankLog) else publish_hot_batch(hot_store)
    if panes:
        return _start(pane_counts_stream(records, item_map), ckpt, foreach=ranked_batch(publish, n), trigger=trigger)
    return _start(popular_items_stream(records, item_map, n), ckpt, foreach=publish, trigger=trigger)


def start_history_job(records: DataFrame, user_map: DataFrame, user_vecs: DataFrame, model,
                      catalog, hot_store: str | RankLog | None, recs_out: str, ckpt: str,
                      trigger: dict | None = None):
    """Histories carried from batch to batch are kept beside the checkpoint."""
    publish = recommend_batch(recs_out, user_map, user_vecs, model, catalog, hot_store)
    return _start(window_events_stream(records), ckpt, foreach=history_batch(f"{ckpt.rstrip('/')}-carry", publish),
                  trigger=trigger)


def start_reward_job(spark: SparkSession, recs_in: str, out: str, ckpt: str,
                     trigger: dict | None = None, files_per_batch: int | None = None):
    """Rewards of the recommendation folder, one sub-folder per micro-batch; the
    carried recommendations are kept beside the checkpoint."""
    schema = "user_id int, raw_user long, window_end long, items array<int>, item_rec array<int>"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _start(reader.parquet(recs_in), ckpt, foreach=reward_batch(out, f"{ckpt.rstrip('/')}-carry"), trigger=trigger)


def start_persist_job(records: DataFrame, out: str, ckpt: str, trigger: dict | None = None):
    """Three queries sharing one source definition: F1, F4, F2."""
    return [
        _start(record_log_stream(records), f"{ckpt}/record_log", f"{out}/record_log", trigger=trigger),
        _start(records, f"{ckpt}/records", foreach=unique_records_batch(f"{out}/records"), trigger=trigger),
        _start(records, f"{ckpt}/consumed", foreach=consumed_pairs_batch(f"{out}/consumed_pairs"),
               trigger=trigger),
    ]


def start_publish_job(records: DataFrame, ckpt: str, fmt: str = "kafka", options: dict | None = None,
                      path: str | None = None, key: str | None = "user_id", trigger: dict | None = None):
    msgs = wire_messages(records, key)
    w = msgs.writeStream.option("checkpointLocation", ckpt).format(fmt).options(**(options or {}))
    if trigger:
        w = w.trigger(**trigger)
    if fmt == "kafka":
        if "topic" not in (options or {}):
            raise ValueError("a topic is needed: options={'topic': ...}")
        return w.start()
    return w.option("path", path).start()
