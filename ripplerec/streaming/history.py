"""Streaming per-user state (the reference's SeqRecommend job).

* ``user_history_stream`` (E1/E2): 60 s / 20 s windows per user close on a
  10 s out-of-order watermark (C2); a ``transformWithStateInPandas``
  processor keyed by user keeps the last N items in a value state (RocksDB,
  checkpointed: the history survives restarts, like the reference's list
  store variant) and emits (user, window_end, items) per closed window.
* ``window_events_stream``, ``history_batch`` (E1): the same histories with no Python: the events of
  the closed windows come in some rows a window, a ``foreachBatch`` body cuts each user's windows from
  them and carries the users' lists to the next batch in a versioned table.
* ``reward_batch`` (E4): a ``foreachBatch`` body; a micro-batch's rewards come from the
  ordered scan that splits hot keys (``operators.segments``), and each key's last
  recommendation is carried to the next batch in a versioned table.
* ``last_reward_stream`` (E4): the same with a value state per mapped user, for
  keys of bounded rate: all rows of a key are one state's work.
* ``recommend_batch`` : a ``foreachBatch`` body that scores a micro-batch of
  histories, fills from the rank store and appends it under its batch id.

Within a micro-batch a key's rows are handled in window-end order; windows
close in end order across batches, so the state sees the same sequence as
the batch operators.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import constants as K
from ..functions.scalar import format_time
from ..operators.history import _last_n, _rewarded
from ..operators.segments import segmented_lag
from ..operators.windows import with_event_time
from ..session import staged
from .popular import RankLog
from .store import KeyedStore

HISTORY_OUT = "user_id long, window_end long, items array<int>"
REWARD_OUT = ("user_id int, raw_user long, window_end long, items array<int>, "
              "item_rec array<int>, last_reward int")


class HistoryProcessor(StatefulProcessor):
    """Append each closed window's items to the user's list, keep the last N."""

    def __init__(self, hist: int = K.HIST_LEN):
        self.hist = hist

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("items", "items array<int>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("window_end")
        cur = list(self.state.get()[0]) if self.state.exists() else []
        ends, lists = [], []
        for end, items in zip(pdf["window_end"], pdf["items"]):
            cur = (cur + [int(x) for x in items])[-self.hist:]
            ends.append(int(end))
            lists.append(list(cur))
        self.state.update((cur,))
        yield pd.DataFrame({"user_id": [key[0]] * len(ends), "window_end": ends, "items": lists})

    def close(self) -> None:
        pass


class HistoryListProcessor(StatefulProcessor):
    """The user's list as a ``ListState`` that other jobs read from the checkpoint
    (``read_history_store``) and that may start from a batch history."""

    def __init__(self, hist: int = K.HIST_LEN):
        self.hist = hist

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("items", "item int")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for items in initialState["items"]:
            self.state.put([(int(x),) for x in items][-self.hist:])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("window_end")
        cur = [x[0] for x in self.state.get()] if self.state.exists() else []
        ends, lists = [], []
        for end, items in zip(pdf["window_end"], pdf["items"], strict=True):
            cur = (cur + [int(x) for x in items])[-self.hist:]
            ends.append(int(end))
            lists.append(list(cur))
        self.state.put([(x,) for x in cur])
        yield pd.DataFrame({"user_id": [key[0]] * len(ends), "window_end": ends, "items": lists})

    def close(self) -> None:
        pass


class RewardProcessor(StatefulProcessor):
    """Reward = (previous rec, clicked) equal pairs; -1 without a previous rec."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last_rec", "rec array<int>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["window_end", "raw_user"])
        prev = list(self.state.get()[0]) if self.state.exists() else None
        rewards = []
        for items, rec in zip(pdf["items"], pdf["item_rec"]):
            if prev is None:
                rewards.append(-1)
            else:
                clicks = [int(c) for c in items]
                rewards.append(sum(clicks.count(int(r)) for r in prev))
            prev = [int(x) for x in rec]
        self.state.update((prev,))
        pdf["last_reward"] = rewards
        yield pdf[["user_id", "raw_user", "window_end", "items", "item_rec", "last_reward"]]

    def close(self) -> None:
        pass


def window_items_stream(records: DataFrame, key: str = "user_id", keep: int = K.HIST_LEN,
                        lateness: str = K.HIST_LATENESS, window: str = K.HIST_WINDOW,
                        slide: str = K.HIST_SLIDE, salt: int = 64) -> DataFrame:
    """C4 on a stream: per closed (user, window) the window's last ``keep``
    items in event order -> (key, window_end, items).

    Two exact levels, so a hot key (a heavy user, the shared OOV id) is not
    held in one state row: the last ``keep`` events per (user, window,
    event-id hash of ``salt`` buckets), then the last ``keep`` of those
    buckets' tails per (user, window) -- the window's last ``keep`` events
    are each among their own bucket's last ``keep``.
    """
    ev = with_event_time(records.select(key, "item_id", "ts", "event_id"), lateness)
    entry = F.struct("ts", "event_id", "item_id")
    part = (ev.groupBy(key, F.window("ts", window, slide).alias("w"),
                       F.pmod(F.xxhash64("event_id"), F.lit(salt)).alias("_s"))
            .agg(_last_n(F.sort_array(F.collect_list(entry)), keep).alias("_ev")))
    agg = (part.groupBy(key, "w")
           .agg(_last_n(F.sort_array(F.flatten(F.collect_list("_ev"))), keep).alias("_ev")))
    return agg.select(key, F.unix_millis(F.col("w.end")).alias("window_end"),
                      F.transform("_ev", lambda e: e["item_id"]).alias("items"))


def user_history_stream(records: DataFrame, key: str = "user_id", hist: int = K.HIST_LEN,
                        lateness: str = K.HIST_LATENESS) -> DataFrame:
    """E1 on a stream (append): (user_id, window_end, items)."""
    win = window_items_stream(records, key, hist, lateness).withColumnRenamed(key, "user_id")
    return win.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=HistoryProcessor(hist), outputStructType=HISTORY_OUT,
        outputMode="Append", timeMode="None")


def window_events_stream(records: DataFrame, key: str = "user_id", lateness: str = K.HIST_LATENESS,
                         window: str = K.HIST_WINDOW, slide: str = K.HIST_SLIDE, buckets: int = 32) -> DataFrame:
    """The events of the windows that close (append): (window_end, events).

    A window's events come in at most ``buckets`` rows, dealt by their event id, whatever users
    they have: the state has a row per window and bucket, not one per user and window, and a
    heavy user's events are spread like all others.
    """
    ev = with_event_time(records.select(key, "item_id", "ts", "event_id"), lateness)
    entry = F.struct(F.col(key).cast("long").alias("user_id"), "ts", "event_id", F.col("item_id").cast("int").alias("item_id"))
    agg = (ev.groupBy(F.window("ts", window, slide).alias("w"), F.pmod(F.xxhash64("event_id", "ts"), F.lit(buckets)).alias("_b"))
           .agg(F.collect_list(entry).alias("events")))
    return agg.select(F.unix_millis(F.col("w.end")).alias("window_end"), "events")


HISTORY_CARRY = "user_id long, batch long, window_end long, items array<int>"


def history_carry(path: str) -> KeyedStore:
    """Each user's last items: of the newest batch, of its last window."""
    def latest(df: DataFrame) -> DataFrame:
        row = F.struct("user_id", "batch", "window_end", "items")
        return df.groupBy("user_id").agg(F.max_by(row, F.struct("batch", "window_end")).alias("r")).select("r.*")
    return KeyedStore(path, HISTORY_CARRY, latest)


def history_batch(carry_path: str, then: Callable[[DataFrame, int], None], hist: int = K.HIST_LEN):
    """``foreachBatch`` body over ``window_events_stream``: hands the micro-batch's (user_id,
    window_end, items) -- the rows of ``user_history_stream`` -- to ``then``.

    The carried list of a user goes first in the user's order.  A list holds the last ``hist`` items, a
    window at least one: the rows of ``hist`` windows make it.  The micro-batch is read once; a
    replayed one reads the carry of the batches before it.
    """
    store = history_carry(carry_path)

    def run(batch: DataFrame, batch_id: int) -> None:
        events = batch.select("window_end", F.inline("events")).repartition("user_id", "window_end")
        last = Window.partitionBy("user_id", "window_end").orderBy(
            *[F.col(c).desc() for c in ("ts", "event_id", "item_id")])
        tails = (events.withColumn("_rn", F.row_number().over(last)).where(F.col("_rn") <= hist)
                 .groupBy("user_id", "window_end")
                 .agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", "item_id"))).alias("_ev"))
                 .select("user_id", F.lit(1).alias("_seq"), "window_end",
                         F.transform("_ev", lambda e: e["item_id"]).alias("items")))
        known = store.read(batch.sparkSession, before=batch_id).select(
            "user_id", F.lit(0).alias("_seq"), "window_end", "items")
        upto = Window.partitionBy("user_id").orderBy("_seq", "window_end").rowsBetween(-(hist - 1), 0)
        lists = _last_n(F.flatten(F.collect_list("items").over(upto)), hist)
        rows = known.unionByName(tails).select("user_id", "_seq", "window_end", lists.alias("items"))
        with staged(rows.where("_seq = 1").drop("_seq"), "histories") as found:
            then(found, batch_id)
            store.append(found.withColumn("batch", F.lit(batch_id).cast("long")).select(
                "user_id", "batch", "window_end", "items"), batch_id)
    return run


def history_store_stream(records: DataFrame, initial: DataFrame | None = None, since: int | None = None,
                         key: str = "user_id", hist: int = K.HIST_LEN, lateness: str = K.HIST_LATENESS) -> DataFrame:
    """E2 on a stream: ``user_history_stream`` whose lists stay readable in the checkpoint.

    ``initial`` (user_id, items) are the lists that a batch job made of the windows up to the end
    ``since``; the stream goes on with the windows after it.
    """
    win = window_items_stream(records, key, hist, lateness).withColumnRenamed(key, "user_id")
    if since is not None:
        win = win.where(F.col("window_end") > since)
    first = None if initial is None else initial.select(F.col("user_id").cast("long").alias("user_id"), "items")
    return win.select(F.col("user_id").cast("long").alias("user_id"), "window_end", "items").groupBy("user_id") \
        .transformWithStateInPandas(
            statefulProcessor=HistoryListProcessor(hist), outputStructType=HISTORY_OUT, outputMode="Append",
            timeMode="None", initialState=None if first is None else first.groupBy("user_id"))


def read_history_store(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(user_id, items): every user's last items as the stream's newest checkpoint has them."""
    found = (spark.read.format("state-metadata").load(checkpoint)
             .where(F.lower("operatorName").startswith("transformwithstate")).select("operatorId").distinct().collect())
    rows = (spark.read.format("statestore").option("operatorId", found[0]["operatorId"]).option("stateVarName", "items")
            .option("flattenCollectionTypes", "false").load(checkpoint))
    return rows.select(F.col("key.user_id").alias("user_id"), F.transform("list_value", lambda x: x["item"]).alias("items"))


def last_reward_stream(recs: DataFrame) -> DataFrame:
    """E4 on a stream of (user_id, raw_user, window_end, items, item_rec)."""
    return recs.select("user_id", "raw_user", "window_end", "items", "item_rec") \
        .groupBy("user_id").transformWithStateInPandas(
            statefulProcessor=RewardProcessor(), outputStructType=REWARD_OUT,
            outputMode="Append", timeMode="None")


CARRY = "user_id int, batch long, window_end long, raw_user long, item_rec array<int>"


def reward_carry(path: str) -> KeyedStore:
    """Each key's last recommendation: of the newest batch, in (window end, raw user) order."""
    def latest(df: DataFrame) -> DataFrame:
        row = F.struct("user_id", "batch", "window_end", "raw_user", "item_rec")
        return df.groupBy("user_id").agg(F.max_by(row, F.struct("batch", "window_end", "raw_user")).alias("r")).select("r.*")
    return KeyedStore(path, CARRY, latest)


def reward_batch(out_path: str, carry_path: str):
    """``foreachBatch`` body: rewards of a micro-batch of (user_id, raw_user,
    window_end, items, item_rec), written under its batch id (E4, F7).

    The carried recommendation of every key in the batch goes first in the key's
    order; a replayed batch reads the carry of the batches before it.
    """
    store = reward_carry(carry_path)
    cols = ["user_id", "raw_user", "window_end", "items", "item_rec"]

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*cols)
        known = store.read(batch.sparkSession, before=batch_id).join(rows.select("user_id").distinct(), "user_id", "left_semi")
        known = known.select("user_id", "raw_user", "window_end", F.lit(None).cast("array<int>").alias("items"),
                             "item_rec", F.lit(0).alias("_seq"))
        lagged = segmented_lag(known.unionByName(rows.withColumn("_seq", F.lit(1))), ["user_id"],
                               ["_seq", "window_end", "raw_user"], "item_rec", "_prev")
        out = _rewarded(lagged.where("_seq = 1").drop("_seq"), "items", "last_reward")
        out.withColumn("time", format_time("window_end")).write.mode("overwrite").parquet(
            f"{out_path.rstrip('/')}/batch_id={batch_id}")
        store.append(rows.select("user_id", F.lit(batch_id).cast("long").alias("batch"), "window_end", "raw_user",
                                 "item_rec"), batch_id)
    return run


def recommend_batch(out_path: str, user_map: DataFrame, user_vecs: DataFrame, model,
                    catalog, hot_store: str | RankLog | None, n_rec: int = K.N_REC):
    """``foreachBatch`` body: map users, keep full histories, score, fill
    from the rank store, append under the batch id (F7).  A ``RankLog`` is read as of
    each row's window end, so the lists do not depend on how the stream
    was cut into batches; a rank store's path gives its current list.  Rows that the
    scorer fails on get the hot list alone (G8), as the reference does on a bad
    response.  Rows: user_id, raw_user, window_end, time, items, item_rec."""
    from ..operators.fallback import attach_hot, fallback_hot, fill_with_hot
    from ..operators.history import full_history
    from ..operators.lookup import map_ids
    from ..operators.scoring import recommend
    from ..operators.sinks import publish_recs
    from .popular import read_hot_store

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = map_ids(batch.withColumnRenamed("user_id", "raw_user"), "raw_user", user_map,
                       out_col="user_id")
        rows = full_history(rows)
        uv = user_vecs.select(F.col("id").alias("user_id"), F.col("vec").alias("user_vec"))
        scored = recommend(rows.join(uv, "user_id", "left"), model, catalog, n_rec,
                           seed_cols=("raw_user", "window_end"), null_on_error=True)
        if isinstance(hot_store, RankLog):
            times = rows.select(F.col("window_end").alias("t")).distinct()
            scored = attach_hot(scored, hot_store.upto(spark, times), "window_end", times=times)
        else:
            # The rank store holds at most N rows (one per rank): a proven bound,
            # so its current state is read into a literal for this batch.
            pairs = sorted((int(r["rank"]), int(r["item_id"])) for r in
                           read_hot_store(spark, hot_store).collect()) if hot_store else []
            hot = F.array(*[F.struct(F.lit(r).cast("int").alias("rank"), F.lit(i).cast("int").alias("item"))
                            for r, i in pairs]) if pairs else F.array().cast("array<struct<rank:int,item:int>>")
            scored = scored.withColumn("hot", hot)
        out = fallback_hot(fill_with_hot(scored, n_rec), n_rec)  # a NULL list stays NULL in the fill
        publish_recs(out.select("user_id", "raw_user", "window_end",
                                format_time("window_end").alias("time"), "items", "item_rec"),
                     out_path, batch_id)
    return run
