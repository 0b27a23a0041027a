"""Per-user histories and feedback: C4 ``user_windows`` (bounded), E1
``user_history``, E3 ``user_history_dedup``, E4 ``last_reward``, E5
``last_reward_literal``.

Skew: a single user (or the shared OOV id) may hold a third of all events.
Nothing here sorts a user's events in one task.  Events are first cut to the
last ``hist`` per (user, window) or (user, pane) with a row-number limit that
Spark applies partially before the shuffle; the carry across windows then
runs over one row per (user, window), whose count is bounded by the time span
(one per 20 s), not by the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from .segments import segmented_lag
from .windows import assign_windows


def _last_n(arr: Column, n: int) -> Column:
    return F.slice(arr, F.greatest(F.size(arr) - F.lit(n - 1), F.lit(1)), n)


def _tails(rows: DataFrame, keys: list[str], n: int, item: str = "item_id",
           with_sizes: bool = False) -> DataFrame:
    """Last ``n`` items per ``keys`` group in (ts, event_id) order (+ group
    size).  The row-number limit runs partially before the shuffle
    (WindowGroupLimit), so a group sends at most ``n`` rows per map task; the
    size is a separate partial-aggregate count, which keeps that limit in
    place (any other window function over the group would disable it)."""
    w = Window.partitionBy(*keys).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    tail = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    out = tail.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", item))).alias("_ev"))
    out = out.select(*keys, F.transform("_ev", lambda e: e[item]).alias("items"))
    if with_sizes:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events"))
        out = sizes.join(out, keys)
    return out


def user_windows(records: DataFrame, key: str = "user_id", keep: int = K.HIST_LEN,
                 window_sec: int = K.HIST_WINDOW_SEC, slide_sec: int = K.HIST_SLIDE_SEC) -> DataFrame:
    """C4 (batch): per (user, 60 s / 20 s window) -> (key, window_end ms,
    n_events, items = the window's last ``keep`` items in event order)."""
    ex = assign_windows(records.select(key, "item_id", "ts", "event_id"), window_sec, slide_sec)
    return _tails(ex, [key, "window_end"], keep, with_sizes=True) \
        .select(key, "window_end", "n_events", "items")


def user_history(records: DataFrame, key: str = "user_id", hist: int = K.HIST_LEN,
                 window_sec: int = K.HIST_WINDOW_SEC, slide_sec: int = K.HIST_SLIDE_SEC) -> DataFrame:
    """History carried across windows, as the reference builds it.

    At each (user, window) the window's items are appended to the user's list
    and the list is trimmed from the front to ``hist``.  Sliding overlap makes
    an event enter once per window that holds it (3 times for 60 s / 20 s).
    Since every non-empty window adds at least one item, the list at window W
    is the last ``hist`` items of the concatenated tails of the user's last
    ``hist`` windows.  -> (key, window_end, items).
    """
    ex = assign_windows(records.select(key, "item_id", "ts", "event_id"), window_sec, slide_sec)
    tails = _tails(ex, [key, "window_end"], hist)
    w = Window.partitionBy(key).orderBy("window_end").rowsBetween(-(hist - 1), 0)
    return tails.select(key, "window_end",
                        _last_n(F.flatten(F.collect_list("items").over(w)), hist).alias("items"))


def user_history_dedup(records: DataFrame, key: str = "user_id", hist: int = K.HIST_LEN,
                       window_sec: int = K.HIST_WINDOW_SEC,
                       slide_sec: int = K.HIST_SLIDE_SEC) -> DataFrame:
    """For each (user, window) with events, the user's last ``hist`` items
    among events before the window end -- each event counted once.

    Events fall in exactly one slide-long pane; tails per pane are carried
    forward per user, then every pane feeds the windows containing it and
    each window keeps the state of its latest pane.
    """
    slide_us = slide_sec * 1_000_000
    slide_ms = slide_sec * 1000
    k = window_sec // slide_sec
    panes = records.select(key, "item_id", "ts", "event_id",
                           F.floor(F.unix_micros("ts") / F.lit(slide_us)).alias("pane"))
    tails = _tails(panes, [key, "pane"], hist)
    w = Window.partitionBy(key).orderBy("pane").rowsBetween(-(hist - 1), 0)
    running = tails.select(key, "pane", _last_n(F.flatten(F.collect_list("items").over(w)), hist)
                           .alias("items"))
    first_end = (F.col("pane") + 1) * F.lit(slide_ms)
    per_window = running.select(
        key, "pane", "items",
        F.explode(F.sequence(first_end, first_end + F.lit((k - 1) * slide_ms), F.lit(slide_ms)))
        .alias("window_end"))
    return per_window.groupBy(key, "window_end").agg(F.max_by("items", "pane").alias("items"))


def full_history(df: DataFrame, n: int = K.HIST_LEN, items: str = "items") -> DataFrame:
    """B2: keep rows whose history holds exactly ``n`` items."""
    return df.where(F.size(items) == n)


def pair_hits(prev: Column, items: Column) -> Column:
    """Number of (recommended, clicked) pairs that are equal: each
    recommendation counts every time it appears in the history."""
    return F.aggregate(prev, F.lit(0), lambda acc, r: acc + F.size(F.filter(items, lambda c: c == r)))


def last_reward(recs: DataFrame, key: str = "user_id", order: str = "window_end",
                tie: str = "raw_user", items: str = "items", rec: str = "item_rec",
                out: str = "last_reward") -> DataFrame:
    """Hits between the key's previous recommendation and the current
    history; -1 when there is none.  State is per (mapped) user; rows of one
    window end sharing a key (several raw users on the OOV id) are taken in
    ``tie`` order.  The scan splits a key of any size, see ``segments``."""
    return _rewarded(segmented_lag(recs, [key], [order, tie], rec, "_prev"), items, out)


def _rewarded(rows: DataFrame, items: str, out: str) -> DataFrame:
    return rows.withColumn(out, F.when(F.col("_prev").isNull(), F.lit(-1))
                           .otherwise(pair_hits(F.col("_prev"), F.col(items))).cast("int")).drop("_prev")


def last_reward_literal(recs: DataFrame, key: str = "user_id", order: str = "window_end",
                        tie: str = "raw_user", items: str = "items", rec: str = "item_rec",
                        out: str = "last_reward") -> DataFrame:
    """E5: the reference's literal scope -- state lives per window end, so only
    rows sharing (window end, key) see each other (SURVEY Q3)."""
    return _rewarded(segmented_lag(recs, [order, key], [tie], rec, "_prev"), items, out)
