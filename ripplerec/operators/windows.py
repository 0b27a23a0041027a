"""Event time and sliding windows: C1/C2 ``with_event_time``, C3/D1
``sliding_counts``, D6 ``sliding_counts_paned``, window assignment for C4
(whose per-window tails, bounded before the shuffle, are in ``history``).

Windows are epoch aligned, [start, end), like the reference's.  Window ends
leave these functions as BIGINT epoch milliseconds (the reference's
``windowEnd`` is a long).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K


def with_event_time(df: DataFrame, lateness: str = K.POP_LATENESS, ts: str = "ts") -> DataFrame:
    """C1 (ascending, "0 seconds") / C2 (bounded, "10 seconds") event time.

    On a batch frame the watermark is a no-op; on a stream it bounds state and
    drops rows later than the bound (C6), which Spark reports as
    ``numRowsDroppedByWatermark`` in the query progress.  When several
    stateful operators are chained, Spark tests lateness against the
    previous micro-batch's watermark, so a drop can lag one batch behind
    the reference's (per-record) watermark.
    """
    if dict(df.dtypes).get(ts) == "timestamp_ntz":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, lateness)


def sliding_counts(records: DataFrame, key: str = "item_id", window: str = K.POP_WINDOW,
                   slide: str = K.POP_SLIDE) -> DataFrame:
    """Count per (sliding window, key) -> (window_end ms, key, cnt).

    Spark's sliding ``window`` expands every row into size/slide windows and
    counts with partial (map-side) then final aggregation.  Works on streams.
    """
    return (records
            .groupBy(F.window("ts", window, slide).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.unix_millis(F.col("w.end")).alias("window_end"), key, "cnt"))


def sliding_counts_paned(records: DataFrame, key: str = "item_id",
                         window_sec: int = K.POP_WINDOW_SEC,
                         slide_sec: int = K.POP_SLIDE_SEC) -> DataFrame:
    """The same counts via panes and a range frame (batch).

    1. Events are counted per (key, slide-long pane): one row per event
       feeds a partial hash aggregate (Spark's sliding ``window`` instead
       expands every event size/slide = 45 times).
    2. One pass per key in pane order: each non-empty pane takes the next
       non-empty pane (``lead``) and the counts of the key's non-empty panes
       among the k-1 before it (a bounded ``rangeBetween`` frame).
    3. The pane is extended to the window ends up to the next non-empty pane
       (at most k): every window end with a count is generated exactly once,
       so the rows equal the output, and its count is the pane's own plus the
       in-range earlier ones.

    A key's partition holds at most one row per slide of the time span,
    however many events the key has; no second sort is needed.
    """
    if window_sec % slide_sec:
        raise ValueError("pane form needs the window length to be a multiple of the slide")
    k = window_sec // slide_sec
    slide_us = slide_sec * 1_000_000
    slide_ms = slide_sec * 1000
    panes = (records
             .select(key, F.floor(F.unix_micros("ts") / F.lit(slide_us)).alias("pane"))
             .groupBy(key, "pane").agg(F.count(F.lit(1)).alias("pcnt")))
    by_key = Window.partitionBy(key).orderBy("pane")
    nxt = F.lead("pane").over(by_key)
    # counts of the key's other non-empty panes in the k-1 panes before this one
    prev = F.collect_list(F.struct("pane", "pcnt")).over(by_key.rangeBetween(-(k - 1), -1))
    reach = F.col("pane") + F.lit(k - 1)
    last_q = F.least(F.coalesce(nxt - 1, reach), reach)
    rows = (panes.select(key, "pcnt", "pane", prev.alias("_prev"), last_q.alias("_last"))
            .select(key, "pcnt", "_prev", F.explode(F.sequence("pane", "_last")).alias("q")))
    # window after pane q covers panes q-k+1 .. q; the generating pane is the
    # key's last non-empty pane <= q, the rest come from _prev
    in_range = F.filter("_prev", lambda x: x["pane"] >= F.col("q") - F.lit(k - 1))
    cnt = F.col("pcnt") + F.aggregate(in_range, F.lit(0).cast("bigint"), lambda a, x: a + x["pcnt"])
    return rows.select(((F.col("q") + 1) * F.lit(slide_ms)).alias("window_end"), key, cnt.alias("cnt"))


def assign_windows(df: DataFrame, window_sec: int, slide_sec: int, ts: str = "ts") -> DataFrame:
    """Add ``window_end`` (ms) once per sliding window containing ``ts``.

    Arithmetic form of Spark's window expansion, for operators that need the
    rows themselves (histories) rather than an aggregate.
    """
    if window_sec % slide_sec:
        raise ValueError("window length must be a multiple of the slide")
    k = window_sec // slide_sec
    slide_us = slide_sec * 1_000_000
    slide_ms = slide_sec * 1000
    first_end = (F.floor(F.unix_micros(ts) / F.lit(slide_us)) + 1) * F.lit(slide_ms)
    return df.withColumn(
        "window_end",
        F.explode(F.sequence(first_end, first_end + F.lit((k - 1) * slide_ms), F.lit(slide_ms))))

