"""Sliding counts on a stream from a ring of panes.

Spark's sliding ``window`` writes a state row per window an event falls in (45 for 60 min /
80 s).  Here an item keeps one count per non-empty slide-long pane (``PackedRing``: all in one value,
as a call of the processor is a message per map entry) and one event-time timer: when the watermark passes a window end the
processor sums the panes of every window that closed, emits the counts and forgets the panes
that no open window holds.

Events are counted per (item, pane) in the tasks that read them, so a hot item
sends one row per pane and task.  All counts of a window leave in the micro-batch whose watermark
closes it: ``foreachBatch`` can rank a window as a batch, for any N, with no
second state.

A row counts in the windows that its micro-batch's watermark has not passed, and in
no other; one later than all of its windows is dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import constants as K
from ..operators.lookup import map_ids
from ..operators.ranking import top_n_items
from ..operators.windows import with_event_time

COUNTS_OUT = "window_end long, item_id int, cnt long"


class PaneRing(StatefulProcessor):
    """Counts per window end of one item; window = ``k`` panes of ``slide`` ms."""

    def __init__(self, k: int, slide: int):
        self.k, self.slide = k, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "cnt long")
        self.next = handle.getValueState("next", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: Counter[int] = Counter()
        for pdf in rows:
            for pane, cnt in zip(pdf["pane"].tolist(), pdf["cnt"].tolist(), strict=True):
                new[pane] += cnt
        mark = timerValues.getCurrentWatermarkInMs()
        if self.next.exists() and self.next.get()[0] <= mark:
            # windows that are due close before these rows are counted
            due = self.next.get()[0]
            self.handle.deleteTimer(due)
            yield self._close(key, due, mark)
        # an item with panes has a timer; without one there is nothing to look up, pane by pane
        known, ends = self.next.exists(), []
        for pane, cnt in new.items():
            if (pane + self.k) * self.slide <= mark:
                continue  # every window of this pane has closed
            old = self.panes.getValue((pane,)) if known else None
            self.panes.updateValue((pane,), (cnt + (old[0] if old else 0),))
            ends.append(self._first_open(pane, mark))
        if ends:
            self._wake(min(ends))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._close(key, expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())

    def _close(self, key, end: int, mark: int) -> pd.DataFrame:
        """Counts of the windows from ``end`` to the watermark; forgets panes that no open window holds."""
        ring = {p[0]: c[0] for p, c in self.panes.iterator()}
        order = sorted(ring)
        panes, counts = np.array(order, dtype=np.int64), np.array([ring[p] for p in order], dtype=np.int64)
        # the window ending at pane ``at`` holds the panes at - k .. at - 1; after a pane its k ends
        # follow, up to the one that the next pane opens
        first, last = np.maximum(panes + 1, end // self.slide), panes + self.k
        last[:-1] = np.minimum(last[:-1], panes[1:])
        n = np.maximum(np.minimum(last, mark // self.slide) - first + 1, 0)
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        upto = np.concatenate([[0], np.cumsum(counts)])
        total = upto[np.searchsorted(panes, at)] - upto[np.searchsorted(panes, at - self.k)]
        gone = [p for p in order if (p + self.k) * self.slide <= mark]
        stay = {p: ring[p] for p in order[len(gone):]}
        if len(gone) > len(stay):  # each call is a message: write again what stays
            self.panes.clear()
            for p, cnt in stay.items():
                self.panes.updateValue((p,), (cnt,))
        else:
            for p in gone:
                self.panes.removeKey((p,))
        ring = stay
        self.next.clear()
        if ring:
            self._wake(min(self._first_open(p, mark) for p in ring))
        return pd.DataFrame({"window_end": at * self.slide, "item_id": np.full(len(at), int(key[0])),
                             "cnt": total}).astype("int64")

    def _first_open(self, pane: int, mark: int) -> int:
        """End of the first window of a pane that the watermark has not passed."""
        return max(pane + 1, mark // self.slide + 1) * self.slide

    def _wake(self, at: int) -> None:
        """One timer a key, at the earliest window end that is due."""
        if self.next.exists():
            due = self.next.get()[0]
            if due <= at:
                return
            self.handle.deleteTimer(due)
        self.next.update((at,))
        self.handle.registerTimer(at)

    def close(self) -> None:
        pass


class PanesInOneValue:
    """The map of an item's panes as arrays of one ``ValueState``: read once a call, written once by ``flush``."""

    def __init__(self, value):
        self.value, self.ring, self.changed = value, None, False

    def _load(self) -> dict[int, int]:
        if self.ring is None:
            kept = self.value.get() if self.value.exists() else None
            self.ring = dict(zip(*kept, strict=True)) if kept else {}
        return self.ring

    def getValue(self, key):
        cnt = self._load().get(key[0])
        return None if cnt is None else (cnt,)

    def updateValue(self, key, value) -> None:
        self._load()[key[0]] = value[0]
        self.changed = True

    def removeKey(self, key) -> None:
        del self._load()[key[0]]
        self.changed = True

    def iterator(self):
        return iter([((p,), (c,)) for p, c in self._load().items()])

    def clear(self) -> None:
        self.ring, self.changed = {}, True

    def flush(self) -> None:
        """End of a call: the next one is another item's."""
        if self.changed and self.ring:
            self.value.update((list(self.ring), list(self.ring.values())))
        elif self.changed:
            self.value.clear()
        self.ring, self.changed = None, False


class PackedRing(PaneRing):
    """``PaneRing`` with two state messages for an item's panes a call, however many they are."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = PanesInOneValue(handle.getValueState("panes", "panes array<long>, cnts array<long>"))
        self.next = handle.getValueState("next", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from super().handleInputRows(key, rows, timerValues)
        self.panes.flush()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
        self.panes.flush()


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            t = pa.Table.from_batches([b]).group_by(["item_id", "pane"]).aggregate([([], "count_all")])
            yield from t.rename_columns(["item_id", "pane", "cnt"]).combine_chunks().to_batches()


def pane_counts_stream(records: DataFrame, item_map: DataFrame | None = None, lateness: str = K.POP_LATENESS,
                       window_sec: int = K.POP_WINDOW_SEC, slide_sec: int = K.POP_SLIDE_SEC) -> DataFrame:
    """Append stream of (window_end, item_id, cnt): the rows of ``sliding_counts`` for closed windows."""
    if window_sec % slide_sec:
        raise ValueError("pane form needs the window length to be a multiple of the slide")
    ev = records.select("item_id", "ts")
    if item_map is not None:
        ev = map_ids(ev, "item_id", item_map)
    ev = with_event_time(ev, lateness)
    panes = ev.select(F.col("item_id").cast("int").alias("item_id"),
                      F.floor(F.unix_micros("ts") / F.lit(slide_sec * 1_000_000)).alias("pane"))
    counted = panes.mapInArrow(_partial, "item_id int, pane long, cnt long")
    return counted.groupBy("item_id").transformWithStateInPandas(
        statefulProcessor=PackedRing(window_sec // slide_sec, slide_sec * 1000), outputStructType=COUNTS_OUT,
        outputMode="Append", timeMode="EventTime")


def ranked_batch(publish, n: int | None = K.TOP_N):
    """``foreachBatch`` body: rank the windows that closed in a micro-batch (all items if
    ``n`` is None) and hand the (window_end, rank, item_id, cnt) rows to ``publish``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        publish(top_n_items(batch, n), batch_id)
    return run
