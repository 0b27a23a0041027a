"""Ring of panes against a brute force that knows each batch's watermark; late records as rows."""

import collections
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from ripplerec import schemas
from ripplerec.streaming.late import late_rows, marked_stream, read_split, split_late_batch
from ripplerec.streaming.panes import pane_counts_stream, ranked_batch

START = 1_700_000_000


def _inbox(spark, folder, batches):
    """One file a batch, in order; rows (user, item, second, event)."""
    inbox, now = str(folder / "in"), time.time() - 1000
    os.makedirs(inbox)
    for i, rows in enumerate(batches):
        part = str(folder / f"p{i}")
        spark.createDataFrame(rows, "user_id long, item_id int, s long, event_id long").select(
            "user_id", "item_id", F.timestamp_seconds(F.col("s") + START).alias("ts"), "event_id").coalesce(1).write.parquet(part)
        f = next(x for x in os.listdir(part) if x.endswith(".parquet"))
        os.link(f"{part}/{f}", f"{inbox}/{i:03d}-{f}")
        os.utime(f"{inbox}/{i:03d}-{f}", (now + i, now + i))
    return spark.readStream.schema(schemas.RECORD).option("maxFilesPerTrigger", 1).parquet(inbox)


def _batches(seed, n=6, rows=150):
    rng, out, event = random.Random(seed), [], 0
    for b in range(n):
        part = []
        for _ in range(rows):
            # half of the rows are of one item; some are older than the watermark, some far older
            s = b * 900 + rng.randrange(1200) - (rng.choice([0, 0, 0, 700, 5000]) if b else 0)
            part.append((rng.randrange(5), 0 if rng.random() < 0.5 else rng.randrange(8), max(s, 0), event))
            event += 1
        out.append(part)
    return out


def _brute(batches, window, slide, lateness):
    counts, mark, late = collections.Counter(), 0, set()
    for part in batches:
        for _, item, s, event in part:
            t = (s + START) * 1000
            if t < mark:
                late.add(event)
            first = t // slide + 1
            for end in range(first * slide, (first + window // slide) * slide, slide):
                if end > mark:
                    counts[end, item] += 1
        mark = max(mark, max((s + START) * 1000 for _, _, s, _ in part) - lateness)
    return {k: c for k, c in counts.items() if k[0] <= mark}, late


@pytest.mark.parametrize("lateness, ms", [("0 seconds", 0), ("100 seconds", 100_000)])
def test_ring_of_panes_equals_brute_force(spark, tmp_path, lateness, ms):
    batches = _batches(1)
    want, late = _brute(batches, 3_600_000, 80_000, ms)
    assert late and want
    got, ranks = [], []

    def keep(batch, batch_id):
        rows = [tuple(r) for r in batch.collect()]
        ends = {r[0] for r in rows}
        assert not ends & {r[0] for r in got}  # a window leaves in one micro-batch
        got.extend(rows)
        ranked_batch(lambda top, _: ranks.extend(tuple(r) for r in top.collect()), 2)(batch, batch_id)

    q = (pane_counts_stream(_inbox(spark, tmp_path, batches), lateness=lateness).writeStream.foreachBatch(keep)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    q.stop()
    assert {(e, i): c for e, i, c in got} == want and len(got) == len(want)
    for end in {e for e, _ in want}:
        order = sorted((-c, i) for (e, i), c in want.items() if e == end)[:2]
        assert sorted((r, i, c) for e, r, i, c in ranks if e == end) == [(n, i, -c) for n, (c, i) in enumerate(order, 1)]
    # open panes (at most 60 between the oldest open window and the newest event), a value and a timer an item
    assert max(state) <= 8 * (60 + 4) < 45 * 150


def test_ring_restarts_from_its_checkpoint(spark, tmp_path):
    batches, out = _batches(2), str(tmp_path / "out")
    want, _ = _brute(batches, 3_600_000, 80_000, 0)
    stream = _inbox(spark, tmp_path, batches)
    files = sorted(os.listdir(tmp_path / "in"))
    hidden = tmp_path / "later"
    os.makedirs(hidden)
    for f in files[3:]:
        os.rename(tmp_path / "in" / f, hidden / f)
    for again in range(2):
        q = (pane_counts_stream(stream).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", str(tmp_path / "ck")).start())
        q.processAllAvailable()
        q.stop()
        if not again:
            for f in files[3:]:
                os.rename(hidden / f, tmp_path / "in" / f)
    assert {(r.window_end, r.item_id): r.cnt for r in spark.read.parquet(out).collect()} == want


def test_late_records_are_kept_apart_and_none_is_lost(spark, tmp_path):
    batches = _batches(3)
    _, late = _brute(batches, 3_600_000, 80_000, 10_000)
    path = str(tmp_path / "split")
    assert late_rows(spark, path) == 0
    q = (marked_stream(_inbox(spark, tmp_path, batches)).writeStream.foreachBatch(split_late_batch(path))
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = {r.event_id for r in read_split(spark, path, "late").collect()}
    kept = {r.event_id for r in read_split(spark, path, "kept").collect()}
    assert got == late and late_rows(spark, path) == len(late)
    assert got | kept == {r[3] for b in batches for r in b} and not got & kept


def test_a_long_first_batch_sends_one_message_a_pane():
    import pandas as pd
    from ripplerec.streaming.panes import PaneRing
    calls, ring, cell = collections.Counter(), {}, {}

    class Map:
        def getValue(self, k):
            calls["get"] += 1
            return ring.get(k)

        def updateValue(self, k, v):
            calls["put"] += 1
            ring[k] = v

        def removeKey(self, k):
            calls["remove"] += 1
            del ring[k]

        def iterator(self):
            return iter(list(ring.items()))

        def clear(self):
            ring.clear()

    class Value:
        exists = staticmethod(lambda: "at" in cell)
        get = staticmethod(lambda: cell["at"])
        update = staticmethod(lambda v: cell.update(at=v))
        clear = staticmethod(lambda: cell.clear())

    class Handle:
        getMapState = staticmethod(lambda *a: Map())
        getValueState = staticmethod(lambda *a: Value())
        registerTimer = deleteTimer = staticmethod(lambda at: None)

    class Times:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

        getExpiryTimeInMs = getCurrentWatermarkInMs

    p = PaneRing(3, 10)
    p.init(Handle())
    rows = pd.DataFrame({"pane": range(100), "cnt": [2] * 100})
    assert not [f for f in p.handleInputRows((7,), iter([rows]), Times(0)) if len(f)]
    closed = next(p.handleExpiredTimer((7,), Times(995), Times(10)))
    assert closed["cnt"].tolist() == [2, 4] + [6] * 97 and closed["window_end"].tolist() == list(range(10, 1000, 10))
    assert sorted(ring) == [(97,), (98,), (99,)] and cell["at"] == (1000,)
    assert calls["get"] == 0 and calls["remove"] == 0 and calls["put"] == 103
    more = pd.DataFrame({"pane": [99, 100], "cnt": [1, 5]})
    assert not [f for f in p.handleInputRows((7,), iter([more]), Times(995)) if len(f)]
    assert ring[(99,)] == (3,) and calls["get"] == 2
    assert next(p.handleExpiredTimer((7,), Times(1010), Times(1000)))["cnt"].tolist() == [7, 10]
    assert sorted(ring) == [(99,), (100,)] and calls["remove"] == 2
