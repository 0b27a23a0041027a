"""Scans and stores that split hot keys, survive replays and crashes, and stay short."""

import collections
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from ripplerec.operators.history import last_reward, last_reward_literal
from ripplerec.operators.ranking import hot_list_asof
from ripplerec.operators.segments import scan_chunks, segmented_lag
from ripplerec.streaming.history import reward_batch
from ripplerec.streaming.popular import DAY_MS, RankLog
from ripplerec.streaming.store import KeyedStore

RECS = "user_id int, raw_user long, window_end long, items array<int>, item_rec array<int>"


def _recs(n=4000, seed=7):
    """Half of all rows are on the shared key 0, most of them in two window ends."""
    rng, rows, seen = random.Random(seed), [], set()
    while len(rows) < n:
        raw = rng.randrange(3000)
        end = rng.choice([20_000, 40_000]) if raw < 1500 and rng.random() < 0.8 else 20_000 * rng.randrange(1, 30)
        if (raw, end) not in seen:
            seen.add((raw, end))
            rec = None if rng.random() < 0.02 else [rng.randrange(6) for _ in range(3)]
            rows.append((0 if raw < 1500 else raw, raw, end, [rng.randrange(6) for _ in range(4)], rec))
    return rows


def _brute(rows, scope):
    prev, want = {}, {}
    for key, raw, end, items, rec in sorted(rows, key=lambda r: (r[2], r[1])):
        k = (key, end) if scope == "literal" else key
        p = prev.get(k)
        want[raw, end] = -1 if p is None else sum(items.count(x) for x in p)
        prev[k] = rec
    return want


@pytest.mark.parametrize("scope", ["state", "literal"])
def test_rewards_of_a_hot_key_equal_brute_force(spark, scope):
    rows = _recs()
    run = last_reward if scope == "state" else last_reward_literal
    got = {(r.raw_user, r.window_end): r.last_reward for r in run(spark.createDataFrame(rows, RECS)).collect()}
    assert got == _brute(rows, scope)


def test_hot_key_is_cut_into_even_chunks(spark):
    rows = _recs(4000, 8)
    df = spark.createDataFrame(rows, RECS)
    chunks = scan_chunks(df, ["user_id"], ["window_end", "raw_user"], "item_rec", chunks=10)
    sizes = sorted(r["count"] for r in chunks.groupBy("_chunk").count().collect())
    assert len(sizes) == 10 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    hot = chunks.where("user_id = 0").select("_chunk").distinct().count()
    assert hot >= 4


def test_segmented_lag_of_null_keys_and_empty_tables(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), i, f"v{i}" if i % 7 else None) for i in range(500)]
    schema = "k string, j int, at int, v string"
    got = segmented_lag(spark.createDataFrame(rows, schema), ["k", "j"], ["at"], "v", chunks=6)
    prev, want = {}, {}
    for k, j, at, v in rows:
        want[at] = prev.get((k, j))
        prev[k, j] = v
    assert {r["at"]: r["prev"] for r in got.collect()} == want
    assert segmented_lag(spark.createDataFrame([], schema), ["k"], ["at"], "v").count() == 0


def test_reward_stream_carries_across_batches_and_replays(spark, tmp_path):
    rows = sorted(_recs(3000, 9), key=lambda r: (r[2], r[1]))
    out, carry = str(tmp_path / "out"), str(tmp_path / "carry")
    run = reward_batch(out, carry)
    cuts = [0, 400, 401, 1500, 1500, 3000]  # one row, an empty batch; cuts inside a window end
    for i in range(5):
        batch = spark.createDataFrame(rows[cuts[i]:cuts[i + 1]], RECS)
        run(batch, i)
        if i in (0, 2, 4):
            run(batch, i)  # replayed
    got = {(r.raw_user, r.window_end): r.last_reward for r in spark.read.parquet(out).collect()}
    assert got == _brute(rows, "state")
    assert spark.read.parquet(out).count() == len(rows)


# ------------------------------------------------------------------ keyed stores

def _store(path, fold_every=3):
    return KeyedStore(path, "k int, v int", lambda d: d.groupBy("k").agg(F.min("v").alias("v")), fold_every)


def test_store_reads_the_same_after_folds_crashes_and_replays(spark, tmp_path):
    rng, want = random.Random(2), {}
    store, plain = _store(str(tmp_path / "a")), _store(str(tmp_path / "b"), fold_every=10**9)
    before = {}
    for b in range(12):
        rows = [(rng.randrange(8), rng.randrange(1000)) for _ in range(5)]
        for k, v in rows:
            want[k] = min(v, want.get(k, v))
        df = spark.createDataFrame(rows, "k int, v int")
        for s in (store, plain):
            s.append(df, b)
        if b % 4 == 1:
            store.append(df, b)  # replayed after its own fold
        before[b + 1] = dict(want)
        assert {r.k: r.v for r in store.read(spark).collect()} == want
        # the table that a replay of the newest batch starts from
        assert {r.k: r.v for r in store.read(spark, before=b).collect()} == before.get(b, {})
    assert {r.k: r.v for r in plain.read(spark).collect()} == want
    assert len(plain.batches(spark)) == 12
    # a read takes one snapshot and a bounded tail, however many batches were written
    done = store.snapshots(spark)
    assert done and len(store.batches(spark, done[-1])) <= store.fold_every + 1
    assert len(done) <= 2 and len(store.batches(spark)) < 12
    # a fold that died before its marker is not seen, and can be repeated
    upto = 11
    store.fold(spark, upto)
    os.remove(f"{store._snapshot(upto)}/_SUCCESS")
    for f in os.listdir(store._snapshot(upto)):
        if f.endswith(".parquet"):
            os.truncate(f"{store._snapshot(upto)}/{f}", 0)
    assert {r.k: r.v for r in store.read(spark).collect()} == want
    store.fold(spark, upto)
    assert {r.k: r.v for r in store.read(spark).collect()} == want and store.snapshots(spark)[-1] == upto


def test_empty_store(spark, tmp_path):
    store = _store(str(tmp_path / "none"))
    assert store.read(spark).count() == 0
    store.append(spark.createDataFrame([], "k int, v int"), 0)
    assert store.read(spark).count() == 0


# ------------------------------------------------------------------ rank log

def test_rank_log_answers_as_of_any_time(spark, tmp_path):
    rng, slide = random.Random(3), 80_000
    ends = sorted(rng.sample(range(0, 5 * DAY_MS, slide), 60))
    writes = [(e, r, rng.randrange(100)) for e in ends for r in range(1, rng.randrange(1, 5) + 1)]
    log, schema = RankLog(str(tmp_path / "log")), "window_end long, rank int, item_id int"
    cut = [0, 20, 21, 90, len(writes)]
    for b in range(4):
        batch = spark.createDataFrame(writes[cut[b]:cut[b + 1]], schema)
        log.publish(batch, b)
        log.publish(batch, b)  # replayed
    for lo, hi in ((0, 5 * DAY_MS), (2 * DAY_MS, 2 * DAY_MS + 20_000), (4 * DAY_MS, 9 * DAY_MS), (20 * DAY_MS, 21 * DAY_MS)):
        asked = sorted({rng.randrange(lo // 20_000, hi // 20_000) * 20_000 for _ in range(40)})
        times = spark.createDataFrame([(t,) for t in asked], "t long")
        got = {(r.t, r["rank"]): r.item_id for r in hot_list_asof(log.upto(spark, times), times, "t", 4).collect()}
        want = {}
        for t in asked:
            for e, r, i in writes:
                if e <= t:
                    want[t, r] = i
        assert got == want
    # a read within one day takes that day's rows and one row a rank
    times = spark.createDataFrame([(3 * DAY_MS + 5,)], "t long")
    assert log.upto(spark, times).where(f"window_end < {3 * DAY_MS}").count() <= 4
    assert log.upto(spark, times.limit(0)).count() == 0


def test_rewards_job_in_small_batches(spark, tmp_path):
    from ripplerec.plans.jobs import start_reward_job
    rows = sorted(_recs(1200, 11), key=lambda r: (r[2], r[1]))
    inbox, now = str(tmp_path / "in"), time.time() - 1000
    os.makedirs(inbox)
    for i in range(4):
        part = str(tmp_path / f"p{i}")
        spark.createDataFrame(rows[i * 300:(i + 1) * 300], RECS).coalesce(1).write.parquet(part)
        f = next(x for x in os.listdir(part) if x.endswith(".parquet"))
        os.link(f"{part}/{f}", f"{inbox}/{i}-{f}")
        os.utime(f"{inbox}/{i}-{f}", (now + i, now + i))
    q = start_reward_job(spark, inbox, str(tmp_path / "out"), str(tmp_path / "ck"), {"availableNow": True}, files_per_batch=1)
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch_id").distinct().count() == 4
    assert collections.Counter((r.raw_user, r.window_end, r.last_reward) for r in got.collect()) == collections.Counter(
        (raw, end, n) for (raw, end), n in _brute(rows, "state").items())


# ------------------------------------------------------------------ consumed sets in chunks

def test_consumed_sets_of_a_hot_user_in_bounded_rows(spark, tmp_path):
    from ripplerec.operators.sinks import consumed_chunks, user_consumed, user_consumed_literal
    from ripplerec.streaming.persist import consumed_pairs_batch, read_consumed_chunks
    rng = random.Random(12)
    rows = [(0 if k % 2 else rng.choice([1, 2, 3]), rng.randrange(300), 1_700_000_000 + rng.randrange(500), k) for k in range(2000)]
    df = spark.createDataFrame(rows, "user_id long, item_id int, s long, event_id long").select(
        "user_id", "item_id", F.timestamp_seconds("s").alias("ts"), "event_id")
    for literal, whole in ((False, user_consumed), (True, user_consumed_literal)):
        want = {r.user: {"item": [str(x) for x in r.consumed], "time": list(r.time)} for r in whole(df).collect()}
        got = collections.defaultdict(dict)
        for r in consumed_chunks(df, literal, size=16).collect():
            assert 0 < len(r.vals) <= 16
            got[r.user, r.kind][r.chunk] = r.vals
        for user, sets in want.items():
            for kind, vals in sets.items():
                parts = got[user, kind]
                assert [v for c in sorted(parts) for v in parts[c]] == vals and sorted(parts) == list(range(len(parts)))
    run = consumed_pairs_batch(str(tmp_path / "pairs"))
    for b in range(3):
        run(df.where(F.col("event_id") % 3 == b), b)
    run(df.where(F.col("event_id") % 3 == 2), 2)
    norm = lambda d: sorted((r.user, r.kind, r.chunk, tuple(r.vals)) for r in d.collect())
    assert norm(read_consumed_chunks(spark, str(tmp_path / "pairs"), 16)) == norm(consumed_chunks(df, size=16))
    assert consumed_chunks(df.limit(0)).count() == 0
