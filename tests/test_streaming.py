"""Streaming = batch on closed windows (SURVEY §5 (2), (4), (5))."""

import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ripplerec import constants as K
from ripplerec import schemas
from ripplerec.operators.history import user_history
from ripplerec.operators.ranking import top_n_items
from ripplerec.operators.windows import sliding_counts
from ripplerec.sources.tables import read_records
from ripplerec.streaming.history import user_history_stream
from ripplerec.streaming.popular import popular_items_stream

FAR = "2030-01-01 00:00:00"


def _replay_files(spark, records, folder, n_files=6):
    """Write records as time-ordered files (oldest first, ordered mtimes) plus
    one far-future event that closes every open window."""
    bounds = records.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    lo, hi = bounds["lo"].timestamp(), bounds["hi"].timestamp() + 1
    step = (hi - lo) / n_files
    paths = []
    for i in range(n_files):
        a, b = lo + i * step, lo + (i + 1) * step
        part = records.where((F.unix_micros("ts") >= int(a * 1e6)) & (F.unix_micros("ts") < int(b * 1e6)))
        p = os.path.join(folder, f"part{i:02d}")
        part.coalesce(1).write.parquet(p)
        paths.append(p)
    closing = spark.createDataFrame([(999999, 0, None, 999999)], schemas.RECORD.simpleString()) \
        .withColumn("ts", F.to_timestamp(F.lit(FAR)))
    p = os.path.join(folder, "part99")
    closing.select("user_id", "item_id", "ts", "event_id").coalesce(1).write.parquet(p)
    paths.append(p)
    # move every parquet file into one input folder with increasing mtimes
    inbox = os.path.join(folder, "inbox")
    os.makedirs(inbox)
    now = time.time() - 1000
    for i, p in enumerate(paths):
        for f in sorted(os.listdir(p)):
            if f.endswith(".parquet"):
                dst = os.path.join(inbox, f"{i:03d}-{f}")
                os.link(os.path.join(p, f), dst)
                os.utime(dst, (now + i, now + i))
    return inbox


def _run(stream_df, name, ckpt):
    q = (stream_df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    dropped = sum(sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", []))
                  for p in q.recentProgress)
    q.stop()
    return dropped


def _rows(df, cols):
    return sorted(tuple(r[c] if not isinstance(r[c], list) else tuple(r[c]) for c in cols)
                  for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("replay"))
    records = read_records(spark, SF_SMALL)
    return records, _replay_files(spark, records, folder)


def test_popular_stream_equals_batch(spark, replay, tmp_path):
    records, inbox = replay
    stream = spark.readStream.schema(schemas.RECORD).option("maxFilesPerTrigger", 1).parquet(inbox)
    dropped = _run(popular_items_stream(stream), "pop_stream", str(tmp_path / "ck"))
    assert dropped == 0
    got = spark.table("pop_stream")
    batch = top_n_items(sliding_counts(records))
    last_event_ms = records.agg(F.max(F.unix_millis("ts"))).first()[0]
    # windows that do not contain the closing event
    closed = got.where(F.col("window_end") <= last_event_ms + 3600 * 1000)
    assert _rows(closed, ["window_end", "rank", "item_id", "cnt"]) == \
        _rows(batch, ["window_end", "rank", "item_id", "cnt"])


def test_history_stream_equals_batch(spark, replay, tmp_path):
    records, inbox = replay
    stream = spark.readStream.schema(schemas.RECORD).option("maxFilesPerTrigger", 1).parquet(inbox)
    dropped = _run(user_history_stream(stream), "hist_stream", str(tmp_path / "ck"))
    assert dropped == 0
    got = spark.table("hist_stream").where(F.col("user_id") != 999999)
    batch = user_history(records)
    assert _rows(got, ["user_id", "window_end", "items"]) == _rows(batch, ["user_id", "window_end", "items"])


def test_history_restart_from_checkpoint(spark, replay, tmp_path):
    """Stop after part of the input, restart on the same checkpoint: the
    file sink holds exactly the batch result (state survived the restart)."""
    records, inbox = replay
    files = sorted(os.listdir(inbox))
    stage = str(tmp_path / "stage")
    os.makedirs(stage)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run_once():
        stream = spark.readStream.schema(schemas.RECORD).option("maxFilesPerTrigger", 1).parquet(stage)
        q = (user_history_stream(stream).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).outputMode("append").start())
        q.processAllAvailable()
        q.stop()

    half = len(files) // 2
    for i, f in enumerate(files[:half]):
        os.link(os.path.join(inbox, f), os.path.join(stage, f))
    run_once()
    for f in files[half:]:
        os.link(os.path.join(inbox, f), os.path.join(stage, f))
    run_once()
    got = spark.read.parquet(out).where(F.col("user_id") != 999999)
    batch = user_history(records)
    assert _rows(got, ["user_id", "window_end", "items"]) == _rows(batch, ["user_id", "window_end", "items"])


def test_late_rows_dropped_and_counted(spark, tmp_path):
    """A row older than the watermark is dropped and reported.

    With chained stateful operators Spark tests lateness against the previous
    batch's watermark, so the late row comes two batches after the advance.
    """
    base = "2024-01-01 00:00:00"
    mk = lambda rows: spark.createDataFrame(rows, "user_id long, item_id int, sec int, event_id long") \
        .select("user_id", "item_id", (F.to_timestamp(F.lit(base)) + F.make_interval(secs=F.col("sec")))
                .alias("ts"), "event_id")
    inbox = str(tmp_path / "in")
    mk([(1, 1, 0, 1), (1, 2, 30, 2), (1, 3, 200, 3)]).coalesce(1).write.parquet(inbox + "/a")
    mk([(1, 5, 210, 6)]).coalesce(1).write.parquet(inbox + "/b")
    mk([(1, 9, 5, 4)]).coalesce(1).write.parquet(inbox + "/c")       # ~200 s late
    mk([(1, 4, 4000, 5)]).coalesce(1).write.parquet(inbox + "/d")    # closes the windows
    flat = str(tmp_path / "flat")
    os.makedirs(flat)
    now = time.time() - 100
    for i, d in enumerate(["a", "b", "c", "d"]):
        for f in os.listdir(os.path.join(inbox, d)):
            if f.endswith(".parquet"):
                dst = os.path.join(flat, f"{i}-{f}")
                os.link(os.path.join(inbox, d, f), dst)
                os.utime(dst, (now + i, now + i))
    stream = spark.readStream.schema(schemas.RECORD).option("maxFilesPerTrigger", 1).parquet(flat)
    dropped = _run(user_history_stream(stream), "late_stream", str(tmp_path / "ck"))
    assert dropped == 3  # one event, counted once per sliding window it falls in
    items = [r["items"] for r in spark.table("late_stream").orderBy("window_end").collect()]
    assert all(9 not in it for it in items)


def test_reward_stream_equals_batch(spark, tmp_path):
    from ripplerec.operators.history import last_reward
    from ripplerec.streaming.history import last_reward_stream
    rows = [(0, 10, 20000, [1, 2, 2], [2, 3]), (0, 10, 40000, [2, 3, 4], [4, 5]),
            (0, 11, 40000, [4, 4, 5], [1]), (1, 12, 20000, [7], [7, 8]), (1, 12, 60000, [8, 8], [9])]
    df = spark.createDataFrame(rows, "user_id int, raw_user long, window_end long, items array<int>, item_rec array<int>")
    path = str(tmp_path / "recs")
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    _run(last_reward_stream(stream), "reward_stream", str(tmp_path / "ck"))
    got = _rows(spark.table("reward_stream"), ["raw_user", "window_end", "last_reward"])
    want = _rows(last_reward(df), ["raw_user", "window_end", "last_reward"])
    assert got == want
    assert [r[2] for r in got] == [-1, 2, 3, -1, 2]  # [4,5] vs [4,4,5]: 2 + 1 pairs


def test_persistence_streams_equal_batch(spark, replay, tmp_path):
    from ripplerec.operators.sinks import record_log, unique_records, user_consumed
    from ripplerec.streaming.persist import (consumed_pairs_batch, read_user_consumed,
                                             read_unique_records, record_log_stream,
                                             unique_records_batch)
    records, inbox = replay
    real = records
    src = lambda: spark.readStream.schema(schemas.RECORD).option("maxFilesPerTrigger", 1).parquet(inbox) \
        .where(F.col("user_id") != 999999)
    _run(record_log_stream(src()), "log_stream", str(tmp_path / "ck1"))
    assert _rows(spark.table("log_stream"), ["user", "item", "time"]) == \
        _rows(record_log(real), ["user", "item", "time"])
    uniq = str(tmp_path / "uniq")
    q = src().writeStream.foreachBatch(unique_records_batch(uniq)) \
        .option("checkpointLocation", str(tmp_path / "ck2")).start()
    q.processAllAvailable()
    q.stop()
    assert _rows(read_unique_records(spark, uniq), ["user", "item", "time"]) == \
        _rows(unique_records(real), ["user", "item", "time"])
    pairs = str(tmp_path / "pairs")
    q = src().writeStream.foreachBatch(consumed_pairs_batch(pairs)) \
        .option("checkpointLocation", str(tmp_path / "ck3")).start()
    q.processAllAvailable()
    q.stop()
    assert _rows(read_user_consumed(spark, pairs), ["user", "consumed", "time"]) == \
        _rows(user_consumed(real), ["user", "consumed", "time"])


def test_jobs_end_to_end(spark, replay, tmp_path):
    """Wire lines on a text stream (A3) -> popular job (rank store, F6) ->
    history + scoring job (F7) -> reward job; persistence job (F1/F2/F4)."""
    from ripplerec.functions.scalar import encode_wire
    from ripplerec.plans import jobs
    from ripplerec.plans.fixtures import EMBED_DIM, Fixture
    from ripplerec.plans.recommend import fixture_catalog, fixture_models
    from ripplerec.sources.events import decode_records, read_events_stream
    from ripplerec.streaming.popular import read_hot_store

    records, inbox = replay
    fx = Fixture(spark, SF_SMALL)
    lines_dir = str(tmp_path / "lines")
    # wire lines derived from the replay files, one text file per parquet file, in order
    os.makedirs(lines_dir)
    now = time.time() - 1000
    for i, f in enumerate(sorted(os.listdir(inbox))):
        part = spark.read.schema(schemas.RECORD).parquet(os.path.join(inbox, f)).orderBy("ts")
        d = str(tmp_path / f"l{i}")
        part.select(encode_wire("user_id", "item_id", F.unix_millis("ts")).alias("value")) \
            .coalesce(1).write.text(d)
        for g in os.listdir(d):
            if g.endswith(".txt"):
                dst = os.path.join(lines_dir, f"{i:03d}-{g}")
                os.link(os.path.join(d, g), dst)
                os.utime(dst, (now + i, now + i))
    lines = read_events_stream(spark, fmt="text", options={"path": lines_dir, "maxFilesPerTrigger": 1})
    # popularity path maps ids first (A4); event id for ordering = time (unique here)
    mapped = decode_records(lines, fx.user_map, fx.item_map).withColumn("event_id", F.col("time_ms"))
    hot = str(tmp_path / "hot")
    q = jobs.start_popular_job(mapped, None, hot, str(tmp_path / "ck_pop"))
    q.processAllAvailable()
    q.stop()
    store = read_hot_store(spark, hot).collect()
    assert 0 < len(store) <= K.TOP_N

    raw = spark.readStream.schema(schemas.RECORD).option("maxFilesPerTrigger", 1).parquet(inbox) \
        .where(F.col("user_id") != 999999)
    from ripplerec.operators.lookup import map_ids
    raw = map_ids(raw, "item_id", fx.item_map)
    cat = fixture_catalog(fx)
    model = fixture_models(len(cat.ids))["ddpg"]
    recs_out = str(tmp_path / "recs")
    q = jobs.start_history_job(raw, fx.user_map, fx.user_vectors, model, cat, hot, recs_out,
                               str(tmp_path / "ck_hist"))
    q.processAllAvailable()
    q.stop()
    recs = spark.read.parquet(recs_out)
    assert recs.count() > 0
    assert recs.where(F.size("item_rec") != K.N_REC).count() == 0
    assert recs.where("time is null").count() == 0

    out = str(tmp_path / "rewarded")
    q = jobs.start_reward_job(spark, recs_out, out, str(tmp_path / "ck_rw"))
    q.processAllAvailable()
    q.stop()
    from ripplerec.operators.history import last_reward
    want = _rows(last_reward(recs), ["raw_user", "window_end", "last_reward"])
    rewarded = spark.read.parquet(out)
    assert _rows(rewarded, ["raw_user", "window_end", "last_reward"]) == want
    assert _rows(rewarded, ["raw_user", "window_end", "time"]) == _rows(recs, ["raw_user", "window_end", "time"])

    qs = jobs.start_persist_job(raw, str(tmp_path / "persist"), str(tmp_path / "ck_persist"))
    for q in qs:
        q.processAllAvailable()
        q.stop()
    assert spark.read.parquet(str(tmp_path / "persist" / "record_log")).count() == records.count()


def test_keyed_insert_keeps_late_rows(spark, tmp_path):
    """Keys that arrive long after newer events are inserted all the same, and
    the earliest event of a key wins whenever it arrives."""
    from ripplerec.operators.sinks import unique_records
    from ripplerec.streaming.persist import read_unique_records, unique_records_batch
    files = [[(1, 1, 5000, 0), (2, 1, 5_000_000, 1)], [(3, 1, 6000, 2), (1, 1, 1000, 3)],
             [(4, 2, 2000, 4), (5, 2, 9_000_000, 5), (2, 1, 4_000_000, 6)]]
    inbox, store = str(tmp_path / "in"), str(tmp_path / "store")
    every = None
    now = time.time() - 1000
    for i, rows in enumerate(files):
        df = spark.createDataFrame(rows, "user_id long, item_id int, ms long, event_id long").select(
            "user_id", "item_id", F.timestamp_millis("ms").alias("ts"), "event_id")
        every = df if every is None else every.union(df)
        df.coalesce(1).write.mode("append").parquet(inbox)
        for f in os.listdir(inbox):
            p = os.path.join(inbox, f)
            if os.path.getmtime(p) > now + 500:
                os.utime(p, (now + i, now + i))
    q = spark.readStream.schema(schemas.RECORD).option("maxFilesPerTrigger", 1).parquet(inbox) \
        .writeStream.foreachBatch(unique_records_batch(store)) \
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = _rows(read_unique_records(spark, store), ["user", "item", "time"])
    assert got == _rows(unique_records(every), ["user", "item", "time"])
    assert len(got) == 5


def test_missing_hot_store_is_an_empty_one(spark, tmp_path):
    from ripplerec.streaming.popular import read_hot_store
    assert read_hot_store(spark, str(tmp_path / "never written")).collect() == []


@pytest.mark.parametrize("model_fails", [True, False])
@pytest.mark.parametrize("store", ["missing", "three ranks"])
def test_failing_scorer_falls_back_and_replay_writes_once(spark, tmp_path, model_fails, store):
    import numpy as np

    from ripplerec.operators.scoring import ActorModel, ItemCatalog, Layer
    from ripplerec.streaming.history import recommend_batch

    class FailingModel:  # local, so that it travels to the tasks by value
        def action(self, state, rng=None):
            raise RuntimeError("no answer")

    hot = str(tmp_path / "hot")
    if store == "three ranks":
        spark.createDataFrame([(1, 40, 9), (2, 41, 9), (4, 43, 9)], "rank int, item_id int, window_end long") \
            .write.parquet(f"{hot}/tail/batch_id=0")
    hist = K.HIST_LEN
    vecs = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "id int, vec array<float>")
    catalog = ItemCatalog.from_frame(vecs, 1, oov_id=2)
    model = FailingModel() if model_fails else ActorModel(
        Layer(np.eye(1, 1 + hist), np.ones(1)), Layer(np.eye(1), np.ones(1)), Layer(np.eye(1), np.ones(1)))
    users = spark.createDataFrame([(7, 0)], "raw_id long, dense_id int")
    batch = spark.createDataFrame([(7, 1_700_000_000_000, [0] * hist), (8, 1_700_000_020_000, [1] * hist)],
                                  "user_id long, window_end long, items array<int>")
    out = str(tmp_path / "out")
    run = recommend_batch(out, users, vecs, model, catalog, hot, n_rec=4)
    run(batch, 3)
    run(batch, 3)  # a replayed batch takes the place of its first try
    got = {r["raw_user"]: r["item_rec"] for r in spark.read.parquet(out).collect()}
    ranks = [] if store == "missing" else [40, 41, 43]
    want = ranks if model_fails else [1, 0] + ranks[:2]
    assert got == {7: want, 8: want}
    rows = spark.read.parquet(out)
    assert rows.count() == 2 and rows.where("time is null").count() == 0
