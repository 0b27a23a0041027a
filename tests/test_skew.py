"""Hot keys: one user holds a third of all events, many raw users share the
OOV id.  The skew-safe plans must give exactly the brute-force results, and
the pre-shuffle row limit must stay in the plan."""

import datetime as dt
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from ripplerec.operators.history import last_reward, user_history
from ripplerec.operators.ranking import top_n_items
from ripplerec.operators.windows import sliding_counts_paned

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _events(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    users = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))   # user 0: a third of the rows
    items = rng.integers(0, 25, n)
    secs = np.sort(rng.integers(0, 6 * 3600, n))
    return [(int(u), int(i), int(s), k) for k, (u, i, s) in enumerate(zip(users, items, secs))]


def _brute_history(rows, hist=10, win=60, slide=20):
    seq = defaultdict(list)
    for u, i, s, e in rows:
        first_end = (s // slide + 1) * slide
        for j in range(win // slide):
            seq[u].append((first_end + j * slide, s, e, i))
    out = {}
    for u, lst in seq.items():
        lst.sort()
        cur = []
        for end, _, _, item in lst:
            cur = (cur + [item])[-hist:]
            out[(u, end)] = list(cur)
    return out


def test_hot_user_history_matches_brute_force(spark):
    rows = _events()
    df = spark.createDataFrame([(u, i, T0 + dt.timedelta(seconds=s), e) for u, i, s, e in rows],
                               "user_id long, item_id int, ts timestamp, event_id long")
    h = user_history(df)
    t0 = int(T0.timestamp())
    got = {(r["user_id"], r["window_end"] // 1000 - t0): r["items"] for r in h.collect()}
    assert got == _brute_history(rows)
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # the per-window tail limit runs before the shuffle


def test_hot_item_counts_match_brute_force(spark):
    rows = _events()
    df = spark.createDataFrame([(u, i, T0 + dt.timedelta(seconds=s), e) for u, i, s, e in rows],
                               "user_id long, item_id int, ts timestamp, event_id long")
    t0 = int(T0.timestamp())
    brute = defaultdict(int)
    for _, i, s, _ in rows:
        first = (s // 80 + 1) * 80
        for j in range(45):
            brute[(first + 80 * j, i)] += 1
    got = {(r["window_end"] // 1000 - t0, r["item_id"]): r["cnt"] for r in sliding_counts_paned(df).collect()}
    assert got == dict(brute)
    top = top_n_items(sliding_counts_paned(df), 3).collect()
    for r in top:
        w = r["window_end"] // 1000 - t0
        ranked = sorted(((-c, i) for (ww, i), c in brute.items() if ww == w))[:3]
        assert (-ranked[r["rank"] - 1][0], ranked[r["rank"] - 1][1]) == (r["cnt"], r["item_id"])


def test_shared_oov_key_reward_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for end in range(20000, 20000 * 40, 20000):
        for raw in rng.choice(200, size=8, replace=False):
            key = 0 if raw < 150 else int(raw)          # 150 raw users share OOV key 0
            rows.append((key, int(raw), end, [int(x) for x in rng.integers(0, 6, 4)],
                         [int(x) for x in rng.integers(0, 6, 3)]))
    df = spark.createDataFrame(rows, "user_id int, raw_user long, window_end long, "
                                     "items array<int>, item_rec array<int>")
    got = {(r["raw_user"], r["window_end"]): r["last_reward"] for r in last_reward(df).collect()}
    prev, want = {}, {}
    for key, raw, end, items, rec in sorted(rows, key=lambda r: (r[2], r[1])):
        p = prev.get(key)
        want[(raw, end)] = -1 if p is None else sum(items.count(x) for x in p)
        prev[key] = rec
    assert got == want


def test_users_outside_the_dictionary_do_not_meet_in_one_task(spark, tmp_path):
    from ripplerec.plans.fixtures import Fixture
    from ripplerec.plans.registry import _scoring, _state_rows
    # 60 users of 5 events each are outside the dictionary, 20 of 30 events each are in it
    rows = [(u, T0 + dt.timedelta(seconds=100 * k + u)) for u in range(80) for k in range(5 if u < 60 else 30)]
    raw = [(k, ts, u, "view", 1.0, '{"k": %d}' % (k % 7)) for k, (u, ts) in enumerate(rows)]
    ev = spark.createDataFrame(raw, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    ev.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    vecs = [(i, [float(i)] * 64) for i in range(80)]
    spark.createDataFrame(vecs, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    d, n_known = str(tmp_path), 20
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fx = Fixture.prepared(spark, d)
        assert fx.user_map.count() == n_known
        joined = _scoring(spark, d)[2]
        for df in (joined, _state_rows(spark, d)[2]):
            made = df.select(F.spark_partition_id().alias("task"), "raw_user", "user_id").distinct().collect()
            outside = [r["task"] for r in made if r["user_id"] == n_known]
            assert len(outside) == len({(r["raw_user"]) for r in made if r["user_id"] == n_known}) > 30
            assert max(outside.count(t) for t in set(outside)) < len(outside) / 2
        got = {r["raw_user"]: r["user_vec"] for r in joined.select("raw_user", "user_vec").collect()}
        assert all(v == ([float(u)] * 64 if u >= 60 else None) for u, v in got.items())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_reward_files_follow_the_rows(spark, monkeypatch):
    from ripplerec.operators import segments
    from ripplerec.plans import registry
    paths, scratch = {}, registry._scratch
    monkeypatch.setattr(registry, "_scratch", lambda s, name: paths.setdefault(name, scratch(s, name)))
    monkeypatch.setattr(segments, "CHUNK_ROWS", 300)
    from conftest import SF_SMALL
    n = registry.q_last_reward_stream(spark, SF_SMALL).count()
    files = [r["count"] for r in spark.read.parquet(paths["recommendations"]).groupBy(F.input_file_name()).count().collect()]
    assert sum(files) == n > 1500 and len(files) > 3 and max(files) < n / 3


def test_small_top_k_equals_a_full_sort():
    from ripplerec.operators.scoring import Block, _topk_index, _walk
    rng = np.random.default_rng(8)
    r, ids = rng.integers(-3, 3, (500, 40)) / 8, np.arange(3, 43)
    want = np.lexsort((np.broadcast_to(ids, r.shape), -r), axis=-1)
    for k in (1, 8, 16, 40):
        assert (_topk_index(r, ids, k) == want[:, :k]).all()
    act, items = rng.integers(-3, 3, (60, 4)) / 4, rng.integers(-3, 3, (40, 4)) / 4
    for parts in (1, 4):  # blocks of 40 and of 10 items
        cut = [Block(np.inf, 0.0, lambda a=a: (ids[a], items[a], None)) for a in np.split(np.arange(40), parts)]
        s = act @ items.T
        best = ids[np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=-1)]
        assert (_walk(act, cut, 8) == best[:, :8]).all()
        assert (_walk(act, cut, 12) == best[:, :12]).all()
    r[0, 5] = np.nan
    assert (_topk_index(r, ids, 8) == np.lexsort((np.broadcast_to(ids, r.shape), -r), axis=-1)[:, :8]).all()
