"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or frames Spark derives from them)
in full; none runs on made-up input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators.lookup import map_ids
from ..operators.ranking import hot_list, top_n_items
from ..operators.windows import sliding_counts as _sliding_counts
from ..operators.windows import sliding_counts_paned as _sliding_counts_paned
from .fixtures import Fixture
from .popular import popular_items

Query = Callable[[SparkSession, str], DataFrame]


def _mapped_items(fx: Fixture) -> DataFrame:
    return map_ids(fx.records.select("item_id", "ts"), "item_id", fx.item_map)


def q_sliding_counts(spark, sf_dir):
    return _sliding_counts(_mapped_items(Fixture.prepared(spark, sf_dir)), "item_id")


def q_sliding_counts_paned(spark, sf_dir):
    return _sliding_counts_paned(_mapped_items(Fixture.prepared(spark, sf_dir)), "item_id")


def q_top_n_items(spark, sf_dir):
    fx = Fixture.prepared(spark, sf_dir)
    return popular_items(fx.records, fx.item_map, K.TOP_N)


def q_rank_all_items(spark, sf_dir):
    fx = Fixture.prepared(spark, sf_dir)
    return popular_items(fx.records, fx.item_map, None)


def q_hot_list(spark, sf_dir):
    fx = Fixture.prepared(spark, sf_dir)
    return hot_list(popular_items(fx.records, fx.item_map, K.TOP_N))


# ---------------------------------------------------------------- lookups, prep

def q_build_id_map(spark, sf_dir):
    return Fixture.prepared(spark, sf_dir).user_map


def q_filter_min_interactions(spark, sf_dir):
    from ..operators.prep import filter_min_interactions
    from .fixtures import VOCAB_MIN_SHARE
    r = Fixture.prepared(spark, sf_dir).records
    return filter_min_interactions(r, "user_id", min_share=VOCAB_MIN_SHARE) \
        .select("event_id", "user_id", "item_id")


def q_merge_features(spark, sf_dir):
    from ..operators.prep import merge_features
    fx = Fixture.prepared(spark, sf_dir)
    li = fx.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = fx.table("orders").select("o_orderkey", "o_custkey")
    behaviour = li.join(orders, li["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey")
    users = fx.table("customer").select("c_custkey", "c_mktsegment")
    items = fx.table("part").select("p_partkey", "p_brand")
    out = merge_features(behaviour, users, items, ("o_custkey", "c_custkey"), ("l_partkey", "p_partkey"))
    return out.select("l_orderkey", "l_linenumber", "c_custkey", "c_mktsegment", "p_partkey",
                      "p_brand", "l_quantity")


def q_map_ids(spark, sf_dir):
    from .popular import mapped_records
    fx = Fixture.prepared(spark, sf_dir)
    return mapped_records(fx.records, fx.user_map, fx.item_map).select("event_id", "user_id", "item_id")


def q_map_id_arrays(spark, sf_dir):
    from ..operators.history import user_history
    from ..operators.lookup import map_id_arrays
    fx = Fixture.prepared(spark, sf_dir)
    h = user_history(fx.records)
    return map_id_arrays(h, ["user_id", "window_end"], "items", fx.item_map)


def q_format_time(spark, sf_dir):
    from ..functions.scalar import format_time
    r = Fixture.prepared(spark, sf_dir).records
    return r.select("event_id", format_time(F.unix_millis("ts")).alias("time"))


def q_encode_wire(spark, sf_dir):
    from ..functions.scalar import encode_wire
    r = Fixture.prepared(spark, sf_dir).records
    return r.select("event_id", encode_wire("user_id", "item_id", F.unix_millis("ts")).alias("line"))


def q_decode_records(spark, sf_dir):
    from ..functions.scalar import encode_wire
    from ..sources.events import decode_records
    fx = Fixture.prepared(spark, sf_dir)
    lines = fx.records.select("event_id", encode_wire("user_id", "item_id", F.unix_millis("ts")).alias("value"))
    out = decode_records(lines, fx.user_map, fx.item_map)
    return out.select("user_id", "item_id", "time_ms")


def q_explode_ranks(spark, sf_dir):
    from ..operators.ranking import explode_ranks
    fx = Fixture.prepared(spark, sf_dir)
    top = popular_items(fx.records, fx.item_map, K.TOP_N)
    lists = top.groupBy("window_end").agg(
        F.array_sort(F.collect_list(F.struct("rank", "item_id"))).alias("r")) \
        .select("window_end", F.transform("r", lambda x: x["item_id"]).alias("items"))
    return explode_ranks(lists, "items", ["window_end"])


# ---------------------------------------------------------------- windows, history

def q_user_windows(spark, sf_dir):
    from ..operators.history import user_windows
    return user_windows(Fixture.prepared(spark, sf_dir).records)


def q_user_history(spark, sf_dir):
    from ..operators.history import user_history
    return user_history(Fixture.prepared(spark, sf_dir).records)


def q_user_history_dedup(spark, sf_dir):
    from ..operators.history import user_history_dedup
    return user_history_dedup(Fixture.prepared(spark, sf_dir).records)


def q_full_history(spark, sf_dir):
    from ..operators.history import full_history, user_history
    return full_history(user_history(Fixture.prepared(spark, sf_dir).records))


def q_hot_list_asof(spark, sf_dir):
    """The rank store as read at every history window end (the times at
    which the recommender reads it).  Each event opens its windows, so these
    are the window ends of ``user_windows``, taken without its tails."""
    from ..operators.ranking import hot_list_asof
    from .recommend import rank_writes, window_end_times
    fx = Fixture.prepared(spark, sf_dir)
    return hot_list_asof(rank_writes(fx), window_end_times(fx.records), "t", K.TOP_N)


# ---------------------------------------------------------------- scoring

def _scoring(spark, sf_dir):
    from . import recommend as R
    fx = Fixture.prepared(spark, sf_dir)
    rows = R.with_user_vectors(R.history_rows(fx.records, fx.user_map, fx.item_map), fx.raw_user_vectors, "raw_user")
    return fx, R, rows


def _recommend_query(algo):
    def q(spark, sf_dir):
        from ..operators.scoring import model_for
        fx, R, rows = _scoring(spark, sf_dir)
        out = R.score(fx, rows, model_for(algo, R.fixture_models(fx.item_map.count())), K.N_REC)
        return out.select("raw_user", "user_id", "window_end", "item_rec")
    q.__name__ = f"q_recommend_{algo}"
    return q


def q_actor_action(spark, sf_dir):
    from ..operators.scoring import actor_action
    fx, R, st = _state_rows(spark, sf_dir)
    out = actor_action(st, R.fixture_models(fx.item_map.count())["ddpg"], state_col="state")
    return out.select("raw_user", "window_end", F.posexplode("action").alias("pos", "value"))


def _state_rows(spark, sf_dir, each=None):
    from ..operators.lookup import state_vector
    from . import recommend as R
    from .fixtures import EMBED_DIM
    fx = Fixture.prepared(spark, sf_dir)
    rows = R.history_rows(fx.records, fx.user_map, fx.item_map)
    return fx, R, state_vector(rows, ["raw_user", "window_end"], "raw_user", "items",
                               fx.raw_user_vectors, fx.item_vectors, EMBED_DIM, width=K.HIST_LEN, each=each)


def q_state_vector(spark, sf_dir):
    _, _, st = _state_rows(spark, sf_dir)
    return st.select("raw_user", "window_end", "state")


def _recommend_state_query(algo):
    def q(spark, sf_dir):
        from ..operators.scoring import model_for
        fx, R, st = _state_rows(spark, sf_dir)
        out = R.score(fx, st, model_for(algo, R.fixture_models(fx.item_map.count())), K.N_REC, state_col="state")
        return out.select("raw_user", "user_id", "window_end", "item_rec")
    q.__name__ = f"q_recommend_state_{algo}"
    return q


def q_recommend_policy_blocked(spark, sf_dir):
    """The policy head as weight blocks in the shared folder, as for a head beyond the shipped size."""
    from ..operators.scoring import model_for
    fx, R, rows = _scoring(spark, sf_dir)
    out = R.score(fx, rows, model_for("reinforce", R.fixture_models(fx.item_map.count())), K.N_REC, max_bytes=0)
    return out.select("raw_user", "user_id", "window_end", "item_rec")


def q_topk_per_key(spark, sf_dir):
    """Blocked scoring (catalog not shipped): a running top k per row over the
    item blocks; exploded to (row, rank, item)."""
    from ..operators.ranking import explode_ranks
    from ..operators.scoring import recommend
    fx, R, st = _state_rows(spark, sf_dir)
    n_items = fx.item_map.count()
    model = R.fixture_models(n_items)["ddpg"]
    out = recommend(st, model, None, K.N_REC, state_col="state", item_vecs=fx.item_vectors,
                    blocked=True, block_size=32)
    return explode_ranks(out, "item_rec", ["raw_user", "window_end"])


def q_scoring_requests(spark, sf_dir):
    from ..functions.scalar import scoring_request
    from . import recommend as R
    fx = Fixture.prepared(spark, sf_dir)
    rows = R.history_rows(fx.records, fx.user_map, fx.item_map)
    return rows.select("raw_user", "window_end",
                       scoring_request("user_id", "items", F.lit(K.N_REC)).alias("request"))


def q_scoring_requests_state(spark, sf_dir):
    """B8, embedding form: bare user id and six-decimal floats, written once per vector."""
    from ..functions.scalar import scoring_request_state, vector_text
    _, _, st = _state_rows(spark, sf_dir, each=vector_text)
    return st.select("raw_user", "window_end",
                     scoring_request_state("user_id", "state", F.lit(K.N_REC), texts=True).alias("request"))


def q_decode_scores(spark, sf_dir):
    """Scores pass through the scorer's response text and back."""
    from ..functions.scalar import decode_scores, encode_scores
    out = _recommend_query("ddpg")(spark, sf_dir)
    return out.withColumn("item_rec", decode_scores(encode_scores("item_rec")))


def _pipeline_query(**kw):
    def q(spark, sf_dir):
        from .recommend import recommend_pipeline
        return recommend_pipeline(Fixture.prepared(spark, sf_dir), **kw)
    return q


def q_last_reward(spark, sf_dir):
    from .recommend import recommend_pipeline
    out = recommend_pipeline(Fixture.prepared(spark, sf_dir), scorer_failed=True)
    return out.select("user_id", "raw_user", "window_end", "last_reward")


def q_last_reward_literal(spark, sf_dir):
    from ..operators.history import last_reward_literal
    from ..operators.fallback import attach_hot, fill_with_hot
    from .recommend import rank_writes, scored_rows, window_end_times
    fx = Fixture.prepared(spark, sf_dir)
    rows = scored_rows(fx, "ddpg", K.N_REC)
    rows = fill_with_hot(attach_hot(rows, rank_writes(fx), times=window_end_times(fx.records)))
    out = last_reward_literal(rows, "user_id", "window_end", "raw_user", "items", "item_rec")
    return out.select("user_id", "raw_user", "window_end", "last_reward")


# ---------------------------------------------------------------- sinks

def _mapped(fx):
    from .popular import mapped_records
    return mapped_records(fx.records, fx.user_map, fx.item_map)


def q_record_log(spark, sf_dir):
    from ..operators.sinks import record_log
    return record_log(_mapped(Fixture.prepared(spark, sf_dir)))


def q_user_consumed(spark, sf_dir):
    from ..operators.sinks import user_consumed
    return user_consumed(_mapped(Fixture.prepared(spark, sf_dir)))


def q_user_consumed_literal(spark, sf_dir):
    from ..operators.sinks import user_consumed_literal
    return user_consumed_literal(_mapped(Fixture.prepared(spark, sf_dir)))


def q_unique_records(spark, sf_dir):
    from ..operators.sinks import unique_records
    return unique_records(_mapped(Fixture.prepared(spark, sf_dir)))


def q_wire_messages(spark, sf_dir):
    from ..operators.sinks import wire_messages
    return wire_messages(Fixture.prepared(spark, sf_dir).records)


def q_top_table(spark, sf_dir):
    from ..operators.sinks import top_table
    fx = Fixture.prepared(spark, sf_dir)
    return top_table(hot_list(popular_items(fx.records, fx.item_map, K.TOP_N)))


# ---------------------------------------------------------------- file sources

def _scratch(spark, name):
    import uuid
    from ..session import scratch_path
    return scratch_path(spark, f"derived/{name}-{uuid.uuid4().hex[:12]}")


def _write_behaviour_csv(fx, header: bool) -> str:
    """Behaviour CSV derived from ``events``: user,item,value,time_ms,event_type."""
    path = _scratch(fx.spark, "behaviour-csv")
    rows = fx.table("events").select(
        F.col("user_id").cast("string"), F.get_json_object("props", "$.k"),
        F.col("value").cast("string"),
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.col("event_type"))
    rows.write.option("header", str(header).lower()).csv(path)
    return path


def q_read_events_csv(spark, sf_dir):
    from ..sources.events import read_events_csv
    fx = Fixture.prepared(spark, sf_dir)
    return read_events_csv(spark, _write_behaviour_csv(fx, False)).select("user_id", "item_id", "time_ms")


def q_read_text_tolerant(spark, sf_dir):
    from ..sources.events import read_text_tolerant
    fx = Fixture.prepared(spark, sf_dir)
    return read_text_tolerant(spark, _write_behaviour_csv(fx, True))


def q_read_id_map(spark, sf_dir):
    from ..sources.dimensions import read_id_map, write_id_map
    fx = Fixture.prepared(spark, sf_dir)
    path = _scratch(spark, "user-map-json")
    write_id_map(fx.user_map, path)
    return read_id_map(spark, path)


def q_read_embeddings(spark, sf_dir):
    from ..sources.dimensions import read_embeddings, write_embeddings
    from .fixtures import EMBED_DIM
    fx = Fixture.prepared(spark, sf_dir)
    path = _scratch(spark, "embeddings-json")
    write_embeddings(fx.user_vectors, fx.item_vectors, path, EMBED_DIM)
    return read_embeddings(spark, path)


# ---------------------------------------------------------------- streams over the event table

def _raw_event_stream(spark, sf_dir):
    """The records as a file stream of ``events``."""
    from ..sources.tables import records_from_events
    schema = Fixture.prepared(spark, sf_dir).table("events").schema
    # a file source wants a folder or a pattern; the table may be either
    return records_from_events(
        spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]"))


def _event_stream(spark, sf_dir):
    """The records with mapped ids as a file stream of ``events``."""
    from ..operators.lookup import map_ids
    fx = Fixture.prepared(spark, sf_dir)
    rec = map_ids(_raw_event_stream(spark, sf_dir), "user_id", fx.user_map, oov=fx.user_map.count())
    return map_ids(rec, "item_id", fx.item_map, oov=fx.item_map.count()).select(
        F.col("user_id").cast("bigint").alias("user_id"), "item_id", "ts", "event_id")


def _run_stream(df, spark, name, path=None, foreach=None):
    w = df.writeStream.option("checkpointLocation", _scratch(spark, f"{name}-checkpoint")).trigger(availableNow=True)
    q = w.foreachBatch(foreach).start() if foreach else w.format("parquet").option("path", path).start()
    q.awaitTermination()


def q_record_log_stream(spark, sf_dir):
    from ..streaming.persist import record_log_stream
    path = _scratch(spark, "record-log")
    _run_stream(record_log_stream(_event_stream(spark, sf_dir)), spark, "record-log", path)
    return spark.read.parquet(path)


def q_unique_records_stream(spark, sf_dir):
    from ..streaming.persist import read_unique_records, unique_records_batch
    path = _scratch(spark, "unique-records")
    _run_stream(_event_stream(spark, sf_dir), spark, "unique-records", foreach=unique_records_batch(path))
    return read_unique_records(spark, path)


def q_user_consumed_stream(spark, sf_dir):
    from ..streaming.persist import consumed_pairs_batch, read_user_consumed
    path = _scratch(spark, "consumed-pairs")
    _run_stream(_event_stream(spark, sf_dir), spark, "consumed-pairs", foreach=consumed_pairs_batch(path))
    return read_user_consumed(spark, path)


def _rocksdb(spark):
    """State of any size stays off the heap; the stateful processors need it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def q_top_n_items_stream(spark, sf_dir):
    """The windows that the ascending watermark closes."""
    from ..streaming.popular import popular_items_stream
    _rocksdb(spark)
    path = _scratch(spark, "popular-items")
    _run_stream(popular_items_stream(_event_stream(spark, sf_dir)), spark, "popular-items", path)
    return spark.read.schema("window_end long, rank int, item_id int, cnt long").parquet(path)


def q_user_history_stream(spark, sf_dir):
    """The windows that the 10 s watermark closes."""
    from ..streaming.history import HISTORY_OUT, user_history_stream
    _rocksdb(spark)
    path = _scratch(spark, "user-history")
    _run_stream(user_history_stream(_raw_event_stream(spark, sf_dir)), spark, "user-history", path)
    return spark.read.schema(HISTORY_OUT).parquet(path)


def q_last_reward_stream(spark, sf_dir):
    """Rewards of the written recommendation rows, read back as a stream of several batches."""
    from ..operators.segments import CHUNK_ROWS
    from .jobs import start_reward_job
    from .recommend import recommendations
    recs, path = _scratch(spark, "recommendations"), _scratch(spark, "rewards")
    fx = Fixture.prepared(spark, sf_dir)
    rows = recommendations(fx, scorer_failed=True).select(
        "user_id", "raw_user", "window_end", "items", "item_rec")
    # files of ascending window ends, as the recommendation job leaves them: an event opens
    # HIST_WINDOW / HIST_SLIDE windows at most, and a file has about CHUNK_ROWS rows whatever their number
    most = fx.records.count() * (K.HIST_WINDOW_SEC // K.HIST_SLIDE_SEC)
    cuts = rows.repartitionByRange(max(3, -(-most // CHUNK_ROWS)), "window_end", "raw_user").sortWithinPartitions("window_end")
    cuts.write.parquet(recs)
    start_reward_job(spark, recs, path, _scratch(spark, "rewards-checkpoint"), {"availableNow": True}).awaitTermination()
    return spark.read.parquet(path).select("user_id", "raw_user", "window_end", "last_reward")


def q_recommend_stream(spark, sf_dir):
    """The whole chain as streams: popular items to a rank log; histories scored and filled from the
    log as of their window end; rewards.  The windows that the 10 s watermark closes."""
    from .jobs import start_history_job, start_popular_job, start_reward_job
    from .recommend import fixture_catalog, fixture_models
    from ..streaming.popular import RankLog
    _rocksdb(spark)
    fx, now = Fixture.prepared(spark, sf_dir), {"availableNow": True}
    log, recs, path = RankLog(_scratch(spark, "rank-log")), _scratch(spark, "recommendations"), _scratch(spark, "rewards")
    start_popular_job(_event_stream(spark, sf_dir), None, log, _scratch(spark, "popular-checkpoint"),
                      trigger=now).awaitTermination()
    raw = map_ids(_raw_event_stream(spark, sf_dir), "item_id", fx.item_map, oov=fx.item_map.count())
    start_history_job(raw, fx.user_map, fx.user_vectors, fixture_models(fx.item_map.count())["ddpg"], fixture_catalog(fx),
                      log, recs, _scratch(spark, "history-checkpoint"), trigger=now).awaitTermination()
    start_reward_job(spark, f"{recs}/*", path, _scratch(spark, "rewards-checkpoint"), now).awaitTermination()
    return spark.read.parquet(path).select("user_id", "raw_user", "window_end", "time", "item_rec", "last_reward")


def _ranked_rows(spark, sf_dir, n):
    from ..streaming.panes import pane_counts_stream, ranked_batch
    _rocksdb(spark)
    path = _scratch(spark, "pane-ranks")

    def publish(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    _run_stream(pane_counts_stream(_event_stream(spark, sf_dir)), spark, "pane-ranks", foreach=ranked_batch(publish, n))
    return spark.read.schema("window_end long, rank int, item_id int, cnt long").parquet(f"{path}/*")


def q_top_n_panes_stream(spark, sf_dir):
    """Top N of the windows that the watermark closes, from a ring of panes an item."""
    return _ranked_rows(spark, sf_dir, K.TOP_N)


def q_rank_all_panes_stream(spark, sf_dir):
    """Every item ranked (D3), from the same stream."""
    return _ranked_rows(spark, sf_dir, None)


def q_late_rows_stream(spark, sf_dir):
    """The events, read in four batches that overlap in time, as kept and late records."""
    from ..streaming.late import marked_stream, read_split, split_late_batch
    _rocksdb(spark)
    inbox, path = _scratch(spark, "event-cuts"), _scratch(spark, "split")
    rec = Fixture.prepared(spark, sf_dir).records
    schema = "user_id long, item_id int, ts timestamp, event_id long"
    split, checkpoint = split_late_batch(path), _scratch(spark, "split-checkpoint")
    for cut in range(4):  # the same query, restarted for each arrival
        rec.where(F.pmod("event_id", F.lit(4)) == cut).select("user_id", "item_id", "ts", "event_id") \
            .write.mode("append").parquet(inbox)
        (marked_stream(spark.readStream.schema(schema).parquet(inbox)).writeStream.option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).foreachBatch(split).start().awaitTermination())
    return (read_split(spark, path, "kept").select("event_id", "user_id", "item_id", F.lit(False).alias("late"))
            .union(read_split(spark, path, "late").select("event_id", "user_id", "item_id", F.lit(True))))


def q_user_consumed_chunks(spark, sf_dir):
    from ..operators.sinks import consumed_chunks
    return consumed_chunks(_mapped(Fixture.prepared(spark, sf_dir)))


def q_user_consumed_literal_chunks(spark, sf_dir):
    from ..operators.sinks import consumed_chunks
    return consumed_chunks(_mapped(Fixture.prepared(spark, sf_dir)), drop_first=True)


def q_user_consumed_chunks_stream(spark, sf_dir):
    from ..streaming.persist import consumed_pairs_batch, read_consumed_chunks
    path = _scratch(spark, "consumed-pairs")
    _run_stream(_event_stream(spark, sf_dir), spark, "consumed-pairs", foreach=consumed_pairs_batch(path))
    return read_consumed_chunks(spark, path)


def q_hot_store_stream(spark, sf_dir):
    """the current hot list that the popularity job leaves in its store."""
    from ..operators.sinks import top_table
    from ..streaming.popular import read_hot_store
    from .jobs import start_popular_job
    _rocksdb(spark)
    store = _scratch(spark, "hot-store")
    start_popular_job(_event_stream(spark, sf_dir), None, store, _scratch(spark, "hot-checkpoint"),
                      trigger={"availableNow": True}).awaitTermination()
    return top_table(read_hot_store(spark, store))


def q_wire_topic_stream(spark, sf_dir):
    """Events published as wire messages, read back as a topic and decoded.  The
    topic is a folder here; on a cluster the same two jobs take ``kafka``."""
    from ..sources.events import decode_records, read_events_stream
    from .jobs import start_publish_job
    fx, topic, path, now = Fixture.prepared(spark, sf_dir), _scratch(spark, "topic"), _scratch(spark, "decoded"), {"availableNow": True}
    start_publish_job(_raw_event_stream(spark, sf_dir), _scratch(spark, "topic-checkpoint"), "parquet", path=topic,
                      trigger=now).awaitTermination()
    infer = "spark.sql.streaming.schemaInference"
    old = spark.conf.get(infer)
    spark.conf.set(infer, "true")
    try:
        lines = read_events_stream(spark, "parquet", {"path": topic})
    finally:
        spark.conf.set(infer, old)
    _run_stream(decode_records(lines, fx.user_map, fx.item_map).select("user_id", "item_id", "time_ms"), spark, "decoded", path)
    return spark.read.parquet(path)


def q_recommend_by_name(spark, sf_dir):
    """The lists of every algorithm that can be asked for by name."""
    out = None
    for algo in K.ALGOS:
        rows = _recommend_query(algo)(spark, sf_dir).withColumn("algo", F.lit(algo))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_history_store_stream(spark, sf_dir):
    """Each user's last items, read from the state of a stream that went on from a batch
    history of the first half and was restarted."""
    from ..operators.history import user_history
    from ..streaming.history import history_store_stream, read_history_store
    _rocksdb(spark)
    rec, checkpoint, path = Fixture.prepared(spark, sf_dir).records, _scratch(spark, "history-store"), _scratch(spark, "history-rows")
    lo, hi = rec.agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts"))).first()
    since = (lo + hi) // 2 // (K.HIST_SLIDE_SEC * 1000) * (K.HIST_SLIDE_SEC * 1000)
    initial = (user_history(rec).where(F.col("window_end") <= since).groupBy("user_id")
               .agg(F.max_by("items", "window_end").alias("items")))
    for _ in range(2):
        rows = history_store_stream(_raw_event_stream(spark, sf_dir), initial, since)
        (rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet")
         .option("path", path).start().awaitTermination())
    return read_history_store(spark, checkpoint)


QUERIES: dict[str, Query] = {
    "sliding_counts": q_sliding_counts,
    "sliding_counts_paned": q_sliding_counts_paned,
    "top_n_items": q_top_n_items,
    "rank_all_items": q_rank_all_items,
    "hot_list": q_hot_list,
    "build_id_map": q_build_id_map,
    "filter_min_interactions": q_filter_min_interactions,
    "merge_features": q_merge_features,
    "map_ids": q_map_ids,
    "map_id_arrays": q_map_id_arrays,
    "format_time": q_format_time,
    "encode_wire": q_encode_wire,
    "decode_records": q_decode_records,
    "explode_ranks": q_explode_ranks,
    "user_windows": q_user_windows,
    "user_history": q_user_history,
    "user_history_dedup": q_user_history_dedup,
    "full_history": q_full_history,
    "hot_list_asof": q_hot_list_asof,
    "actor_action": q_actor_action,
    "recommend_actor": _recommend_query("ddpg"),
    "recommend_policy": _recommend_query("reinforce"),
    "recommend_constrained": _recommend_query("bcq"),
    "recommend_state": _recommend_state_query("ddpg"),
    "recommend_state_policy": _recommend_state_query("reinforce"),
    "recommend_state_constrained": _recommend_state_query("bcq"),
    "recommend_policy_blocked": q_recommend_policy_blocked,
    "topk_per_key": q_topk_per_key,
    "state_vector": q_state_vector,
    "scoring_requests": q_scoring_requests,
    "scoring_requests_state": q_scoring_requests_state,
    "decode_scores": q_decode_scores,
    "fill_with_hot": _pipeline_query(k=5),
    "fallback_hot": _pipeline_query(scorer_failed=True),
    "recommend_pipeline": _pipeline_query(),
    "last_reward": q_last_reward,
    "last_reward_literal": q_last_reward_literal,
    "record_log": q_record_log,
    "user_consumed": q_user_consumed,
    "user_consumed_literal": q_user_consumed_literal,
    "unique_records": q_unique_records,
    "wire_messages": q_wire_messages,
    "top_table": q_top_table,
    "read_events_csv": q_read_events_csv,
    "read_text_tolerant": q_read_text_tolerant,
    "read_id_map": q_read_id_map,
    "read_embeddings": q_read_embeddings,
    "record_log_stream": q_record_log_stream,
    "unique_records_stream": q_unique_records_stream,
    "user_consumed_stream": q_user_consumed_stream,
    "top_n_items_stream": q_top_n_items_stream,
    "user_history_stream": q_user_history_stream,
    "last_reward_stream": q_last_reward_stream,
    "recommend_stream": q_recommend_stream,
    "top_n_panes_stream": q_top_n_panes_stream,
    "rank_all_panes_stream": q_rank_all_panes_stream,
    "late_rows_stream": q_late_rows_stream,
    "history_store_stream": q_history_store_stream,
    "user_consumed_chunks": q_user_consumed_chunks,
    "user_consumed_literal_chunks": q_user_consumed_literal_chunks,
    "user_consumed_chunks_stream": q_user_consumed_chunks_stream,
    "hot_store_stream": q_hot_store_stream,
    "wire_topic_stream": q_wire_topic_stream,
    "recommend_by_name": q_recommend_by_name,
}
