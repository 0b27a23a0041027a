"""Sequence-recommendation job (batch form of the reference's SeqRecommend):

events -> item ids mapped -> per-user history across 60 s / 20 s windows ->
user id mapped -> full histories only -> score (ddpg / reinforce / bcq) ->
hot-list fill as of the window end -> last reward -> (user, recs, time, reward).

Item ids are mapped at the event (one join on events instead of exploding
histories); mapping is element-wise, so the histories are the same as
mapping afterwards (SURVEY Q6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import format_time
from ..operators.fallback import attach_hot, fallback_hot, fill_with_hot
from ..operators.history import full_history, last_reward, user_history
from ..operators.lookup import map_ids, state_vector
from ..operators.windows import assign_windows
from ..session import materialize
from ..operators.scoring import (MAX_SHIPPED_BYTES, ActorModel, ConstrainedModel, ItemCatalog, Layer, PolicyModel,
                                 head_bytes, recommend)
from .fixtures import EMBED_DIM, HIDDEN, Fixture, dyadic_matrix
from .popular import popular_items


def window_end_times(records: DataFrame, window_sec: int = K.HIST_WINDOW_SEC,
                     slide_sec: int = K.HIST_SLIDE_SEC) -> DataFrame:
    """Every history window end that any event opens (a superset of the
    recommendation times), straight from the events: (t)."""
    return assign_windows(records.select("ts"), window_sec, slide_sec) \
        .select(F.col("window_end").alias("t")).distinct()


def rank_writes(fx: Fixture) -> DataFrame:
    """Per-window top N, written once: what the popularity job leaves in the
    rank store and the as-of readers read more than once."""
    return materialize(popular_items(fx.records, fx.item_map, K.TOP_N), "rank_writes")


def checkpoint_rows(df: DataFrame) -> DataFrame:
    return materialize(df, "recommendations")


def history_rows(records: DataFrame, user_map: DataFrame, item_map: DataFrame,
                 hist: int = K.HIST_LEN) -> DataFrame:
    """(raw_user, user_id dense, window_end, items dense) for full histories."""
    mapped = map_ids(records, "item_id", item_map)
    h = user_history(mapped, "user_id", hist).withColumnRenamed("user_id", "raw_user")
    h = map_ids(h, "raw_user", user_map, out_col="user_id")
    return full_history(h, hist)


def with_user_vectors(rows: DataFrame, user_vecs: DataFrame, key: str = "user_id") -> DataFrame:
    """``user_vec`` by ``key``; of ``raw_user`` no value is shared by the users outside the dictionary."""
    uv = user_vecs.select(F.col("id").alias(key), F.col("vec").alias("user_vec"))
    return rows.join(uv, key, "left")


def fixture_models(n_items: int, dim: int = EMBED_DIM, hidden: int = HIDDEN,
                   hist: int = K.HIST_LEN, noise: bool = False) -> dict:
    """Models with the fixture weights (dyadic rule, every layer its own shape)."""
    inp = dim * (hist + 1)

    def L(o, i):
        return Layer(*dyadic_matrix(o, i))
    latent = 2 * dim
    return {
        "ddpg": ActorModel(L(hidden, inp), L(hidden, hidden), L(dim, hidden)),
        "reinforce": PolicyModel(L(hidden, inp), L(hidden, hidden), L(n_items, hidden)),
        "bcq": ConstrainedModel(L(hidden, inp + latent), L(hidden, hidden), L(dim, hidden),
                                L(hidden, inp + dim), L(hidden, hidden), L(dim, hidden),
                                latent=latent, noise=noise),
    }


def fixture_catalog(fx: Fixture) -> ItemCatalog:
    """The shipped catalog (row count checked in ``from_frame``), built once
    per prepared fixture."""
    if "catalog" not in fx._cache:
        n = fx.item_map.count()
        fx._cache["catalog"] = ItemCatalog.from_frame(fx.item_vectors, EMBED_DIM, oov_id=n)
    return fx._cache["catalog"]


def score(fx: Fixture, rows: DataFrame, model, k: int = K.N_REC, state_col: str | None = None,
          seed_cols: tuple[str, ...] = (), max_bytes: int = MAX_SHIPPED_BYTES) -> DataFrame:
    """Score ``rows`` against the fixture's items: with the shipped catalog if
    it and the policy's head have at most ``max_bytes``, else block by block; the lists are the same."""
    small = not isinstance(getattr(model, "head", None), DataFrame) and head_bytes(model) <= max_bytes
    if small and ItemCatalog.size_in_bytes(fx.item_vectors, EMBED_DIM, oov_id=fx.item_map.count()) <= max_bytes:
        return recommend(rows, model, fixture_catalog(fx), k, state_col=state_col, seed_cols=seed_cols)
    if state_col is None:
        rows = state_vector(rows.drop("user_vec"), ["raw_user", "window_end"], "raw_user", "items",
                            fx.raw_user_vectors, fx.item_vectors, EMBED_DIM, width=K.HIST_LEN)
    return recommend(rows, model, None, k, state_col=state_col or "state", seed_cols=seed_cols,
                     item_vecs=fx.item_vectors, blocked=True)


def scored_rows(fx: Fixture, algo: str = "ddpg", k: int = K.N_REC, noise: bool = False) -> DataFrame:
    from ..operators.scoring import model_for
    model = model_for(algo, fixture_models(fx.item_map.count(), noise=noise))
    rows = with_user_vectors(history_rows(fx.records, fx.user_map, fx.item_map), fx.raw_user_vectors, "raw_user")
    return score(fx, rows, model, k, seed_cols=("raw_user", "window_end")).drop("user_vec")


def recommendations(fx: Fixture, algo: str = "ddpg", n_rec: int = K.N_REC,
                    k: int | None = None, scorer_failed: bool = False,
                    noise: bool = False) -> DataFrame:
    """The chain up to the filled lists: (raw_user, user_id, window_end,
    items, item_rec).  ``k`` < ``n_rec`` asks the scorer for fewer items so
    the hot fill (G7) completes the list; ``scorer_failed`` takes the
    reference's bad-response branch (G8)."""
    if scorer_failed:
        rows = history_rows(fx.records, fx.user_map, fx.item_map) \
            .withColumn("item_rec", F.lit(None).cast("array<int>"))
    else:
        rows = scored_rows(fx, algo, k or n_rec, noise)
    rows = attach_hot(rows, rank_writes(fx), "window_end", times=window_end_times(fx.records))
    rows = fallback_hot(rows, n_rec) if scorer_failed else fill_with_hot(rows, n_rec)
    return rows.drop("hot")


def recommend_pipeline(fx: Fixture, algo: str = "ddpg", n_rec: int = K.N_REC,
                       k: int | None = None, scorer_failed: bool = False,
                       noise: bool = False) -> DataFrame:
    """The whole chain, ``recommendations`` and their rewards."""
    # The reward reads the recommendations twice (within and across window
    # ends): materialise them once in the checkpoint folder, as the
    # reference's job writes them to its result store.
    rows = checkpoint_rows(recommendations(fx, algo, n_rec, k, scorer_failed, noise))
    rows = last_reward(rows, "user_id", "window_end", "raw_user", "items", "item_rec")
    return rows.select("user_id", "raw_user", "window_end",
                       format_time("window_end").alias("time"), "item_rec", "last_reward")
