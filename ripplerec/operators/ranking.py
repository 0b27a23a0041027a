"""Ranking and hot lists: D2 ``top_n_items``, D3 ``rank_all_items``, D4
``hot_list``, D5 ``hot_list_asof``, B6 ``explode_ranks``, G6 ``topk_per_key``.

Ties are always broken by item id ascending (SURVEY Q2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K


def topk_per_key(df: DataFrame, key: str | list[str], score: str, item: str,
                 k: int | None, rank_col: str = "rank") -> DataFrame:
    """Rank rows per ``key`` by ``score`` desc, ``item`` asc; keep ``k``.

    ``row_number`` followed by ``rank <= k`` is planned with a partial
    WindowGroupLimit before the shuffle, so at most k rows per key leave each
    map task -- a hot key does not ship its whole group.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(item).asc())
    out = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        out = out.where(F.col(rank_col) <= k)
    return out


def top_n_items(counts: DataFrame, n: int | None = K.TOP_N, key: str = "item_id") -> DataFrame:
    """Per window end, items by count desc -> (window_end, rank, item_id, cnt)."""
    ranked = topk_per_key(counts, "window_end", "cnt", key, n)
    return ranked.select("window_end", "rank", key, "cnt")


def rank_all_items(counts: DataFrame, key: str = "item_id") -> DataFrame:
    """D3: what the reference's code emits -- every item ranked (no limit)."""
    return top_n_items(counts, None, key)


def explode_ranks(df: DataFrame, list_col: str, keys: list[str],
                  item_col: str = "item_id") -> DataFrame:
    """Ordered list -> one (keys.., rank from 1, item) row per element."""
    return df.select(*keys, F.posexplode(list_col).alias("_pos", item_col)) \
        .select(*keys, (F.col("_pos") + 1).cast("int").alias("rank"), item_col)


def hot_list(top: DataFrame, key: str = "item_id") -> DataFrame:
    """The rank -> item store after all windows: last write per rank.

    ``max_by`` is a partial aggregate, so each map task sends one row per rank.
    """
    return top.groupBy("rank").agg(F.max_by(key, "window_end").alias(key))


def snap(t, grid_ms: int | None):
    """Grid point of a time: the answer of the rank store at T equals the
    answer at floor(T) on the write grid, since writes happen only there."""
    return F.col(t) if not grid_ms else F.floor(F.col(t) / F.lit(grid_ms)) * F.lit(grid_ms)


def hot_on_grid(top: DataFrame, grid: DataFrame, n: int = K.TOP_N,
                key: str = "item_id", chunk_ms: int = 86_400_000) -> DataFrame:
    """(g) grid points -> (g, rank, item): per rank, the item of the latest
    write with window_end <= g.

    A parallel prefix scan over time, not one ordered pass per rank (which
    would run in only N tasks): (1) the last write per (time chunk, rank), a
    table of chunks x N rows; (2) the value carried into each chunk, a
    forward fill over that small table; (3) per (chunk, rank) the writes and
    grid points are ordered and the last item carried forward, starting from
    the carried-in value.  Work is bounded by the time span (grid points x
    ranks), spread over chunks x ranks tasks.
    """
    chunk = lambda c: F.floor(F.col(c) / F.lit(chunk_ms)).cast("bigint")
    ranks = F.explode(F.sequence(F.lit(1), F.lit(n))).alias("rank")
    probes = grid.select(F.col("g").cast("bigint").alias("at"), ranks).select(
        chunk("at").alias("chunk"), "at", "rank", F.lit(None).cast("int").alias(key),
        F.lit(1).alias("kind"))
    writes = top.where(F.col("rank") <= n).select(
        F.col("window_end").cast("bigint").alias("at"), "rank", F.col(key).cast("int").alias(key)) \
        .select(chunk("at").alias("chunk"), "at", "rank", key, F.lit(0).alias("kind"))
    # (1) last write per (chunk, rank); (2) carried into each chunk that has rows
    last = writes.groupBy("chunk", "rank").agg(F.max_by(key, "at").alias("_last"))
    chunks = probes.select("chunk").union(writes.select("chunk")).distinct() \
        .select("chunk", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("rank"))
    before = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.join(last, ["chunk", "rank"], "left") \
        .select("chunk", (F.col("chunk") * F.lit(chunk_ms) - 1).alias("at"), "rank",
                F.last("_last", ignorenulls=True).over(before).alias(key), F.lit(0).alias("kind"))
    # (3) ordered fill inside each (chunk, rank), the carried value first
    rows = probes.unionByName(writes).unionByName(carry)
    w = Window.partitionBy("chunk", "rank").orderBy("at", "kind") \
        .rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumn("_v", F.last(key, ignorenulls=True).over(w))
    return filled.where((F.col("kind") == 1) & F.col("_v").isNotNull()) \
        .select(F.col("at").alias("g"), "rank", F.col("_v").alias(key))


def hot_list_asof(top: DataFrame, times: DataFrame, time_col: str = "t",
                  n: int = K.TOP_N, key: str = "item_id",
                  grid_ms: int | None = K.POP_SLIDE_SEC * 1000) -> DataFrame:
    """What a reader of the rank store saw at time T, per rank.

    For each T and rank: the item of the latest write with window_end <= T.
    A rank that a later, shorter window did not write stays stale.  Times
    are snapped to the write grid, answered there (``hot_on_grid``) and
    joined back by equality.
    """
    q = times.select(F.col(time_col).cast("bigint").alias("t")).distinct() \
        .withColumn("g", snap("t", grid_ms))
    grid = q.select("g").distinct()
    return q.join(hot_on_grid(top, grid, n, key), "g").select("t", "rank", key)


def hot_arrays(asof: DataFrame, key: str = "item_id") -> DataFrame:
    """(t, rank, item) -> (t, hot ARRAY<STRUCT<rank,item>>) in rank order (<= N per t)."""
    return asof.groupBy("t").agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col(key).alias("item")))).alias("hot"))
