"""Hot-list completion: G7 ``fill_with_hot`` and G8 ``fallback_hot``.

Both read the rank store as it stood at the row's time (D5 as-of rows,
collected per time into at most N (rank, item) pairs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .ranking import hot_on_grid, snap


def _hot_items_upto(hot: Column, upto: Column) -> Column:
    """Items of hot ranks 1..upto; a rank missing from the store is skipped."""
    return F.transform(F.filter(hot, lambda h: h["rank"] <= upto), lambda h: h["item"])


def attach_hot(df: DataFrame, top: DataFrame, time_col: str = "window_end",
               n: int = K.TOP_N, times: DataFrame | None = None,
               grid_ms: int = K.POP_SLIDE_SEC * 1000) -> DataFrame:
    """Attach to each row the hot list as of its time: ``hot`` =
    ARRAY<STRUCT<rank, item>> in rank order (at most N entries).

    Rows are joined by their grid point (writes happen only on the slide
    grid), so no per-time expansion is needed.  ``times`` (column ``t``) may
    give a cheaper superset of the rows' times (e.g. derived from the
    events) so that ``df`` is not computed twice.
    """
    src = times.select(F.col("t").alias("_t")) if times is not None else \
        df.select(F.col(time_col).alias("_t"))
    grid = src.select(snap("_t", grid_ms).alias("g")).distinct()
    hot = hot_on_grid(top, grid, n).groupBy("g").agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col("item_id").alias("item")))).alias("hot"))
    out = df.withColumn("_g", snap(time_col, grid_ms)) \
        .join(hot.withColumnRenamed("g", "_g"), "_g", "left").drop("_g")
    return out.withColumn(
        "hot", F.coalesce(F.col("hot"), F.array().cast("array<struct<rank:int,item:int>>")))


def fill_with_hot(df: DataFrame, n_rec: int = K.N_REC, rec: str = "item_rec",
                  hot: str = "hot") -> DataFrame:
    """Fewer than ``n_rec`` results -> append hot ranks 1..missing, in
    rank order, no de-duplication (a hot item may repeat a scored one)."""
    missing = F.greatest(F.lit(n_rec) - F.size(rec), F.lit(0))
    return df.withColumn(rec, F.concat(F.col(rec), _hot_items_upto(F.col(hot), missing)))


def fallback_hot(df: DataFrame, n_rec: int = K.N_REC, rec: str = "item_rec",
                 hot: str = "hot") -> DataFrame:
    """No scorer result (NULL) -> hot ranks 1..n_rec only."""
    return df.withColumn(rec, F.coalesce(F.col(rec), _hot_items_upto(F.col(hot), F.lit(n_rec))))
