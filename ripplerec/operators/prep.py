"""Preparation steps the reference documents (README: filter, merge, id maps).

H1 ``filter_min_interactions``, H2 ``merge_features``, H3 ``build_id_map``
plus ``vocabulary`` (H1 applied to a key, giving the ids a dictionary keeps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interaction_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, cnt): partial aggregation before the shuffle, so a key holding a
    third of all rows costs one row per map task, not a third of the data."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def _threshold(counts: DataFrame, min_count: int | None, min_share: float | None):
    if (min_count is None) == (min_share is None):
        raise ValueError("give exactly one of min_count / min_share")
    if min_count is not None:
        return F.lit(int(min_count))
    # Relative threshold: a share of the mean count per key (scale-free).  The
    # mean is a scalar subquery, planned once and not joined to every row.
    return F.lit(float(min_share)) * counts.select(F.avg("cnt")).scalar()


def vocabulary(df: DataFrame, key: str, min_count: int | None = None,
               min_share: float | None = None) -> DataFrame:
    """Distinct ``key`` values with enough interactions, as a one-column frame."""
    counts = interaction_counts(df, key)
    return counts.where(F.col("cnt") >= _threshold(counts, min_count, min_share)).select(key)


def filter_min_interactions(df: DataFrame, key: str, min_count: int | None = None,
                            min_share: float | None = None) -> DataFrame:
    """H1: keep rows whose ``key`` has at least the threshold of interactions.

    A left-semi join against the qualifying keys: no window over a key, so a
    hot key is never pulled into one task; AQE splits a skewed join partition.
    """
    keep = vocabulary(df, key, min_count, min_share)
    return df.join(keep, on=key, how="left_semi")


def merge_features(behaviour: DataFrame, users: DataFrame, items: DataFrame,
                   user_key: tuple[str, str], item_key: tuple[str, str]) -> DataFrame:
    """H2: merge a behaviour table with its user and item tables (equi joins).

    ``user_key``/``item_key`` are (behaviour column, dimension column).  Spark
    picks broadcast or sort-merge from measured sizes.
    """
    out = behaviour.join(users, behaviour[user_key[0]] == users[user_key[1]], "inner")
    return out.join(items, out[item_key[0]] == items[item_key[1]], "inner")


def _count_below(c, bounds: list[int]):
    """Number of sorted ``bounds`` below ``c``, as a balanced CASE WHEN binary
    search (log2 of the bound count comparisons per row, no lambda)."""
    def node(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c <= F.lit(bounds[mid]).cast("bigint"), node(lo, mid)).otherwise(node(mid + 1, hi))
    return node(0, len(bounds))


def build_id_map(ids: DataFrame, col: str, buckets: int | None = None,
                 rel_error: float = 0.001) -> DataFrame:
    """H3: raw id -> dense id 0..n-1 in raw-id order, as (raw_id, dense_id).

    A global ``row_number`` would sort every id in one task.  Instead ids are
    cut into range buckets at approximate quantiles (only the bucket bounds
    reach the driver), numbered inside each bucket in parallel, and shifted
    by the exact prefix count of the earlier buckets (one row per bucket).
    """
    spark = ids.sparkSession
    distinct_ids = ids.select(F.col(col).cast("bigint").alias("raw_id")).distinct()
    n_b = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / n_b for i in range(1, n_b)]
    bounds = sorted(set(distinct_ids.approxQuantile("raw_id", probs, rel_error))) if probs else []
    bucket = _count_below(F.col("raw_id"), [int(b) for b in bounds])
    bucketed = distinct_ids.withColumn("bucket", bucket)
    sizes = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # At most n_b rows: a proven bound, so broadcasting it is safe.
    offsets = sizes.select(
        "bucket",
        F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    local = bucketed.withColumn(
        "local", F.row_number().over(Window.partitionBy("bucket").orderBy("raw_id")) - 1)
    return local.join(F.broadcast(offsets), "bucket").select(
        "raw_id", (F.col("offset") + F.col("local")).cast("int").alias("dense_id"))


def dictionary_size(id_map: DataFrame):
    """Out-of-vocabulary code = dictionary size, as a scalar-subquery column."""
    return id_map.select(F.count(F.lit(1)).cast("int")).scalar()
