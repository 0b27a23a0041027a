"""Dictionary and embedding lookups: B3 ``map_ids``, B4 ``map_id_arrays``,
B7 ``state_vector``.

Dictionaries are dimension tables joined by key.  Spark chooses broadcast
(measured size under the threshold) or sort-merge join; AQE re-plans on
runtime sizes and splits skewed partitions.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prep import dictionary_size

# Largest vector table (rows x dim x 8 bytes) shipped whole to every task.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def map_ids(df: DataFrame, col: str, id_map: DataFrame, out_col: str | None = None,
            oov: int | Column | None = None) -> DataFrame:
    """Replace ``col`` by its dense id; unknown ids get the OOV code
    (= dictionary size).  Left join: every input row is kept."""
    out_col = out_col or col
    m = id_map.select(F.col("raw_id").alias("_raw"), F.col("dense_id").alias("_dense"))
    oov_col = dictionary_size(id_map) if oov is None else (
        oov if isinstance(oov, Column) else F.lit(int(oov)))
    joined = df.join(m, df[col].cast("bigint") == m["_raw"], "left")
    return joined.withColumn(out_col, F.coalesce(F.col("_dense"), oov_col).cast("int")) \
        .drop("_raw", "_dense")


def map_id_arrays(df: DataFrame, keys: list[str], col: str, id_map: DataFrame,
                  out_col: str | None = None, oov: int | Column | None = None) -> DataFrame:
    """Map every element of array ``col``; order and repeats are kept.

    ``keys`` identify a row.  Elements are exploded with their position,
    joined, and gathered back in position order (at most the array length per
    row, so the regroup is bounded).
    """
    out_col = out_col or col
    exploded = df.select(*keys, F.posexplode(col).alias("_pos", "_raw_el"))
    mapped = map_ids(exploded, "_raw_el", id_map, out_col="_el", oov=oov)
    back = mapped.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_el"))).alias("_pairs"))
    back = back.select(*keys, F.transform("_pairs", lambda p: p["_el"]).alias(out_col))
    rest = df.drop(out_col) if out_col != col else df.drop(col)
    # Rows with empty arrays produce no exploded element: keep them.
    return rest.join(back, on=keys, how="left").withColumn(
        out_col, F.coalesce(F.col(out_col), F.array().cast("array<int>")))


def state_vector(df: DataFrame, keys: list[str], user_col: str, items_col: str,
                 user_vecs: DataFrame, item_vecs: DataFrame, dim: int,
                 out_col: str = "state", width: int | None = None,
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                 each: Callable[[Column], Column] | None = None) -> DataFrame:
    """User vector ++ each history item's vector, in history order.

    ``user_vecs``/``item_vecs`` are (id INT, vec ARRAY<FLOAT>).  Ids without a
    vector get zeros (the OOV rule, SURVEY Q9).  Result ARRAY<DOUBLE> of
    ``dim * (1 + len(items))`` for lists of any length; with ``width`` a longer
    list is an error, whichever way the vectors are looked up.

    ``width`` (longest history length) and a vector table whose size is checked
    under ``max_broadcast_bytes`` (row count x ``dim`` doubles): one lookup
    per position against a single broadcast of the table (the same build
    side, so Spark reuses one broadcast exchange) -- no shuffle of the rows.
    Otherwise (no ``width``, or a table above the bound): items are exploded
    with their position, joined once (sort-merge, AQE splits a hot item such
    as the OOV id) and gathered back in order -- a regroup bounded by the
    history length per row.  Per-position sort-merge joins are never used:
    each would re-shuffle rows that grow by one vector per step.

    ``each`` maps a vector (ARRAY<DOUBLE>) to an array of what the state is made of instead,
    once per vector of the tables and not per row (``vector_text``: the request's text).
    """
    zero = F.array_repeat(F.lit(0.0).cast("double"), dim)
    if each is None:
        each = lambda v: v
    else:  # a constant of the plan, so that no row makes it again
        made = df.sparkSession.range(1).select(each(zero).alias("z"))
        zero = F.lit(made.first()["z"]).cast(made.schema["z"].dataType)
    as_double = lambda c: F.transform(c, lambda x: x.cast("double"))
    uv = user_vecs.select(F.col("id").alias("_uid"), each(as_double(F.col("vec"))).alias("_uvec"))
    base = df.join(uv, df[user_col] == uv["_uid"], "left").drop("_uid") \
        .withColumn("_uvec", F.coalesce("_uvec", zero))
    iv = item_vecs.select(F.col("id").alias("_iid"), each(as_double(F.col("vec"))).alias("_ivec"))
    none = F.slice(zero, 1, 0)
    if width is not None:
        fits = F.coalesce(F.size(items_col), F.lit(0)) <= width
        base = base.withColumn("_uvec", F.when(fits, F.col("_uvec")).otherwise(
            F.raise_error(F.lit(f"a list of more than {width} items"))))
    if width is not None and item_vecs.count() * dim * 8 <= max_broadcast_bytes:
        small = F.broadcast(iv)
        out = base
        parts = [F.col("_uvec")]
        for p in range(width):
            out = out.join(small, F.get(F.col(items_col), F.lit(p)) == F.col("_iid"), "left") \
                .drop("_iid").withColumnRenamed("_ivec", f"_v{p}")
            parts.append(F.when(F.size(items_col) > p, F.coalesce(F.col(f"_v{p}"), zero))
                         .otherwise(none))
        return out.withColumn(out_col, F.concat(*parts)) \
            .drop("_uvec", *[f"_v{p}" for p in range(width)])
    exploded = df.select(*keys, F.posexplode(items_col).alias("_pos", "_iid"))
    with_vec = exploded.join(iv, "_iid", "left").withColumn("_ivec", F.coalesce("_ivec", zero))
    items = with_vec.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_ivec"))).alias("_pairs"))
    items = items.select(*keys, F.flatten(F.transform("_pairs", lambda p: p["_ivec"])).alias("_items"))
    # a null key is a key like any other
    items = items.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_items")
    out = base.join(items, F.expr(" AND ".join(f"`{k}` <=> _k{i}" for i, k in enumerate(keys))), "left")
    return out.withColumn(out_col, F.concat(F.col("_uvec"), F.coalesce(
        F.col("_items"), none))).drop("_uvec", "_items", *[f"_k{i}" for i in range(len(keys))])
