"""Approximate nearest neighbours: vantage-point trees per shard.

Every valid vector is indexed: rows are dealt to shards by a hash of their row
number, and one tree is built per shard and stored in the shared folder.
Queries are cut into blocks; a block meets every shard's tree once, and the best
``k`` of each shard are merged.  A shard and a block are bounded in
bytes, whatever the size of the table.

Of a group of equal vectors only the ``k + 1`` rows of smallest vec_id are
indexed: a result has ``k`` rows, of equal scores the smaller ids come first,
and the query's own row may be among them.  That keeps results whole.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite
component take no part; vectors meet only vectors of their own length.  Ties go to the
smaller vec_id, null ids last.  Rows that repeat a vec_id are rows of their
own, as queries and as candidates (a query leaves out only its own row).  A
query with fewer candidates returns all.  Empty tables give no rows; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vptree
from .common import parts, store

K = 20
#: Rows whose vec_id is divisible by this are the queries.
EVERY = 20
#: Triangle-inequality pruning is relaxed by this factor; one searches exactly.
FACTOR = 1.0
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20
NULL_ID = np.iinfo(np.int64).max

_TREE = "dim int, shard int, vectors binary, ids binary, rows binary, norm double, point binary, lo binary, hi binary, reach binary"
_FOUND = "query_row long, query_id long, vec_id long, vec_row long, score double"


def valid(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(row, vec_id, v, dim) of every vector that takes part."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (vectors.where(F.col(column).isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
            .select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("vec_id"),
                    v.alias("v"), F.size(column).alias("dim")))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(flat).reshape(-1, dim) if flat else np.empty((0, dim))


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(NULL_ID).to_numpy().astype(np.int64)


def _build(group: pa.Table) -> pa.Table:
    dim, shard = group["dim"][0].as_py(), group["shard"][0].as_py()
    t = vptree.build(_matrix(group["v"], dim), _longs(group["vec_id"]), _longs(group["row"]))
    blobs = {"vectors": t.vectors, "ids": t.ids, "rows": t.rows, "point": t.point, "lo": t.left, "hi": t.right,
             "reach": t.reach}
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
                     **{k: pa.array([v.tobytes()], pa.binary()) for k, v in blobs.items()},
                     "norm": pa.array([t.norm])}).select(
        ["dim", "shard", "vectors", "ids", "rows", "norm", "point", "lo", "hi", "reach"])


def index(vectors: DataFrame, shards: int, k: int = K) -> DataFrame:
    """One tree per (dim, shard) over all of ``vectors`` (row, vec_id, v, dim)."""
    w = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    return (vectors.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k + 1)
            .withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
            .select("dim", "shard", "row", "vec_id", "v")
            .groupBy("dim", "shard").applyInArrow(_build, _TREE))


def _search(k: int, factor: float):
    def run(queries: pa.Table, trees: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("query_row", "query_id", "vec_id", "vec_row", "score")}
        for r in trees.to_pylist() if queries.num_rows else []:
            dim = r["dim"]
            i8 = {c: np.frombuffer(r[c], dtype=np.int64) for c in ("ids", "rows", "point", "lo", "hi")}
            tree = vptree.Tree(np.frombuffer(r["vectors"]).reshape(-1, dim), i8["ids"], i8["rows"], r["norm"],
                               i8["point"], i8["lo"], i8["hi"], np.frombuffer(r["reach"]).reshape(-1, 4))
            own, names = _longs(queries["row"]), _longs(queries["vec_id"])
            row, score = vptree.Search(tree, _matrix(queries["v"], dim), own, k, factor).run()
            qi, at = np.nonzero(row >= 0)
            hit = row[qi, at]
            for c, x in (("query_row", own[qi]), ("query_id", names[qi]), ("vec_id", tree.ids[hit]),
                         ("vec_row", tree.rows[hit]), ("score", score[qi, at])):
                out[c].append(x)
        cols = {c: np.concatenate(x) if x else np.empty(0, np.float64 if c == "score" else np.int64)
                for c, x in out.items()}
        table = pa.table(cols)
        ids = table["vec_id"].to_numpy()
        return table.set_column(2, "vec_id", pa.array(ids, mask=ids == NULL_ID))
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR,
            shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_row, query_id, rank, vec_id, score: the ``k`` best of ``vectors`` for each
    of ``queries`` (both row, vec_id, v, dim; a stored table), the row itself left out."""
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("d")).first()
    asked = queries.count()
    if not size["n"] or not asked:
        return vectors.sparkSession.createDataFrame([], "query_row long, query_id long, rank int, vec_id long, score double")
    shards = parts(size["n"] * size["d"] * 8, shard_bytes)
    blocks = parts(asked * size["d"] * 8, block_bytes)
    trees = store(index(vectors, shards, k), "trees")
    block = F.pmod(F.xxhash64(F.col("row") + 1), F.lit(blocks)).cast("int")
    asks = (queries.withColumn("block", block)
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    there = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = asks.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(_search(k, factor), _FOUND)
    w = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "vec_row")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_row", "query_id", "rank", "vec_id", "score"))


def neighbours(vectors: DataFrame, every: int = EVERY, k: int = K, factor: float = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: the rows whose vec_id ``every`` divides against all rows."""
    rows = store(valid(vectors), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    return nearest(rows, queries, k, factor).select("query_id", "rank", "vec_id", "score")


#: Factor one is exact, so plain SQL gives the same rows.
ORACLE_SQL = """
with e as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (
  select q.vec_id as query_id, e.vec_id, list_inner_product(q.v, e.v) as score
  from e q join e on q.vec_id % 20 = 0 and e.vec_id <> q.vec_id and len(q.v) = len(e.v))
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
       vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20
"""
