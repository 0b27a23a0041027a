"""Exact dedup against immutable snapshots screened by binary-fuse filters.

A corpus arrives as batches.  Each finished batch is an immutable snapshot:
one row per distinct digest plus one static binary-fuse filter per shard of
its digests.  The digests of a later batch are grouped on their own first,
then screened by the filters of every earlier snapshot; only the positives
are joined with the snapshot's exact buckets, and only rows whose digest
occurs more than once have their bytes compared.

Defined results: a null text is an empty text; equal texts are those identical
after lower-casing A-Z; of equal texts the row with the largest doc_id stays
(null counts as smaller than any); rows that repeat that doc_id all stay; an
empty table gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fuse
from .common import ascii_lower, drop, parts, store

#: Distinct digests per filter: a shard's filter and keys stay a few MB.
SHARD_KEYS = 50_000
#: Batches that op5 and the pipeline split a table into.
BATCHES = 2

_FILTER = "batch int, shard int, seed long, seg int, cnt int, prints binary"
_HIT = "digest binary, snapshot int"


def digests(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, digest, batch) of every row: SHA-256 of the normalised text."""
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(ascii_lower(F.col("text")).cast("binary"), 256)).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"))


def _key(digest: pa.Array) -> np.ndarray:
    """First eight bytes of each digest."""
    return np.frombuffer(b"".join(d[:8] for d in digest.to_pylist()), dtype="<u8")


def _build_filter(group: pa.Table) -> pa.Table:
    f = fuse.build(_key(group["digest"]))
    return pa.table({"batch": pa.array([group["batch"][0].as_py()], pa.int32()),
                     "shard": pa.array([group["shard"][0].as_py()], pa.int32()),
                     "seed": pa.array([f["seed"]], pa.int64()), "seg": pa.array([f["seg"]], pa.int32()),
                     "cnt": pa.array([f["count"]], pa.int32()), "prints": pa.array([f["prints"]], pa.binary())})


def _screen(incoming: pa.Table, filters: pa.Table) -> pa.Table:
    """Positives of one shard: (digest, snapshot) that a filter lets through."""
    digest, batch, snapshot = incoming["digest"].to_pylist(), [], []
    out: list[bytes] = []
    if digest:
        keys = _key(incoming["digest"])
        batch = incoming["batch"].to_numpy()
        for f in filters.to_pylist():
            hit = fuse.contains({"seed": f["seed"], "seg": f["seg"], "count": f["cnt"], "prints": f["prints"]}, keys)
            for i in np.flatnonzero(hit & (batch > f["batch"])):
                out.append(digest[i])
                snapshot.append(f["batch"])
    return pa.table({"digest": pa.array(out, pa.binary()), "snapshot": pa.array(snapshot, pa.int32())})


def sharded(groups: DataFrame, shards: int) -> DataFrame:
    """Digests with their shard, the same for every batch."""
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def build_filters(groups: DataFrame) -> DataFrame:
    """One binary-fuse filter per (snapshot, shard); ``groups`` has digest, batch, shard."""
    return groups.groupBy("batch", "shard").applyInArrow(_build_filter, _FILTER)


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """(digest, snapshot) pairs that may be equal, false positives included."""
    return (incoming.groupBy("shard").cogroup(filters.groupBy("shard"))
            .applyInArrow(_screen, _HIT))


def verified(rows: DataFrame, docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Byte check of the rows of repeated digests: one row per distinct text.

    Returns digest, norm, keep_id, n.  Rows are joined with their texts by
    the unique doc_id, and equal texts are combined before they are shuffled
    by digest, so that a group of any size meets as a few rows per task.
    """
    rows = rows.join(repeated.select("digest"), "digest", "left_semi").select("doc_id", "digest").distinct()
    texts = docs.select(F.col("doc_id").alias("_id"), ascii_lower(F.col("text")).alias("norm"))
    return (rows.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")))
            .where(F.unhex(F.sha2(F.col("norm").cast("binary"), 256)) == F.col("digest"))
            .groupBy("digest", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))


def dedup(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 per row of ``docs``."""
    rows = store(digests(docs, batches), "digests")
    # duplicates inside each batch, grouped separately from the snapshots
    groups = rows.groupBy("batch", "digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    groups = store(groups, "groups")
    total = groups.count()
    shards = parts(total / batches, SHARD_KEYS)
    keyed = sharded(groups.select("batch", "digest"), shards)
    filters = build_filters(keyed.where(F.col("batch") < batches - 1))
    hits = screen(keyed.where(F.col("batch") > 0), filters)
    # exact buckets of the snapshots that a filter pointed to
    found = hits.join(groups.select("digest", F.col("batch").alias("snapshot")), ["digest", "snapshot"])
    found = found.select("digest").distinct()
    repeated = store(found.union(groups.where("n > 1").select("digest")).distinct(), "repeated")
    classes = store(verified(rows, docs, repeated), "classes")
    # a digest with two different texts (never seen) is told apart by its text
    split = classes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"),
                                          F.sum("n").alias("n"))
    clash = split.where("texts > 1").select("digest")
    plain = split.where("texts = 1").select("digest", "keep_id", "n")
    one = (rows.join(clash, "digest", "left_anti").join(plain, "digest", "left")
           .select("doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
                   F.coalesce("n", F.lit(1)).alias("group_size"), "digest"))
    if not clash.isEmpty():
        odd = (docs.select("doc_id", ascii_lower(F.col("text")).alias("norm"))
               .withColumn("digest", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)))
               .join(clash, "digest", "left_semi").join(classes, ["digest", "norm"])
               .select("doc_id", "keep_id", F.col("n").alias("group_size"), "digest"))
        one = one.union(odd)
    return one.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def keep_largest(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Rows of ``docs`` without those whose text a larger doc_id repeats."""
    gone = (dedup(docs, batches).where(~F.col("kept"))
            .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct())
    sha = F.sha2(ascii_lower(docs["text"]).cast("binary"), 256)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (sha == gone["_sha"]), "left_anti")


ORACLE_SQL = """
with n as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id is not distinct from max(doc_id) over (partition by t) as kept,
       sha256(t) as text_sha256
from n
"""
