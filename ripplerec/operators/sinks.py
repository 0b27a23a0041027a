"""Result tables and writers: F1 ``record_log``, F2 ``user_consumed``, F3
``user_consumed_literal``, F4 ``unique_records``, F5 ``wire_messages`` /
``publish_wire``, F6 ``top_table`` / ``publish_hot``, F7 ``publish_recs``,
F8 ``conform``.

Row builders are DataFrame -> DataFrame (batch or stream).  Writers are
idempotent: a batch written twice (a retried task, a replayed micro-batch)
leaves the same table, which the reference's per-row inserts did not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.scalar import encode_wire, format_time
from .segments import positions


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """F8: select and cast to a target schema (missing columns are an error)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for target schema: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def record_log(records: DataFrame) -> DataFrame:
    """(user, item, time text) per event, appended as they come."""
    return records.select(F.col("user_id").alias("user"), F.col("item_id").alias("item"),
                          format_time(F.unix_millis("ts")).alias("time"))


def user_consumed(records: DataFrame, drop_first: bool = False) -> DataFrame:
    """per user, the set of items and the set of time texts, each in
    first-seen order (the two arrays are not aligned).

    One stream of (user, kind, value, first-seen) rows -- a marker row per
    user, one per item, one per time text -- is de-duplicated by a partial
    aggregate on (user, kind, value) and collected once per user; the two
    ordered sets are split out with array functions.  Two exchanges, no join.
    A user's row holds only distinct values (items <= catalog, times <= the
    seconds of its activity).  ``drop_first`` gives F3: the reference creates
    the document on a user's first event and adds nothing from it (Q4).
    """
    first = F.struct("ts", "event_id")
    rec = records.select("user_id", "item_id", "ts", "event_id",
                         format_time(F.unix_millis("ts")).alias("time"))
    if drop_first:
        users = rec.groupBy("user_id").agg(F.min(first).alias("_first"))
        rec = rec.join(users, "user_id").where(first != F.col("_first")).drop("_first")
        marker = users.select("user_id", F.lit("user").alias("kind"), F.lit(None).cast("string").alias("value"),
                              F.col("_first").alias("first"))
    else:
        marker = rec.select("user_id", F.lit("user").alias("kind"), F.lit(None).cast("string").alias("value"),
                            first.alias("first"))
    values = rec.select("user_id", F.explode(F.array(
        F.struct(F.lit("item").alias("kind"), F.col("item_id").cast("string").alias("value"), first.alias("first")),
        F.struct(F.lit("time").alias("kind"), F.col("time").alias("value"), first.alias("first")))).alias("p")) \
        .select("user_id", "p.kind", "p.value", "p.first")
    pairs = marker.unionByName(values).groupBy("user_id", "kind", "value").agg(F.min("first").alias("first"))
    per_user = pairs.groupBy(F.col("user_id").alias("user")).agg(
        F.array_sort(F.collect_list(F.struct("first", "kind", "value"))).alias("_all"))

    def values_of(kind: str):
        return F.transform(F.filter("_all", lambda x: x["kind"] == kind), lambda x: x["value"])
    return per_user.select("user", values_of("item").cast("array<int>").alias("consumed"),
                          values_of("time").alias("time"))


#: Values of one row of ``consumed_chunks``.
CONSUMED_CHUNK = 1_000


def consumed_pairs(records: DataFrame, drop_first: bool = False) -> DataFrame:
    """(user_id, kind, value, first): each user's distinct items and time texts with the
    event that brought them; ``drop_first`` leaves a user's first event out (F3)."""
    first = F.struct("ts", "event_id")
    rec = records.select("user_id", "item_id", "ts", "event_id", format_time(F.unix_millis("ts")).alias("time"))
    if drop_first:
        users = rec.groupBy(F.col("user_id").alias("_u")).agg(F.min(first).alias("_first"))
        rec = rec.join(users, F.col("user_id").eqNullSafe(F.col("_u"))).where(first != F.col("_first")).drop("_u", "_first")
    values = rec.select("user_id", F.explode(F.array(
        F.struct(F.lit("item").alias("kind"), F.col("item_id").cast("string").alias("value"), first.alias("first")),
        F.struct(F.lit("time").alias("kind"), F.col("time").alias("value"), first.alias("first")))).alias("p"))
    return values.select("user_id", "p.kind", "p.value", "p.first").groupBy("user_id", "kind", "value").agg(
        F.min("first").alias("first"))


def chunked(pairs: DataFrame, size: int = CONSUMED_CHUNK) -> DataFrame:
    """(user, kind, chunk, vals): the values in first-seen order, ``size`` to a row.

    Places come from prefix counts over range chunks, so a user who holds half of all
    pairs (the shared OOV id) is spread over the tasks and over rows of bounded size.
    """
    placed = positions(pairs, ["user_id", "kind"], ["first", "value"])
    cut = placed.withColumn("chunk", F.floor(F.col("pos") / size))
    lists = cut.groupBy(F.col("user_id").alias("user"), "kind", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("_v"))
    return lists.select("user", "kind", "chunk", F.transform("_v", lambda x: x["value"]).alias("vals"))


def consumed_chunks(records: DataFrame, drop_first: bool = False, size: int = CONSUMED_CHUNK) -> DataFrame:
    """F2 / F3 in rows of bounded size: ``user_consumed`` cut into chunks of ``size`` values."""
    return chunked(consumed_pairs(records, drop_first), size)


def user_consumed_literal(records: DataFrame) -> DataFrame:
    """F2 with the reference's first-event loss."""
    return user_consumed(records, drop_first=True)


def unique_records(records: DataFrame, strict: bool = False) -> DataFrame:
    """one row per (user, item) key -- the first event's time.

    ``min_by`` is a partial aggregate (skew-safe).  ``strict`` fails the job
    on a repeated key, as the store's primary key would.
    """
    agg = records.groupBy(F.col("user_id").alias("user"), F.col("item_id").alias("item")).agg(
        F.min_by(F.unix_millis("ts"), F.struct("ts", "event_id")).alias("_ms"),
        F.count(F.lit(1)).alias("_n"))
    time = format_time("_ms")
    if strict:
        # part of an output column, so the check cannot be pruned away
        time = F.when(F.col("_n") == 1, time).otherwise(
            F.raise_error(F.lit("duplicate primary key (user, item)")))
    return agg.select("user", "item", time.alias("time"))


def wire_messages(records: DataFrame, key: str | None = "user_id") -> DataFrame:
    """F5 rows: (key, value = 'user,item,time').  The reference used one
    constant key (every message on one topic partition); keying by user
    spreads the topic.  ``key=None`` restores the constant key."""
    k = F.lit(K.WIRE_KEY) if key is None else F.col(key).cast("string")
    return records.select(k.alias("key"),
                          encode_wire("user_id", "item_id", F.unix_millis("ts")).alias("value"))


def publish_wire(messages: DataFrame, fmt: str = "kafka", options: dict | None = None,
                 path: str | None = None) -> None:
    """publish (key, value) rows; ``kafka`` needs the connector jar."""
    w = messages.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        if "topic" not in (options or {}):
            raise ValueError("a topic is needed: options={'topic': ...}")
        w.save()
    else:
        w.mode("append").save(path)


def top_table(hot: DataFrame, key: str = "item_id") -> DataFrame:
    """F6 rows in the ``top`` table shape: (item INT, rank VARCHAR)."""
    return hot.select(F.col(key).cast("int").alias("item"), F.col("rank").cast("string").alias("rank"))


def publish_hot(top: DataFrame, path: str) -> None:
    """overwrite the rank store with the last write per rank.  Highest
    window end wins, so a replayed batch cannot move the store backwards
    past a later one when batches are merged with the stored state."""
    top.write.mode("overwrite").parquet(path)


def publish_recs(recs: DataFrame, path: str, batch_id: int | None = None) -> None:
    """append recommendations.  With a micro-batch id the batch lands in
    its own folder (overwritten on replay) -- exactly-once per batch."""
    if batch_id is None:
        recs.write.mode("append").parquet(path)
    else:
        recs.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
