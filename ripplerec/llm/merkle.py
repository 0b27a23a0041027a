"""Merkle manifest of a dataset with octopus multiproofs.

A forest has one tree per group of rows and one tree over the groups' roots.
Leaves of a tree are numbered in order; two consecutive nodes have one parent, a
last one alone has a parent too, up to the single node that remains.

* ``numbered`` gives rows their places by a range partitioning and prefix
  counts: no group is sorted in one task, so a hot group does not matter.
* ``grow`` builds the nodes in aligned blocks of 2^BLOCK leaves, a block a
  group, then goes on with the blocks' roots: the rounds are log(n) / BLOCK.
* ``multiproofs`` proves any set of leaves.  A leaf partition (an aligned block)
  computes the minimal union of node coordinates that its leaves miss, all
  partitions' coordinates are fetched in one join with the nodes of these levels,
  and every partition derives the interiors that its leaves share and expands
  the single proofs locally.

Defined results: a null group is a group of its own, first in order; rows that repeat a
place's key are leaves of their own, next to each other (ties by leaf digest); a null
doc_id comes first; null columns hash as ``-``; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import parts, rows_of, store

#: Leaves of one aligned block: 2^BLOCK.
BLOCK = 12
#: Rows of one range partition while places are counted.
RANGE_ROWS = 100_000
#: The tree over the groups' roots; group names begin with "-" or "=".
TOP = ""
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPER = 7

_NODE = "tree string, n long, level int, pos long, digest string"
_WANT = "tree string, block long, level int, idx long"


@dataclass
class Manifest:
    """leaves (row, tree, pos, n, digest and further columns), nodes (tree, level, pos, digest),
    trees (tree, n, depth, top_pos, subroot), number of trees, root."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    groups: int
    root: str | None


def digest(*fields: Column) -> Column:
    """Digest of a row: each field as its UTF-8 byte count and value, ``-`` if null."""
    said = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")),
                       F.lit("-")) for f in fields]
    return F.sha2(F.concat(*said).cast("binary"), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _depth(n: str) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(F.col(n) > 1, F.length(F.bin(F.col(n) - 1))).otherwise(0).cast("int")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place ``pos`` in their ``tree`` by ``order`` and its size ``n``."""
    count = rows.count()
    at = (rows.repartitionByRange(parts(count, RANGE_ROWS), "tree", *order).sortWithinPartitions("tree", *order)
          .withColumn("_at", F.monotonically_increasing_id()))
    at = store(at.withColumn("_part", F.shiftright("_at", 33)), "ranged")
    runs = at.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_c"))
    per_tree = Window.partitionBy("tree")
    before = per_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))).withColumn(
        "n", F.sum("_c").over(per_tree))
    return (at.join(runs, ["tree", "_part"])
            .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_part", "_first", "_before", "_c"))


def _climb(block: int):
    def run(group: pa.Table) -> pa.Table:
        tree, n, base = (group[c][0].as_py() for c in ("tree", "n", "level"))
        order = np.argsort(group["pos"].to_numpy())
        digests = np.array(group["digest"].to_pylist(), dtype=object)[order].tolist()
        first = int(group["pos"].to_numpy().min())
        level, out_l, out_p, out_d = base, [], [], []
        while level - base < block if n > 1 << block else len(digests) > 1:
            digests = [_hash("".join(digests[i:i + 2])) for i in range(0, len(digests), 2)]
            first, level = first >> 1, level + 1
            out_l += [level] * len(digests)
            out_p += range(first, first + len(digests))
            out_d += digests
        rows = len(out_d)
        return pa.table({"tree": pa.array([tree] * rows, pa.string()), "n": pa.array([n] * rows, pa.int64()),
                         "level": pa.array(out_l, pa.int32()), "pos": pa.array(out_p, pa.int64()),
                         "digest": pa.array(out_d, pa.string())})
    return run


def grow(leaves: DataFrame, block: int = BLOCK) -> DataFrame:
    """(tree, level, pos, digest) of all nodes over ``leaves`` (tree, pos, n, digest), level 0 included."""
    nodes = leaves.select("tree", F.lit(0).alias("level"), "pos", "digest")
    base, top = leaves.select("tree", "n", F.lit(0).alias("level"), "pos", "digest"), 0
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        made = store(base.groupBy("tree", F.shiftright("pos", block)).applyInArrow(_climb(block), _NODE), "nodes")
        nodes = nodes.union(made.select("tree", "level", "pos", "digest"))
        top, most = top + block, -(-most >> block)
        # n becomes the size of the level that the next round starts from
        base = (made.where((F.col("level") == top) & (F.col("n") > 1 << block))
                .withColumn("n", F.expr(f"(n + {(1 << block) - 1}) div {1 << block}")))
    return nodes


def manifest(rows: DataFrame, order: list[str], block: int = BLOCK) -> Manifest:
    """The forest over ``rows`` (row, tree, digest, the columns of ``order`` and further ones)."""
    leaves = store(numbered(rows, order), "leaves")
    nodes = grow(leaves, block)
    sizes = leaves.groupBy("tree").agg(F.first("n").alias("n")).withColumn("depth", _depth("n"))
    heads = (nodes.join(sizes.withColumnRenamed("depth", "level"), ["tree", "level"])
             .select(F.col("tree").alias("name"), F.col("n").alias("size"), "digest"))
    heads = store(heads.withColumn("tree", F.lit(TOP)), "heads")
    tops = store(numbered(heads, ["name"]), "tops")
    above = grow(tops, block)
    trees = tops.select(F.col("name").alias("tree"), F.col("size").alias("n"), F.col("pos").alias("top_pos"),
                        F.col("digest").alias("subroot")).withColumn("depth", _depth("n"))
    groups = tops.count()
    root = above.where(F.col("level") == max(groups - 1, 0).bit_length()).select("digest").first()
    return Manifest(leaves, nodes.union(above), trees, groups, root["digest"] if root else None)


def _coordinates(group: pa.Table) -> pa.Table:
    """Octopus: siblings that the leaves of one block can't derive from each other."""
    tree, block, n = (group[c][0].as_py() for c in ("tree", "block", "n"))
    have = np.unique(group["pos"].to_numpy())
    level, size, out_l, out_i = 0, n, [], []
    while size > 1:
        beside = have ^ 1
        missing = beside[(beside < size) & ~np.isin(beside, have)]
        out_l += [level] * len(missing)
        out_i += missing.tolist()
        have, size, level = np.unique(have >> 1), (size + 1) >> 1, level + 1
    rows = len(out_l)
    return pa.table({"tree": pa.array([tree] * rows, pa.string()), "block": pa.array([block] * rows, pa.int64()),
                     "level": pa.array(out_l, pa.int32()), "idx": pa.array(out_i, pa.int64())})


def missing(wanted: DataFrame, m: Manifest) -> DataFrame:
    """(tree, block, at, level, idx): per leaf partition the coordinates to fetch, ``at`` their tree."""
    own = (wanted.select("tree", "block", "pos", "n").groupBy("tree", "block").applyInArrow(_coordinates, _WANT)
           .select("tree", "block", F.col("tree").alias("at"), "level", "idx"))
    tops = max(m.groups - 1, 0).bit_length()
    if not tops:
        return own
    upper = (wanted.select("tree", "block").distinct().join(m.trees.select("tree", "top_pos"), "tree")
             .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(tops - 1))))
             .withColumn("idx", F.expr("shiftright(top_pos, level) ^ 1"))
             .where(F.col("idx") < F.expr(f"shiftright({m.groups - 1}L, level) + 1"))
             .select("tree", "block", F.lit(TOP).alias("at"), "level", "idx"))
    return own.union(upper)


def _expand(tops: int, carry: list[str]):
    def run(wanted: pa.Table, fetched: pa.Table) -> pa.Table:
        n = wanted["n"][0].as_py() if wanted.num_rows else 0
        pos = wanted["pos"].to_numpy()
        levels: list[dict[int, str]] = [{} for _ in range(max(n - 1, 0).bit_length())]
        above: list[str | None] = [None] * tops
        top_pos, subroot = 0, None
        for at, level, idx, d in zip(*(fetched[c].to_pylist() for c in ("at", "level", "idx", "digest")), strict=True):
            if level < 0:
                top_pos, subroot = idx, d
            elif at == TOP:
                above[level] = d
            else:
                levels[level][idx] = d
        # shared interiors, once for all leaves of the partition
        known = dict(zip(pos.tolist(), wanted["digest"].to_pylist(), strict=True))
        for level in levels:
            level.update(known)
            known = {}
            for i in list(level):
                p = i >> 1
                if p not in known:
                    known[p] = _hash(level[2 * p] + level.get(2 * p + 1, ""))
        proofs = [[level.get((p >> i) ^ 1) for i, level in enumerate(levels)] + above for p in pos.tolist()]
        rows = len(proofs)
        return pa.table({**{c: wanted[c] for c in carry}, "top_pos": pa.array([top_pos] * rows, pa.int64()),
                         "subroot": pa.array([subroot] * rows, pa.string()),
                         "siblings": pa.array(proofs, pa.list_(pa.string()))})
    return run


def multiproofs(m: Manifest, wanted: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Columns of ``wanted`` (rows of ``m.leaves``; all by default) with top_pos, subroot
    and siblings (from the leaf to the root; null where a node has none)."""
    wanted = m.leaves if wanted is None else wanted
    carry = wanted.columns
    wanted = wanted.withColumn("block", F.shiftright("pos", block))
    asked = store(missing(wanted, m), "coordinates")
    # at most 64 levels: only these levels of the nodes are read and shuffled
    levels = [r["level"] for r in asked.select("level").distinct().collect()]
    there = m.nodes.where(F.col("level").isin(levels)) if levels else m.nodes.where(F.lit(False))
    there = there.select(F.col("tree").alias("at"), "level", F.col("pos").alias("idx"), "digest")
    fetched = asked.join(there, ["at", "level", "idx"]).select("tree", "block", "at", "level", "idx", "digest")
    heads = (wanted.select("tree", "block").distinct().join(m.trees, "tree")
             .select("tree", "block", F.lit(TOP).alias("at"), F.lit(-1).alias("level"), F.col("top_pos").alias("idx"),
                     F.col("subroot").alias("digest")))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema if f.name in carry)
    tops = max(m.groups - 1, 0).bit_length()
    fetched = store(fetched.union(heads), "fetched")
    return (wanted.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block"))
            .applyInArrow(_expand(tops, carry), f"{fields}, top_pos long, subroot string, siblings array<string>"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in rows_of(batches):
        out = []
        for d, p, n, top, beside in zip(*(b[c].to_pylist() for c in ("leaf", "pos", "n", "top_pos", "siblings")),
                                        strict=True):
            depth = max(n - 1, 0).bit_length()
            for i, s in enumerate(beside):
                right = (p >> i if i < depth else top >> (i - depth)) & 1
                d = _hash(d if s is None else s + d if right else d + s)
            out.append(d)
        kept = [c for c in b.schema.names if c != "siblings"]
        yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), pa.array(out, pa.string())], [*kept, "folded"])


def folded(proofs: DataFrame) -> DataFrame:
    """Columns of ``proofs`` (leaf, pos, n, top_pos, siblings and further ones) without
    the siblings, with ``folded``: the root that a leaf and its proof give."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in proofs.schema if f.name != "siblings")
    return proofs.mapInArrow(_fold, f"{fields}, folded string")


def leaves_of(docs: DataFrame) -> DataFrame:
    """row, tree, doc_id, digest, forged (the digest with one more in n_chars; null if not tampered with)."""
    doc = F.col("doc_id").cast("long").cast("string")
    hit = (F.crc32(doc.cast("binary")) % TAMPER == 0) & F.col("n_chars").isNotNull()
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),
        "doc_id", digest(*(F.col(c) for c in FIELDS)).alias("digest"),
        F.when(hit, digest(*changed)).alias("forged"))


def manifest_check(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per row of ``docs``."""
    m = manifest(store(leaves_of(docs.select(*FIELDS)), "rows"), ["doc_id", "digest", "row"], block)
    proofs = multiproofs(m, block=block).select(
        "doc_id", "digest", "subroot", F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"),
        F.coalesce("forged", "digest").alias("leaf"), "pos", "n", "top_pos", "siblings")
    return folded(proofs).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(m.root).alias("root"), "proof_sha256",
        F.col("folded").alias("folded_root"), (F.col("folded") == F.lit(m.root)).alias("verified"))


#: CRC-32 by its bitwise rule; the levels of all trees by recursion, the proofs by folding.
ORACLE_SQL = """
with recursive d as (
  select row_number() over () as r, doc_id, coalesce('=' || lang, '-') as tree, n_chars,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(doc_id::varchar)::int),
             lambda i: ascii(substr(doc_id::varchar, (i + 1)::int, 1))::bigint)),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 7 = 0 as hit,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') as head,
         coalesce(strlen(text) || ':' || text, '-') as tail
  from documents),
l as (
  select r, doc_id, tree, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
         sha256(head || coalesce(strlen((n_chars + hit::int)::varchar) || ':' || (n_chars + hit::int), '-') || tail) as forged
  from d),
p as (
  select *, row_number() over (partition by tree order by doc_id, leaf, r) - 1 as pos, count(*) over (partition by tree) as n
  from l),
nodes as (
  select tree, 0 as level, pos, n, leaf as digest from p
  union all
  select tree, level + 1, pos // 2, max((n + 1) // 2), sha256(string_agg(digest, '' order by pos))
  from nodes where n > 1 group by tree, level, pos // 2),
tops as (
  select tree, digest, row_number() over (order by tree) - 1 as pos, count(*) over () as n from nodes where n = 1),
upper as (
  select 0 as level, pos, n, digest from tops
  union all
  select level + 1, pos // 2, max((n + 1) // 2), sha256(string_agg(digest, '' order by pos))
  from upper where n > 1 group by level, pos // 2),
low as (
  select p.r, 0 as level, p.tree, p.pos, p.n, p.forged as digest, '' as proof from p
  union all
  select f.r, f.level + 1, f.tree, f.pos // 2, (f.n + 1) // 2,
         sha256(case when f.pos % 2 = 1 then s.digest || f.digest else f.digest || coalesce(s.digest, '') end),
         f.proof || coalesce(s.digest, '')
  from low f left join nodes s on s.tree = f.tree and s.level = f.level and s.pos = xor(f.pos, 1) where f.n > 1),
high as (
  select low.r, 0 as level, tops.pos, tops.n, low.digest, low.proof
  from low join tops using (tree) where low.n = 1
  union all
  select f.r, f.level + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(case when f.pos % 2 = 1 then s.digest || f.digest else f.digest || coalesce(s.digest, '') end),
         f.proof || coalesce(s.digest, '')
  from high f left join upper s on s.level = f.level and s.pos = xor(f.pos, 1) where f.n > 1)
select p.doc_id, p.leaf, tops.digest as subroot, u.digest as root, sha256(high.proof) as proof_sha256,
       high.digest as folded_root, high.digest = u.digest as verified
from p join tops using (tree) join high on high.r = p.r and high.n = 1 cross join (select digest from upper where n = 1) u
"""
