"""SimHash near-dedup with deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits.  Two fingerprints
that differ in at most three bits have one segment that differs in at most
one, so it is enough to index, per segment, its exact value and its 32
one-wildcard variants, to join on equality, and to verify the whole distance.
A wildcard entry is written only on the side its bit belongs to (0 left, 1
right), and a pair already seen through the first segment is skipped in the
second: every link comes out once.

Equal fingerprints are one node.  An index bucket of more than ``HOT_BUCKET``
different fingerprints is not joined pair by pair: its members are linked
through the patterns of the other segment with the remaining bits wild (and the
bucket's own wildcard bit), which is exact too and grows with the members only.

Defined results: null and empty texts have the fingerprint zero and are linked
like any other; component_id is the smallest doc_id reachable (nulls are
ignored unless all are null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, small_batches, store
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEG_BITS = 32
SEGMENTS = 64 // SEG_BITS
#: From here on patterns (4,960 a member) are fewer than pairs.
HOT_BUCKET = 10_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    one = xxhash.xxh64_intdigest
    h = np.array([one(g, SEED) for g in grams], dtype="<u8")
    half, set_bits = len(h), np.zeros(64, dtype=np.int64)
    for i in range(0, half, 1 << 16):
        bits = np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > half, bitorder="little").view("<u8")[0])


def _prints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            fp = np.array([fingerprint(t, shingle) for t in b["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.array(fp.view(np.int64))],
                                             ["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_prints(shingle), "doc_id long, fp long")


def _index(prints: DataFrame, bit: int) -> DataFrame:
    """Index entries (key, fp): exact segments and wildcards of bits equal to ``bit``."""
    entries = []
    for s in range(SEGMENTS):
        seg = F.expr(f"shiftrightunsigned(fp, {SEG_BITS * s}) & {(1 << SEG_BITS) - 1}L")
        entries.append(seg.bitwiseOR(F.lit((s * 64 + SEG_BITS) << SEG_BITS)))
        for i in range(SEG_BITS):
            has = seg.bitwiseAND(F.lit(1 << i)) != 0
            entries.append(F.when(has if bit else ~has,
                                  seg.bitwiseAND(F.lit(((1 << SEG_BITS) - 1) ^ (1 << i)))
                                  .bitwiseOR(F.lit((s * 64 + i) << SEG_BITS))))
    return (prints.select("fp", F.explode(F.array_compact(F.array(*entries))).alias("key")))


def _distance(a: str, b: str) -> F.Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(star, fp): every way to blank the bits that a hot bucket leaves over."""
    for b in rows_of(batches):
        for key, fp in zip(b["key"].to_pylist(), b["fp"].to_numpy(), strict=True):
            part, wild = divmod(key >> SEG_BITS, 64)
            free = MAX_BITS - (wild < SEG_BITS)
            other = [i for i in range(64) if i // SEG_BITS != part]
            masks = np.array([sum(1 << i for i in c) for c in combinations(other, free)], dtype=np.uint64)
            # the members of a wildcard bucket may differ in its bit
            bit = np.uint64(1 << (SEG_BITS * part + wild) if wild < SEG_BITS else 0)
            star = np.uint64(int(fp) & 0xFFFFFFFFFFFFFFFF) & ~(masks | bit)
            n = len(masks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, key)), pa.array(masks.view(np.int64)), pa.array(star.view(np.int64)),
                 pa.array(np.full(n, fp))], ["key", "mask", "star", "fp"])


def links(prints: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``prints`` (fp) whose
    graph has the components of "at most MAX_BITS bits apart"."""
    left, right = _index(prints, 0), _index(prints, 1)
    sizes = left.union(right).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    large = store(sizes.where(F.col("n") > hot).select("key"), "hot")
    busy = not large.isEmpty()
    if busy:
        members = left.union(right).join(large, "key", "left_semi").distinct()
        left = left.join(large, "key", "left_anti")
        right = right.join(large, "key", "left_anti")
    seg0 = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp")).bitwiseAND(F.lit((1 << SEG_BITS) - 1)))
    exact = F.expr(f"(l.key >> {SEG_BITS}) & 63") == SEG_BITS
    first = F.expr(f"(l.key >> {SEG_BITS + 6})") == 0
    # Spark sizes an exploded table like the one below it, dozens of times too small: never broadcast
    pairs = (left.alias("l").join(right.hint("merge").alias("r"), "key")
             .where((_distance("l.fp", "r.fp") <= MAX_BITS)
                    & (~exact | (F.col("l.fp") < F.col("r.fp")))  # an exact entry is on both sides
                    & (first | (seg0 > 1)))
             .select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")))
    if busy:
        stars = members.mapInArrow(_patterns, "key long, mask long, star long, fp long")
        least = stars.groupBy("key", "mask", "star").agg(F.min("fp").alias("m"))
        pairs = pairs.union(stars.join(least.hint("merge"), ["key", "mask", "star"]).where("fp <> m")
                            .select(F.col("fp").alias("a"), F.col("m").alias("b")).distinct())
    return pairs


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, hot: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fingerprint (hex), component_id per row of ``docs``."""
    prints = store(fingerprints(docs, shingle), "prints")
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    member = components(links(nodes.select("fp"), hot))
    joined = nodes.join(member, nodes["fp"] == member["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = store(joined, "named")
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    names = named.join(roots, "root").select(F.col("fp"), "component_id")
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the smallest of its component."""
    gone = (near_duplicates(docs).where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("_id")).distinct())
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
