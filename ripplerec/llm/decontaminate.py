"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits of the lower-cased text.  A document and
a benchmark item are compared if they share a seed, five words in a row (an item
of fewer words is its own seed).  The longest common run of unmarked words, found
by running Karp-Rabin hashes, is marked as a tile on both sides, then the next
longest, down to the seed's length, so that passages whose parts were reordered
are covered tile by tile.  Of equally long tiles the first of the item, then of
the document, is marked.  A document is contaminated by an item if its tiles cover
at least ``COVERAGE`` of it.

Only some seeds of an item have to be looked up.  If its tiles cover enough, they
leave at most ``len - need`` words out, so every stretch of one word more holds a
covered word, and a seed over that stretch is in the document.  The stretch whose
seeds fewest items share is indexed: a seed that very many items share costs
nothing, unless it is all that an item consists of.  For pairs that such a seed
proposes, all seeds of the item are looked up before anything is tiled.

The benchmark is worked through in blocks of bounded size, each of which is
sent to all tasks; documents are never shuffled.

Defined results: null and empty texts, and items without a word, match nothing;
an item of one to four words matches where all of it stands in a row; texts of any
length are compared whole; repeated documents and items give a row each; empty
tables give no rows; extra columns are ignored (``clean`` keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, rows_of, small_batches

SEED_WORDS = 5
COVERAGE = 0.8
#: Benchmark text (in characters) that is sent to the tasks at once.
BLOCK_CHARS = 16 << 20

_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_RESULT = "doc_id long, item_id long, n_words int, n_covered int, coverage double, n_tiles int"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def running_hash(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash (mod 2**64) of every window of ``n`` ids."""
    if len(ids) < n:
        return np.zeros(0, dtype=np.uint64)
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    h, width, power = None, 0, _BASE
    block = x  # hash of 2**k ids, combined by the bits of n
    with np.errstate(over="ignore"):
        for k in range(n.bit_length()):
            if n >> k & 1:
                if h is None:
                    h = block
                else:
                    m = len(h) - (1 << k) if width else len(h)
                    h = h[:len(block) - width][:m] * power + block[width:][:m]
                width += 1 << k
            if n >> (k + 1):
                size = 1 << k
                block = block[:-size] * power + block[size:]
                power = power * power
    return h[:len(ids) - n + 1]


def tiles(doc: np.ndarray, item: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in doc, place in item, length) per tile.

    ``doc`` may hold negative ids, each of them a barrier that equals nothing.
    """
    free_doc, free_item = doc >= 0, np.ones(len(item), dtype=bool)
    found: list[tuple[int, int, int]] = []

    def clear(free: np.ndarray, n: int) -> np.ndarray:
        """Windows of ``n`` places that are all free."""
        total = np.concatenate([[0], np.cumsum(free)])
        return total[n:] - total[:-n] == n if len(free) >= n else np.zeros(0, dtype=bool)

    def common(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        hd, hi = running_hash(doc, n), running_hash(item, n)
        pd, pi = np.flatnonzero(clear(free_doc, n)), np.flatnonzero(clear(free_item, n))
        pd = pd[np.isin(hd[pd], hi[pi])]
        pi = pi[np.isin(hi[pi], hd[pd])]
        return pd, pi, hd, hi

    longest = len(item)
    while True:
        lo, hi = least - 1, longest
        while lo < hi:  # a common run of n words holds one of n - 1
            mid = (lo + hi + 1) // 2
            if len(common(mid)[1]):
                lo = mid
            else:
                hi = mid - 1
        if lo < least:
            return found
        longest = lo
        pd, pi, hd, hi_ = common(lo)
        marked = False
        for q in pi.tolist():
            if not free_item[q:q + lo].all():
                continue
            for p in pd[hd[pd] == hi_[q]].tolist():
                if free_doc[p:p + lo].all() and np.array_equal(doc[p:p + lo], item[q:q + lo]):
                    free_doc[p:p + lo] = False
                    free_item[q:q + lo] = False
                    found.append((p, q, lo))
                    marked = True
                    break
        if not marked:  # equal hashes of different words
            longest = lo - 1
            if longest < least:
                return found


def _least(n: int) -> int:
    """Words of a seed of an item of ``n`` words."""
    return min(SEED_WORDS, n)


def _need(n: int, coverage: float) -> int:
    """Fewest covered words of ``n`` that reach the coverage."""
    need = max(1, int(np.ceil(coverage * n)))
    while need > 1 and need - 1 >= coverage * n:
        need -= 1
    while need < coverage * n:
        need += 1
    return need


def block_index(rows: list[tuple[int, str]], coverage: float = COVERAGE) -> dict:
    """Benchmark block: vocabulary, items as word numbers, and by seed length the sorted seeds of each
    item's rarest stretch with the items."""
    vocab: dict[str, int] = {}
    items = [(item, np.array([vocab.setdefault(w, len(vocab)) for w in words(text)], dtype=np.int64))
             for item, text in rows]
    seeds = [running_hash(ids, _least(len(ids))) if len(ids) else np.zeros(0, dtype=np.uint64) for _, ids in items]
    # number of items that share a seed
    owner = np.repeat(np.arange(len(items)), [len(s) for s in seeds]) if items else np.zeros(0, dtype=np.int64)
    every = np.concatenate([*seeds, np.zeros(0, dtype=np.uint64)])
    distinct, at = np.unique(every, return_inverse=True)
    pair = np.unique(at * max(1, len(items)) + owner) // max(1, len(items))
    shared = np.bincount(pair, minlength=len(distinct))[at]
    begin = np.cumsum([0, *(len(s) for s in seeds)])
    lookup: dict[int, tuple[list[np.ndarray], list[int]]] = {}
    for i, (_, ids) in enumerate(items):
        if not len(ids):
            continue
        n, least = len(ids), _least(len(ids))
        stretch = n - _need(n, coverage) + 1
        cost = np.concatenate([[0], np.cumsum(shared[begin[i]:begin[i + 1]])])
        word = np.arange(n - stretch + 1)  # first word of the stretch: its seeds begin up to least - 1 words before
        lo, hi = np.maximum(word - least + 1, 0), np.minimum(word + stretch, len(seeds[i]))
        best = int(np.argmin(cost[hi] - cost[lo]))
        keys, owners = lookup.setdefault(least, ([], []))
        keys.append(np.unique(seeds[i][lo[best]:hi[best]]))
        owners.append(i)
    sorted_seeds = {}
    for least, (keys, owners) in lookup.items():
        key, own = np.concatenate(keys), np.repeat(owners, [len(k) for k in keys])
        order = np.argsort(key, kind="stable")
        sorted_seeds[least] = key[order], own[order]
    return {"vocab": vocab, "items": items, "seeds": seeds, "lookup": sorted_seeds}


def contaminations(texts: list[str | None], index: dict, coverage: float) -> Iterator[tuple[int, int, int, int]]:
    """(number of the text, number of the item, covered words, tiles) per match."""
    get = index["vocab"].get
    for d, text in enumerate(texts):
        ids = np.array([get(w, -1) for w in words(text)], dtype=np.int64)
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        for least, (keys, owner) in index["lookup"].items():
            if len(ids) < least:
                continue
            at = np.flatnonzero(known[least:] - known[:-least] == least)
            if not len(at):
                continue
            h = running_hash(ids, least)[at]
            if not (keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h).any():
                continue
            mine, number = np.unique(h, return_inverse=True)
            lo, hi = np.searchsorted(keys, mine), np.searchsorted(keys, mine, side="right")
            # at most the entries of the index, whatever the document repeats
            proposed = np.unique(np.concatenate([owner[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True) if b > a]
                                                or [owner[:0]]))
            for i in proposed.tolist():
                item, seeds = index["items"][i][1], index["seeds"][i]
                place = np.minimum(np.searchsorted(mine, seeds), len(mine) - 1)
                there = mine[place] == seeds
                reach = np.zeros(len(item) + 1, dtype=np.int64)
                np.add.at(reach, np.flatnonzero(there), 1)
                np.add.at(reach, np.flatnonzero(there) + least, -1)
                if (np.cumsum(reach)[:-1] > 0).sum() < coverage * len(item):
                    continue  # tiles lie within seeds, so they can't cover more
                hit = np.zeros(len(mine), dtype=bool)
                hit[place[there]] = True
                near = np.zeros(len(ids), dtype=bool)  # words of the document within a seed
                start = at[hit[number]]
                for k in range(least):
                    near[start + k] = True
                keep = np.flatnonzero(near)
                breaks = np.flatnonzero(np.diff(keep) > 1) + 1
                found = tiles(np.insert(ids[keep], breaks, -1), item, least)
                covered = sum(t[2] for t in found)
                if covered >= coverage * len(item):
                    yield d, i, covered, len(found)


def _search(shared, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        items = [(i, len(ids)) for i, ids in index["items"]]
        for b in rows_of(batches):
            ids = b["doc_id"].to_pylist()
            out = [(ids[d], items[i][0], items[i][1], n, n / items[i][1], k)
                   for d, i, n, k in contaminations(b["text"].to_pylist(), index, coverage)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                        pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32()), strict=True)],
                    ["doc_id", "item_id", "n_words", "n_covered", "coverage", "n_tiles"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, n_words, n_covered, coverage, n_tiles per contaminated pair."""
    spark = docs.sparkSession
    small_batches(spark)
    bench = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = parts(size, block_chars)
    out = None
    for k in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        shared = spark.sparkContext.broadcast(block_index([(r["item_id"], r["text"]) for r in rows], coverage))
        found = docs.select("doc_id", "text").mapInArrow(_search(shared, coverage), _RESULT)
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that no benchmark item contaminates."""
    gone = contaminated(docs, benchmark).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]), "left_anti")
