"""Substring dedup with run-length Burrows-Wheeler indexes.

Every byte covered by a ``MATCH``-byte string that also starts in a document
with a smaller doc_id is removed.  Documents are dealt into buckets of a few
MB of text, and all windows of ``MATCH`` bytes are keyed by the least hash of
the 16-byte strings in them, so that equal windows have equal keys and
neighbouring windows mostly share one.

1. Each bucket sends its distinct keys to shards; a shard finds the keys that
   more than one document has.  A bucket sends a key once, with the number of
   its differing runs, however often it occurs.
2. Each bucket cuts the runs of windows with shared keys out as pieces (at most
   84 bytes) and sends every distinct piece once, with its least doc_id.  A key
   with more than ``HOT_PIECES`` pieces (a common phrase in many contexts) is
   split: each of its windows is a piece of its own that goes where its own
   hash tells, so that no shard has more than others of it.
3. A shard holds all pieces of its keys and leaves out the windows that a single
   document has, which nothing can cover.  It indexes the rest, some keys at a
   time, as a run-length Burrows-Wheeler transform with sampled run ends and
   streams their matching statistics: of every window whose match is ``MATCH``
   long the index tells the least document.  These documents alone decide what
   is covered, in equal pieces as in differing ones.
4. The answers go back to the buckets, which cut the covered bytes out.

The text is shuffled once (the exchange is shared by all steps); no step holds
more than a bucket or a shard, and an index no more than ``INDEX_BYTES`` and
the pieces of one key.

Defined results: a null text is empty; a null doc_id is neither smaller nor
larger than any, so its text is kept whole and removes nothing (such rows are
not shuffled at all); rows that repeat a doc_id do not remove each other's
text; a very long text is one row of its bucket; ties do not arise, as equal
doc_ids remove nothing; further columns, whatever their names, are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts
from .rindex import NOBODY, RunLengthIndex

MATCH = 50
GRAM = 16
#: Windows of one piece; more would only repeat the key.
PIECE_WINDOWS = MATCH - GRAM + 1
BUCKET_BYTES = 4 << 20
#: Text bytes whose keys share a shard: about one key in 18 bytes, 9 bytes each.
SHARD_BYTES = 24 << 20
#: Pieces of a key, summed over the buckets, above which its windows are dealt one by one: at most
#: 1.4 MB of text, about a tenth of a shard.  A lower bound splits most keys of a larger corpus.
HOT_PIECES = 16_384
#: Piece text screened and indexed at once; the pieces of a key stay together.
INDEX_BYTES = 1 << 17
_CHUNK = 1 << 15

_KEYS = "shard int, bucket int, keys binary, many binary, runs binary"
_SHARED = "bucket int, keys binary, hot binary"
_PIECES = "shard int, bucket int, hot boolean, lengths binary, bytes binary, docs binary, many binary"
_ANSWERS = "bucket int, shard int, hot boolean, keys binary, whole binary, covered binary"
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def window_keys(flat: np.ndarray) -> np.ndarray:
    """Key of every window of MATCH bytes of ``flat``."""
    n = len(flat) - MATCH + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, n, _CHUNK):
            part = flat[a:min(a + _CHUNK, n) + MATCH - 1]
            h = (part.astype(np.uint64) + np.uint64(0x2545F491)) * np.uint64(0x9E3779B97F4A7C15)
            power, width = np.uint64(0xD6E8FEB86659FD93), 1
            while width < GRAM:  # polynomial hash of 2, 4, 8, 16 bytes
                h = h[:-width] * power + h[width:]
                power, width = power * power, width * 2
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(29)
            width = 1
            while width * 2 <= PIECE_WINDOWS:
                h = np.minimum(h[:-width], h[width:])
                width *= 2
            rest = PIECE_WINDOWS - width
            out[a:a + _CHUNK] = np.minimum(h[:-rest], h[rest:]) if rest else h
    return out


def window_hashes(flat: np.ndarray) -> np.ndarray:
    """64-bit hash of every window of MATCH bytes."""
    h = (flat.astype(np.uint64) + np.uint64(0x1B873593)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(31)
    out, done, width, power = None, 0, 1, np.uint64(0x9FB21C651E98DF25)
    with np.errstate(over="ignore"):
        while True:
            if MATCH & width:
                out = h if out is None else out[:len(h) - done] * power + h[done:]
                done += width
            if width * 2 > MATCH:
                return out[:max(len(flat) - MATCH + 1, 0)]
            h = h[:-width] * power + h[width:]
            power, width = power * power, width * 2


class Bucket:
    """The documents of one bucket with their runs of equal window keys."""

    def __init__(self, group: pa.Table):
        self.ids = np.array(group["doc_id"].to_pylist(), dtype=np.int64)
        self.raw = [(t or "").encode() for t in group["text"].to_pylist()]
        sizes = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.flat = b"".join(self.raw)
        self.codes = np.frombuffer(self.flat, dtype=np.uint8)
        keys = window_keys(self.codes)
        # a new run starts where the key or the document changes
        begin = np.zeros(len(keys) + 1, dtype=bool)
        begin[1:-1] = keys[1:] != keys[:-1]
        begin[self.starts[self.starts < len(keys)]] = True
        begin[:1] = True
        at = np.flatnonzero(begin[:-1])
        stop = np.concatenate([at[1:], [len(keys)]]) if len(at) else at
        self.row = np.searchsorted(self.ends, at, side="right")
        if len(at):
            stop = np.minimum(stop, self.ends[self.row] - MATCH + 1)  # windows end in their document
            ok = stop > at
            at, stop, self.row = at[ok], stop[ok], self.row[ok]
        self.at, self.windows = at, stop - at
        self.key = keys[at]

    def marks(self, runs: np.ndarray) -> np.ndarray:
        """Number per run that equal runs share: its length, first and last 8 bytes."""
        eight = np.arange(8)
        with np.errstate(over="ignore"):
            head = self.codes[self.at[runs][:, None] + eight].view(np.uint64)[:, 0]
            tail = self.codes[(self.at + self.windows)[runs][:, None] + MATCH - 9 + eight].view(np.uint64)[:, 0]
            return (head * np.uint64(0x9E3779B97F4A7C15) ^ tail) * np.uint64(0xD6E8FEB86659FD93) + self.windows[runs].astype(np.uint64)

    def distinct(self, shared: np.ndarray, hot: np.ndarray):
        """Distinct pieces of the sorted keys ``shared`` as a sorted list of (key, bytes),
        which of them are windows of ``hot`` keys, the number of each piece in
        the list, and the pieces' row, start and windows."""
        if not len(shared) or not len(self.key):
            none = np.zeros(0, dtype=np.int64)
            return [], none.astype(bool), none, none, none, none
        pos = np.minimum(np.searchsorted(shared, self.key), len(shared) - 1)
        sel = np.flatnonzero(shared[pos] == self.key)
        single = hot[pos[sel]]
        step = np.where(single, 1, PIECE_WINDOWS)
        n = -(-self.windows[sel] // step)  # long runs of one key are cut
        owner, step = np.repeat(sel, n), np.repeat(step, n)
        number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = self.at[owner] + number * step
        windows = np.minimum(self.windows[owner] - number * step, step)
        flat = self.flat
        texts = [flat[s:e] for s, e in zip(start.tolist(), (start + windows + MATCH - 1).tolist(), strict=True)]
        place: dict[bytes, int] = {}
        number = np.array([place.setdefault(t, len(place)) for t in texts], dtype=np.int64)
        key = np.empty(len(place), dtype=np.uint64)  # a text has one key
        key[number] = self.key[owner]
        by_text = sorted(place)
        own = np.array([place[t] for t in by_text], dtype=np.int64)
        order = np.argsort(key[own], kind="stable")
        rank = np.empty(len(place), dtype=np.int64)
        rank[own[order]] = np.arange(len(place))
        key = key[own[order]]
        names = list(zip(key.tolist(), [by_text[i] for i in order.tolist()], strict=True))
        return names, hot[np.searchsorted(shared, key)], rank[number], self.row[owner], start, windows


def _u64(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype=np.uint64) for b in column.to_pylist()]


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a key; keys are least hashes, so their low bits are used."""
    return ((keys & np.uint64(0xFFFFFF)) % np.uint64(shards)).astype(np.int64)


def _shards_of(names: list[tuple[int, bytes]], hot: np.ndarray, shards: int) -> np.ndarray:
    """Twice the shard of every piece, plus one for the windows of hot keys."""
    to = _shard_of(np.array([k for k, _ in names], dtype=np.uint64), shards) * 2
    some = np.flatnonzero(hot)
    if len(some):
        joined = np.frombuffer(b"".join(names[i][1] for i in some.tolist()), dtype=np.uint8)
        to[some] = _shard_of(window_hashes(joined)[::MATCH], shards) * 2 + 1
    return to


def _table(schema: str, cols: list) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(cols, fields, strict=True)], [n for n, _ in fields])


def _send_keys(shards: int):
    def run(group: pa.Table) -> pa.Table:
        bucket = Bucket(group)
        order = np.argsort(bucket.key, kind="stable")
        key, row = bucket.key[order], bucket.row[order]
        rows = []
        if len(key):
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            many = np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)
            # differing runs of a key
            size = np.diff(first, append=len(key))
            of = np.repeat(np.arange(len(first)), size)
            several = np.flatnonzero((size > 1)[of])
            of, mark = of[several], bucket.marks(order[several])
            by = np.lexsort((mark, of))
            of, mark = of[by], mark[by]
            equal = np.flatnonzero((of[1:] == of[:-1]) & (mark[1:] == mark[:-1]))
            runs = np.minimum(size - np.bincount(of[equal], minlength=len(first)), 255).astype(np.uint8)
            key = key[first]
            shard = _shard_of(key, shards)
            for s in np.unique(shard).tolist():
                sel = shard == s
                rows.append((s, group["bucket"][0].as_py(), key[sel].tobytes(), np.packbits(many[sel]).tobytes(),
                             runs[sel].tobytes()))
        return _table(_KEYS, list(zip(*rows, strict=True)) or [[]] * 5)
    return run


def _find_shared(hot_pieces: int):
    def run(group: pa.Table) -> pa.Table:
        """Of each bucket the keys that it or another bucket has in two documents; which are hot."""
        keys = _u64(group["keys"])
        many = np.concatenate([np.unpackbits(np.frombuffer(m, dtype=np.uint8), count=len(k)).astype(bool)
                               for m, k in zip(group["many"].to_pylist(), keys, strict=True)])
        runs = np.concatenate([np.frombuffer(r, dtype=np.uint8) for r in group["runs"].to_pylist()]).astype(np.int64)
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
        sizes = np.diff(first, append=len(flat))
        good = (sizes > 1) | np.logical_or.reduceat(many[order], first)
        shared, hot = flat[order][first][good], (np.add.reduceat(runs[order], first) > hot_pieces)[good]
        rows = []
        for bucket, k in zip(group["bucket"].to_pylist(), keys, strict=True):
            pos = np.minimum(np.searchsorted(shared, k), max(len(shared) - 1, 0))
            sel = shared[pos] == k if len(shared) else np.zeros(len(k), dtype=bool)
            if sel.any():
                rows.append((bucket, k[sel].tobytes(), np.packbits(hot[pos[sel]]).tobytes()))
        return _table(_SHARED, list(zip(*rows, strict=True)) or [[]] * 3)
    return run


def _send_pieces(shards: int):
    def run(docs: pa.Table, shared: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows and shared.num_rows:
            bucket = Bucket(docs)
            keys = _u64(shared["keys"])
            hot = np.concatenate([np.unpackbits(np.frombuffer(h, dtype=np.uint8), count=len(k)).astype(bool)
                                  for h, k in zip(shared["hot"].to_pylist(), keys, strict=True)])
            flat = np.concatenate(keys)
            order = np.argsort(flat)
            names, is_hot, number, row, _, _ = bucket.distinct(flat[order], hot[order])
            first = np.full(len(names), NOBODY)
            np.minimum.at(first, number, bucket.ids[row])
            last = np.full(len(names), np.iinfo(np.int64).min)
            np.maximum.at(last, number, bucket.ids[row])
            to = _shards_of(names, is_hot, shards)
            for s in np.unique(to).tolist():
                sel = np.flatnonzero(to == s)
                texts = [names[i][1] for i in sel.tolist()]
                rows.append((s // 2, docs["bucket"][0].as_py(), s % 2 == 1,
                             np.array([len(t) for t in texts], dtype=np.uint8).tobytes(),
                             zstandard.compress(b"".join(texts), 3), first[sel].tobytes(),
                             np.packbits(first[sel] != last[sel]).tobytes()))
        return _table(_PIECES, list(zip(*rows, strict=True)) or [[]] * 7)
    return run


def _in_two(first: np.ndarray, many: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Of entries with equal ``by``: whether there are two documents among them."""
    order = np.argsort(by, kind="stable")
    value = by[order]
    head = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    docs = first[order]
    two = (np.minimum.reduceat(docs, head) != np.maximum.reduceat(docs, head)) | np.logical_or.reduceat(many[order], head)
    out = np.empty(len(by), dtype=bool)
    out[order] = np.repeat(two, np.diff(head, append=len(by)))
    return out


def covered_windows(texts: list[bytes], key: np.ndarray, first: np.ndarray, many: np.ndarray,
                    index_bytes: int = INDEX_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Per piece the document after which it is covered as a whole, and the bit
    mask of the windows that a document before its first one has.

    ``first`` is a piece's least document, ``many`` tells that it has others.
    Windows that a single document has are left out; what remains of the pieces
    is indexed some keys at a time and streamed, and a window is covered in a
    document if the index holds it for a smaller one.
    """
    whole = np.full(len(texts), NOBODY)
    covered = np.zeros(len(texts), dtype=np.uint64)
    some = np.flatnonzero(_in_two(first, many, key))
    some = some[np.argsort(key[some], kind="stable")]
    size = np.array([len(texts[i]) for i in some.tolist()], dtype=np.int64)
    heads = np.flatnonzero(np.diff(key[some], prepend=key[some[:1]] + np.uint64(1)) != 0)
    block = (np.cumsum(size) - size)[heads] // index_bytes
    cuts = [*heads[np.flatnonzero(np.diff(block, prepend=-1))].tolist(), len(some)]
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        own = some[a:z]
        whole[own], covered[own] = _covered_block([texts[i] for i in own.tolist()], first[own], many[own])
    return whole, covered


def _covered_block(strings: list[bytes], first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``covered_windows`` of the pieces of some whole keys."""
    sizes = np.array([len(t) for t in strings], dtype=np.int64)
    windows = sizes - MATCH + 1
    begin = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(strings)), windows)
    offset = np.arange(len(owner)) - begin[owner]
    hashes = window_hashes(np.frombuffer(b"".join(strings), dtype=np.uint8))[(np.cumsum(sizes) - sizes)[owner] + offset]
    keep = _in_two(first[owner], many[owner], hashes)
    # what is left: runs of windows, equal ones once with their least document
    joined = owner[1:] == owner[:-1]
    starts = np.flatnonzero(keep & np.concatenate([[True], ~(keep[:-1] & joined)]))
    stops = np.flatnonzero(keep & np.concatenate([~(keep[1:] & joined), [True]]))
    place: dict[bytes, int] = {}
    part = np.array([place.setdefault(strings[o][a:a + n + MATCH], len(place)) for o, a, n in zip(
        owner[starts].tolist(), offset[starts].tolist(), (stops - starts).tolist(), strict=True)], dtype=np.int64)
    found = np.full(len(owner), NOBODY)
    if place:
        names = list(place)
        least = np.full(len(names), NOBODY)
        np.minimum.at(least, part, first[owner[starts]])
        at, _, earliest = RunLengthIndex(names, MATCH, least).earliest_flat(names)
        n = stops - starts + 1
        found[keep] = earliest[np.repeat(at[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    bit = np.where(found < first[owner], np.uint64(1) << offset.astype(np.uint64), np.uint64(0))
    return np.maximum.reduceat(found, begin), np.bitwise_or.reduceat(bit, begin)


def _compare(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    number: dict[bytes, int] = {}
    every: list[np.ndarray] = []
    for r in rows:
        lengths = np.frombuffer(r["lengths"], dtype=np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        joined = zstandard.decompress(r["bytes"])
        every.append(np.array([number.setdefault(joined[s:e], len(number)) for s, e in zip(
            (ends - lengths).tolist(), ends.tolist(), strict=True)], dtype=np.int64))
    texts = list(number)
    flat = np.concatenate(every)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    key = window_keys(np.frombuffer(b"".join(texts), dtype=np.uint8))[np.cumsum(sizes) - sizes]
    docs = np.concatenate([np.frombuffer(r["docs"], dtype=np.int64) for r in rows])
    first = np.full(len(texts), NOBODY)
    np.minimum.at(first, flat, docs)
    many = np.zeros(len(texts), dtype=bool)
    many[flat[docs != first[flat]]] = True
    for r, own in zip(rows, every, strict=True):
        many[own[np.unpackbits(np.frombuffer(r["many"], dtype=np.uint8), count=len(own)).astype(bool)]] = True
    whole, covered = covered_windows(texts, key, first, many)
    return _table(_ANSWERS, [[r["bucket"] for r in rows], [r["shard"] for r in rows], [r["hot"] for r in rows],
                             *([v[i].tobytes() for i in every] for v in (key, whole, covered))])


def _cut(shards: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """Remove the covered bytes of one bucket's documents."""
        bucket = Bucket(docs)
        gone = np.zeros(len(bucket.flat) + 1, dtype=np.int64)
        if answers.num_rows:
            sent = answers.to_pylist()
            keys = [np.frombuffer(r["keys"], dtype=np.uint64) for r in sent]
            shared = np.unique(np.concatenate(keys))
            hot = np.isin(shared, np.concatenate([k for k, r in zip(keys, sent, strict=True) if r["hot"]] or [shared[:0]]))
            names, is_hot, number, row, start, windows = bucket.distinct(shared, hot)
            # a shard answers in the order in which its pieces were sent
            to = _shards_of(names, is_hot, shards)
            name_key = np.array([k for k, _ in names], dtype=np.uint64)
            last = np.full(len(names), NOBODY)
            covered = np.zeros(len(names), dtype=np.uint64)
            done = 0
            for r, k in zip(sent, keys, strict=True):
                sel = np.flatnonzero(to == r["shard"] * 2 + r["hot"])
                if not np.array_equal(name_key[sel], k):
                    raise ValueError("the answers do not fit the bucket's pieces")
                last[sel] = np.frombuffer(r["whole"], dtype=np.int64)
                covered[sel] = np.frombuffer(r["covered"], dtype=np.uint64)
                done += len(sel)
            if done != len(names):
                raise ValueError("a piece has no answer")
            whole = bucket.ids[row] > last[number]
            np.add.at(gone, start[whole], 1)
            np.add.at(gone, start[whole] + windows[whole] + MATCH - 1, -1)
            part = np.flatnonzero(~whole & (covered[number] > 0))
            for bit in range(PIECE_WINDOWS):
                hit = part[(covered[number[part]] >> np.uint64(bit)) & np.uint64(1) > 0]
                np.add.at(gone, start[hit] + bit, 1)
                np.add.at(gone, start[hit] + bit + MATCH, -1)
        gone = np.cumsum(gone)[:-1] > 0
        rows = []
        for doc, raw, lo, hi in zip(bucket.ids.tolist(), bucket.raw, bucket.starts.tolist(), bucket.ends.tolist(), strict=True):
            cut = gone[lo:hi]
            n = int(cut.sum())
            spans = int(cut[:1].sum() + (cut[1:] & ~cut[:-1]).sum()) if n else 0
            kept = bucket.codes[lo:hi][~cut].tobytes() if n else raw
            rows.append((doc, len(raw), n, spans, hashlib.sha256(kept).hexdigest()))
        return _table(_RESULT, list(zip(*rows, strict=True)) or [[]] * 5)
    return run


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, shard_bytes: int = SHARD_BYTES,
                   hot_pieces: int = HOT_PIECES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, shards = parts(size, bucket_bytes), parts(size, shard_bytes)
    dealt = (docs.where(F.col("doc_id").isNotNull())
             .select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                     F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int").alias("bucket")))
    keys = dealt.groupBy("bucket").applyInArrow(_send_keys(shards), _KEYS)
    shared = keys.groupBy("shard").applyInArrow(_find_shared(hot_pieces), _SHARED)
    pieces = (dealt.groupBy("bucket").cogroup(shared.groupBy("bucket"))
              .applyInArrow(_send_pieces(shards), _PIECES))
    answers = pieces.groupBy("shard").applyInArrow(_compare, _ANSWERS)
    cleaned = (dealt.groupBy("bucket").cogroup(answers.groupBy("bucket"))
               .applyInArrow(_cut(shards), _RESULT))
    text = F.coalesce("text", F.lit(""))
    nobody = docs.where(F.col("doc_id").isNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
    return cleaned.unionByName(nobody)
