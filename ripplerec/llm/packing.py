"""Pattern packing: few-document length patterns fitted by non-negative least squares.

Documents become token pieces of at most ``CAPACITY`` ids.  Only the histogram
of piece lengths (at most CAPACITY rows, whatever the corpus) comes to the
driver.  There every pattern of one to three lengths that fills a sequence
exactly is enumerated, repeat counts are fitted to the histogram by accelerated
projected gradient descent, rounded by error diffusion, clipped to what is
left, and the residual lengths are packed best fit, longest first.  The plan
says, for the r-th piece of a length, which sequence and place it takes; the
ranks are computed in Spark in buckets of every length, so that a length that
a third of the pieces share is no single task.

Defined results: null and empty texts are one id 0; a table without rows gives
no rows; repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, rows_of, small_batches, store

CAPACITY = 2048
#: Words whose ids a worker remembers; beyond it the memory is emptied.
CACHE_WORDS = 1_000_000
#: Pieces of one length that are ranked by one task.
RANK_ROWS = 20_000

_TOKENIZERS: dict[str, tuple] = {}


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str):
    """Function from texts to packed little-endian uint32 ids.

    The vocabulary drops white space and never merges across it, so a text's
    ids are those of its space-separated words, and a word met before is not
    encoded again.
    """
    if path not in _TOKENIZERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _TOKENIZERS[path] = (Tokenizer.from_file(path), {})
    tok, seen = _TOKENIZERS[path]

    def words(text: str) -> list[bytes]:
        raw = text.encode()
        # the tokenizer lowers letters itself; special tokens keep their case
        return (raw if b"<|" in raw else raw.lower()).split()

    def learn(some: list[bytes]) -> None:
        """Encode new words as one text; tokens are told apart by their places."""
        plain = [w.decode() for w in some]
        begin = np.cumsum([0, *(len(w) + 1 for w in plain)])
        e = tok.encode(" ".join(plain), add_special_tokens=False)
        word = np.searchsorted(begin, [o[0] for o in e.offsets], side="right") - 1
        cut = (4 * np.searchsorted(word, np.arange(len(some) + 1))).tolist()
        packed = np.array(e.ids, dtype="<u4").tobytes()
        for w, lo, hi in zip(some, cut, cut[1:], strict=False):
            seen[w] = packed[lo:hi]

    def encode(texts: list[str]) -> list[bytes]:
        split = [words(t) for t in texts]
        new = list(set().union(*split).difference(seen))
        if new:
            if len(seen) + len(new) > CACHE_WORDS:
                seen.clear()
                new = list(set().union(*split))
            for at in range(0, len(new), 4096):
                learn(new[at:at + 4096])
        get = seen.__getitem__
        return [b"".join(map(get, ws)) for ws in split]

    return encode


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in rows_of(batches):
            cols: list[list] = [[], [], [], [], []]
            ids = b["doc_id"].to_pylist()
            for at in range(0, len(ids), 64):
                some = encode([t or "" for t in b["text"].slice(at, 64).to_pylist()])
                for doc, packed in zip(ids[at:at + 64], some, strict=True):
                    packed += b"\0\0\0\0"
                    for piece, lo in enumerate(range(0, len(packed), capacity * 4)):
                        part = packed[lo:lo + capacity * 4]
                        for c, v in zip(cols, (doc, piece, lo // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_cut(path or tokenizer_path(), capacity), _PIECES)


def patterns(capacity: int, present: np.ndarray) -> np.ndarray:
    """All patterns of two or three present lengths that fill ``capacity``
    exactly; rows are ascending, padded with zeros at the front."""
    has = np.zeros(capacity + 1, dtype=bool)
    has[present] = True
    a = present[(2 * present <= capacity)]
    two = a[has[capacity - a]]
    out = [np.stack([np.zeros_like(two), two, capacity - two], axis=1)]
    for small in present[3 * present <= capacity]:
        b = present[(present >= small) & (small + 2 * present <= capacity)]
        c = capacity - small - b
        ok = has[c]
        out.append(np.stack([np.full(ok.sum(), small), b[ok], c[ok]], axis=1))
    return np.concatenate(out)


def fit(pats: np.ndarray, hist: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeat counts that minimise the weighted squared misfit to
    the histogram (long pieces weigh more: short ones are easy to place)."""
    size = len(hist)
    w = np.arange(size, dtype=float) / size
    w[0] = 0.0

    def forward(x):
        return sum(np.bincount(pats[:, j], weights=x, minlength=size) for j in range(3))

    def back(r):
        r = r * w
        return r[pats[:, 0]] + r[pats[:, 1]] + r[pats[:, 2]]

    v = np.ones(len(pats))
    for _ in range(12):  # the largest eigenvalue sets the step
        v = back(forward(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1.0 / (1.05 * norm)
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0.0, y - step * back(forward(y) - hist))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def best_fit(hist: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit, longest first, over lengths with multiplicities: a list of
    (content as (length, copies) runs, number of equal sequences)."""
    open_: dict[int, list] = {}
    spaces: list[int] = []

    def put(space: int, content: tuple, n: int) -> None:
        if n:
            if space not in open_:
                bisect.insort(spaces, space)
                open_[space] = []
            open_[space].append((content, n))

    for length in sorted(hist, reverse=True):
        left = hist[length]
        while left:
            k = bisect.bisect_left(spaces, length)
            if k == len(spaces):
                each = capacity // length
                put(capacity - each * length, ((length, each),), left // each)
                rest = left % each
                if rest:
                    put(capacity - rest * length, ((length, rest),), 1)
                left = 0
                continue
            space = spaces[k]
            content, n = open_[space].pop()
            if not open_[space]:
                del open_[space]
                spaces.pop(k)
            each = min(space // length, left)
            use = min(n, left // each)
            put(space, content, n - use)
            put(space - each * length, (*content, (length, each)), use)
            left -= each * use
    return [group for space in spaces for group in open_[space]]


def plan(hist: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Slots as arrays sorted by (length, first): the r-th piece of a length
    takes sequence ``base + r - first`` at ``offset`` of the slot whose
    [first, first + count) holds r."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in hist.items():
        left[length] = n
    groups: list[tuple[tuple[tuple[int, int], ...], int]] = []
    if left[capacity]:
        groups.append((((capacity, 1),), int(left[capacity])))
        left[capacity] = 0
    present = np.flatnonzero(left)
    pats = patterns(capacity, present) if len(present) else np.zeros((0, 3), dtype=np.int64)
    if len(pats):
        x = fit(pats, left.astype(float))
        order = np.argsort(-x, kind="stable")
        total = np.floor(np.cumsum(x[order]) + 0.5).astype(np.int64)
        repeats = np.diff(total, prepend=0)
        used = np.flatnonzero(repeats)
        for p, want in zip(pats[order[used]].tolist(), repeats[used].tolist(), strict=True):
            need: dict[int, int] = {}
            for length in p:
                if length:
                    need[length] = need.get(length, 0) + 1
            n = min(want, *(int(left[length]) // k for length, k in need.items()))
            if n:
                groups.append((tuple(need.items()), n))
                for length, k in need.items():
                    left[length] -= n * k
    groups += best_fit({int(k): int(left[k]) for k in np.flatnonzero(left)}, capacity)
    rows: list[tuple[int, int, int, int, int]] = []
    taken = np.zeros(capacity + 1, dtype=np.int64)
    base = 0
    for content, n in groups:
        offset = 0
        for length, copies in content:
            for _ in range(copies):
                rows.append((length, int(taken[length]), n, base, offset))
                taken[length] += n
                offset += length
        base += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return {"length": table[:, 0], "first": table[:, 1], "base": table[:, 3], "offset": table[:, 4],
            "begin": np.searchsorted(table[:, 0], np.arange(capacity + 2)), "sequences": np.array([base])}


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in rows_of(batches):
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            at = np.empty(len(length), dtype=np.int64)
            for v in np.unique(length):
                sel = length == v
                lo, hi = p["begin"][v], p["begin"][v + 1]
                at[sel] = lo + np.searchsorted(p["first"][lo:hi], rank[sel], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [b[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(p["base"][at] + rank - p["first"][at]), pa.array(p["offset"][at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    spark = docs.sparkSession
    cut = store(pieces(docs, path, capacity), "pieces")
    hist = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = spark.sparkContext.broadcast(plan(hist, capacity))
    buckets = parts(max(hist.values(), default=1), RANK_ROWS)
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (rows.withColumn("r", F.row_number().over(inside)).join(starts, ["length", "bucket"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("r") - 1 + F.col("first")).alias("rank")))
    return ranked.mapInArrow(_place(shared), _PIECES + ", sequence_id long, offset long")
