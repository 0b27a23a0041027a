"""Spelling variants grouped by Bloom-guided neighbourhoods.

Words are Latin-1 letters, so a word is a row of bytes.  Its key is the sum of one random
64-bit number per (place, character), mixed; the key of an edited word follows
from the word's by one subtraction and one addition, without building the string.

The vocabulary is put into blocked Bloom filters, sharded by word length.  Every
word's one-edit neighbours are probed: deletions against the
filters one shorter, replacements by a greater character against those of
its own length; insertions and replacements by a smaller character are the same pairs
seen from the other word, so every pair comes out once.  Only positives, as (word id,
key), are shuffled to the exact vocabulary join, which then compares the two
strings.  Filters are broadcast in rounds of at most ``ROUND_BYTES``, so any
vocabulary passes.

Defined results: null and empty texts have no words; a null doc_id counts as the
empty string in the deletion rule; repeated rows count each; ties of a form
go to the smallest word in code-point order; an empty table gives no
rows; further columns are ignored.  Words of any length are treated alike (filters
of ``LONG`` characters and more share one length shard).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, parts, rows_of, small_batches, store

RUN = re.compile("[A-Za-zÀ-ÿ]+")
DROP_EVERY = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form is at least this many times as frequent as the word.
RATIO = 2
#: Words of this many characters and more share one length shard.
LONG = 64
#: Words of one filter; 16 bits a word.
PIECE_WORDS = 1 << 18
WORD_BITS = 16
#: Bytes of the filters that are broadcast at once.
ROUND_BYTES = 64 << 20
#: Words counted in a task before they are passed on.
FLUSH = 200_000
#: Edited keys held at once.
CELLS = 1 << 20

_COUNT = "word string, n long"
_KEYED = "id long, word string, n long, len int, key long"
_FILTER = "cls int, piece int, bits binary"
_POSITIVE = "id long, key long"


# ------------------------------------------------------------------ words

def words_of(text: str, doc_id: int | None) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text, after the deletion rule."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        length = len(run)
        if length < LEAST_LENGTH:
            continue
        low = run.encode().lower()  # bytes: A-Z only
        h = zlib.crc32(low, start)
        word = low.decode()
        if h % DROP_EVERY == 0:
            at = h % length
            word = word[:at] + word[at + 1:]
            if length == LEAST_LENGTH:
                continue
        yield word, n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                         ["word", "n"])
        total.clear()
        return out

    for b in rows_of(batches):
        for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
            for word, n in words_of(text.as_py() or "", doc_id):
                total[word] += n
            if len(total) >= FLUSH:
                yield flush()
    if total:
        yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_count, _COUNT)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


# ------------------------------------------------------------------ keys

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weight(place: np.ndarray, char: np.ndarray) -> np.ndarray:
    """The random number of a character at a place."""
    return mix((place.astype(np.uint64) * np.uint64(256) + char.astype(np.uint64) + np.uint64(1))
               * np.uint64(0x9E3779B97F4A7C15))


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of characters."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def sums(chars: np.ndarray) -> np.ndarray:
    """Unmixed keys of the rows of a character matrix, some columns at a time."""
    total = np.zeros(len(chars), dtype=np.uint64)
    step = max(1, CELLS // max(1, len(chars)))
    for at in range(0, chars.shape[1], step):
        place = np.arange(at, min(at + step, chars.shape[1]))
        total += weight(place[None, :], chars[:, at:at + step]).sum(axis=1, dtype=np.uint64)
    return total


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return {k: np.array(v) for k, v in out.items()}


def _key_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in rows_of(batches):
        words = b["word"].to_pylist()
        key = np.empty(len(words), dtype=np.uint64)
        for at in _by_length(words).values():
            key[at] = mix(sums(letters([words[i] for i in at])))
        yield pa.RecordBatch.from_arrays(
            [b["id"], b["word"], b["n"], pa.array([len(w) for w in words], pa.int32()), pa.array(key.view(np.int64))],
            ["id", "word", "n", "len", "key"])


def keyed(words: DataFrame) -> DataFrame:
    """(id, word, n, len, key) of ``words`` (word, n); ids are unique once stored."""
    return words.withColumn("id", F.monotonically_increasing_id()).mapInArrow(_key_words, _KEYED)


# ------------------------------------------------------------------ filters

def _probe_bits(key: np.ndarray, blocks: int) -> tuple[np.ndarray, ...]:
    """(lane, mask) twice: two lanes of one 512-bit block, four bits in each."""
    one = np.uint64(1)
    block = ((key >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    other = key * np.uint64(0x9E3779B97F4A7C15)
    out = []
    for k, shift in ((key, 0), (other, 32)):
        lane = block * np.uint64(8) + ((k >> np.uint64(shift)) & np.uint64(7))
        mask = np.zeros(len(key), dtype=np.uint64)
        for i in range(4):
            mask |= one << ((k >> np.uint64(shift + 3 + 6 * i)) & np.uint64(63))
        out += [lane, mask]
    return tuple(out)


def piece_of(key: np.ndarray, pieces: int) -> np.ndarray:
    return (mix(key) % np.uint64(pieces)).astype(np.int64)


def blocks_of(words: int, pieces: int) -> int:
    """512-bit blocks of each piece of a length shard."""
    return max(1, -(-words * WORD_BITS // (512 * pieces)))


def bloom(keys: np.ndarray, blocks: int) -> np.ndarray:
    bits = np.zeros(blocks * 8, dtype=np.uint64)
    for i in range(0, len(keys), CELLS):
        a, m, b, n = _probe_bits(keys[i:i + CELLS], blocks)
        np.bitwise_or.at(bits, a.astype(np.int64), m)
        np.bitwise_or.at(bits, b.astype(np.int64), n)
    return bits


def _build(blocks: dict[int, int]):
    def run(group: pa.Table) -> pa.Table:
        cls = group["cls"][0].as_py()
        bits = bloom(group["key"].to_numpy().view(np.uint64), blocks[cls])
        return pa.table({"cls": pa.array([cls], pa.int32()), "piece": pa.array([group["piece"][0].as_py()], pa.int32()),
                         "bits": pa.array([bits.tobytes()], pa.binary())})
    return run


def _piece_rows(pieces: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            cls = np.minimum(b["len"].to_numpy(), LONG)
            key = b["key"].to_numpy().view(np.uint64)
            piece = np.zeros(len(cls), dtype=np.int32)
            for c in np.unique(cls).tolist():
                piece[cls == c] = piece_of(key[cls == c], pieces[c])
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int32()), pa.array(piece, pa.int32()), b["key"]],
                                             ["cls", "piece", "key"])
    return run


class Filters:
    """The filters of one round: (length shard, piece) -> bits."""

    def __init__(self, bits: dict[tuple[int, int], np.ndarray], pieces: dict[int, int], blocks: dict[int, int]):
        self.bits, self.pieces, self.blocks = bits, pieces, blocks
        self.shards = {c for c, _ in bits}

    def hit(self, length: int, key: np.ndarray) -> np.ndarray:
        """Places in ``key`` that some word of that length may have."""
        cls = min(length, LONG)
        if cls not in self.shards:
            return np.empty(0, dtype=np.int64)
        pieces, found = self.pieces[cls], []
        piece = piece_of(key, pieces) if pieces > 1 else None
        for p in range(pieces):
            bits = self.bits.get((cls, p))
            if bits is None:
                continue
            at = np.arange(len(key)) if piece is None else np.flatnonzero(piece == p)
            some = key[at]
            a, m, b, n = _probe_bits(some, self.blocks[cls])
            ok = (bits[a.astype(np.int64)] & m) == m
            at, b, n = at[ok], b[ok], n[ok]
            found.append(at[(bits[b.astype(np.int64)] & n) == n])
        return np.concatenate(found) if found else np.empty(0, dtype=np.int64)


# ------------------------------------------------------------------ probing

def probe(ids: np.ndarray, chars: np.ndarray, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, keys) of the neighbours that pass; ``chars`` has words of one length."""
    n, length = chars.shape
    rows = max(1, CELLS // (length * max(1, len(alphabet))))
    for r in range(0, n, rows):
        some, who = chars[r:r + rows], ids[r:r + rows]
        total = sums(some)
        before = np.zeros(len(some), dtype=np.uint64)  # weights of the characters left of the step
        left = np.zeros(len(some), dtype=np.uint64)  # the same characters' weights one place to the left
        shifted = sums(some[:, 1:]) if length > 1 else np.zeros(len(some), dtype=np.uint64)
        columns = max(1, CELLS // (len(some) * max(1, len(alphabet))))
        for at in range(0, length, columns):
            part = some[:, at:at + columns]
            place = np.arange(at, at + part.shape[1])
            own = weight(place[None, :], part)
            # deletions: prefix as it is, suffix one place to the left
            pre = np.cumsum(own, axis=1, dtype=np.uint64)
            moved = np.cumsum(np.where(place[None, :] > 0, weight(np.maximum(place - 1, 0)[None, :], part), np.uint64(0)),
                              axis=1, dtype=np.uint64)
            cut = (before[:, None] + pre - own) + (shifted - left)[:, None] - moved
            first = np.ones(part.shape, dtype=bool)  # of a run of equal characters one deletion
            first[:, 1:] = part[:, 1:] != part[:, :-1]
            if at:
                first[:, 0] = part[:, 0] != some[:, at - 1]
            if length > LEAST_LENGTH:
                w, _ = np.nonzero(first)
                key = mix(cut[first])
                ok = filters.hit(length - 1, key)
                yield who[w[ok]], key[ok]
            before, left = before + pre[:, -1], left + moved[:, -1]
            # replacements by a greater character
            w, c, a = np.nonzero(alphabet[None, None, :] > part[:, :, None])
            if len(w):
                put = weight(place[:, None], alphabet[None, :])
                key = mix((total[:, None] - own)[w, c] + put[c, a])
                ok = filters.hit(length, key)
                yield who[w[ok]], key[ok]


def _probe(filters, alphabet: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, chars = filters.value, np.array(alphabet, dtype=np.uint8)
        for b in rows_of(batches):
            words, ids = b["word"].to_pylist(), b["id"].to_numpy()
            for at in _by_length(words).values():
                for who, key in probe(ids[at], letters([words[i] for i in at]), chars, f):
                    if len(who):
                        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(key.view(np.int64))], ["id", "key"])
    return run


def positives(words: DataFrame, round_bytes: int = ROUND_BYTES, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(id, key): words and keys of their neighbours that a filter lets through; ``words`` is stored."""
    spark = words.sparkSession
    counts = {r["cls"]: r["c"] for r in words.groupBy(F.least("len", F.lit(LONG)).alias("cls"))
              .agg(F.count(F.lit(1)).alias("c")).collect()}  # at most LONG rows
    pieces = {c: parts(n, piece_words) for c, n in counts.items()}
    blocks = {c: blocks_of(n, pieces[c]) for c, n in counts.items()}
    # at most as many characters as Latin-1 has letters
    alphabet = sorted(ord(r["c"]) for r in words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c"))
                      .where("c <> ''").distinct().collect())
    cells = words.select("len", "key").mapInArrow(_piece_rows(pieces), "cls int, piece int, key long")
    filters = store(cells.groupBy("cls", "piece").applyInArrow(_build(blocks), _FILTER), "filters")
    rounds, used = [], round_bytes + 1
    for c in sorted(pieces):
        for p in range(pieces[c]):
            if used + blocks[c] * 64 > round_bytes:
                rounds.append([])
                used = 0
            rounds[-1].append((c, p))
            used += blocks[c] * 64
    out = None
    for names in rounds:
        low, high = names[0][0], names[-1][0]
        pick = filters.where(F.col("cls").between(low, high))
        if len(rounds) > 1:
            pick = pick.where(F.concat_ws(":", "cls", "piece").isin([f"{c}:{p}" for c, p in names]))
        bits = {(r["cls"], r["piece"]): np.frombuffer(bytes(r["bits"]), dtype=np.uint64) for r in pick.collect()}
        sent = spark.sparkContext.broadcast(Filters(bits, pieces, blocks))
        near = words.where(F.col("len") >= low)
        if high < LONG:
            near = near.where(F.col("len") <= high + 1)
        found = near.select("id", "word").mapInArrow(_probe(sent, alphabet), _POSITIVE)
        out = found if out is None else out.union(found)
    return out


def pairs(words: DataFrame, **sizes: int) -> DataFrame:
    """(a, b): ids of the words of ``words`` (id, word, n, len, key; stored) that are one edit apart, each pair once."""
    some = store(positives(words, **sizes), "positives")
    exact = some.join(words.select("key", F.col("id").alias("b"), F.col("word").alias("other")), "key")
    return (exact.join(words.select("id", "word"), "id")
            .where(F.levenshtein("word", "other", 1) == 1).select(F.col("id").alias("a"), "b"))


# ------------------------------------------------------------------ forms

def roots(up: DataFrame) -> DataFrame:
    """(id, root) of every row of ``up`` (id, form): forms followed to the last,
    doubling the steps each round."""
    now = store(up.select("id", F.col("form").alias("root")), "up")
    while True:
        step = now.select(F.col("id").alias("_id"), F.col("root").alias("_next"))
        after = store(now.join(step, now["root"] == step["_id"], "left")
                      .select("id", F.coalesce("_next", "root").alias("root"), F.col("_id").isNotNull().alias("moved")), "up")
        moved = after.where("moved").isEmpty()
        drop(now)
        now = after
        if moved:
            return now.select("id", "root")


def variants(docs: DataFrame, **sizes: int) -> DataFrame:
    """word, form, root, n, n_near, form_n of the vocabulary of ``docs``."""
    words = store(keyed(vocabulary(docs)), "words")
    if words.isEmpty():
        return words.sparkSession.createDataFrame(
            [], "word string, form string, root string, n long, n_near long, form_n long")
    links = store(pairs(words, **sizes), "pairs")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("id").alias("b"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = both.join(other, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("word"), F.col("b").alias("id"))).alias("best"))
    has = -F.col("best.minus") >= RATIO * F.col("n")
    rows = store(words.join(near, words["id"] == near["a"], "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best.word")).alias("form"),
        F.when(has, F.col("best.id")).alias("up"), F.when(has, -F.col("best.minus")).alias("form_n")), "forms")
    top = roots(rows.where("up is not null").select("id", F.col("up").alias("form")))
    named = top.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return rows.join(named, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
