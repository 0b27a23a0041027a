"""Edit-aware token counts.

A document is cut into segments of about ``SEGMENT`` characters at places where
no token crosses in any context.  A binary tree over the segments holds the sums
of characters and tokens.  ``trees`` builds one tree a row, a table that is kept;
``recount`` takes the kept trees with edits, re-encodes only the segments that an
edit touches, plus their neighbours while a cut next to the edit is no longer
such a place, and updates the sums on the way to the root.  The result is a tree
again.

A cut is such a place between two characters if the pre-token pattern always
ends a token there: in front of white space behind anything else, and between
letters, digits and other signs, but for an apostrophe before a letter.  Inside
a run of letters (texts without spaces) two characters beyond ASCII may also be
cut if no token of the vocabulary holds the bytes at the cut next to each other,
so that no merge can cross it.  Characters whose class has changed since Unicode
3.2 are never cut.

Defined results: null and empty texts have no tokens; a text without such a
place, however long, is one segment, exactly counted; edits are given in
ascending places of the original text and do not overlap; an edit names the
document and the version (hash) of its text, and applies to every row of both;
repeated rows are counted as often as they occur; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, small_batches, store

SEGMENT = 512

# What the registered query's edits mask, and their mask.
MASKED = re.compile(
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"  # mail address
    r"|\b\d{1,3}(?:\.\d{1,3}){3}\b"  # IPv4 address
    r"|\b\d{9,}\b"  # card or phone number
    r"|\b(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,}\b")  # key
MASK = "[masked]"

_ENCODINGS: dict[str, Callable[[str], int]] = {}
Edit = tuple[int, int, str]


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def counter(path: str) -> Callable[[str], int]:
    """Number of tokens of a text under a byte-level vocabulary file."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken
        enc = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(path),
                                special_tokens={})
        _ENCODINGS[path] = lambda text: len(enc.encode_ordinary(text))
    return _ENCODINGS[path]


_SPACE, _LETTER, _DIGIT, _SIGN, _QUOTE, _UNKNOWN = range(6)
# The characters of the property White_Space.
_WHITE = {*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}


@cache
def _classes() -> np.ndarray:
    """Class of every code point for the pre-token pattern."""
    out = np.full(0x110000, _UNKNOWN, dtype=np.uint8)
    now, then = unicodedata.category, unicodedata.ucd_3_2_0.category
    for c in range(0x110000):
        ch = chr(c)
        kind = now(ch)
        if kind != "Cn" and kind == then(ch):
            out[c] = {"L": _LETTER, "N": _DIGIT}.get(kind[0], _SIGN)
    out[list(_WHITE)] = _SPACE
    out[ord("'")] = _QUOTE
    return out


@cache
def _ends() -> np.ndarray:
    """Whether a pre-token always ends between two classes."""
    ok = np.zeros((6, 6), dtype=bool)
    ok[[_LETTER, _DIGIT, _SIGN, _QUOTE], _SPACE] = True
    ok[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = True
    ok[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = True
    ok[_SIGN, [_LETTER, _DIGIT]] = True
    ok[_QUOTE, _DIGIT] = True
    return ok


@cache
def _neighbours(path: str) -> np.ndarray:
    """Byte pairs that stand next to each other in some token."""
    pairs = np.zeros((256, 256), dtype=bool)
    for token in _ranks(path):
        raw = np.frombuffer(token, dtype=np.uint8)
        pairs[raw[:-1], raw[1:]] = True
    return pairs


def cuts(text: str, path: str) -> np.ndarray:
    """Places of the text that no token crosses, whatever stands around them."""
    code = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    kind = _classes()[code]
    a, b = kind[:-1], kind[1:]
    ok = _ends()[a, b]
    run = np.flatnonzero((a == b) & (a != _SPACE) & (a != _UNKNOWN) & (code[:-1] > 127) & (code[1:] > 127))
    if len(run):
        left, right = code[run], code[run + 1]
        first = np.where(right < 0x800, 0xC0 | right >> 6, np.where(right < 0x10000, 0xE0 | right >> 12, 0xF0 | right >> 18))
        ok[run] = ~_neighbours(path)[0x80 | left & 0x3F, first]
    return np.flatnonzero(ok) + 1


def segments(text: str, path: str) -> list[str]:
    """Pieces of the text that encode on their own as they do together."""
    if len(text) <= SEGMENT:
        return [text] if text else []
    places = [*cuts(text, path).tolist(), len(text)]
    out, at, i = [], 0, 0
    while at < len(text):
        while places[i] < min(at + SEGMENT, len(text)):
            i += 1
        out.append(text[at:places[i]])
        at = places[i]
    return out


class SegmentTree:
    """Token sums over the segments of one document."""

    def __init__(self, path: str, parts: list[str], tokens: list[int] | None = None, chars: list[int] | None = None):
        """From the segments alone, or with the sums of a kept tree."""
        self.path = path
        self.count = counter(path)
        self.encoded = 0  # characters encoded since the tree was built
        self.parts = parts
        if tokens is None or chars is None:
            self._build([self.count(p) for p in parts])
        else:
            self.width, self.tokens, self.chars = len(tokens) // 2, tokens, chars

    @classmethod
    def of(cls, text: str, path: str) -> SegmentTree:
        return cls(path, segments(text, path))

    def _build(self, counts: list[int]) -> None:
        self.width = 1
        while self.width < len(self.parts):
            self.width *= 2
        pad = [0] * (self.width - len(self.parts))
        self.tokens = [0] * self.width + counts + pad
        self.chars = [0] * self.width + [len(p) for p in self.parts] + pad
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]

    @property
    def total(self) -> int:
        """Tokens of the document as it is now."""
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def _find(self, place: int) -> tuple[int, int]:
        """(segment, characters before it) of the segment that holds a place."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if place - before >= self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.width, before

    def _set(self, i: int, part: str, tokens: int) -> None:
        self.parts[i] = part
        node = self.width + i
        self.tokens[node], self.chars[node] = tokens, len(part)
        node //= 2
        while node:
            self._sum(node)
            node //= 2

    def _joined(self, left: str, right: str) -> bool:
        """Whether a token might cross the border of two neighbouring texts."""
        return not (left and right and len(cuts(left[-1] + right[0], self.path)))

    def edit(self, start: int, stop: int, text: str) -> None:
        """Replace the characters [start, stop) of the document as it is now."""
        if not self.parts:
            self.parts = [""]
        first, before = self._find(start)
        last, _ = self._find(max(start, stop - 1))
        old = "".join(self.parts[first:last + 1])
        new = old[:start - before] + text + old[stop - before:]
        # an emptied or changed border may no longer be a cut: take the neighbour in
        while True:
            left = next((i for i in range(first - 1, -1, -1) if self.parts[i]), None)
            right = next((i for i in range(last + 1, len(self.parts)) if self.parts[i]), None)
            if left is not None and self._joined(self.parts[left], new):
                new, first = self.parts[left] + new, left
            elif right is not None and self._joined(new, self.parts[right]):
                new, last = new + self.parts[right], right
            else:
                break
        self.encoded += len(new)
        pieces = segments(new, self.path) if len(new) > 2 * SEGMENT else [new]
        counts = [self.count(p) if p else 0 for p in pieces]
        if len(pieces) > last + 1 - first:  # more leaves than there were: only the sums are built anew
            leaves = self.tokens[self.width:self.width + len(self.parts)]
            self.parts[first:last + 1] = pieces
            self._build(leaves[:first] + counts + leaves[last + 1:])
            return
        for k, i in enumerate(range(first, last + 1)):
            if k < len(pieces):
                self._set(i, pieces[k], counts[k])
            elif self.parts[i]:
                self._set(i, "", 0)


def masks(text: str) -> list[Edit]:
    """Edits that mask personal data and keys."""
    return [(m.start(), m.end(), MASK) for m in MASKED.finditer(text)]


_TREE = "doc_id long, version long, parts array<string>, tokens array<long>, chars array<long>"
_RESULT = ("doc_id long, n_tokens long, n_segments long, n_edits long, n_tokens_edited long, "
           "n_chars_edited long, n_chars_encoded long")
_LONGS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())


def _grow(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or vocabulary_path()
        for b in rows_of(batches):
            made = [SegmentTree.of(t or "", file) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].cast(pa.int64()), b["version"], pa.array([t.parts for t in made], _STRINGS),
                 pa.array([t.tokens for t in made], _LONGS), pa.array([t.chars for t in made], _LONGS)],
                ["doc_id", "version", "parts", "tokens", "chars"])
    return run


def trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Segment tree of every row: doc_id, version (hash of the text), parts (segments), tokens and chars (sums:
    node n has the children 2n and 2n + 1, the root is 1)."""
    small_batches(docs.sparkSession)
    return (docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
            .mapInArrow(_grow(path), _TREE))


def with_edits(kept: DataFrame, edits: DataFrame) -> DataFrame:
    """Kept trees with their rows of ``edits`` (doc_id, version, start, stop, text) as a column ``edits``."""
    mine = (edits.groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version"))
            .agg(F.array_sort(F.collect_set(F.struct("start", "stop", "text"))).alias("edits")))
    return (kept.join(mine, kept["doc_id"].eqNullSafe(mine["_id"]) & (kept["version"] == mine["_version"]), "left")
            .drop("_id", "_version"))


def _recount(path: str | None, edits_of: Callable[[str], list[Edit]] | None, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or vocabulary_path()
        for b in rows_of(batches):
            rows, made = [], []
            given = b["edits"].to_pylist() if edits_of is None else [None] * b.num_rows
            for doc, parts, tokens, chars, told in zip(*(b[c].to_pylist() for c in ("doc_id", "parts", "tokens", "chars")),
                                                       given, strict=True):
                tree = SegmentTree(file, parts, tokens, chars)
                before, size, shift = tree.total, len(parts), 0
                edits = edits_of(tree.text) if edits_of else [(e["start"], e["stop"], e["text"]) for e in told or []]
                for start, stop, new in edits:
                    tree.edit(start + shift, stop + shift, new)
                    shift += len(new) - (stop - start)
                rows.append((doc, before, size, len(edits), tree.total, tree.chars[1], tree.encoded))
                made.append(tree)
            names = ["doc_id", "n_tokens", "n_segments", "n_edits", "n_tokens_edited", "n_chars_edited", "n_chars_encoded"]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            if keep:
                names += ["parts", "tokens", "chars"]
                cols += [pa.array([t.parts for t in made], _STRINGS), pa.array([t.tokens for t in made], _LONGS),
                         pa.array([t.chars for t in made], _LONGS)]
            yield pa.RecordBatch.from_arrays(cols, names)
    return run


def recount(kept: DataFrame, edits_of: Callable[[str], list[Edit]] | None = None, keep: bool = False,
            path: str | None = None) -> DataFrame:
    """Tokens of kept trees behind their edits (the column ``edits``, or what ``edits_of`` gives for a text); with
    ``keep`` also the trees as they are then."""
    small_batches(kept.sparkSession)
    columns = ["doc_id", "parts", "tokens", "chars"] + ([] if edits_of else ["edits"])
    schema = _RESULT + (", parts array<string>, tokens array<long>, chars array<long>" if keep else "")
    return kept.select(*columns).mapInArrow(_recount(path, edits_of, keep), schema)


def edited(kept: DataFrame) -> DataFrame:
    """Trees to keep from the rows of ``recount(..., keep=True)``: with the versions of their new texts."""
    return kept.select("doc_id", F.xxhash64(F.concat_ws("", "parts")).alias("version"), "parts", "tokens", "chars")


def token_counts(docs: DataFrame, path: str | None = None,
                 edits_of: Callable[[str], list[Edit]] = masks) -> DataFrame:
    """Per document its tokens, its edits, and its tokens behind them, counted on the kept trees."""
    return recount(store(trees(docs, path), "trees"), edits_of, path=path)
