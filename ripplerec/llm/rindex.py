"""Run-length Burrows-Wheeler index with streamed matching statistics.

The index of a set of byte strings keeps the runs of their joined
Burrows-Wheeler transform and the suffix positions at both ends of every run.
Patterns are streamed right to left, all of them at once: while the current
row's transform character is the pattern's, one backward step lengthens the
match; otherwise the match restarts from the nearer run end above or below
that holds the character, whichever shares the longer prefix.  A match of full
length also tells the least owner of all strings that hold it.
"""

from __future__ import annotations

import numpy as np

#: Ends every indexed string; smaller than any byte + 1.
SEPARATOR = 0
#: Owner of a place whose match is shorter than the limit.
NOBODY = np.iinfo(np.int64).max


def _suffix_order(text: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffix array by prefix doubling; ranks by the first ``width`` symbols, and that width.

    The width is the largest one reached that is at most ``limit``.  Only
    suffixes that still share their rank are sorted again.
    """
    n = len(text)
    bits = max(int(text.max(initial=0)) + 1, 1).bit_length()
    width = max(1, min(4, limit, 62 // bits))
    key = np.zeros(n, dtype=np.int64)
    for d in range(width):
        key <<= bits
        key[:max(n - d, 0)] += text[d:] + 1
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, dtype=np.int64)  # of a suffix: the first row of its equals
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rows = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    short, short_width = rank, width
    while len(rows):
        if width <= limit:
            short, short_width = rank.copy(), width
        pos = order[rows]
        beyond = np.minimum(pos + width, n - 1)
        key = rank[pos] * (n + 1) + np.where(pos + width < n, rank[beyond] + 1, 0)
        by = np.argsort(key)
        pos, key = pos[by], key[by]
        order[rows] = pos
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[pos] = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        rows = rows[~(new & np.concatenate([new[1:], [True]]))]
        width *= 2
    return (order, short, short_width) if width > limit else (order, rank, width)


class RunLengthIndex:
    """Index of byte strings; ``limit`` is the longest match that matters.

    ``owners`` numbers the strings, e.g. by document; ``earliest`` needs it.
    """

    def __init__(self, strings: list[bytes], limit: int, owners: np.ndarray | None = None):
        self.limit = limit
        symbols, ends = self._symbols(strings)
        # separators are distinct and smaller than all symbols: suffixes never
        # compare beyond their string, and the transform is a permutation
        k = len(strings)
        inner = symbols >= 0
        self.alphabet = np.flatnonzero(np.bincount(symbols[inner], minlength=256))
        self.number = np.zeros(257, dtype=np.int64)  # of a byte in the alphabet, from 1; 0 is none
        self.number[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        flat = np.empty(len(symbols), dtype=np.int64)
        flat[ends - 1] = np.arange(k)
        flat[inner] = self.number[symbols[inner]] + k - 1
        self.words, self.left = self._words(strings, ends)
        order, rank, width = _suffix_order(flat, limit)
        bwt = flat[order - 1]  # of position 0: the last separator
        bwt[bwt < k] = SEPARATOR if k else 0
        bwt[bwt >= k] -= k - 1
        starts = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.size = len(flat)
        self.start = starts
        self.char = bwt[starts]
        self.end = np.concatenate([starts[1:], [self.size]])
        # sampled run ends: the suffix position before the row's suffix
        self.first_pos = order[starts] - 1
        self.last_pos = order[self.end - 1] - 1
        # runs by character, with the number of the character's rows before each
        self.by_char = np.argsort(self.char.astype(np.uint16), kind="stable")
        length = (self.end - self.start)[self.by_char]
        chars = self.char[self.by_char]
        before = np.cumsum(length) - length
        first = np.concatenate([[True], chars[1:] != chars[:-1]])
        self.before = before - np.maximum.accumulate(np.where(first, before, 0))
        counts = np.bincount(chars, weights=length, minlength=len(self.alphabet) + 1).astype(np.int64)
        self.smaller = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.wide = self.size + 1
        self.key = chars * self.wide + self.start[self.by_char]
        # what a backward step inside a run adds to the row; run of every row
        self.step = np.empty(len(starts), dtype=np.int64)
        self.step[self.by_char] = self.smaller[chars] + self.before - self.start[self.by_char]
        self.run_at = np.repeat(np.arange(len(starts), dtype=np.int32), self.end - self.start)
        if owners is not None and k:
            # rows whose suffixes share their first ``limit`` symbols, with their least owner
            whole = order + limit <= self.size
            tail = rank[np.minimum(order + limit - width, self.size - 1)]
            head = rank[order]
            same = (head[1:] == head[:-1]) & (tail[1:] == tail[:-1]) & whole[1:] & whole[:-1]
            self.class_start = np.flatnonzero(np.concatenate([[True], ~same]))
            owner = np.repeat(np.asarray(owners, dtype=np.int64), np.diff(ends, prepend=0))
            self.class_owner = np.minimum.reduceat(owner[order], self.class_start)

    @staticmethod
    def _symbols(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the joined strings, -1 behind each; ends of the strings."""
        sizes = np.array([len(s) + 1 for s in strings], dtype=np.int64)
        ends = np.cumsum(sizes)
        out = np.frombuffer(b"\0".join([*strings, b""]), dtype=np.uint8).astype(np.int64)
        out[ends - 1] = -1
        return out, ends

    @staticmethod
    def _words(strings: list[bytes], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every place of the joined strings the next 8 bytes as one number, and the bytes left in its string."""
        sizes = np.diff(ends, prepend=0)
        raw = b"\0".join(strings) + bytes(72)
        words = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
        return words, np.repeat(ends - 1, sizes) - np.arange(sizes.sum())

    def _compare(self, pos: np.ndarray, words: np.ndarray, left: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Common prefix, up to the limit, of text[pos:] and the pattern at ``at``, 8 bytes at a time."""
        out = np.minimum(np.minimum(self.left[pos], left[at]), self.limit)
        live = np.flatnonzero(out)
        for d in range(0, self.limit, 8):
            if not len(live):
                break
            differ = self.words[pos[live] + d] ^ words[at[live] + d]
            some = np.flatnonzero(differ)
            if len(some):
                x = differ[some]
                low = (x & (~x + np.uint64(1))).astype(np.float64)  # a power of two: the first differing bit
                out[live[some]] = np.minimum(out[live[some]], d + (np.frexp(low)[1] - 1) // 8)
            live = live[(differ == 0) & (out[live] > d + 8)]
        return out

    def matching_statistics(self, patterns: list[bytes]) -> list[np.ndarray]:
        """Per pattern and place: length (up to the limit) of the longest
        prefix of the rest that occurs in an indexed string."""
        first, lengths, match, _ = self._stream(patterns)
        return [match[f:f + n] for f, n in zip(first.tolist(), lengths.tolist(), strict=True)]

    def earliest(self, patterns: list[bytes]) -> list[np.ndarray]:
        """Per pattern and place: least owner of the strings that hold the next
        ``limit`` bytes, ``NOBODY`` where the match is shorter."""
        first, lengths, out = self.earliest_flat(patterns)
        return [out[f:f + n] for f, n in zip(first.tolist(), lengths.tolist(), strict=True)]

    def earliest_flat(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``earliest`` of all patterns in one array; where each begins in it, and its length."""
        first, lengths, match, row = self._stream(patterns)
        out = np.full(len(match), NOBODY)
        hit = np.flatnonzero(match >= self.limit)
        if len(hit):
            out[hit] = self.class_owner[np.searchsorted(self.class_start, row[hit], side="right") - 1]
        return first, lengths, out

    def _stream(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start and length of every pattern in the joined patterns; per place
        of these the match's length and a row of the index that has it."""
        lengths = np.array([len(p) for p in patterns], dtype=np.int64)
        symbols, ends = self._symbols(patterns)
        words, left = self._words(patterns, ends)
        code = self.number[symbols]  # of -1: the last entry, none
        code[code == 0] = -1  # the text has no such symbol
        out = np.zeros(len(code), dtype=np.int64)
        rows = np.zeros(len(code), dtype=np.int64)
        first = ends - 1 - lengths
        # the longest patterns first: those that still have characters are always the first ones
        order = np.argsort(-lengths, kind="stable")
        falling = lengths[order]
        last = (ends - 2)[order]
        row = np.zeros(len(patterns), dtype=np.int64)
        match = np.zeros(len(patterns), dtype=np.int64)
        longest = int(falling[0]) if len(falling) else 0
        still = len(falling) - np.searchsorted(falling[::-1], np.arange(longest), side="right")
        for step, n in enumerate(still.tolist()):
            at, r, m = last[:n] - step, row[:n], match[:n]
            c = code[at]
            run = self.run_at[r]
            other = np.flatnonzero(self.char[run] != c)
            nxt = r + self.step[run]
            grown = np.minimum(m + 1, self.limit)
            if len(other):
                nxt[other], grown[other] = r[other], 0
                jump = other[c[other] > 0]
                if len(jump):
                    # the character's last run that starts before the row, and its next one
                    cj, here = c[jump], at[jump]
                    up = np.searchsorted(self.key, cj * self.wide + r[jump], side="right") - 1
                    has_up = (up >= 0) & (self.char[self.by_char[np.maximum(up, 0)]] == cj)
                    down = np.minimum(up + 1, len(self.key) - 1)
                    has_down = (up + 1 < len(self.key)) & (self.char[self.by_char[down]] == cj)
                    u = np.maximum(up, 0)
                    ru, rd = self.by_char[u], self.by_char[down]
                    lu = np.where(has_up, self._compare(self.last_pos[ru], words, left, here), -1)
                    ld = np.where(has_down, self._compare(self.first_pos[rd], words, left, here), -1)
                    take_up = lu >= ld
                    nxt[jump] = self.smaller[cj] + np.where(
                        take_up, self.before[u] + self.end[ru] - 1 - self.start[ru], self.before[down])
                    grown[jump] = np.minimum(np.maximum(lu, ld), m[jump] + 1)
            row[:n], match[:n] = nxt, grown
            out[at], rows[at] = grown, nxt
        return first, lengths, out, rows
