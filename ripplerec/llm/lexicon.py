"""Levenshtein automata of a lexicon trie, run over a whole trie of words at once.

The words of a vocabulary, sorted, are a trie of ranges.  At each depth the state
is a table of (word prefix, lexicon node, edits used): the lexicon's Levenshtein automata
intersected with its trie, for all prefixes together.  One step joins the table with the
children of both tries, so words that share a prefix share its work and a prefix that no term is near to
leaves the table.  The answers are those of ``LexiconAutomaton.match``.
"""

from __future__ import annotations

import numpy as np

#: Words that one walk takes; bounds its tables.
WALK_WORDS = 20_000


def _ranges(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) of every element of the ranges start .. start + count."""
    row = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, start[row] + offset


class LexiconWalk:
    """The trie of an automaton as arrays."""

    def __init__(self, automaton):
        nodes = len(automaton.child)
        self.budget = np.array(automaton.budget)
        self.own, self.tail, self.end = np.array(automaton.own), np.array(automaton.tail), np.array(automaton.end)
        edges = sorted((n, ord(c), to) for n, below in enumerate(automaton.child) for c, to in below.items())
        parent = np.array([e[0] for e in edges], dtype=np.int64)
        char = np.array([e[1] for e in edges], dtype=np.int64)
        self.to = np.array([e[2] for e in edges], dtype=np.int64)
        self.char = char
        self.key = parent << 21 | char
        self.first = np.searchsorted(parent, np.arange(nodes))
        self.count = np.searchsorted(parent, np.arange(nodes), side="right") - self.first
        depth = [0] * nodes
        for n, _, to in edges:  # parents are numbered before their children
            depth[to] = depth[n] + 1
        self.reach = max(depth) + int(self.budget.max(initial=0))  # no term goes on beyond so many characters

    def _least(self, v: np.ndarray, node: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct (prefix, node) within the node's budget, with the fewest edits."""
        ok = used <= self.budget[node]
        v, node, used = v[ok], node[ok], used[ok]
        place = (v * len(self.budget) + node) * 4 + used
        place.sort()
        pair = place >> 2
        place = place[np.concatenate([[True], pair[1:] != pair[:-1]])] if len(place) else place
        pair = place >> 2
        return pair // len(self.budget), pair % len(self.budget), place & 3

    def _closed(self, v, node, used):
        """With the term characters that the word leaves out."""
        last_v, last_node, last_used = v, node, used
        for _ in range(int(self.budget.max(initial=0))):
            some = last_used + 1 <= self.budget[last_node]
            row, edge = _ranges(self.first[last_node[some]], self.count[last_node[some]])
            last_v, last_node, last_used = last_v[some][row], self.to[edge], last_used[some][row] + 1
            v, node, used = (np.concatenate(x) for x in ((v, last_v), (node, last_node), (used, last_used)))
        return self._least(v, node, used)

    def match(self, words: list[str]) -> np.ndarray:
        """2, 1 or 0 for each of ``words``, which are sorted by code points and distinct."""
        out = np.zeros(len(words), dtype=np.int64)
        if self.first.size <= 1 or not words:
            return out
        for at in range(0, len(words), WALK_WORDS):
            out[at:at + WALK_WORDS] = self._walk(words[at:at + WALK_WORDS])
        return out

    def _walk(self, words: list[str]) -> np.ndarray:
        length = np.array([len(w) for w in words])
        wide = min(int(length.max()), self.reach)
        chars = np.array([w[:wide] for w in words], dtype=f"U{max(1, wide)}").view(np.uint32).reshape(len(words), -1)
        chars = chars.astype(np.int64)
        least = np.full(len(words), 9)  # edits of the best hit of each word
        lo, hi = np.array([0]), np.array([len(words)])  # the prefixes of this depth as ranges of words
        v, node, used = self._closed(np.array([0]), np.array([0]), np.array([0]))
        for depth in range(wide + 1):
            hit = (self.end[node] > 0) & (used <= self.own[node])
            ends = length[lo] == depth  # the shortest word of a range comes first
            here = hit & ends[v]
            np.minimum.at(least, lo[v[here]], used[here])
            if depth == wide:
                # longer words: only stems, after which any suffix may follow
                more = hit & (self.tail[node] >= used)
                row, word = _ranges(lo[v[more]], hi[v[more]] - lo[v[more]])
                np.minimum.at(least, word, used[more][row])
                break
            if not len(v):
                break
            alive = np.unique(v)
            row, word = _ranges(lo[alive] + ends[alive], hi[alive] - lo[alive] - ends[alive])
            c = chars[word, depth]
            new = np.ones(len(word), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (c[1:] != c[:-1])
            lo = word[new]
            hi = np.append(lo[1:], 0)
            last = np.flatnonzero(np.append(row[new][1:] != row[new][:-1], True)) if len(lo) else np.empty(0, dtype=int)
            # a prefix's range ends with its parent's, or where the next sibling begins
            parent, letter = row[new], c[new]
            hi[last] = (np.searchsorted(row, parent[last], side="right") - 1) if len(lo) else 0
            hi[last] = word[hi[last]] + 1
            first = np.searchsorted(parent, np.arange(len(alive)))
            count = np.searchsorted(parent, np.arange(len(alive)), side="right") - first
            at = np.searchsorted(alive, v)
            item, child = _ranges(first[at], count[at])
            n0, u0, ch = node[item], used[item], letter[child]
            key = n0 << 21 | ch
            spot = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            same = self.key[spot] == key
            loop = u0 <= self.tail[n0]
            extra = u0 + 1 <= self.budget[n0]
            pick = np.flatnonzero(extra & (self.count[n0] > 0))
            row, edge = _ranges(self.first[n0[pick]], self.count[n0[pick]])
            v = np.concatenate([child[same], child[loop], child[extra], child[pick][row]])
            node = np.concatenate([self.to[spot[same]], n0[loop], n0[extra], self.to[edge]])
            used = np.concatenate([u0[same], u0[loop], u0[extra] + 1, u0[pick][row] + 1])
            v, node, used = self._closed(*self._least(v, node, used))
        return np.where(least == 0, 2, np.where(least < 9, 1, 0))
