"""Vantage-point trees over the vectors of one shard, searched for the largest inner product.

A vector v with norm at most M becomes (v, sqrt(M^2 - |v|^2)) and a query q
becomes (q, 0) scaled to norm M, which keeps the order of its results.  Their Euclidean
distance is sqrt(2 M^2 - 2 q.v), so the nearest point has the largest inner product
and the triangle inequality holds.  An inner node keeps its vantage point and the least and
greatest distance of the points of either side; a leaf keeps a run of rows.

A batch of queries walks the tree once.  Each query first goes down to one leaf,
which gives it a first k-th best score; then every node is visited
with the queries whose lower bound, times ``factor``, is not beyond that
score.  Factor one prunes nothing that could count (rounding included);
a larger one prunes more and may lose results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 128
#: Relative slack for rounding in distances (square root of cancelled terms).
SLACK = 1e-7


@dataclass
class Tree:
    vectors: np.ndarray  # (n, d) double, in leaf order
    ids: np.ndarray  # vec_id of each row; NULL_ID for null
    rows: np.ndarray  # unique row number of each row
    norm: float  # greatest norm
    point: np.ndarray  # (nodes,) row of the vantage point, -1 for a leaf
    left: np.ndarray  # (nodes,) left child, or the leaf's first row
    right: np.ndarray  # (nodes,) right child, or the row after the leaf's last
    reach: np.ndarray  # (nodes, 4) least and greatest distance inside, then outside


def build(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Tree:
    """A tree over all rows; points at equal distance stay on one side, so a
    group of equal vectors is one leaf however large it is."""
    vectors = np.ascontiguousarray(vectors, dtype=np.float64)
    square = np.einsum("ij,ij->i", vectors, vectors)
    norm = float(np.sqrt(square.max()))
    lift = np.sqrt(np.maximum(norm * norm - square, 0.0))
    order = np.arange(len(vectors))
    point, left, right, reach = [], [], [], []

    def add(p, a, b, r):
        point.append(p), left.append(a), right.append(b), reach.append(r)
        return len(point) - 1

    def away(of: np.ndarray, p: int) -> np.ndarray:
        gap = vectors[of] - vectors[p]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap) + (lift[of] - lift[p]) ** 2)

    root = add(-1, 0, len(order), (0.0, 0.0, 0.0, 0.0))
    todo = [(root, 0, len(order))]
    while todo:
        node, a, b = todo.pop()
        if b - a <= leaf:
            continue
        part = order[a:b]
        # the point farthest from the first one has the widest spread of distances
        far = int(part[np.argmax(away(part, part[0]))])
        d = away(part, far)
        cut = np.partition(d, (b - a) // 2)[(b - a) // 2]
        inside = d <= cut
        if inside.all():
            inside = d < cut
        n = int(inside.sum())
        if not 0 < n < b - a:
            continue
        order[a:b] = np.concatenate([part[inside], part[~inside]])
        point[node] = far
        reach[node] = (d[inside].min(), d[inside].max(), d[~inside].min(), d[~inside].max())
        left[node] = add(-1, a, a + n, (0.0, 0.0, 0.0, 0.0))
        right[node] = add(-1, a + n, b, (0.0, 0.0, 0.0, 0.0))
        todo += [(left[node], a, a + n), (right[node], a + n, b)]
    at = np.empty(len(order), dtype=np.int64)
    at[order] = np.arange(len(order))
    point = np.array(point, dtype=np.int64)
    point[point >= 0] = at[point[point >= 0]]
    return Tree(vectors[order], ids[order], rows[order], norm, point, np.array(left, dtype=np.int64),
                np.array(right, dtype=np.int64), np.array(reach, dtype=np.float64))


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of the components."""
    total = np.zeros(len(q))
    for i in range(q.shape[1]):
        total += q[:, i] * v[:, i]
    return total


class Search:
    """The k best rows of a tree for a batch of queries."""

    def __init__(self, tree: Tree, queries: np.ndarray, own: np.ndarray, k: int, factor: float = 1.0):
        self.tree, self.k, self.factor, self.own = tree, k, factor, own
        self.q = np.ascontiguousarray(queries, dtype=np.float64)
        square = np.einsum("ij,ij->i", self.q, self.q)
        self.to_m = tree.norm / np.sqrt(square)
        self.slack = SLACK * tree.norm
        self.eps = 1e-15 * (self.q.shape[1] + 8) * np.sqrt(square) * tree.norm
        self.score = np.full((len(self.q), k), -np.inf)
        self.row = np.full((len(self.q), k), -1, dtype=np.int64)
        self.tau = np.full(len(self.q), -np.inf)
        self.seen = np.full(len(self.q), -1, dtype=np.int64)  # leaf of the first descent
        self.compared = 0

    def _distance(self, act: np.ndarray, node: int) -> np.ndarray:
        v = self.tree.vectors[self.tree.point[node]]
        return self._apart(act, self.q[act] @ v)

    def _apart(self, act: np.ndarray, product: np.ndarray) -> np.ndarray:
        """Distance between points whose inner product is given."""
        return np.sqrt(np.maximum(2.0 * self.tree.norm ** 2 - 2.0 * self.to_m[act] * product, 0.0))

    def _leaf(self, node: int, act: np.ndarray) -> None:
        a, b = int(self.tree.left[node]), int(self.tree.right[node])
        # a group of equal vectors may be long: rows in steps, scores in bounded blocks
        for at in range(a, b, 1024):
            end = min(b, at + 1024)
            for i in range(0, len(act), 2048):
                self._compare(act[i:i + 2048], at, end)

    def _compare(self, act: np.ndarray, a: int, b: int) -> None:
        t, k = self.tree, self.k
        self.compared += len(act) * (b - a)
        rough = self.q[act] @ t.vectors[a:b].T
        hit = rough >= (self.tau[act] - self.eps[act])[:, None]
        qi, xi = np.nonzero(hit & (t.rows[a:b][None, :] != self.own[act][:, None]))
        if not len(qi):
            return
        score = np.empty(len(qi))
        for i in range(0, len(qi), 1 << 16):
            s = slice(i, i + (1 << 16))
            score[s] = exact(self.q[act[qi[s]]], t.vectors[a + xi[s]])
        touched = np.unique(qi)
        who = np.concatenate([np.repeat(touched, k), qi])
        score = np.concatenate([self.score[act[touched]].ravel(), score])
        row = np.concatenate([self.row[act[touched]].ravel(), a + xi])
        ids = np.where(row >= 0, t.ids[row], np.iinfo(np.int64).max)
        unique = np.where(row >= 0, t.rows[row], np.iinfo(np.int64).max)
        order = np.lexsort((unique, ids, -score, who))
        who, score, row = who[order], score[order], row[order]
        first = np.searchsorted(who, touched)
        keep = first[:, None] + np.arange(k)[None, :]  # k old places a query, so k exist
        self.score[act[touched]] = score[keep]
        self.row[act[touched]] = row[keep]
        self.tau[act[touched]] = score[keep[:, -1]]

    def _descend(self, node: int, act: np.ndarray) -> None:
        while len(act):
            if self.tree.point[node] < 0:
                self.seen[act] = node
                self._leaf(node, act)
                return
            d = self._distance(act, node)
            r = self.tree.reach[node]
            near = d <= (r[1] + r[2]) / 2
            self._descend(int(self.tree.right[node]), act[~near])
            node, act = int(self.tree.left[node]), act[near]

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """(row in the tree, score) per query, best first; row -1 for none."""
        every = np.arange(len(self.q))
        self._descend(0, every)
        todo = [(0, every, np.zeros(len(every)))]
        while todo:
            node, act, low = todo.pop()
            open_ = self.factor * (low - self.slack) <= self._apart(act, self.tau[act]) + self.slack
            act, low = act[open_], low[open_]
            if not len(act):
                continue
            if self.tree.point[node] < 0:
                self._leaf(node, act[self.seen[act] != node])
                continue
            d, r = self._distance(act, node), self.tree.reach[node]
            todo.append((int(self.tree.right[node]), act, np.maximum(low, np.maximum(r[2] - d, d - r[3]))))
            todo.append((int(self.tree.left[node]), act, np.maximum(low, np.maximum(r[0] - d, d - r[1]))))
        return self.row, self.score
