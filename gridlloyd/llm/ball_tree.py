"""A ball tree of integer vectors in one task, and best-first branch and bound for many queries at once."""

from __future__ import annotations

import numpy as np

from .inner_products import BestLists

LEAF_ROWS = 64
#: Nodes that a query opens at most in one round.
_WIDEST = 8
#: Scores computed at a time.
_BLOCK = 1 << 22


class BallTree:
    """Nodes are runs of the reordered rows; each has a centre, a radius and the smallest id in it."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        order = np.arange(len(points))
        start, end, child = [0], [len(points)], [-1]
        at = 0
        while at < len(start):
            a, b = start[at], end[at]
            if b - a > LEAF_ROWS:
                own = points[order[a:b]]
                axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                half = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], half)]
                child[at] = len(start)  # two children in a row
                start += [a, a + half]
                end += [a + half, b]
                child += [-1, -1]
            at += 1
        self.points, self.ids = points[order], ids[order]
        self.start, self.end, self.child = (np.array(x) for x in (start, end, child))
        nodes = range(len(start))
        self.center = np.array([self.points[a:b].mean(axis=0) for a, b in zip(start, end)])
        self.radius = np.array([
            np.sqrt(((self.points[start[i]:end[i]] - self.center[i]) ** 2).sum(axis=1).max()) for i in nodes])
        self.least = np.array([self.ids[a:b].min() for a, b in zip(start, end)])

    def search(self, queries: np.ndarray, own: np.ndarray, best: BestLists) -> None:
        """Bring every list up to date with the rows of this tree; ``own`` is the id a query must not find.

        Each round every query opens its most promising nodes, those with the largest upper bound of the
        inner product. A node that cannot enter the list any more - its bound below the score in the last
        place, or equal to it with larger ids only - is dropped with all below it.
        """
        norm = np.sqrt((queries**2).sum(axis=1))
        query, node = np.arange(len(queries)), np.zeros(len(queries), "int64")
        bound, wide = upper_bound(queries, norm, query, self.center, self.radius, node), 1
        while len(query):
            last, last_id = best.scores[query, -1], best.ids[query, -1]
            alive = (bound > last) | ((bound == last) & (self.least[node] < last_id))
            query, node, bound = query[alive], node[alive], bound[alive]
            order = np.lexsort((-bound, query))
            query, node, bound = query[order], node[order], bound[order]
            now = np.arange(len(query)) - np.searchsorted(query, query) < wide
            opened, leaf = self.child[node] >= 0, self.child[node] < 0
            self._score(queries, own, best, query[now & leaf], node[now & leaf])
            inner = np.flatnonzero(now & opened)
            below_query = np.repeat(query[inner], 2)
            below = (self.child[node[inner]][:, None] + np.arange(2)).ravel()
            below_bound = upper_bound(queries, norm, below_query, self.center, self.radius, below)
            query, node = np.concatenate([query[~now], below_query]), np.concatenate([node[~now], below])
            bound, wide = np.concatenate([bound[~now], below_bound]), min(2 * wide, _WIDEST)

    def _score(self, queries, own, best, query, node) -> None:
        order = np.argsort(node, kind="stable")
        query, node = query[order], node[order]
        cuts = np.append(np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else [], len(node)).astype(int)
        found = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows = slice(self.start[node[a]], self.end[node[a]])
            scores = (queries[query[a:b]] @ self.points[rows].T).astype("int64")
            keep = (scores >= best.scores[query[a:b], -1][:, None]) & (self.ids[rows][None, :] != own[query[a:b]][:, None])
            i, j = np.nonzero(keep)
            found.append((query[a:b][i], scores[i, j], self.ids[rows][j]))
            if sum(len(f[0]) for f in found) > _BLOCK:
                best.add(*map(np.concatenate, zip(*found)))
                found = []
        if found:
            best.add(*map(np.concatenate, zip(*found)))


def upper_bound(queries, norm, query, centers, radius, node) -> np.ndarray:
    """Largest whole number that the inner product of a query with any point of a ball can be."""
    out = np.empty(len(query))
    step = max(1, _BLOCK // max(1, queries.shape[1]))
    size = np.sqrt((centers**2).sum(axis=1))
    for a in range(0, len(query), step):
        q, n = query[a:a + step], node[a:a + step]
        reach = norm[q] * radius[n]
        inner = (queries[q] * centers[n]).sum(axis=1)
        out[a:a + step] = inner + reach + 1e-9 * (norm[q] * size[n] + reach) + 1e-6
    return np.floor(out)
