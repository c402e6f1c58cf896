"""What the exact inner-product searches share: integer vectors, exact scores, lists of the k best.

A vector stands for the integers floor(``SCALE`` * x). Rows with a null id, a null vector, or a null or
non-finite component take no part; a shorter vector counts as filled up with zeros. A score beyond the
range of long is given as the nearest long, and ranked as such.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import floor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BOUNDED_BYTES

SCALE = 256
#: Score and id of a place in a list that nothing has taken.
NO_SCORE, NO_ID = -(2**63 - 1), 2**63 - 1
#: Rows that a driver-side model (pivots, anchor clusters) is fitted on at most.
SAMPLE_ROWS = 4096
#: Bytes of doubles that the candidates of one task may take.
SHARD_BYTES = 64 << 20
_EXACT = 2.0**53


def valid_rows(table: pa.Table | pa.RecordBatch, vector: str, ids: str) -> pa.Array:
    """Places of the rows that take part."""
    column = table.column(vector)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    good = pc.and_(pc.is_valid(column), pc.is_valid(table.column(ids)))
    values, parents = pc.list_flatten(column), pc.list_parent_indices(column)
    bad = parents.filter(pc.invert(pc.fill_null(pc.is_finite(values), False)))
    good = good.to_numpy(zero_copy_only=False).copy()
    good[bad.to_numpy(zero_copy_only=False)] = False
    return pa.array(np.flatnonzero(good))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros. The column has no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype("float64")
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims)[None, :] < lengths[:, None]] = flat
    return out


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as doubles."""
    with np.errstate(over="ignore"):
        return np.floor(x * SCALE)


def are_exact(a: np.ndarray, b: np.ndarray) -> bool:
    """True when every inner product of rows of the two is exact in doubles, whatever the order of adding."""
    if not a.size or not b.size:
        return True
    with np.errstate(over="ignore"):
        return bool(np.abs(whole(a)).max() * np.abs(whole(b)).max() * a.shape[1] < _EXACT)


def big_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows as Python integers, for values that doubles cannot hold."""
    def integers(x):
        whole_numbers = [[int(v) * SCALE if abs(v) >= 2.0**52 else floor(v * SCALE) for v in row] for row in x.tolist()]
        return np.array(whole_numbers, dtype=object).reshape(x.shape)

    return integers(a) @ integers(b).T


def as_long(scores: np.ndarray) -> np.ndarray:
    return np.clip(scores, NO_SCORE, NO_ID).astype("int64")


class BestLists:
    """The k best (score, id) of each of m queries: higher scores first, then smaller ids."""

    def __init__(self, m: int, k: int):
        self.scores = np.full((m, k), NO_SCORE, "int64")
        self.ids = np.full((m, k), NO_ID, "int64")
        self.fresh = np.zeros((m, k), bool)

    def start(self, found: Sequence[Sequence[dict]]) -> None:
        """Begin with entries found elsewhere."""
        for i, entries in enumerate(found):
            for j, entry in enumerate(entries or []):
                self.scores[i, j], self.ids[i, j] = entry["score"], entry["vec_id"]

    def add(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge (query, score, id) triples in."""
        if not len(query):
            return
        k, touched = self.scores.shape[1], np.unique(query)
        q = np.concatenate([np.repeat(touched, k), query])
        s = np.concatenate([self.scores[touched].ravel(), scores])
        i = np.concatenate([self.ids[touched].ravel(), ids])
        f = np.concatenate([self.fresh[touched].ravel(), np.ones(len(query), bool)])
        order = np.lexsort((i, -s, q))
        place = np.arange(len(q)) - np.searchsorted(q[order], q[order])
        order, place = order[place < k], place[place < k]
        self.scores[q[order], place], self.ids[q[order], place], self.fresh[q[order], place] = s[order], i[order], f[order]

    def triples(self, fresh: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, score and id of all entries, or of those added here."""
        query, place = np.nonzero(self.fresh if fresh else self.ids != NO_ID)
        return query, self.scores[query, place], self.ids[query, place]


def fewest_of_equals(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows to keep: of equal rows those with the ``k`` smallest ids, each once.

    Equal rows have equal scores everywhere, so the others can be in no list of fewer than k.
    """
    if not len(ids):
        return np.zeros(0, "int64")
    _, group = np.unique(rows, axis=0, return_inverse=True)
    order = np.lexsort((ids, group.ravel()))
    g, i = group.ravel()[order], ids[order]
    once = np.concatenate([[True], (g[1:] != g[:-1]) | (i[1:] != i[:-1])])
    order, g = order[once], g[once]
    return np.sort(order[np.arange(len(g)) - np.searchsorted(g, g) < k])


def facts(rows: DataFrame, vector: str) -> tuple[int, int]:
    """Number of rows and width of the widest vector."""
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("width")).first()
    return row["n"], max(1, row["width"] or 1)


def sampled(rows: DataFrame, ids: str, vector: str, dims: int) -> np.ndarray:
    """At most ``SAMPLE_ROWS`` of the vectors, those with the smallest hashes, as integers in doubles."""
    count = max(1, min(SAMPLE_ROWS, BOUNDED_BYTES // (8 * dims)))
    table = rows.select(ids, vector).orderBy(F.xxhash64(ids), ids).limit(count).toArrow()
    return whole(matrix(table.take(valid_rows(table, vector, ids)).column(vector), dims))


def centers_of(sample: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """A few rounds of k-means over a sample, from its first distinct rows."""
    distinct = np.unique(sample, axis=0, return_index=True)[1]
    centers = sample[np.sort(distinct)[:count]].copy()
    for _ in range(rounds if len(centers) > 1 else 0):
        label = nearest(sample, centers)[0]
        for c in range(len(centers)):
            if (label == c).any():
                centers[c] = sample[label == c].mean(axis=0)
    return centers if len(centers) else np.zeros((1, sample.shape[1]))


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and its distance computed from the differences."""
    square = (centers**2).sum(axis=1)[None, :] - 2.0 * (x @ centers.T)
    label = square.argmin(axis=1)
    return label, np.sqrt(((x - centers[label]) ** 2).sum(axis=1))
