"""Exact top-k search and hard negatives against plain versions."""

import math
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conftest import SF  # noqa: E402

from gridlloyd.llm import ball_tree, hard_negatives, top_k  # noqa: E402
from gridlloyd.llm.inner_products import NO_ID, NO_SCORE, BestLists  # noqa: E402
from gridlloyd.session import Scratch  # noqa: E402

COLUMNS = "vec_id long, embedding array<double>, label int, score string, query_id string, rank int, pivot string"


def integers(x):
    return tuple(int(v) * 256 if abs(v) >= 2**52 else math.floor(256 * v) for v in x)


def score(a, b):
    return max(NO_SCORE, min(NO_ID, sum(p * q for p, q in zip(a, b))))


def valid(rows):
    """Distinct (id, vector as given, label) and the integers."""
    out = []
    for row in rows:
        if row[0] is not None and row[1] is not None and all(v is not None and math.isfinite(v) for v in row[1]):
            out.append((row[0], tuple(row[1]), row[2]))
    return sorted(set(out), key=repr)


def plain_top_k(rows, k, every):
    good = [(i, x) for i, x, _ in valid(rows)]
    candidates = sorted({(i, integers(x)) for i, x in good}, key=repr)
    out = []
    for q, x in sorted(set(good), key=repr):
        if q % every == 0:
            found = sorted((-score(integers(x), c), i) for i, c in candidates if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def plain_negatives(rows, every, k=5, low=80, high=100):
    good = [r for r in valid(rows) if r[2] is not None]
    candidates = sorted({(i, integers(x), label) for i, x, label in good}, key=repr)
    out = []
    for a, x, label in sorted(set(good), key=repr):
        if a % every:
            continue
        ranked = sorted((-score(integers(x), c), i, l) for i, c, l in candidates)
        positives = [(i, -s) for s, i, l in ranked if l == label and i != a][:k]
        for p, s in positives:
            window = [(i, -n) for n, i, l in ranked if l != label and low * s <= 100 * -n <= high * s][:k]
            out += [(a, p, r + 1, i, s, n) for r, (i, n) in enumerate(window)]
    return sorted(out)


def awkward():
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)], rng.randrange(3)) for i in range(-40, 400)]
    same = [0.5, -0.25, 0.125, 0.0, 1.0, -1.0]
    rows += [(1000 + i, same, i % 2) for i in range(300)]  # ties and a large group of equal vectors
    rows += [(50, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (50, [0.5] * 6, None), (2000, [], 0), (2050, [0.0] * 6, 1), (None, same, 1)]
    rows += [(2100, None, 1), (2150, [1.0, None], 0), (2200, [float("nan")] * 6, 0), (2250, [float("inf")], 2), (2300, same, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "q", 3, "p") for r in rows], COLUMNS).repartition(4)


def searched(spark, rows, k, every):
    df = frame(spark, rows)
    found = top_k.exact_top_k(df, df.where(F.col("vec_id") % every == 0), Scratch(spark), k=k)
    return sorted(tuple(r) for r in found.collect())


def mined(spark, rows, every):
    df = frame(spark, rows)
    return sorted(tuple(r) for r in hard_negatives.mine_hard_negatives(
        df, df.where(F.col("vec_id") % every == 0), Scratch(spark)).collect())


@pytest.mark.parametrize("k", [1, 5])
def test_top_k_on_awkward_rows(spark, k):
    assert searched(spark, awkward(), k, 10) == plain_top_k(awkward(), k, 10)


def test_hard_negatives_on_awkward_rows(spark):
    want = plain_negatives(awkward(), 10)
    assert len(want) > 500
    assert mined(spark, awkward(), 10) == want


def test_many_pivots_shards_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    middle = rng.normal(0, 1, (12, 8))
    rows = [(i, [float(v) for v in middle[i % 12] + rng.normal(0, 0.2, 8)], int(i % 5)) for i in range(3000)]
    for name, value in (("PIVOT_ROWS", 300), ("SHARD_BYTES", 100 * 64), ("QUERY_BLOCK", 7)):
        monkeypatch.setattr(top_k, name, value)
    assert searched(spark, rows, 5, 50) == plain_top_k(rows, 5, 50)
    for name, value in (("CLUSTER_ANCHORS", 10), ("SHARD_ROWS", 700), ("ANCHOR_BLOCK", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert mined(spark, rows, 100) == plain_negatives(rows, 100)


def test_values_beyond_doubles(spark):
    rows = [(0, [1e300, 1.0], 1), (50, [3e15, 7.0], 1), (1, [2e15, -3.0], 1), (2, [1e300, 0.0], 0), (3, [-1e308, 0.0], 0),
            (100, [1.0, 1.0], 0), (4, [2e15, 5.0], 0), (5, [2e15, -4.0], 0)]
    assert searched(spark, rows, 3, 50) == plain_top_k(rows, 3, 50)
    assert mined(spark, rows, 50) == plain_negatives(rows, 50)


@pytest.mark.parametrize("rows", [[], [(7, [1.0], 1)], [(50, [1.0, 2.0], 1)], [(50, None, 1), (100, None, None)]])
def test_nothing_to_find(spark, rows):
    assert searched(spark, rows, 5, 50) == [] == mined(spark, rows, 50)


def test_fewer_rows_than_asked_for(spark):
    rows = [(50, [1.0], 1), (51, [1.0], 1), (52, [0.9], 2)]
    assert searched(spark, rows, 5, 50) == [(50, 1, 51, 65536), (50, 2, 52, 58880)]
    assert mined(spark, rows, 50) == [(50, 51, 1, 52, 65536, 58880)]


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert searched(spark, rows, 5, 50) == plain_top_k(rows, 5, 50)


def test_tree_prunes_clustered_points():
    rng = np.random.default_rng(1)
    middle = rng.normal(0, 500, (40, 16))
    points = np.floor(np.repeat(middle, 200, axis=0) + rng.normal(0, 10, (8000, 16)))
    tree, looked = ball_tree.BallTree(points, np.arange(8000)), []
    best, queries = BestLists(20, 5), points[::400]
    real = tree._score
    tree._score = lambda *a: (looked.append(len(a[3])), real(*a))
    tree.search(queries, np.full(20, -1), best)
    want = np.sort(queries @ points.T, axis=1)[:, :-6:-1]
    assert (best.scores == want).all()
    assert sum(looked) * ball_tree.LEAF_ROWS < 0.2 * 20 * 8000


def test_walk_ends_early():
    rng = np.random.default_rng(2)
    anchors = np.floor(rng.normal(0, 4, (10, 8)) + 300)
    candidates = np.floor(rng.normal(0, 200, (20_000, 8)))
    best, looked = BestLists(10, 5), []

    def take(active, part, scores):
        looked.append(len(active) * len(part))
        i, j = np.nonzero(scores >= best.scores[active, -1][:, None])
        best.add(active[i], scores[i, j], part[j])

    hard_negatives.walk(candidates, anchors, take, lambda active: best.scores[active, -1])
    assert (best.scores == np.sort(anchors @ candidates.T, axis=1)[:, :-6:-1]).all()
    assert sum(looked) < 0.2 * 10 * 20_000
