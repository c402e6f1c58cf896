import tracemalloc
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlloyd.functions import measures
from gridlloyd.operators import blocks, joins, metrics
from gridlloyd.operators.blocks import expected_mutual_information


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 0.3, (40, 3)) for m in ([0, 0, 0], [1, 1, 0], [0, 2, 1])])
    y = np.repeat([0, 1, 2], 40)
    y[rng.integers(0, 120, 15)] = 1
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=np.arange(120), y=y, name=[f"c{v}" for v in y])
    return x, y, spark.createDataFrame(pdf).repartition(5)


NAMES = ["a", "b", "c"]


def brute_silhouette(x, y):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = y == y[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, y == o].mean() for o in set(y) - {y[i]})
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("block", [4096, 17])
@pytest.mark.parametrize("label", ["y", "name"])
def test_silhouette(sample, monkeypatch, block, label):
    x, y, df = sample
    monkeypatch.setattr(metrics, "SILHOUETTE_BLOCK_ROWS", block)
    rows = metrics.silhouette_samples(df, NAMES, label, ["id"]).orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(120))
    assert np.allclose([r["silhouette"] for r in rows], brute_silhouette(x, y))


def test_silhouette_of_a_single_member_is_zero(spark):
    df = spark.createDataFrame([(0, 0.0, 0), (1, 1.0, 0), (2, 9.0, 1)], "id int, a double, y int")
    got = {r["id"]: r["silhouette"] for r in metrics.silhouette_samples(df, ["a"], "y", ["id"]).collect()}
    assert got[2] == 0.0 and got[0] > 0.8
    numbered = df.select(F.monotonically_increasing_id().alias("row"), "a", "y")  # a key that cannot be null
    assert metrics.silhouette_samples(numbered, ["a"], "y", ["row"]).count() == 3


@pytest.mark.parametrize("unrolled", [16, 2])
def test_calinski_harabasz(sample, monkeypatch, unrolled):
    x, y, df = sample
    monkeypatch.setattr(metrics, "UNROLLED_DIMS", unrolled)
    m = x.mean(0)
    between = sum((y == k).sum() * ((x[y == k].mean(0) - m) ** 2).sum() for k in set(y))
    within = sum(((x[y == k] - x[y == k].mean(0)) ** 2).sum() for k in set(y))
    want = (between / 2) / (within / 117)
    assert np.isclose(metrics.calinski_harabasz(df, NAMES, "y"), want)
    with pytest.raises(ValueError):
        metrics.calinski_harabasz(df.withColumn("one", F.lit(1)), NAMES, "one")


@pytest.mark.parametrize("chunked,unrolled", [(False, 16), (True, 16), (False, 2)])
def test_davies_bouldin(sample, monkeypatch, chunked, unrolled):
    x, y, df = sample
    monkeypatch.setattr(metrics, "UNROLLED_DIMS", unrolled)
    if chunked:
        monkeypatch.setattr(metrics, "SILHOUETTE_BLOCK_ROWS", 1)
        monkeypatch.setattr(joins, "BOUNDED_BYTES", 0)
    c = np.array([x[y == k].mean(0) for k in range(3)])
    s = np.array([np.sqrt(((x[y == k] - c[k]) ** 2).sum(1)).mean() for k in range(3)])
    want = np.mean([max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(3) if j != i) for i in range(3)])
    assert np.isclose(metrics.davies_bouldin(df, NAMES, "name"), want)


def brute_emi(a, b, n):
    total = 0.0
    for i in a:
        for j in b:
            for v in range(max(1, i + j - n), min(i, j) + 1):
                p = exp(sum(map(lgamma, (i + 1, j + 1, n - i + 1, n - j + 1)))
                        - sum(map(lgamma, (n + 1, v + 1, i - v + 1, j - v + 1, n - i - j + v + 1))))
                total += v / n * log(n * v / (i * j)) * p
    return total


@pytest.mark.parametrize("a,b", [([3, 4, 5], [6, 6]), ([100, 1], [50, 51]), ([12], [5, 7]), ([1] * 8, [4, 4]), ([300, 700], [10, 990])])
def test_expected_mutual_information(a, b):
    n = sum(a)
    got = sum(expected_mutual_information(i, np.array(b), np.ones(len(b)), n) for i in a)
    assert np.isclose(got, brute_emi(a, b, n), atol=1e-12)


def test_expected_mutual_information_of_huge_margins():
    n = 10**12
    got = 2 * expected_mutual_information(n // 2, np.array([n // 2]), np.array([2]), n)
    assert np.isclose(got, 0.5 / n, rtol=1e-2)  # (R - 1)(C - 1) / 2n for large n


def test_agreement(sample, spark):
    x, y, df = sample
    truth = np.repeat([0, 1, 2], 40)
    both = df.withColumn("t", F.floor(F.col("id") / 40).cast("int"))
    table = np.array([[((truth == i) & (y == j)).sum() for j in range(3)] for i in range(3)])
    pairs = lambda v: (v * (v - 1) / 2).sum()
    a, b, n = table.sum(1), table.sum(0), table.sum()
    expected = pairs(a) * pairs(b) / (n * (n - 1) / 2)
    ari = (pairs(table) - expected) / (0.5 * (pairs(a) + pairs(b)) - expected)
    h = lambda v: -(v[v > 0] / n * np.log(v[v > 0] / n)).sum()
    mi, mean = h(a) + h(b) - h(table.ravel()), 0.5 * (h(a) + h(b))
    emi = brute_emi(a.tolist(), b.tolist(), int(n))
    got = metrics.agreement(both, "t", "y")
    assert np.isclose(got["adjusted_rand"], ari)
    assert np.isclose(got["normalized_mutual_info"], mi / mean)
    assert np.isclose(got["adjusted_mutual_info"], (mi - emi) / (mean - emi))
    assert np.isclose(metrics.accuracy(both, "t", "y"), (truth == y).mean())


def test_agreement_extremes(spark):
    same = spark.createDataFrame([(0, "a"), (0, "a"), (1, "b")], "x int, y string")
    assert metrics.agreement(same, "x", "y") == pytest.approx(
        {"adjusted_mutual_info": 1.0, "adjusted_rand": 1.0, "normalized_mutual_info": 1.0})
    single = spark.createDataFrame([(0, 0), (0, 0)], "x int, y int")
    assert set(metrics.agreement(single, "x", "y").values()) == {1.0}
    split = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "x int, y int")
    assert metrics.normalized_mutual_info(split, "x", "y") == pytest.approx(0.0, abs=1e-12)


def test_formulas(spark):
    row = spark.range(1).select(
        measures.relative_error(0.0, 0.0).alias("zero"), measures.relative_error(1.0, 3.0).alias("half"),
        measures.std_error(10.0, 12.0).alias("std"), measures.silhouette_to_unit(0.0).alias("mid")).first()
    assert (row["zero"], row["half"], row["std"], row["mid"]) == (1.0, 0.5, -0.2, 0.5)
    # published distance counts: 600 + 300 * 3.2 and 600 + 300 * 19
    assert measures.kmeans_pp_distances(3, 100, 3.2) == pytest.approx(1560)
    assert measures.mini_batch_distances(3, 100, 100, 19) == 6300
    assert measures.kmeans_pp_distances(3, 150, 6) == 3600


@pytest.mark.parametrize("few", [10_000, 5])
def test_quantiles_are_exact(spark, monkeypatch, few):
    from gridlloyd.operators import order_statistics

    monkeypatch.setattr(order_statistics, "FEW_ROWS", few)
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(0, 1, 3000), np.full(2000, 0.25), rng.normal(0, 1e-9, 500), [1e6, -1e6]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(4)
    shares = [0.0, 0.01, 0.25, 0.5, 0.61, 0.75, 1.0]
    assert np.allclose(order_statistics.quantiles(df, "v", shares), np.quantile(values, shares), rtol=0, atol=1e-12)
    assert order_statistics.quantiles(df.where("v is null"), "v", [0.5]) == [None]


def test_distances_are_held_a_tile_at_a_time():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(3000, 4)), rng.normal(size=(2500, 4))
    mx, my = (rng.random((3000, 3)) < 0.4) * 1.0, (rng.random((2500, 5)) < 0.4) * 1.0
    to_x, to_y, own = np.zeros((3000, 5)), np.zeros((2500, 3)), np.zeros((3000, 3))
    tracemalloc.start()
    blocks.add_distances(x, y, mx, my, to_x, to_y)
    blocks.add_distances(x, None, mx, None, own, None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20  # all distances together take 60 MB
    far = np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))
    assert np.allclose(to_x, far @ my) and np.allclose(to_y, far.T @ mx)
    assert np.allclose(own, np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) @ mx)


def test_silhouette_of_many_labels_in_small_groups(spark, monkeypatch):
    monkeypatch.setattr(metrics, "SILHOUETTE_BLOCK_ROWS", 16)
    monkeypatch.setattr(metrics, "LABELS_AT_ONCE", 3)
    monkeypatch.setattr(metrics, "GROUP_ROWS", 30)
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(150, 3)), rng.integers(0, 20, 150)
    df = spark.createDataFrame(pd.DataFrame(x, columns=NAMES).assign(id=np.arange(150), y=y))
    assert metrics.group_count(df, 1000, 1) >= 1000 // 30  # a group is bounded in rows too
    assert np.isclose(metrics.silhouette(df, NAMES, "y", ["id"]), brute_silhouette(x, y).mean())


def test_the_second_group_of_a_pair_streams(spark, monkeypatch):
    """A task holds one group, and batches of the other one by one."""
    import pyarrow as pa

    caught = []

    class Caught:
        def applyInArrow(self, fn, layout):
            caught.append((fn, layout))
            raise InterruptedError

    monkeypatch.setattr(metrics, "by_pair", lambda *a, **k: Caught())
    df = spark.createDataFrame([(0, [0.0, 0.0], "a")], "id long, x array<double>, y string")
    with pytest.raises(InterruptedError):
        metrics.silhouette_samples(df, "x", "y", ["id"])
    (sums, _), = caught
    rng = np.random.default_rng(0)
    x, y, g = rng.uniform(0, 1, (90, 2)), rng.choice(["a", "b", "c"], 90), np.repeat([3, 5], [30, 60])
    read = []

    def batches():
        for at in range(0, 90, 20):
            read.append(at)
            part = slice(at, at + 20)
            yield pa.RecordBatch.from_pylist([
                {"key": {"id": i}, "label": l, "x": v, "g": n} for i, l, v, n in zip(range(90)[part], y[part], x[part].tolist(), g[part].tolist())],
                pa.schema([("key", pa.struct([("id", pa.int64())])), ("label", pa.string()), ("x", pa.list_(pa.float64())), ("g", pa.int32())]))

    made = sums((pa.scalar(3), pa.scalar(5)), batches())
    first = next(made)
    assert read == [0, 20] and first.num_rows
    table = pa.Table.from_batches([first, *made]).to_pandas()
    table["id"] = [k["id"] for k in table["key"]]
    got = table.groupby(["id", "other"])[["total", "n"]].sum()
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for i in range(90):
        for label in "abc":
            there = (g != g[i]) & (y == label)
            assert np.allclose(got.loc[i, label], [gap[i, there].sum(), there.sum()])
    with pytest.raises(RuntimeError):
        list(sums((pa.scalar(3), pa.scalar(5)), [*batches(), *batches()]))
