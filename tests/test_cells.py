import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlloyd.functions.vectors import bits_to_int, int_to_bits
from gridlloyd.operators import cells

GOLDEN = {
    -1.3: (0, 0, 0), -1.0: (0, 0, 0), -0.5: (0, 0, 1), -0.25: (0, 1, 2), 0.0: (0, 1, 3),
    0.1: (1, 2, 4), 0.5: (1, 2, 5), 0.75: (1, 3, 6), 1.0: (1, 3, 7), 1.3: (1, 3, 7),
}


def bisect(x, depth):
    """Chain of strict comparisons against midpoints."""
    low, high, code = -1.0, 1.0, 0
    for _ in range(depth):
        mid = (low + high) / 2
        up = x > mid
        low, high = (mid, high) if up else (low, mid)
        code = 2 * code + up
    return code


def points(spark, n, d, seed=0, spread=1.2):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-spread, spread, (n, d))
    dyadic = rng.integers(-8, 9, (n, d)) / 8.0
    x = np.where(rng.random((n, d)) < 0.3, dyadic, x)
    frame = pd.DataFrame(x, columns=[f"f{j}" for j in range(d)])
    frame["id"] = np.arange(n)
    return spark.createDataFrame(frame).repartition(4), x


def test_golden_coordinates(spark):
    df = spark.createDataFrame([(x,) for x in GOLDEN], "x double")
    rows = df.select("x", *[cells.cell_coordinate(F.col("x"), i).alias(f"d{i}") for i in (1, 2, 3)]).collect()
    assert {r["x"]: (r["d1"], r["d2"], r["d3"]) for r in rows} == GOLDEN


@pytest.mark.parametrize("depth", [1, 2, 5, 11, 24])
def test_coordinates_equal_bisection(spark, depth):
    df, x = points(spark, 500, 3, seed=depth)
    got = {r["id"]: r["cell"] for r in cells.with_cell(df, ["f0", "f1", "f2"], depth).collect()}
    for i, row in enumerate(x):
        assert got[i] == [bisect(v, depth) for v in row]


def test_bounds_rescale(spark):
    df = spark.createDataFrame([(x,) for x in GOLDEN], "x double").withColumn("y", F.col("x") * 50 + 50)
    got = df.select("x", cells.cell_coordinate(F.col("y"), 3, (0.0, 100.0)).alias("g")).collect()
    assert {r["x"]: r["g"] for r in got} == {x: g[2] for x, g in GOLDEN.items()}


@pytest.mark.parametrize("dims,depth", [(1, 4), (3, 4), (5, 3), (20, 6), (13, 24)])
def test_levels_equal_direct_grouping(spark, dims, depth):
    df, x = points(spark, 400, dims, seed=dims)
    names = [f"f{j}" for j in range(dims)]
    tree = cells.levels(df, names, depth).collect()
    for i in range(1, depth + 1):
        want = {}
        for row in x:
            key = tuple(bisect(v, i) for v in row)
            n, s = want.get(key, (0, np.zeros(dims)))
            want[key] = (n + 1, s + row)
        got = {tuple(r["cell"]): (r["n"], np.array(r["sum"])) for r in tree if r["depth"] == i}
        assert got.keys() == want.keys()
        for key in want:
            assert got[key][0] == want[key][0]
            assert np.allclose(got[key][1], want[key][1])


def test_levels_scan_rows_once(spark, capsys):
    df, _ = points(spark, 50, 2)
    cells.levels(df, ["f0", "f1"], 3).collect()
    ratio = {r["depth"]: r for r in cells.instance_ratio_by_depth(cells.levels(df, ["f0", "f1"], 3)).collect()}
    assert all(r["n_rows"] == 50 for r in ratio.values())
    assert ratio[1]["n_cells"] <= ratio[2]["n_cells"] <= ratio[3]["n_cells"]


def test_geometry_contains_rows(spark):
    df, _ = points(spark, 300, 2, spread=1.0)
    stats = cells.geometry(cells.cell_stats(df, ["f0", "f1"], 2), 2).collect()
    for r in stats:
        for j in range(2):
            assert r["lo"][j] <= r["mean"][j] <= r["hi"][j]
            assert r["hi"][j] - r["lo"][j] == 0.5
            assert r["threshold"][j] == (r["lo"][j] + r["hi"][j]) / 2
    two = [r for r in stats if r["cell"][0] == 2][0]
    assert (two["lo"][0], two["hi"][0], two["threshold"][0]) == (0.0, 0.5, 0.25)


def test_hypercube_id_bit_order(spark):
    df = spark.createDataFrame([(0.5, -0.5), (-0.5, 0.5)], "a double, b double")
    ids = cells.with_cell(df, ["a", "b"], 1).select(cells.hypercube_id(F.col("cell"), 2).alias("h")).collect()
    assert [r["h"] for r in ids] == [1, 2]
    back = spark.createDataFrame([(6,)], "v bigint").select(*[b.alias(f"b{i}") for i, b in enumerate(int_to_bits(F.col("v"), 3))])
    assert list(back.first()) == [False, True, True]
    assert back.select(bits_to_int([F.col("b0"), F.col("b1"), F.col("b2")])).first()[0] == 6


def test_cell_levels_extend_and_reject(spark):
    df, x = points(spark, 300, 2)
    store = cells.CellLevels(df, ["f0", "f1"])
    store.require(2)
    store.require(3, 5)
    for i in range(1, 6):
        store.require(i)
        want = len({tuple(bisect(v, i) for v in row) for row in x})
        assert store.cells[i] == want == store.points(i).count()
        rows = store.points(i).select("w", *[c.alias(f"c{j}") for j, c in enumerate(store.coordinates(i))]).collect()
        assert sum(r["w"] for r in rows) == 300
        assert {(r["c0"], r["c1"]) for r in rows} == {tuple(bisect(v, i) for v in row) for row in x}
    store.drop()
    for bad in (None, float("nan"), float("inf")):
        broken = df.limit(5).unionByName(spark.createDataFrame([(0.1, bad, 9)], "f0 double, f1 double, id long"))
        with pytest.raises(ValueError, match="null, NaN or infinite"):
            cells.CellLevels(broken, ["f0", "f1"]).require(2)


def test_crowded_rows_are_split_to_the_last_bit(spark):
    """Two far outliers set the box; all other rows share one cell down to depth 30."""
    from gridlloyd import RecursiveKMeans

    inside = [0.5 * 2.0**-30 + i * 2.0**-40 for i in range(40)]
    df = spark.createDataFrame([(v,) for v in [-1.0, 1.0, *inside]], "x double")
    store = cells.CellLevels(df, ["x"])
    depth = store.first_with(10)
    assert depth > 30 and store.cells[depth] >= 10 > store.cells.get(depth - 1, 0)
    assert store.first_with(10**6) is None
    store.drop()
    model = RecursiveKMeans(inputCols=["x"], nClusters=10, maxIter=2).fit(df)
    assert model.n_iter >= 1 and model.history.first()["depth"] == depth
    stats = cells.cell_stats(df, ["x"], 52)
    assert stats.count() == 42 and dict(stats.dtypes)["cell"] == "array<bigint>"
