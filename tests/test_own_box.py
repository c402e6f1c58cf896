import json

import numpy as np
import pytest

from gridlloyd import RecursiveKMeans, RecursiveKMeansModel
from gridlloyd.operators import cells

SHIFT, SPAN = np.array([100.0, -4000.0]), np.array([3.0, 5000.0])


@pytest.fixture(scope="module")
def table(spark):
    x = SHIFT + SPAN * np.random.default_rng(5).beta(2, 5, (400, 2))
    return spark.createDataFrame(x.tolist(), "a double, b double").repartition(3), x


def brute_cells(x, lo, hi, depth):
    """Bisection, dimension by dimension."""
    found = set()
    for row in x:
        at = []
        for v, a, b in zip(row, lo, hi):
            u, low, high, g = 2.0 * (v - a) / (b - a) - 1.0, -1.0, 1.0, 0
            for _ in range(depth):
                middle = (low + high) / 2
                g = 2 * g + (u > middle)
                low, high = (middle, high) if u > middle else (low, middle)
            at.append(g)
        found.add(tuple(at))
    return found


@pytest.mark.parametrize("depth", [1, 4, 9])
def test_cells_in_the_range_of_each_dimension(spark, table, depth):
    df, x = table
    want = brute_cells(x, x.min(0), x.max(0), depth)
    assert {tuple(r["cell"]) for r in cells.cell_stats(df, ["a", "b"], depth, "auto").collect()} == want
    pairs = cells.data_bounds(df, ["a", "b"])
    assert pairs == tuple(zip(x.min(0), x.max(0)))
    for r in cells.geometry(cells.cell_stats(df, ["a", "b"], depth, pairs), 2, pairs).collect():
        for j in range(2):
            assert r["lo"][j] - 1e-9 <= r["mean"][j] <= r["hi"][j] + 1e-9
    ordinals = cells.with_cell_ordinal(df, ["a", "b"], depth, "auto").select("ordinal").distinct().count()
    assert ordinals == len(want)


def test_one_pair_for_all_is_a_pair_for_each(table):
    df, _ = table
    key = lambda bounds: sorted(map(str, cells.cell_stats(df, ["a", "b"], 3, bounds).select("cell", "n").collect()))
    assert key((-5000.0, 200.0)) == key([(-5000.0, 200.0), (-5000.0, 200.0)]) != key([(100.0, 103.0), (-4000.0, 1000.0)])


def test_awkward_boxes(spark, table):
    df, _ = table
    nan = float("nan")
    odd = spark.createDataFrame([(7.0, 1.0), (7.0, 3.0), (None, 99.0), (nan, -99.0)], "a double, b double")
    assert cells.data_bounds(odd, ["a", "b"]) == ((7.0, 14.0), (1.0, 3.0))
    assert {tuple(r["cell"]) for r in cells.cell_stats(odd.na.drop(), ["a", "b"], 1, "auto").collect()} == {(0, 0), (0, 1)}
    with pytest.raises(ValueError, match="no row has finite"):
        cells.data_bounds(df.limit(0), ["a", "b"])
    with pytest.raises(ValueError, match="too wide"):
        cells.data_bounds(spark.createDataFrame([(-1.5e308,), (1.5e308,)], "a double"), ["a"])
    for bad in ([(0.0, 1.0)], [(0.0, 1.0), (2.0, 2.0)], (1.0, -1.0), "range"):
        with pytest.raises(ValueError):
            cells.cell_stats(df, ["a", "b"], 2, bad)
    with pytest.raises(ValueError, match="is no box"):
        cells.geometry(cells.cell_stats(df, ["a", "b"], 2, "auto"), 2, "auto")


def test_fit_in_its_own_box(spark, table, tmp_path):
    df, x = table
    unit = spark.createDataFrame((2.0 * (x - x.min(0)) / (x.max(0) - x.min(0)) - 1.0).tolist(), "a double, b double")
    fit = lambda data, **options: RecursiveKMeans(inputCols=["a", "b"], nClusters=3, maxIter=3, **options).fit(data)
    model, scaled = fit(df, bounds="auto"), fit(unit)
    count = lambda m: [r["n_cells"] for r in m.history.orderBy("depth").collect()]
    assert count(model) == count(scaled)
    assert model.getOrDefault("bounds") == [list(b) for b in zip(x.min(0), x.max(0))]
    assert count(fit(df, bounds=model.getOrDefault("bounds"))) == count(model)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = RecursiveKMeansModel.load(str(tmp_path / "model"))
    assert again.getOrDefault("bounds") == model.getOrDefault("bounds")
    assert np.array_equal(again.centers, model.centers)
    assert json.dumps(model.get_params()["bounds"])


def test_several_numbers_of_clusters_share_the_box(table):
    df, x = table
    for model in RecursiveKMeans(inputCols=["a", "b"], maxIter=2, bounds="auto").fit_clusters(df, [2, 5]):
        assert model.getOrDefault("bounds") == [list(b) for b in zip(x.min(0), x.max(0))]
        assert (model.centers >= x.min(0)).all() and (model.centers <= x.max(0)).all()
