"""Tiled points and the passes over them, against plain ways."""

import numpy as np
import pandas as pd
import pytest

from gridlloyd.operators import baselines, blocks, lloyd, many_labels, packed
from gridlloyd.plans import sweep

FEATURES = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(12)
    return np.column_stack([rng.uniform(-1, 1, 5000), rng.normal(0, 0.4, 5000), rng.integers(0, 4, 5000) / 4])


@pytest.fixture(scope="module")
def rows(spark, values):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(values)), **dict(zip(FEATURES, values.T))}))


@pytest.mark.parametrize("n", [1, 31, 33, 5000])
@pytest.mark.parametrize("flat", [False, True])
def test_leaves_within_a_cluster_are_added_up_whole(values, n, flat):
    rng = np.random.default_rng(n)
    x = values[:n].T.copy()
    if flat:
        x[1:] = 0.25
    block = np.vstack([x, rng.integers(1, 4, n)])
    points, leaves = blocks.tiled(block)
    assert sorted(map(tuple, points[:, points[-1] > 0].T)) == sorted(map(tuple, block.T))
    for k in (1, 2, 7):
        centers = x[:, rng.integers(0, n, k)].T + rng.normal(0, 0.1, (k, 3))
        want = blocks.block_sums(block[:-1], block[-1], centers)
        assert np.allclose(blocks.tiled_sums(points, leaves, centers), want)
        found = blocks.Leaves(leaves, centers, with_gap=True)
        labels, _, gaps = blocks.nearest_with_gap(points[:-1], centers)
        size = points.shape[1] // leaves.shape[1]
        assert ((labels.reshape(-1, size) == found.labels[:, None]) | ~found.sure[:, None]).all()
        assert (gaps.reshape(-1, size).min(axis=1) >= found.gap - 1e-9).all() if k > 1 else found.sure.all()
        (a,), w = blocks.tiled_labels(points, leaves, [centers])
        assert np.allclose(np.bincount(a, w, k), want[:, 0])
    if n == 5000:
        assert 0.2 < found.sure.mean() < 1


def test_shared_passes_read_the_rows_once(spark, rows, values, monkeypatch):
    """Lloyd, errors and agreements of several models over rows that have been packed once."""
    monkeypatch.setattr(lloyd, "BOUNDARY_BYTES", 0)
    monkeypatch.setattr(packed, "TILED_BYTES", 20_000)
    models = [values[:3], values[10:17], values[20:24]]
    want = lloyd.lloyd_models(lloyd.point_frame(rows, FEATURES), models)
    errors, table = baselines.sse_of_all(rows, FEATURES, models), many_labels.labelled(rows, FEATURES, models, ["id"])
    with lloyd.PackedPoints(rows, FEATURES) as kept:
        for module in (lloyd, baselines):
            monkeypatch.setattr(module, "pack", lambda *a: pytest.fail("rows are packed again"))
        monkeypatch.setattr(lloyd, "pack_tiled", lambda *a: pytest.fail("rows are packed again"))
        for one, got in zip(want, baselines.lloyd_from_all(rows, FEATURES, models, packed=kept)):
            assert one.n_iter == got.n_iter and np.allclose(one.centers, got.centers)
        assert np.allclose(baselines.sse_of_all(rows, FEATURES, models, kept), errors)
        pairs = [(0, 1), (1, 2), (2, 2)]
        labelled = many_labels.labelled(rows, FEATURES, models, ["id"], kept)
        for one, got in zip(many_labels.agreements(table, pairs), many_labels.agreements(labelled, pairs)):
            assert np.allclose(list(one.values()), list(got.values()))


def test_rows_of_a_sweep_are_not_kept(spark, rows):
    make = sweep.table_maker(rows, FEATURES, ["id"])
    with sweep._shared(make(2, 2, 5000, 0)) as sample:
        assert not sample.data.is_cached
