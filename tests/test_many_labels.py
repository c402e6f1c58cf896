"""Metrics of many labelings at once against those of one."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from gridlloyd.operators import baselines, blocks, lloyd, many_labels, metrics
from gridlloyd.plans import sweep


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(9)
    x = np.repeat(rng.uniform(-1, 1, (5, 3)), 40, axis=0) + rng.normal(0, 0.2, (200, 3))
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(200), **{f"f{j}": x[:, j] for j in range(3)}}))


FEATURES = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def models():
    rng = np.random.default_rng(2)
    return [rng.uniform(-1, 1, (k, 3)) for k in (2, 4, 7)]


def test_internal_metrics(rows, models):
    table = many_labels.labelled(rows, FEATURES, models, ["id"])
    for model, got in zip(models, many_labels.internal_metrics(table, 3, 3)):
        one = lloyd.assign(rows, FEATURES, model)
        want = (metrics.silhouette(one, FEATURES, "prediction", ["id"]),
                metrics.calinski_harabasz(one, FEATURES, "prediction"), metrics.davies_bouldin(one, FEATURES, "prediction"))
        assert np.allclose(got, want)


def test_agreements(rows, models):
    table = many_labels.labelled(rows, FEATURES, models, ["id"])
    both = lloyd.assign(lloyd.assign(rows, FEATURES, models[1], "a"), FEATURES, models[2], "b")
    same, other = many_labels.agreements(table, [(0, 0), (1, 2)])
    assert np.allclose(list(same.values()), 1.0)
    assert np.allclose(list(other.values()), list(metrics.agreement(both, "a", "b").values()))


def test_errors(rows, models):
    assert np.allclose(baselines.sse_of_all(rows, FEATURES, models), [metrics.sse(rows, FEATURES, m) for m in models])


def test_shared_fits_equal_single_ones(rows):
    ks, specs = [2, 5], [(2, 30), (5, 70), (3, 30)]
    for k, got in zip(ks, baselines.kmeans_pp_all(rows, FEATURES, ks, ["id"], seed=4)):
        one = baselines.kmeans_pp(rows, FEATURES, k, ["id"], seed=4)
        assert got.n_iter == one.n_iter and np.allclose(got.centers, one.centers)
    for (k, size), got in zip(specs, baselines.mini_batch_all(rows, FEATURES, specs, ["id"], seed=4)):
        one = baselines.mini_batch_kmeans(rows, FEATURES, k, size, ["id"], seed=4)
        assert got.n_iter == one.n_iter and np.allclose(got.centers, one.centers)


def test_replicas_share_the_passes_that_compare_them(spark, rows, monkeypatch):
    calls = []
    real = many_labels.internal_metrics
    monkeypatch.setattr(many_labels, "internal_metrics", lambda *a: calls.append(a[1]) or real(*a))
    sample = sweep.Sample(rows, FEATURES, ["id"])
    both = sweep.compare_with_baseline(sample, 3, [0, 1])
    assert calls == [4]
    assert np.allclose(both[1], sweep.compare_with_baseline(sample, 3, [1])[0])


def test_few_points_are_iterated_over_in_tasks(spark, rows, models, monkeypatch):
    """Several models over few points make no pass of all models at all."""
    points = lloyd.point_frame(rows, FEATURES)
    monkeypatch.setattr(lloyd, "BOUNDARY_BYTES", 0)
    want = lloyd.lloyd_models(points, models)
    monkeypatch.undo()
    monkeypatch.setattr(lloyd, "model_sums", lambda *a: pytest.fail("a pass over all points"))
    for one, got in zip(want, lloyd.lloyd_models(points, models)):
        assert one.n_iter == got.n_iter and np.allclose(one.centers, got.centers)


def test_each_model_goes_on_by_its_bounds(spark, rows, models, monkeypatch):
    points, made = lloyd.point_frame(rows, FEATURES), []
    want = lloyd.lloyd_models(points, models, tol=0.0)
    monkeypatch.setattr(lloyd, "BOUNDARY_BYTES", 0)
    monkeypatch.setattr(lloyd, "SHARED_STEPS", 1)
    real = lloyd._last_model
    monkeypatch.setattr(lloyd, "_last_model", lambda *a: made.append(a) or real(*a))
    for one, got in zip(want, lloyd.lloyd_models(points, models, tol=0.0)):
        assert one.n_iter == got.n_iter and np.allclose(one.centers, got.centers)
    assert len(made) > 1


def test_equal_models_are_compared_once(spark, rows, monkeypatch):
    """Fits that end early are the same for all larger level counts."""
    made, real = [], many_labels.labelled
    monkeypatch.setattr(many_labels, "labelled", lambda *a: made.append(real(*a)) or seen.append(a[2]) or made[-1])
    seen: list = []
    grid = sweep.Grid([3], [3], [200], level_counts=(1, 2, 18, 20), batch_sizes=(50,), replicas=1)
    got = {(r["algorithm"], r["param"]): tuple(r[6:]) for r in sweep.quality_sweep(
        spark, lambda *a: sweep.Sample(rows, FEATURES, ["id"]), grid).collect()}
    assert len(seen[0]) == len({m.tobytes() for m in seen[0]}) < len(got) == 6
    assert got[sweep.RECURSIVE, 18] == got[sweep.RECURSIVE, 20]
    model = sweep._recursive(sweep.Sample(rows, FEATURES, ["id"]), [3], 20, 0)[0]
    one = lloyd.assign(rows, FEATURES, model.centers)
    assert np.allclose(got[sweep.RECURSIVE, 20], (
        metrics.silhouette(one, FEATURES, "prediction", ["id"]), metrics.calinski_harabasz(one, FEATURES, "prediction"),
        metrics.davies_bouldin(one, FEATURES, "prediction")))


@pytest.mark.parametrize("k", [1, 9, 40])
def test_steps_in_a_task_copy_no_points(k):
    rng = np.random.default_rng(1)
    block = rng.uniform(0, 1, (33, 40_000))
    centers = block[:-1, :k].T.copy()
    want = np.delete(blocks.block_sums(block[:-1], block[-1], centers), 1, axis=1)
    tracemalloc.start()
    got = blocks.center_sums(block, centers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, want) and peak < block.nbytes / 2
    assert not blocks.center_sums(block[:, :0], centers).any()
