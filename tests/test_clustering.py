import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlloyd import RecursiveKMeans, RecursiveKMeansModel
from gridlloyd.operators import baselines, lloyd, metrics, packed
from gridlloyd.operators import cells as cell_ops
from gridlloyd.functions.randomness import keyed_uniform
from gridlloyd.operators.blocks import move_centers, nearest_with_gap
from gridlloyd.sources.mixture import gaussian_mixture


def frame(spark, x, **extra):
    pdf = pd.DataFrame(x, columns=[f"f{j}" for j in range(x.shape[1])])
    for name, values in extra.items():
        pdf[name] = values
    return spark.createDataFrame(pdf).repartition(3)


def brute_labels(x, centers):
    return ((x[:, None, :] - centers[None]) ** 2).sum(-1).argmin(1)


def brute_lloyd(x, w, centers, steps):
    for _ in range(steps):
        k = brute_labels(x, centers)
        centers = np.array([np.average(x[k == i], axis=0, weights=w[k == i]) for i in range(len(centers))])
    return centers


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(3)
    mid = np.array([[-0.6, -0.6, 0.0], [0.6, 0.5, -0.4], [0.0, 0.7, 0.6], [0.6, -0.6, 0.3]])
    return np.clip(np.concatenate([rng.normal(m, 0.12, (250, 3)) for m in mid]), -1, 1)


@pytest.mark.parametrize("k", [1, 4, 40])
def test_assign_matches_brute_force(spark, blobs, k):
    centers = np.random.default_rng(k).uniform(-1, 1, (k, 3))
    df = frame(spark, blobs, id=np.arange(len(blobs)))
    rows = lloyd.assign(df, ["f0", "f1", "f2"], centers, distance="d2").orderBy("id").collect()
    assert [r["prediction"] for r in rows] == brute_labels(blobs, centers).tolist()
    assert np.allclose([r["d2"] for r in rows], ((blobs[:, None] - centers[None]) ** 2).sum(-1).min(1))


def test_assign_tie_takes_lowest_index(spark):
    df = spark.createDataFrame([(0.0,)], "a double")
    assert lloyd.assign(df, ["a"], [[-1.0], [1.0]]).first()["prediction"] == 0
    many = np.tile([[-1.0], [1.0]], (60, 1))
    assert lloyd.assign(df, ["a"], many).first()["prediction"] == 0


def test_assign_accepts_array_column(spark, blobs):
    df = frame(spark, blobs, id=np.arange(len(blobs))).select("id", F.array("f0", "f1", "f2").alias("v"))
    rows = lloyd.assign(df, "v", blobs[:4]).orderBy("id").collect()
    assert [r["prediction"] for r in rows] == brute_labels(blobs, blobs[:4]).tolist()


def test_weighted_lloyd_matches_brute_force(spark, blobs):
    w = np.random.default_rng(1).integers(1, 5, len(blobs)).astype(float)
    points = lloyd.point_frame(frame(spark, blobs, n=w), ["f0", "f1", "f2"], "n")
    start = blobs[[0, 250, 500, 750]]
    got = lloyd.weighted_lloyd(points, start, max_iter=3, tol=0.0)
    assert np.allclose(got.centers, brute_lloyd(blobs, w, start, got.n_iter))


@pytest.mark.parametrize("k", [2, 60])
def test_rows_without_a_label(spark, k):
    """Null, NaN and infinite features give null on both sides of the unroll limit; a wrong width is an error."""
    rows = [(1, [0.1, 0.2]), (2, None), (3, [None, 0.2]), (4, [float("nan"), 0.2]), (5, [0.1, float("inf")])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    centers = np.random.default_rng(0).uniform(-1, 1, (k, 2))
    got = {r["id"]: r for r in lloyd.assign(df, "v", centers, distance="d2").collect()}
    assert got[1]["prediction"] == brute_labels(np.array([[0.1, 0.2]]), centers)[0]
    assert all(got[i]["prediction"] is None and got[i]["d2"] is None for i in (2, 3, 4, 5))
    with pytest.raises(ValueError, match="null"):
        metrics.sse(df, "v", centers)
    wide = spark.createDataFrame([(1, [0.1, 0.2, 9.0])], "id int, v array<double>")
    with pytest.raises(Exception, match="must hold 2 values"):
        lloyd.assign(wide, "v", centers).collect()


def test_empty_cluster_takes_farthest_point(spark):
    x = np.array([[0.0], [0.1], [0.2], [0.9]])
    points = lloyd.point_frame(frame(spark, x), ["f0"])
    got = lloyd.weighted_lloyd(points, [[0.0], [5.0]], max_iter=1, tol=0.0)
    assert np.allclose(sorted(got.centers.ravel()), [0.1, 0.9])


def test_weighted_step_golden():
    sums = np.array([[4.0, 0.0, 0.0 * 3 + 1.0 * 1]])
    assert move_centers(sums, np.array([[9.0]]), lambda m: [])[0, 0] == 0.25


def reference_fit(x, k, m, init, max_depth=24):
    """Plain driver-side recursion on row lists, to compare the levels with."""
    n, depth, centers, out = len(x), 0, None, []
    while len(out) < m and depth < max_depth:
        depth += 1
        half = 2.0 ** (depth - 1)
        g = np.clip(np.ceil(x * half) + half - 1, 0, 2**depth - 1).astype(int)
        cells, inverse, count = np.unique(g, axis=0, return_inverse=True, return_counts=True)
        rep = np.array([x[inverse.ravel() == i].mean(0) for i in range(len(cells))])
        if len(cells) < k:
            continue
        if centers is None:
            centers = init
        elif len(cells) >= n:
            return out, len(cells) / n
        tol = 1e-4 * rep.var(0).mean()
        for it in range(1, 301):
            new = brute_lloyd(rep, count, centers, 1)
            shift = ((new - centers) ** 2).sum()
            centers = new
            if shift <= tol:
                break
        out.append((depth, len(cells), it, centers))
    return out, len(cells) / n


def test_recursive_fit_equals_plain_recursion(spark, blobs):
    df = frame(spark, blobs)
    init = blobs[[0, 250, 500, 750]]
    model = RecursiveKMeans(inputCols=["f0", "f1", "f2"], nClusters=4, maxIter=5, init=init.tolist()).fit(df)
    want, ratio = reference_fit(blobs, 4, 5, init)
    rows = model.history.orderBy("iteration").collect()
    assert [(r["depth"], r["n_cells"], r["lloyd_iterations"]) for r in rows] == [w[:3] for w in want]
    for r, w in zip(rows, want):
        assert np.allclose(r["centers"], w[3])
        assert r["distances"] == w[2] * 4 * w[1]
    assert model.instance_ratio == ratio
    assert model.distance_computations == sum(w[2] * 4 * w[1] for w in want)
    # a shorter fit is a prefix of a longer one
    short = RecursiveKMeans(inputCols=["f0", "f1", "f2"], nClusters=4, maxIter=2, init=init.tolist()).fit(df)
    assert np.allclose(short.centers, model.at_iteration(2).centers)
    assert short.summary == model.at_iteration(2).summary


def test_depth_is_not_iteration_and_saturation(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (60, 2))
    model = RecursiveKMeans(inputCols=["f0", "f1"], nClusters=9, maxIter=30, seed=4).fit(frame(spark, x))
    rows = model.history.orderBy("iteration").collect()
    assert rows[0]["depth"] >= 2 and rows[0]["iteration"] == 1
    assert model.instance_ratio == 1.0 and rows[-1]["n_cells"] < 60
    assert model.n_iter < 30 and model.summary["stopped"] == "saturated"


def test_distance_threshold_stops(spark, blobs):
    fit = lambda t: RecursiveKMeans(
        inputCols=["f0", "f1", "f2"], nClusters=4, maxIter=6, distanceThreshold=t, seed=1).fit(frame(spark, blobs))
    free, stopped = fit(0.0), fit(10.0)
    assert stopped.n_iter == 1 < free.n_iter
    assert (stopped.summary["stopped"], free.summary["stopped"]) == ("threshold", "iterations")
    assert np.allclose(stopped.centers, free.at_iteration(1).centers)


def test_seed_cells_are_distinct_representatives(spark, blobs):
    df = frame(spark, blobs)
    model = RecursiveKMeans(inputCols=["f0", "f1", "f2"], nClusters=4, maxIter=1, seed=7).fit(df)
    start = {tuple(np.round(s, 9)) for s in model.history.first()["start"]}
    means = {tuple(np.round(r["mean"], 9)) for r in cell_ops.cell_stats(df, ["f0", "f1", "f2"], 1).collect()}
    assert len(start) == 4 and start <= means


def test_errors(spark, blobs):
    df = frame(spark, blobs)
    with pytest.raises(ValueError, match="fit first"):
        RecursiveKMeansModel().transform(df)
    model = RecursiveKMeans(inputCols=["f0", "f1", "f2"], nClusters=2, maxIter=1).fit(df)
    model.set_params(inputCols=["f0", "f1"])
    with pytest.raises(ValueError, match="features"):
        model.transform(df)
    same = spark.createDataFrame([(0.5, 0.5)] * 5, "a double, b double")
    with pytest.raises(ValueError, match="distinct points"):
        RecursiveKMeans(inputCols=["a", "b"], nClusters=2).fit(same)


def test_score_params_and_persistence(spark, blobs, tmp_path):
    truth = np.repeat(np.arange(4), 250)
    df = frame(spark, blobs, y=truth)
    est = RecursiveKMeans(inputCols=["f0", "f1", "f2"], nClusters=4, maxIter=3,
                          init=blobs[[0, 250, 500, 750]].tolist())
    assert est.get_params()["nClusters"] == 4
    model = est.fit(df)
    assert model.score(df, "y") > 0.95
    model.save_tables(str(tmp_path / "m"))
    again = RecursiveKMeansModel.load_tables(spark, str(tmp_path / "m"))
    assert np.array_equal(again.centers, model.centers) and again.summary == model.summary
    assert again.score(df, "y") == model.score(df, "y")
    model.write().save(str(tmp_path / "ml"))
    est.write().save(str(tmp_path / "estimator"))
    whole = RecursiveKMeansModel.load(str(tmp_path / "ml"))
    assert np.array_equal(whole.centers, model.centers) and whole.get_params() == model.get_params()
    loaded = RecursiveKMeans.load(str(tmp_path / "estimator"))
    assert loaded.getOrDefault("init") == est.getOrDefault("init")
    assert np.array_equal(loaded.fit(df).centers, model.centers)
    assert model.trajectory().count() == 4 * model.n_iter
    levels = model.label_levels(df)
    assert levels.where(F.col(f"level{model.n_iter}") != F.col("y")).count() < 50
    model.reset()
    assert model.centers is None and model.instance_ratio == -1


@pytest.mark.parametrize("refresh", [8, 2])
@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_kmeans_pp_seeding_follows_the_race(spark, blobs, monkeypatch, refresh, method):
    monkeypatch.setattr(baselines, "REFRESH", refresh)
    df = frame(spark, blobs, id=np.arange(len(blobs)))
    with baselines._points(df, ["f0", "f1", "f2"], ["id"], 5, method) as (points, scratch):
        got = baselines.kmeans_pp_seed(points, 5, scratch, method)
        draws = points.select("x0", "x1", "x2", *[keyed_uniform(t, ["h"], method).alias(f"u{t}") for t in range(5)])
        table = np.array([list(r) for r in draws.collect()])
    rows, seeds = table[:, :3], np.empty((0, 3))
    for turn in range(5):
        d2 = np.ones(len(rows)) if turn == 0 else ((rows[:, None] - seeds[None]) ** 2).sum(-1).min(1)
        with np.errstate(divide="ignore"):
            race = -np.log1p(-table[:, 3 + turn]) / d2
        seeds = np.vstack([seeds, rows[race.argmin()]])
    assert np.allclose(got, seeds)


@pytest.mark.parametrize("size,first", [(50, 8), (64, 1), (333, 1), (1000, 1), (5000, 8)])
def test_cuts_follow_the_hash_order(spark, blobs, size, first):
    df = frame(spark, blobs, id=np.arange(len(blobs)) // 3)  # every hash three times
    xs = ["x0", "x1", "x2"]
    with baselines._points(df, ["f0", "f1", "f2"], ["id"], 1, "xxhash64") as (points, scratch):
        want = sorted(tuple(r) for r in points.select("h", *xs).collect())
        got = {}
        for table, done, end in baselines.cuts(points.withColumn("o", F.col("h")), xs, len(blobs), size, scratch, "t", first):
            for r in table.where(F.col("rank").between(done * size, end * size - 1)).collect():
                got.setdefault(r["rank"] // size, []).append((r["h"], *[r[x] for x in xs]))
    assert [sorted(got[b]) for b in range(len(got))] == [want[i:i + size] for i in range(0, len(want), size)]


def test_runs_of_batches_equal_one_job_per_batch(spark, blobs, monkeypatch):
    """Bit for bit; batches too large for one task differ in the order of sums only."""
    df = frame(spark, blobs, id=np.arange(len(blobs)))
    results = []
    for size in (8 << 20, 3 * 32 * 70, 32 * 70, 1):
        monkeypatch.setattr(baselines, "RUN_BYTES", size)
        results.append(baselines.mini_batch_kmeans(df, ["f0", "f1", "f2"], 4, 70, ["id"], seed=3, max_epochs=2))
    assert len({r.n_iter for r in results}) == 1 and results[0].n_iter > 10
    assert all(np.array_equal(r.centers, results[0].centers) for r in results[1:3])
    assert np.allclose(results[3].centers, results[0].centers)


def test_many_models_in_one_pass(spark, blobs):
    points = lloyd.point_frame(frame(spark, blobs), ["f0", "f1", "f2"])
    starts = [blobs[[0, 250, 500, 750]], blobs[[1, 2]], blobs[[5, 300, 301, 302, 900]]]
    together = lloyd.lloyd_models(points, starts, tol=0.0)
    for start, got in zip(starts, together):
        alone = lloyd.weighted_lloyd(points, start, tol=0.0)
        assert got.n_iter == alone.n_iter and np.allclose(got.centers, alone.centers)
        assert np.allclose(got.centers, brute_lloyd(blobs, np.ones(len(blobs)), start, got.n_iter))


@pytest.mark.parametrize("alone", [0, 16 << 20])
def test_boundary_points_give_the_same_steps(spark, monkeypatch, alone):
    """Steps over the points near a border only, distributed or in one task, against plain steps over all."""
    rng = np.random.default_rng(4)
    x = np.repeat(rng.uniform(-1, 1, (6, 3)), 400, axis=0) + rng.normal(0, 0.2, (2400, 3))
    w = rng.integers(1, 5, 2400).astype(float)
    points = lloyd.point_frame(frame(spark, x, n=w), ["f0", "f1", "f2"], "n")
    monkeypatch.setattr(lloyd, "BOUNDARY_BYTES", alone)
    made = []
    for name in ("step", "iterate"):
        real = getattr(packed.Boundary, name)
        monkeypatch.setattr(packed.Boundary, name, lambda *a, real=real, name=name: made.append((name, real(*a))) or made[-1][1])
    for steps in (30, 300):
        got = lloyd.weighted_lloyd(points, x[:6], max_iter=steps, tol=0.0)
        assert np.allclose(got.centers, brute_lloyd(x, w, x[:6], got.n_iter)) and got.n_iter <= steps
    assert {name for name, _ in made} == ({"iterate"} if alone else {"step"})


def test_gaps_are_lower_bounds():
    rng = np.random.default_rng(3)
    x, centers = rng.normal(1e3, 1, (4, 5000)), rng.normal(1e3, 1, (7, 4))
    labels, squares, gaps = nearest_with_gap(x, centers)
    distance = np.sqrt(((x.T[:, None] - centers[None]) ** 2).sum(-1))
    ordered = np.sort(distance, axis=1)
    assert (labels == distance.argmin(axis=1)).all() and np.allclose(squares, ordered[:, 0] ** 2)
    assert (gaps <= ordered[:, 1] - ordered[:, 0]).all() and (gaps > ordered[:, 1] - ordered[:, 0] - 1e-2).all()


def test_mini_batch_matches_running_means(spark, blobs):
    df = frame(spark, blobs, id=np.arange(len(blobs)))
    start = blobs[[0, 250, 500, 750]]
    with baselines._points(df, ["f0", "f1", "f2"], ["id"], 3, "xxhash64") as (points, _):
        rows = np.array(sorted([r["h"], r["x0"], r["x1"], r["x2"]] for r in points.collect()))[:, 1:]
    centers, seen = start.copy(), np.zeros(4)
    for at in range(0, 1000, 130):
        part = rows[at:at + 130]
        labels = brute_labels(part, centers)
        for k in range(4):
            own = part[labels == k]
            if len(own):
                seen[k] += len(own)
                centers[k] += len(own) / seen[k] * (own.mean(axis=0) - centers[k])
    model = baselines.mini_batch_kmeans(df, ["f0", "f1", "f2"], 4, 130, ["id"], seed=3, init=start, max_epochs=1,
                                        max_no_improvement=10**6)
    assert model.n_iter == 8 and np.allclose(model.centers, centers)


def test_kmeans_pp_converges_to_a_fixed_point(spark, blobs):
    df = frame(spark, blobs, id=np.arange(len(blobs)))
    model = baselines.kmeans_pp(df, ["f0", "f1", "f2"], 4, ["id"], seed=2, tol=0.0)
    assert np.allclose(model.centers, brute_lloyd(blobs, np.ones(len(blobs)), model.centers, 1))
    n, k = len(blobs), 4
    assert model.distance_computations == 0.5 * k * (k + 1) * n + k * n * model.n_iter
    again = baselines.lloyd_from(df, ["f0", "f1", "f2"], model.centers)
    assert again.n_iter == 1 and np.allclose(again.centers, model.centers)


@pytest.mark.parametrize("given", [True, False])
def test_mini_batch(spark, blobs, given):
    df = frame(spark, blobs, id=np.arange(len(blobs)))
    start = blobs[[0, 250, 500, 750]]
    model = baselines.mini_batch_kmeans(
        df, ["f0", "f1", "f2"], 4, 100, ["id"], seed=1, init=start if given else None, init_size=500)
    if not given:
        assert len(model.centers) == 4
        return
    exact = brute_lloyd(blobs, np.ones(len(blobs)), start, 20)
    assert np.abs(model.centers - exact).max() < 0.1
    assert model.distance_computations == 0.5 * 4 * 5 * 1000 + 4 * 100 * model.n_iter


def test_one_full_batch_is_one_lloyd_step(spark, blobs):
    df = frame(spark, blobs, id=np.arange(len(blobs)))
    start = blobs[[0, 250, 500, 750]]
    model = baselines.mini_batch_kmeans(df, ["f0", "f1", "f2"], 4, 1000, ["id"], init=start, max_epochs=1)
    assert model.n_iter == 1
    assert np.allclose(model.centers, brute_lloyd(blobs, np.ones(len(blobs)), start, 1))


def test_mixture_recovery(spark):
    df = gaussian_mixture(spark, 3, 2, 3000, seed=11)
    model = RecursiveKMeans(inputCols=["x0", "x1"], nClusters=3, maxIter=6, seed=1).fit(df)
    exact = baselines.lloyd_from(df, ["x0", "x1"], model.centers)
    errors = [
        lloyd.assign(df, ["x0", "x1"], c, distance="d").agg(F.sum("d")).first()[0]
        for c in (exact.centers, model.centers)]
    assert (errors[0] - errors[1]) / errors[0] <= 1e-9
