import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridlloyd.operators import joins, prepare, sampling
from gridlloyd.operators.prepare import Preparer
from gridlloyd.session import Scratch


def values(df, column, by="id"):
    return [r[column] for r in df.orderBy(by).collect()]


def column(spark, items, name="v", kind="string"):
    return spark.createDataFrame(list(enumerate(items)), f"id int, {name} {kind}").repartition(3)


def test_label_codes_are_sorted_ranks(spark):
    df = column(spark, ["b", "?", "a"])
    model = Preparer(scale="none", ids=["id"]).fit(df)
    assert {(r["value"], r["code"]) for r in model.mapping().collect()} == {("?", 0), ("a", 1), ("b", 2)}


@pytest.mark.parametrize("method,want", [
    ("most_frequent", 1.0), ("median", 1.0), ("mean", 4 / 3), ("constant", 9.0)])
def test_imputation(spark, method, want):
    df = column(spark, ["a", "?", "a", "b"])
    got = Preparer(scale="none", impute=method, fill_value=9.0, ids=["id"]).fit(df).transform(df)
    assert values(got, "v") == pytest.approx([1.0, want, 1.0, 2.0])


def test_mode_tie_takes_smallest_and_median_averages(spark):
    df = column(spark, ["a", "?", "b"])
    fit = lambda m: values(Preparer(scale="none", impute=m, ids=["id"]).fit(df).transform(df), "v")[1]
    assert fit("most_frequent") == 1.0 and fit("median") == 1.5


@pytest.mark.parametrize("broadcast", [True, False])
def test_random_imputation_draws_observed_values_in_proportion(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(prepare, "BOUNDED_BYTES", 0)
    items = ["?", "a", "?", "b", "?", "b", "?", "b"] * 300
    df = column(spark, items)
    plan = Preparer(scale="none", impute="random", ids=["id"], seed=3)
    got = values(plan.fit(df).transform(df), "v")
    assert [g for g, i in zip(got, items) if i != "?"] == [{"a": 1, "b": 2}[i] for i in items if i != "?"]
    drawn = [g for g, i in zip(got, items) if i == "?"]
    assert set(drawn) == {1, 2} and 0.7 < np.mean(np.array(drawn) == 2) < 0.8
    assert got == values(plan.fit(df).transform(df.repartition(7)), "v")


def test_regression_imputation_excludes_the_column_itself(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 1, 200)
    codes = (x > 0.5).astype(int)
    text = np.where(rng.random(200) < 0.2, "?", np.array(["lo", "up"])[codes])
    df = spark.createDataFrame(pd.DataFrame({"id": range(200), "v": text, "x": x}))
    got = Preparer(scale="none", impute="logistic_regression", ids=["id"]).fit(df).transform(df)
    filled = [(r["v"], c) for r, c, t in zip(got.orderBy("id").collect(), codes, text) if t == "?"]
    assert set(v for v, _ in filled) <= {1.0, 2.0}
    assert np.mean([v == c + 1 for v, c in filled]) > 0.85
    line = Preparer(scale="none", impute="linear_regression", ids=["id"]).fit(df).transform(df)
    known = text != "?"
    slope, intercept = np.polyfit(x[known], codes[known] + 1, 1)
    got = np.array(values(line, "v"))
    assert np.allclose(got[~known], intercept + slope * x[~known], atol=1e-6)


def test_regression_sees_scaled_left_and_raw_right_columns(spark):
    rng = np.random.default_rng(1)
    n = 100
    left, right = rng.uniform(0, 10, n), rng.uniform(0, 10, n)
    text = np.where(np.arange(n) % 5 == 0, "?", np.where(left + right > 10, "b", "a"))
    df = spark.createDataFrame(pd.DataFrame({"id": range(n), "left": left, "v": text, "right": right}))
    model = Preparer(scale="min-max", impute="linear_regression", ids=["id"]).fit(df)
    assert [s[0] for s in model.steps] == ["scale", "model", "scale"]
    scaled = (left - left.min()) / (left.max() - left.min())
    known = text != "?"
    codes = np.where(text == "b", 2, 1)
    a = np.column_stack([scaled, right, np.ones(n)])
    w = np.linalg.lstsq(a[known], codes[known], rcond=None)[0]
    full = np.where(known, codes, a @ w)
    want = (full - full.min()) / (full.max() - full.min())
    assert np.allclose(values(model.transform(df), "v"), want, atol=1e-6)


@pytest.mark.parametrize("method,items,want", [
    ("min-max", [4.0, 4.0], [0, 0]), ("min-max", [2.0, 4.0, 3.0], [0, 1, 0.5]),
    ("standardisation", [1.0, 3.0], [-1, 1]), ("stardardisation", [1.0, 3.0], [-1, 1]), ("mean", [1.0, 3.0], [-1, 1]),
    ("standardisation", [5.0, 5.0], [0, 0]), ("unit", [-2.0, 0.0, 5.0], [-1, 0, 1]), ("max-abs", [-4.0, 2.0], [-1, 0.5])])
def test_scalers(spark, method, items, want):
    df = column(spark, items, kind="double")
    assert values(Preparer(scale=method, ids=["id"]).fit(df).transform(df), "v") == pytest.approx(want)


def test_one_hot_takes_the_place_of_its_column(spark):
    df = spark.createDataFrame([(0, 1.0, "x", 2.0), (1, 3.0, "?", 4.0), (2, 5.0, "x", 6.0)], "id int, a double, k string, b double")
    model = Preparer(categorical="onehot", ids=["id"]).fit(df)
    got = model.transform(df).orderBy("id")
    assert got.columns == ["id", "a", "k_?", "k_x", "b"] and model.feature_names == ["a", "k_?", "k_x", "b"]
    assert [tuple(r)[1:] for r in got.collect()] == [(0.0, 0, 1, 0.0), (0.5, 1, 0, 0.5), (1.0, 0, 1, 1.0)]
    unseen = spark.createDataFrame([(9, 1.0, "new", 2.0)], df.schema)
    assert tuple(model.transform(unseen).first())[2:4] == (0, 0)


def test_target_is_encoded_by_number(spark):
    df = spark.createDataFrame([(0, 1.0, 10), (1, 2.0, 9), (2, 3.0, 100)], "id int, a double, y int")
    model = Preparer(target="y", ids=["id"]).fit(df)
    assert values(model.transform(df), "y") == [1, 0, 2] and model.n_targets == 3


def test_large_dictionary_joins_by_shuffle(spark, monkeypatch):
    items = ["hot"] * 500 + [f"v{i:03d}" for i in range(200)]
    df = column(spark, items)
    want = values(Preparer(scale="none", ids=["id"]).fit(df).transform(df), "v")
    monkeypatch.setattr(joins, "BOUNDED_BYTES", 0)
    assert values(Preparer(scale="none", ids=["id"]).fit(df).transform(df), "v") == want
    ranks = {v: i for i, v in enumerate(sorted(set(items)))}
    assert want == [ranks[i] for i in items]


def test_one_hot_refuses_unbounded_columns(spark, monkeypatch):
    monkeypatch.setattr(prepare, "BOUNDED_BYTES", 0)
    with pytest.raises(ValueError, match="too many distinct values"):
        Preparer(categorical="onehot", ids=["id"]).fit(column(spark, ["a", "b"]))


def test_unknown_options(spark):
    for bad in (dict(scale="x"), dict(impute="x"), dict(categorical="x"), dict(impute="random")):
        with pytest.raises(ValueError):
            Preparer(**bad)


@pytest.mark.parametrize("n", [0, 10, 999, 1001, 2500, 5000, 9999])
def test_sample_rows_is_exact_and_uniform(spark, n):
    df = spark.range(5000).select("id", (F.col("id") * 2).alias("v")).repartition(6)
    got = sampling.sample_rows(df, n, ["id"], seed=1).collect()
    assert len(got) == len({r["id"] for r in got}) == min(n, 5000)
    assert all(r["v"] == 2 * r["id"] for r in got)
    if n == 2500:
        assert abs(np.mean([r["id"] for r in got]) - 2500) < 120


def test_sample_rows_are_nested_and_stable(spark):
    df = spark.range(4000)
    small = {r["id"] for r in sampling.sample_rows(df, 1200, ["id"], seed=5).collect()}
    large = {r["id"] for r in sampling.sample_rows(df.repartition(9), 2000, ["id"], seed=5).collect()}
    assert small < large
    assert small != {r["id"] for r in sampling.sample_rows(df, 1200, ["id"], seed=6).collect()}


def test_sample_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert len(sampling.sample_columns(df, 2, seed=1).columns) == 2


def test_running_total(spark):
    pdf = pd.DataFrame({"k": np.random.default_rng(0).permutation(500)})
    pdf["w"] = pdf["k"] % 7
    got = sampling.with_running_total(
        spark.createDataFrame(pdf).repartition(6), ["k"], F.col("w"), Scratch(spark)).orderBy("k").collect()
    assert [r["idx"] for r in got] == list(range(500))
    weights = np.arange(500) % 7
    assert [r["before"] for r in got] == (np.cumsum(weights) - weights).tolist()


def test_logistic_models_are_optimal(spark):
    """The gradient of the penalised loss vanishes, against a plain evaluation of the probabilities."""
    import numpy as np

    rng = np.random.default_rng(4)
    u, w = rng.normal(size=300), rng.normal(size=300)
    kind = ["?" if i % 11 == 0 else "abc"[int(a > 0.3) + int(b > 0.1)] for i, (a, b) in enumerate(zip(u, w))]
    df = spark.createDataFrame(list(zip(range(300), kind, u.tolist(), w.tolist())), "id long, kind string, u double, w double")
    model = Preparer(scale="none", impute="logistic_regression", ids=["id"]).fit(df)
    found = {(r["code"], r["feature"]): r for r in model.logistic_moments(df).collect()}
    fitted = [s for s in model.steps if s[0] == "model"][0][2]
    codes = {r["value"]: r["code"] for r in model.mapping().collect()}
    known = np.array([k != "?" for k in kind])
    x, y = np.stack([u, w], 1)[known], np.array([codes[k] for k in kind])[known]
    odds = np.exp(x @ fitted.coefficientMatrix.toArray().T + fitted.interceptVector.toArray())
    odds /= odds.sum(1, keepdims=True)
    for code in set(y.tolist()):
        for name, column in (("intercept", np.ones(len(x))), ("u", x[:, 0]), ("w", x[:, 1])):
            row = found[code, name]
            weight = 0.0 if name == "intercept" else fitted.coefficientMatrix.toArray()[code, "uw".index(name)]
            assert abs(row["observed"] - column[y == code].sum()) < 1e-9
            assert abs(row["predicted"] - (odds[:, code] @ column + weight)) < 1e-6
            assert abs(row["observed"] - row["predicted"]) < 1e-2
    with pytest.raises(ValueError, match="no column was imputed"):
        Preparer(scale="none", ids=["id"]).fit(df).logistic_moments(df)
