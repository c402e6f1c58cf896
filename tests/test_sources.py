import pytest
from pyspark.sql import functions as F

from gridlloyd.functions.randomness import keyed_hash, keyed_normal
from gridlloyd.operators.lloyd import assign
from gridlloyd.plans import report, sweep
from gridlloyd.session import checkpoint_folder
from gridlloyd.sources import mixture, tables, text
from gridlloyd.streaming.scoring import cell_stream, score_stream, write_cells


def test_csv_scan_types_and_suffix(spark, tmp_path):
    path = tmp_path / "set.csv"
    path.write_text("a,b,c\n1,x,2.5\n2,?,3\n")
    df = tables.read_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["bigint", "string", "double"]
    assert tables.string_columns(df) == ["b"]
    x, y, name = tables.supervised_view(df)
    assert (x.columns, y.columns, name) == (["a", "b"], ["c"], "c")
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(tmp_path / "set.txt"))
    with pytest.raises(ValueError):
        tables.drop_columns(df, ["nope"])


ARFF = """% a comment
@relation thing
@attribute id numeric
@attribute  kind {x, y}
@attribute value real

@data
1,x,2.5
% inside
2,?,-1e3
3,@data,4
"""


def test_arff(spark, tmp_path):
    (tmp_path / "one.arff").write_text(ARFF)
    df = text.read_arff(spark, str(tmp_path / "one.arff"))
    assert df.dtypes == [("id", "double"), ("kind", "string"), ("value", "double")]
    assert sorted(map(tuple, df.collect())) == [(1.0, "x", 2.5), (2.0, "?", -1000.0), (3.0, "@data", 4.0)]


def test_arff_folder_upper_case_and_many_splits(spark, tmp_path):
    body = "".join(f"{i},k{i % 3},{i / 2}\n" for i in range(3000))
    for name in ("a", "b"):
        (tmp_path / f"{name}.arff").write_text("@ATTRIBUTE id INT\n@ATTRIBUTE kind S\n@ATTRIBUTE value R\n@DATA\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = text.read_arff(spark, str(tmp_path))
        assert df.count() == 6000
        assert df.agg(F.sum("value")).first()[0] == 2 * sum(i / 2 for i in range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "c.arff").write_text("@attribute other x\n@data\n1\n")
    with pytest.raises(ValueError, match="different headers"):
        text.read_arff(spark, str(tmp_path))


def test_sensor_text(spark, tmp_path):
    head = "Time (seconds), Methane conc (ppm), Ethylene conc (ppm), sensor readings (16 channels)\n"
    rows = [[0.01 * i, i, 2 * i] + [i + j / 10 for j in range(16)] for i in range(500)]
    (tmp_path / "sub").mkdir()
    for name in ("a.txt", "sub/b.txt"):
        (tmp_path / name).write_text(head + "".join("  ".join(map(str, r)) + "  \n" for r in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = text.read_sensor_text(spark, str(tmp_path))
        assert df.columns[:4] == ["Time_(seconds)", "Methane_conc_(ppm)", "Ethylene_conc_(ppm)", "attr0"]
        assert len(df.columns) == 19 and df.count() == 1000
        assert df.where(F.col("attr15").isNull()).count() == 0
        assert df.agg(F.sum("attr3")).first()[0] == pytest.approx(2 * sum(r[6] for r in rows))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_result_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(3, None, 0.5), (9, 1, 0.25)], "n_clusters int, param int, value double")
    tables.write_results(df, str(tmp_path / "r.csv"))
    back = tables.read_results(spark, str(tmp_path / "r.csv"), df.schema)
    assert sorted(map(tuple, back.collect())) == [(3, None, 0.5), (9, 1, 0.25)]
    assert {r["param"] for r in tables.none_text(df, ["param"]).collect()} == {"None", "1"}


def test_mixture(spark):
    centers = mixture.mixture_centers(3, 2, 1)
    sigma = mixture.overlap_sigma(centers)
    gap = min(((a - b) ** 2).sum() ** 0.5 for i, a in enumerate(centers) for b in centers[i + 1:])
    assert mixture.normal_overlap(gap, sigma) == pytest.approx(0.05)
    df = mixture.gaussian_mixture(spark, 3, 2, 3001, seed=1)
    assert {r["y"]: r["count"] for r in df.groupBy("y").count().collect()} == {0: 1001, 1: 1000, 2: 1000}
    top = df.agg(F.max(F.abs("x0")), F.max(F.abs("x1"))).first()
    assert tuple(top) == (1.0, 1.0)
    again = mixture.gaussian_mixture(spark, 3, 2, 3001, seed=1).repartition(7)
    assert df.exceptAll(again).count() == 0
    other = mixture.gaussian_mixture(spark, 3, 2, 3001, seed=1, replica=1)
    assert df.select("x0").intersect(other.select("x0")).count() <= 2
    raw = mixture.gaussian_mixture(spark, 3, 2, 6000, seed=1, normalize=False, centers=centers)
    spread = raw.groupBy("y").agg(F.stddev("x0").alias("s"), F.avg("x0").alias("m")).collect()
    for r in spread:
        assert r["s"] == pytest.approx(sigma, rel=0.06)
        assert r["m"] == pytest.approx(centers[r["y"]][0], abs=0.05)


def test_keyed_choices(spark):
    df = spark.range(20000).select(
        keyed_hash(1, ["id"]).alias("h"), keyed_hash(1, ["id"], "md5").alias("m"), keyed_normal(1, ["id"]).alias("z"))
    row = df.agg(F.min("h"), F.max("h"), F.avg("m"), F.avg("z"), F.stddev("z")).first()
    assert row[0] >= 0 and row[1] < 2**60
    assert row[2] == pytest.approx(2**59, rel=0.02)
    assert abs(row[3]) < 0.03 and row[4] == pytest.approx(1.0, abs=0.03)
    with pytest.raises(ValueError):
        keyed_hash(1, ["id"], "crc")


def test_checkpoint_folder_follows_the_session(spark):
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_streaming(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(200).select("id", ((F.col("id") - 100) / 100).alias("v")).repartition(4).write.parquet(src)
    stream = spark.readStream.schema("id long, v double").parquet(src)
    centers = [[-0.5], [0.5]]
    scored = score_stream(stream, ["v"], centers)
    q = scored.writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = assign(spark.read.parquet(src), ["v"], centers)
    assert spark.table("scored").exceptAll(batch).count() == 0 and spark.table("scored").count() == 200
    seen = []
    writer = write_cells(cell_stream(stream, ["v"], 2), str(tmp_path / "cp"), lambda df, i: seen.append(
        {tuple(r["cell"]): r["n"] for r in df.collect()}))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sum(seen[-1].values()) == 200 and set(seen[-1]) == {(0,), (1,), (2,), (3,)}


def test_sweeps(spark):
    grid = sweep.Grid(n_clusters=[3], n_dims=[2], n_samples=[300], level_counts=[1, 3], batch_sizes=[100], replicas=2,
                      parallel=4)
    make = sweep.mixture_maker(spark)
    distances = report.average_replicas(sweep.distance_sweep(spark, make, grid)).collect()
    assert [(r["algorithm"], r["param"]) for r in distances] == [
        ("k-means++", "None"), ("mini-batch", "100"), ("recursive", "1"), ("recursive", "3")]
    assert all(r["fit_time_average"] > 0 and r["distance_calculations_average"] > 0 for r in distances)
    errors = sweep.error_sweep(spark, make, grid).collect()
    assert len(errors) == 4 and all(r["std_error"] <= 1e-9 for r in errors)
    ratios = sweep.ratio_sweep(spark, make, grid).orderBy("replica", "param").collect()
    assert ratios[0]["instance_ratio"] <= ratios[1]["instance_ratio"]
    same = sweep.equivalence_sweep(spark, make, sweep.Grid([3], [2], [300], [6], [], 1)).first()
    assert same["adjusted_rand"] > 0.9
    quality = sweep.quality_sweep(spark, make, grid)
    table = report.relative_table(report.average_replicas(quality), sweep.QUALITY_COLUMNS, "k-means++", "recursive")
    assert table.columns == ["metric", "1", "3"] and table.count() == 3
    assert all(0 <= r["1"] < 1 for r in table.collect())
    panel = report.series(report.average_replicas(quality), "n_samples", "silhouette", ["algorithm", "param"], {"n_clusters": 3})
    assert panel.columns == ["algorithm", "param", "x", "y"]


def test_feature_table_drops_and_scales(spark):
    df = spark.createDataFrame(
        [(0, 0.1, 5.0, "b", 2.0), (1, 0.2, 6.0, "a", 4.0)],
        "id int, `Time_(seconds)` double, `Methane_conc_(ppm)` double, kind string, v double")
    data, features = sweep.feature_table(df, ["id"])
    assert features == ["kind", "v"]
    assert [tuple(r) for r in data.orderBy("id").collect()] == [(0, 1.0, 0.0), (1, 0.0, 1.0)]
    make = sweep.table_maker(data, features, ["id"])
    sample = make(2, 1, 1, 0)
    assert sample.data.count() == 1 and len(sample.features) == 1


def test_dataset_sweep(spark, tmp_path):
    rows = ["a,b,kind"] + [f"{i % 10},{(i * 7) % 13},{'xyz'[i % 3]}" for i in range(120)]
    (tmp_path / "toy.csv").write_text("\n".join(rows) + "\n")
    got = sweep.dataset_sweep(spark, [str(tmp_path / "toy.csv")], replicas=1)
    assert len(got.columns) == 12
    row = got.first()
    assert (row["dataset"], row["instances"], row["dimensions"]) == ("toy", 120, 2)
    assert 0 < row["instance_ratio"] <= 1


def test_csv_missing_texts_are_nulls(spark, tmp_path):
    path = tmp_path / "gaps.csv"
    path.write_text("a,b,c\n1,x,2.5\nNA,null,n/a\n3,?,NaN\n")
    df = tables.read_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["bigint", "string", "double"]
    assert [tuple(r) for r in df.orderBy("b").collect()] == [(None, None, None), (3, "?", None), (1, "x", 2.5)]
    assert [t for _, t in tables.read_csv(spark, str(path), "a int, b string, c float").dtypes] == ["int", "string", "float"]


def test_readers_reject_lines_of_another_width(spark, tmp_path):
    header = "Time (seconds), Methane conc (ppm), Ethylene conc (ppm), sensor readings"
    (tmp_path / "a.txt").write_text(header + "\n" + " ".join(["1.0"] * 20) + "\n")
    with pytest.raises(Exception, match="must have 19 fields"):
        text.read_sensor_text(spark, str(tmp_path / "a.txt")).collect()
    (tmp_path / "b.txt").write_text("Day, Methane, Ethylene, readings\n" + " ".join(["1.0"] * 19) + "\n")
    with pytest.raises(ValueError, match="different headers"):
        text.read_sensor_text(spark, str(tmp_path))
    for line in ("3,4,5", "6"):
        path = tmp_path / "x.arff"
        path.write_text(f"@relation r\n@attribute a numeric\n@attribute b numeric\n@data\n1,2\n{line}\n")
        with pytest.raises(Exception):
            text.read_arff(spark, str(path)).collect()
