"""Registered queries: every operator run over the whole given tables.

Each takes (spark, sf_dir). Random choices use the md5 hash, which every SQL engine has, so that the
results can be recomputed elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures
from ..functions.vectors import euclidean_norm, feature_columns
from ..operators import baselines, cells, lloyd, metrics, prepare, sampling
from ..operators.recursive import RecursiveKMeans
from ..session import Scratch
from ..sources import mixture, tables, text
from ..streaming.scoring import cell_stream, score_stream
from . import report, sweep

LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
#: Integer columns that name a row of lineitem, and the numbers of clusters of the ratio table.
LINE_IDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
RATIO_CLUSTERS = (3, 20)
LINE_ROW = ("l_orderkey", "l_linenumber", "l_extendedprice")
#: Fixed start centres for the four lineitem features, scaled to [-1, 1].
LINE_CENTERS = (
    (-0.5, -0.5, -0.5, -0.5), (0.5, 0.5, 0.5, 0.5), (-0.5, 0.4, 0.6, -0.3), (0.6, -0.4, -0.6, 0.2), (0.1, 0.0, 0.3, 0.7),
)
#: A second fixed set, used as the "approximate" one of two solutions.
LINE_OTHER = (
    (-0.4, -0.6, -0.4, -0.5), (0.4, 0.6, 0.5, 0.3), (-0.6, 0.5, 0.5, -0.2), (0.5, -0.5, -0.5, 0.3), (0.0, 0.1, 0.2, 0.6),
)
#: Width of the embeddings, and fixed centres for them by a rule.
EMBEDDING_DIMS = 64
EMBEDDING_CENTERS = tuple(
    tuple(((k * 7 + j * 3) % 11 - 5) / 40.0 for j in range(EMBEDDING_DIMS)) for k in range(5))
EMBEDDING_COLUMNS = [f"e{j}" for j in range(EMBEDDING_DIMS)]
#: Two unscaled columns of unlike ranges, and start centres for them.
CUSTOMER = ("c_acctbal", "c_nationkey")
CUSTOMER_CENTERS = ((1000.0, 12.0), (8000.0, 12.0))
EVENT_CENTERS = ((5.0,), (20.0,), (60.0,), (120.0,))
MIXTURE_CENTERS = ((-0.5, -0.5), (0.5, -0.25), (0.0, 0.75))
MIXTURE_SIGMA = 0.2
SEED = 7
SMALL_SAMPLE, LARGE_SAMPLE = 50, 2000

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _line(spark, sf_dir, *keep) -> DataFrame:
    """lineitem features scaled to [-1, 1]; Catalyst prunes the scan to these columns."""
    return prepare.to_unit_box(_table(spark, sf_dir, "lineitem").select(*keep, *LINE), LINE)


def _line_with_price(spark, sf_dir) -> DataFrame:
    """Scaled features next to the columns that name a row (the raw price is one of them)."""
    raw = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), *LINE)
    return prepare.to_unit_box(raw, LINE)


def _embedding(spark, sf_dir) -> DataFrame:
    e = _table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", *[x.alias(c) for x, c in zip(feature_columns(e, "embedding", EMBEDDING_DIMS), EMBEDDING_COLUMNS)])


def _labelled(spark, sf_dir) -> DataFrame:
    return lloyd.assign(_embedding(spark, sf_dir), EMBEDDING_COLUMNS, EMBEDDING_CENTERS)


def _one(spark, name: str, value: float) -> DataFrame:
    return spark.createDataFrame([(round(float(value), 6),)], f"{name} double")


def _r(column, digits: int = 6):
    return F.round(column, digits)


def _cell_columns(dims: int):
    return [F.get("cell", F.lit(j)).alias(f"g{j}") for j in range(dims)]


def _mean_columns(dims: int):
    return [_r(F.get("mean", F.lit(j))).alias(f"m{j}") for j in range(dims)]


def _centers_frame(spark, centers, **extra) -> DataFrame:
    rows = [(k, *[round(float(v), 6) for v in c]) for k, c in enumerate(centers)]
    return spark.createDataFrame(rows, "k int, " + ", ".join(f"c{j} double" for j in range(len(rows[0]) - 1)))


# ---------------------------------------------------------------- cells

@query
def cell_assign_d3(spark, sf_dir):
    df = cells.with_cell(_line_with_price(spark, sf_dir), list(LINE), 3)
    return df.select("l_orderkey", "l_linenumber", "price", *_cell_columns(4))


@query
def cell_stats_d3(spark, sf_dir):
    return cells.cell_stats(_line(spark, sf_dir), list(LINE), 3).select(*_cell_columns(4), "n", *_mean_columns(4))


@query
def cell_rollup_d1_d6(spark, sf_dir):
    tree = cells.levels(_line(spark, sf_dir), list(LINE), 6)
    return tree.select("depth", *_cell_columns(4), "n", *_mean_columns(4))


@query
def cell_stats_customer_bounds(spark, sf_dir):
    stats = cells.cell_stats(_table(spark, sf_dir, "customer"), ["c_acctbal"], 5, bounds=(-1000.0, 10000.0))
    return stats.select(*_cell_columns(1), "n", *_mean_columns(1))


@query
def cell_geometry_own_box(spark, sf_dir):
    """Cells of unscaled columns in the box of their own ranges."""
    customer = _table(spark, sf_dir, "customer")
    bounds = cells.data_bounds(customer, CUSTOMER)
    stats = cells.geometry(cells.cell_stats(customer, CUSTOMER, 4, bounds), 2, bounds)
    ends = [_r(F.get(name, F.lit(j)), 9).alias(f"{name}{j}") for name in ("lo", "hi", "threshold") for j in range(2)]
    return stats.select(*_cell_columns(2), "n", *_mean_columns(2), *ends)


@query
def cell_geometry_d2(spark, sf_dir):
    part = prepare.to_unit_box(_table(spark, sf_dir, "part").select("p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    stats = cells.geometry(cells.cell_stats(part, ["p_size", "p_retailprice"], 2), 2)
    box = [F.get(name, F.lit(j)).alias(f"{name}{j}") for name in ("lo", "hi", "threshold") for j in range(2)]
    return stats.select(*_cell_columns(2), "n", *box)


@query
def hypercube_bits(spark, sf_dir):
    df = cells.with_cell(_line(spark, sf_dir), list(LINE), 2)
    return df.groupBy(cells.hypercube_id(F.col("cell"), 4).alias("hypercube")).agg(F.count(F.lit(1)).alias("n"))


@query
def cell_ordinals_d2(spark, sf_dir):
    """Every row labelled by the position of its cell in the tree."""
    df = cells.with_cell_ordinal(_line_with_price(spark, sf_dir), list(LINE), 2)
    return df.select("l_orderkey", "l_linenumber", "price", "ordinal")


@query
def instance_ratio_by_depth(spark, sf_dir):
    ratio = cells.instance_ratio_by_depth(cells.levels(_line(spark, sf_dir), list(LINE), 6))
    return ratio.select("depth", "n_cells", "n_rows", _r("instance_ratio", 9).alias("instance_ratio"))


@query
def first_depth_ge_k(spark, sf_dir):
    """The first level of lineitem with 100 cells, in the scaled box and in one that outliers have set."""
    line, wide = _line(spark, sf_dir), F.col("l_quantity") * F.lit(2.0**-36)
    crowded = _line(spark, sf_dir, "l_orderkey").withColumn(
        "l_quantity", F.when(F.col("l_orderkey") % 64 == 0, F.col("l_quantity")).otherwise(wide)).select("l_quantity", "l_extendedprice")
    crowded = crowded.withColumn("l_extendedprice", F.col("l_extendedprice") * F.lit(2.0**-40))
    rows = []
    for name, df, features, count in (("line", line, list(LINE), 100), ("crowded", crowded, ["l_quantity", "l_extendedprice"], 2000)):
        store = cells.CellLevels(df, features)
        try:
            depth = store.first_with(count)
            rows.append((name, depth, store.cells.get(depth)))
        finally:
            store.drop()
    return spark.createDataFrame(rows, "box string, depth int, n_cells bigint")


@query
def seed_cells_hash(spark, sf_dir):
    store = cells.CellLevels(_line(spark, sf_dir), list(LINE))
    try:
        store.require(2)
        seeds = RecursiveKMeans(nClusters=5, seed=SEED)._seed_centers(store, 2, 5)
    finally:
        store.drop()
    return _centers_frame(spark, seeds)


# ---------------------------------------------------------------- Lloyd and the recursive fit

@query
def assign_fixed_centers(spark, sf_dir):
    df = lloyd.assign(_line_with_price(spark, sf_dir), list(LINE), LINE_CENTERS, distance="d2")
    return df.select("l_orderkey", "l_linenumber", "price", "prediction", _r("d2").alias("d2"))


@query
def assign_embeddings_arrow(spark, sf_dir):
    """Wide vectors and many centres: the Arrow path, straight from the array column."""
    e = _table(spark, sf_dir, "embeddings")
    centers = [[((k * 7 + j * 3) % 11 - 5) / 40.0 for j in range(64)] for k in range(8)]
    return lloyd.assign(e, "embedding", centers, distance="d2").select("vec_id", "prediction", _r("d2").alias("d2"))


@query
def row_norms(spark, sf_dir):
    df = _embedding(spark, sf_dir)
    xs = feature_columns(df, EMBEDDING_COLUMNS)
    return df.select("vec_id", _r(euclidean_norm(xs, EMBEDDING_CENTERS[0])).alias("norm"))


@query
def sse_fixed_centers(spark, sf_dir):
    return _one(spark, "sse", metrics.sse(_line(spark, sf_dir), list(LINE), LINE_CENTERS))


@query
def lloyd_steps_3(spark, sf_dir):
    model = baselines.lloyd_from(_line(spark, sf_dir), list(LINE), LINE_CENTERS, max_iter=3, tol=0.0)
    return _centers_frame(spark, model.centers)


@query
def weighted_lloyd_cells_2(spark, sf_dir):
    store = cells.CellLevels(_line(spark, sf_dir), list(LINE))
    try:
        store.require(3)
        result = lloyd.weighted_lloyd(
            store.points(3), LINE_CENTERS, max_iter=2, tol=0.0, n_rows=store.cells[3], variance=store.variance[3])
    finally:
        store.drop()
    return _centers_frame(spark, result.centers)


def _two_levels(spark, sf_dir):
    return RecursiveKMeans(
        inputCols=list(LINE), nClusters=5, maxIter=2, lloydMaxIter=2, lloydTol=0.0,
        init=[list(c) for c in LINE_CENTERS]).fit(_line(spark, sf_dir))


@query
def recursive_fit_2_levels(spark, sf_dir):
    model = _two_levels(spark, sf_dir)
    facts = model.history.select(
        "iteration", "depth", "n_cells", "distances", _r("instance_ratio", 9).alias("instance_ratio"),
        F.posexplode("centers").alias("k", "c"))
    return facts.select(
        "iteration", "depth", "n_cells", "distances", "instance_ratio", "k",
        *[_r(F.get("c", F.lit(j))).alias(f"c{j}") for j in range(4)])


@query
def recursive_fit_own_box(spark, sf_dir):
    """Three levels over unscaled columns, two Lloyd steps each, in the box of their own ranges."""
    model = RecursiveKMeans(
        inputCols=list(CUSTOMER), nClusters=2, maxIter=3, lloydMaxIter=2, lloydTol=0.0, bounds="auto",
        init=[list(c) for c in CUSTOMER_CENTERS]).fit(_table(spark, sf_dir, "customer"))
    levels = model.history.select("iteration", "depth", "n_cells", F.posexplode("centers").alias("k", "c"))
    return levels.select("iteration", "depth", "n_cells", "k", *[_r(F.get("c", F.lit(j))).alias(f"c{j}") for j in range(2)])


@query
def center_trajectory(spark, sf_dir):
    moved = _two_levels(spark, sf_dir).trajectory()
    gap = F.aggregate(F.zip_with("start", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    return moved.groupBy("iteration").agg(_r(F.max(F.sqrt(gap))).alias("max_shift"))


@query
def labels_by_level(spark, sf_dir):
    data = _line(spark, sf_dir)
    labelled = _two_levels(spark, sf_dir).label_levels(data)
    return labelled.groupBy("level1", "level2").agg(F.count(F.lit(1)).alias("n"))


@query
def recursive_fit_summary(spark, sf_dir):
    """Free-running fit; Lloyd iterates to convergence, so only its invariants can be compared."""
    model = RecursiveKMeans(inputCols=list(LINE), nClusters=9, maxIter=6, seed=SEED).fit(_line(spark, sf_dir))
    return model.history.select("iteration", "depth", "n_cells", "instance_ratio", "lloyd_iterations", "distances")


@query
def recursive_instance_ratio(spark, sf_dir):
    """Instance ratio of the fits with 1 to 6 levels, for two K, two d, and N of half and all rows."""
    make = sweep.table_maker(_line(spark, sf_dir, *LINE_IDS), list(LINE), list(LINE_IDS), method="md5")
    n = _table(spark, sf_dir, "lineitem").count()
    grid = sweep.Grid(n_clusters=RATIO_CLUSTERS, n_dims=[2, len(LINE)], n_samples=[n // 2, n], replicas=1, parallel=4)
    return sweep.ratio_sweep(spark, make, grid).select(
        "n_clusters", "n_dims", "n_samples", "param", _r("instance_ratio", 9).alias("instance_ratio"))


@query
def recursive_score(spark, sf_dir):
    """Accuracy of raw cluster indexes against a label, with fixed centres and one Lloyd step."""
    df = _line(spark, sf_dir, "l_linenumber")
    model = RecursiveKMeans(inputCols=list(LINE), nClusters=5, maxIter=1, lloydMaxIter=1, lloydTol=0.0,
                            init=[list(c) for c in LINE_CENTERS]).fit(df)
    return _one(spark, "score", model.score(df, "l_linenumber"))


# ---------------------------------------------------------------- comparators

@query
def kmeanspp_seed(spark, sf_dir):
    with baselines._points(_table(spark, sf_dir, "embeddings"), "embedding", ["vec_id"], SEED, "md5") as (points, scratch):
        seeds = baselines.kmeans_pp_seed(points, 5, scratch, "md5")
    return _centers_frame(spark, seeds)


@query
def kmeanspp_fit(spark, sf_dir):
    model = baselines.kmeans_pp(_line_with_price(spark, sf_dir), list(LINE), 5,
                                ["l_orderkey", "l_linenumber", "price"], seed=SEED, method="md5")
    return _centers_frame(spark, model.centers)


@query
def kmeanspp_two_steps(spark, sf_dir):
    """k-means++ seeds followed by two Lloyd steps."""
    e = _embedding(spark, sf_dir)
    model = baselines.kmeans_pp(e, EMBEDDING_COLUMNS, 5, ["vec_id"], seed=SEED, max_iter=2, tol=0.0, method="md5")
    return _centers_frame(spark, model.centers)


@query
def minibatch_three_batches(spark, sf_dir):
    """One pass over the rows in three batches from fixed centres."""
    e = _embedding(spark, sf_dir)
    model = baselines.mini_batch_kmeans(
        e, EMBEDDING_COLUMNS, 5, -(-e.count() // 3), ["vec_id"], seed=SEED, max_epochs=1,
        init=EMBEDDING_CENTERS, method="md5")
    return _centers_frame(spark, model.centers)


@query
def minibatch_fit(spark, sf_dir):
    model = baselines.mini_batch_kmeans(_line_with_price(spark, sf_dir), list(LINE), 5, 500,
                                        ["l_orderkey", "l_linenumber", "price"], seed=SEED, method="md5")
    return _centers_frame(spark, model.centers)


@query
def distance_cost_grid(spark, sf_dir):
    """Cost formulas over a grid: K and batch size lists times the row count of every nation."""
    sizes = _table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    grid = sizes.withColumn("k", F.explode(F.array(F.lit(3), F.lit(9)))).withColumn(
        "b", F.explode(F.array(F.lit(100), F.lit(500), F.lit(1000))))
    steps = F.lit(10)
    return grid.select(
        "c_nationkey", "k", "b", "n",
        measures.kmeans_pp_distances(F.col("k"), F.col("n"), steps).cast("double").alias("kmeans_pp"),
        measures.mini_batch_distances(F.col("k"), F.col("n"), F.col("b"), steps).cast("double").alias("mini_batch"))


# ---------------------------------------------------------------- preparation

def _scaled(spark, sf_dir, method):
    df = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.lit(3.5).alias("constant"))
    model = prepare.Preparer(scale=method, ids=["c_custkey"]).fit(df)
    return model.transform(df).select("c_custkey", _r("c_acctbal").alias("c_acctbal"), _r("constant").alias("constant"))


@query
def minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, "min-max")


@query
def zscore_pop(spark, sf_dir):
    return _scaled(spark, sf_dir, "standardisation")


@query
def zscore_mean_alias(spark, sf_dir):
    return _scaled(spark, sf_dir, "mean")


@query
def sign_unit(spark, sf_dir):
    return _scaled(spark, sf_dir, "unit")


@query
def maxabs(spark, sf_dir):
    df = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return mixture.max_abs_scaled(df, ["c_acctbal"]).select("c_custkey", _r("c_acctbal").alias("c_acctbal"))


@query
def label_encode(spark, sf_dir):
    df = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return prepare.Preparer(scale="none", ids=["o_orderkey"]).fit(df).transform(df).select(
        "o_orderkey", F.col("o_orderpriority").cast("int").alias("o_orderpriority"),
        F.col("o_orderstatus").cast("int").alias("o_orderstatus"))


@query
def encoder_mapping(spark, sf_dir):
    df = _table(spark, sf_dir, "part").select("p_brand", "p_type")
    return prepare.Preparer(scale="none").fit(df).mapping()


@query
def target_encode(spark, sf_dir):
    df = _table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    model = prepare.Preparer(scale="none", target="p_size", ids=["p_partkey"]).fit(df)
    return model.transform(df).select("p_partkey", "p_size", F.lit(model.n_targets).cast("bigint").alias("n_targets"))


@query
def one_hot(spark, sf_dir):
    df = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return prepare.Preparer(categorical="onehot", scale="none", ids=["c_custkey"]).fit(df).transform(df)


def _with_gaps(spark, sf_dir):
    gap = F.when(F.col("o_orderkey") % 17 == 0, F.lit("?")).otherwise(F.col("o_orderpriority"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", gap.alias("priority"), "o_totalprice")


def _imputed(spark, sf_dir, method, **options):
    df = _with_gaps(spark, sf_dir)
    plan = prepare.Preparer(scale="none", impute=method, ids=["o_orderkey"], seed=SEED, hash_method="md5", **options)
    return plan.fit(df).transform(df).select("o_orderkey", _r(F.col("priority").cast("double"), 4).alias("priority"))


@query
def impute_mode(spark, sf_dir):
    return _imputed(spark, sf_dir, "most_frequent")


@query
def impute_median(spark, sf_dir):
    return _imputed(spark, sf_dir, "median")


@query
def impute_mean(spark, sf_dir):
    return _imputed(spark, sf_dir, "mean")


@query
def impute_constant(spark, sf_dir):
    return _imputed(spark, sf_dir, "constant", fill_value=-1.0)


@query
def impute_random(spark, sf_dir):
    return _imputed(spark, sf_dir, "random")


@query
def impute_linear(spark, sf_dir):
    return _imputed(spark, sf_dir, "linear_regression")


@query
def impute_logistic(spark, sf_dir):
    return _imputed(spark, sf_dir, "logistic_regression")


@query
def logistic_optimality(spark, sf_dir):
    """Class counts and sums of the price per order under the fitted probabilities: those of the data at the optimum."""
    df = _with_gaps(spark, sf_dir)
    plan = prepare.Preparer(scale="min-max", impute="logistic_regression", ids=["o_orderkey"], seed=SEED, hash_method="md5")
    found = plan.fit(df).logistic_moments(df)
    return found.where("observed > 0").select(
        "column", "code", "feature",
        *[F.when(F.col("feature") == "intercept", _r(c, 3)).otherwise(_r(c, -2)).alias(c) for c in ("observed", "predicted")])


@query
def prepare_pipeline(spark, sf_dir):
    """Encode, impute by mode, min-max scale, encode the target: the default order of the steps."""
    df = _with_gaps(spark, sf_dir).join(
        _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")
    model = prepare.Preparer(target="o_orderstatus", ids=["o_orderkey"]).fit(df)
    return model.transform(df).select(
        "o_orderkey", _r("priority").alias("priority"), _r("o_totalprice").alias("o_totalprice"), "o_orderstatus")


@query
def scale_mixed_columns(spark, sf_dir):
    df = _table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    model = prepare.Preparer(ids=["p_partkey"]).fit(df)
    return model.transform(df).select(
        "p_partkey", *[_r(c).alias(c) for c in ("p_brand", "p_type", "p_size")])


# ---------------------------------------------------------------- sampling and projection

@query
def sample_rows_exact(spark, sf_dir):
    df = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_rows(df, LARGE_SAMPLE, ["o_orderkey"], seed=SEED, method="md5")


@query
def sample_rows_small(spark, sf_dir):
    df = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_rows(df, SMALL_SAMPLE, ["o_orderkey"], seed=SEED, method="md5")


@query
def sample_columns(spark, sf_dir):
    df = _table(spark, sf_dir, "customer")
    names = sampling.sample_columns(df, 2, seed=SEED, among=["c_nationkey", "c_acctbal", "c_mktsegment"]).columns
    return df.select("c_custkey", *sorted(names))


@query
def drop_columns(spark, sf_dir):
    return tables.drop_columns(_table(spark, sf_dir, "supplier"), ["s_name", "s_nationkey"])


@query
def summary_stats(spark, sf_dir):
    stats = report.summary_stats(_table(spark, sf_dir, "lineitem"), list(LINE))
    return stats.select("column", "count", _r("mean").alias("mean"), _r("std").alias("std"), "min",
                        *[_r(c).alias(c) for c in ("q25", "q50", "q75")], "max")


# ---------------------------------------------------------------- metrics

@query
def calinski_harabasz(spark, sf_dir):
    return _one(spark, "calinski_harabasz",
                metrics.calinski_harabasz(_table(spark, sf_dir, "embeddings"), "embedding", "label"))


@query
def davies_bouldin(spark, sf_dir):
    return _one(spark, "davies_bouldin",
                metrics.davies_bouldin(_table(spark, sf_dir, "embeddings"), "embedding", "label"))


@query
def silhouette_exact(spark, sf_dir):
    return _one(spark, "silhouette",
                metrics.silhouette(_table(spark, sf_dir, "embeddings"), "embedding", "label", ["vec_id"]))


@query
def silhouette_rows(spark, sf_dir):
    rows = metrics.silhouette_samples(_table(spark, sf_dir, "embeddings"), "embedding", "label", ["vec_id"])
    return rows.select("vec_id", "label", _r("silhouette").alias("silhouette"))


@query
def silhouette_squared(spark, sf_dir):
    return _one(spark, "silhouette_sq", metrics.silhouette_sq(_labelled(spark, sf_dir), EMBEDDING_COLUMNS, "prediction"))


@query
def contingency(spark, sf_dir):
    return metrics.contingency(_labelled(spark, sf_dir), "label", "prediction")


@query
def contingency_labels(spark, sf_dir):
    return metrics.contingency(_table(spark, sf_dir, "labels"), "quality", "toxic")


@query
def ari(spark, sf_dir):
    return _one(spark, "ari", metrics.adjusted_rand(_labelled(spark, sf_dir), "label", "prediction"))


@query
def nmi(spark, sf_dir):
    return _one(spark, "nmi", metrics.normalized_mutual_info(_labelled(spark, sf_dir), "label", "prediction"))


@query
def ami(spark, sf_dir):
    return _one(spark, "ami", metrics.adjusted_mutual_info(_labelled(spark, sf_dir), "label", "prediction"))


@query
def ami_lineitem(spark, sf_dir):
    """Agreement of two fixed assignments over all lineitem rows: large margins."""
    both = lloyd.assign(lloyd.assign(_line(spark, sf_dir), list(LINE), LINE_CENTERS), list(LINE), LINE_OTHER, "other")
    values = metrics.agreement(both, "prediction", "other")
    return spark.createDataFrame([tuple(round(v, 6) for v in values.values())], "ami double, ari double, nmi double")


@query
def accuracy(spark, sf_dir):
    return _one(spark, "accuracy", metrics.accuracy(_labelled(spark, sf_dir), "label", "prediction"))


@query
def std_error(spark, sf_dir):
    return _one(spark, "std_error", metrics.std_error_of(_line(spark, sf_dir), list(LINE), LINE_CENTERS, LINE_OTHER))


@query
def ideal_centers(spark, sf_dir):
    means = metrics.label_means(_embedding(spark, sf_dir), EMBEDDING_COLUMNS, "label")
    return means.select("label", "n", *[_r(f"m{j}").alias(f"m{j}") for j in range(EMBEDDING_DIMS)])


# ---------------------------------------------------------------- result tables

def _results(spark, sf_dir) -> DataFrame:
    """A result table in the layout of the sweeps, derived from lineitem."""
    li = _table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_linenumber").alias("n_clusters"),
        F.pmod("l_partkey", F.lit(2)).cast("int").alias("n_dims"),
        F.pmod("l_orderkey", F.lit(3)).cast("int").alias("n_samples"),
        F.when(F.col("l_returnflag") == "A", "k-means++").otherwise("recursive").alias("algorithm"),
        F.when(F.col("l_returnflag") != "A", F.month("l_shipdate") % 6 + 1).cast("int").alias("param"),
        F.pmod("l_suppkey", F.lit(4)).cast("int").alias("replica"),
    ).agg(F.avg(F.sqrt("l_discount")).alias("silhouette"), F.avg(F.sqrt("l_extendedprice")).alias("calinski_harabasz"),
          F.avg(F.sqrt("l_tax")).alias("davies_bouldin"))


@query
def average_replicas(spark, sf_dir):
    mean = report.average_replicas(_results(spark, sf_dir))
    return mean.select(*report.RESULT_KEYS, *[_r(c).alias(c) for c in sweep.QUALITY_COLUMNS])


@query
def relative_error_table(spark, sf_dir):
    mean = report.average_replicas(_results(spark, sf_dir))
    table = report.relative_table(mean, sweep.QUALITY_COLUMNS, "k-means++", "recursive",
                                  params=[str(m) for m in sweep.LEVEL_COUNTS])
    return table.select("metric", *[_r(F.col(f"`{m}`")).alias(f"m{m}") for m in sweep.LEVEL_COUNTS])


@query
def plot_series(spark, sf_dir):
    mean = report.average_replicas(_results(spark, sf_dir))
    panel = report.series(mean, "n_samples", "calinski_harabasz", ["algorithm", "param"], {"n_clusters": 3, "n_dims": 1})
    return panel.select("algorithm", "param", "x", _r("y").alias("y"))


@query
def result_panels(spark, sf_dir):
    return report.panels(_results(spark, sf_dir), ["n_clusters", "n_dims"])


# ---------------------------------------------------------------- generator

@query
def gaussian_mixture_rows(spark, sf_dir):
    """One mixture row per order."""
    df = mixture.gaussian_mixture(
        _table(spark, sf_dir, "orders"), 3, 2, seed=SEED, id_col="o_orderkey", centers=MIXTURE_CENTERS,
        sigma=MIXTURE_SIGMA, method="md5")
    return df.select("id", _r("x0").alias("x0"), _r("x1").alias("x1"), "y")


@query
def gaussian_mixture_counts(spark, sf_dir):
    df = mixture.gaussian_mixture(_table(spark, sf_dir, "orders"), 4, 2, seed=SEED, id_col="o_orderkey", method="md5")
    return df.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- sources and sinks

@query
def csv_round_trip(spark, sf_dir):
    scratch = Scratch(spark)
    gaps = _table(spark, sf_dir, "customer").withColumn("c_acctbal", F.expr("if(c_custkey % 5 > 0, c_acctbal, null)"))
    gaps.write.option("header", True).option("nullValue", "NA").csv(f"{scratch.path}/customer.csv")
    return tables.read_csv(spark, f"{scratch.path}/customer.csv").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query
def supervised_view(spark, sf_dir):
    x, y, name = tables.supervised_view(_table(spark, sf_dir, "part"))
    return y.agg(F.count(F.lit(1)).alias("rows"), _r(F.sum(name)).alias("total")).withColumn(
        "features", F.lit(len(x.columns)).cast("bigint")).withColumn("target", F.lit(name))


@query
def arff_round_trip(spark, sf_dir):
    """Orders written as ARFF parts - comment, attribute lines, data mark, CSV body - and read back."""
    scratch = Scratch(spark)
    names = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    body = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), F.concat_ws(",", *names).alias("line")).repartition(3, "o_orderkey")
    head = ["% orders", "@RELATION orders", *[f"@ATTRIBUTE {n} whatever" for n in names], "@DATA"]
    marks = F.array(*[F.lit(h) for h in head])
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0
    lines = body.select(F.explode(F.when(first, F.concat(marks, F.array("line"))).otherwise(F.array("line"))).alias("value"))
    lines.write.text(f"{scratch.path}/orders.arff")
    df = text.read_arff(spark, f"{scratch.path}/orders.arff")
    return df.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_totalprice", "o_orderpriority")


def _sensor_logs(spark, sf_dir, only=None) -> DataFrame:
    """Embeddings as sensor lines, four of 16 values each."""
    rows = _table(spark, sf_dir, "embeddings")
    parts = (rows.where(only) if only else rows).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(3))))
    values = [F.col("vec_id").cast("string"), F.col("label").cast("string"), F.col("part").cast("string")]
    values += [F.get("embedding", F.col("part") * 16 + j).cast("double").cast("string") for j in range(16)]
    return parts.select(F.concat_ws("   ", *values).alias("line"))


def _write_log(lines: DataFrame, header: str, path: str) -> None:
    lines.toDF(header).write.option("header", True).option("sep", "\u0001").option("quote", "").option("extension", "txt").csv(path)


@query
def sensor_text_round_trip(spark, sf_dir):
    """Embeddings written as sensor logs with a header in every file, and read back."""
    path = f"{Scratch(spark).path}/log.txt"
    _write_log(_sensor_logs(spark, sf_dir), "Time (seconds), Methane conc (ppm), Ethylene conc (ppm), sensor readings", path)
    df = text.read_sensor_text(spark, path)
    return df.select(*[_r(c).alias(c.split("_")[0].lower()) for c in df.columns])


@query
def sensor_own_headers(spark, sf_dir):
    """Logs of one folder under two headers: each table has the names of its own files."""
    path = f"{Scratch(spark).path}/logs"
    for i, gas in enumerate(("Methane", "CO")):
        _write_log(_sensor_logs(spark, sf_dir, f"vec_id % 2 = {i}"), f"Time (seconds), {gas} conc (ppm), Ethylene conc (ppm), rest", f"{path}/{i}.txt")
    tables_found = text.read_sensor_tables(spark, path)
    both = [df.select(F.lit(names[1]).alias("second"), *[_r(c).alias(n) for c, n in zip(
        df.columns, ("time", "gas", "ethylene", *df.columns[3:]))]) for names, df in tables_found.items()]
    return reduce(DataFrame.unionByName, both)


@query
def result_sink(spark, sf_dir):
    """Averaged results written as CSV with ``None`` for nulls, and read back."""
    scratch = Scratch(spark)
    mean = _results(spark, sf_dir).groupBy("n_clusters", "algorithm", "param").agg(_r(F.avg("silhouette")).alias("silhouette"))
    tables.write_results(mean, f"{scratch.path}/results_agg.csv")
    return tables.read_results(spark, f"{scratch.path}/results_agg.csv", mean.schema)


# ---------------------------------------------------------------- sweeps

def _line_maker(spark, sf_dir):
    data = _line_with_price(spark, sf_dir)
    return sweep.table_maker(data, list(LINE), ["l_orderkey", "l_linenumber", "price"])


def _grid(df: DataFrame, dims, **options):
    """Several K, d and N up to the whole table, all level counts and batch sizes, two replicas."""
    n = df.count()
    return sweep.Grid(n_clusters=[3, 9], n_dims=dims, n_samples=[n // 2, n], replicas=2, parallel=4, **options)


def _line_grid(spark, sf_dir, **options):
    return _grid(_table(spark, sf_dir, "lineitem"), [2, len(LINE)], **options)


@query
def distance_sweep_table(spark, sf_dir):
    results = sweep.distance_sweep(spark, _line_maker(spark, sf_dir), _line_grid(spark, sf_dir))
    return report.average_replicas(results).drop("fit_time_average")


@query
def error_sweep_table(spark, sf_dir):
    return report.average_replicas(sweep.error_sweep(spark, _line_maker(spark, sf_dir), _line_grid(spark, sf_dir)))


@query
def equivalence_sweep_table(spark, sf_dir):
    return report.average_replicas(
        sweep.equivalence_sweep(spark, _line_maker(spark, sf_dir), _line_grid(spark, sf_dir)))


@query
def quality_sweep_table(spark, sf_dir):
    """Internal metrics of all algorithms over the embeddings, in a few and in all of their dimensions."""
    data = _embedding(spark, sf_dir)
    maker = sweep.table_maker(data, EMBEDDING_COLUMNS, ["vec_id"])
    return report.average_replicas(sweep.quality_sweep(spark, maker, _grid(data, [4, EMBEDDING_DIMS])))


@query
def dataset_sweep(spark, sf_dir):
    """A folder of labelled CSVs with different columns - suppliers, customers, parts - compared with k-means++ in
    all twelve columns, two replicas each."""
    folder = f"{Scratch(spark).path}/datasets"
    for name, columns, key in (("supplier", ["s_acctbal", "s_nationkey"], "s_suppkey"),
                               ("customer", ["c_acctbal", "c_nationkey", "c_mktsegment"], "c_custkey"),
                               ("part", ["p_size", "p_retailprice"], "p_partkey")):
        rows = _table(spark, sf_dir, name).select(*columns, F.pmod(key, F.lit(3)).alias("target"))
        rows.write.option("header", True).csv(f"{folder}/{name}.csv")
    return sweep.dataset_sweep(spark, folder)


# ---------------------------------------------------------------- streaming

def _drain(writer) -> None:
    stream = writer.trigger(availableNow=True).start()
    stream.awaitTermination()


@query
def stream_scores(spark, sf_dir):
    scratch = Scratch(spark)
    schema = _table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    scored = score_stream(events, ["value"], EVENT_CENTERS).select("event_id", "prediction")
    _drain(scored.writeStream.format("parquet").option("path", f"{scratch.path}/scores").option(
        "checkpointLocation", f"{scratch.path}/progress"))
    return spark.read.parquet(f"{scratch.path}/scores")


@query
def stream_cells(spark, sf_dir):
    scratch = Scratch(spark)
    schema = _table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    sketch = cell_stream(events, ["value"], 4, bounds=(0.0, 100.0)).select(*_cell_columns(1), "n", *_mean_columns(1))
    _drain(sketch.writeStream.outputMode("complete").option("checkpointLocation", f"{scratch.path}/progress").foreachBatch(
        lambda batch, _: batch.write.mode("overwrite").parquet(f"{scratch.path}/cells")))
    return spark.read.parquet(f"{scratch.path}/cells")
