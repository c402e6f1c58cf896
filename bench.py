"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm the JVM up and is then timed; the result is consumed in full.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gridlloyd import RecursiveKMeans  # noqa: E402
from gridlloyd.operators import baselines, cells, lloyd, metrics, prepare, sampling  # noqa: E402
from gridlloyd.plans.queries import LINE, LINE_CENTERS, LINE_OTHER  # noqa: E402
from gridlloyd.sources.mixture import gaussian_mixture  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("gridlloyd-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    n = raw.count()
    line = prepare.to_unit_box(raw, LINE)
    two, four = list(LINE[:2]), list(LINE)
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    blobs = gaussian_mixture(spark, 3, 2, n, seed=1).persist()
    blobs8 = gaussian_mixture(spark, 9, 8, n, seed=1).persist()
    blobs.count(), blobs8.count()

    def fit(df, features, k, m):
        model = RecursiveKMeans(inputCols=features, nClusters=k, maxIter=m, seed=1).fit(df)
        notes.append((k, len(features), m, model.summary))

    x2, x8 = ["x0", "x1"], [f"x{j}" for j in range(8)]
    notes = []
    queries = {
        "cells_d6": lambda: consume(cells.levels(line, four, 6)),
        "assign_k5": lambda: consume(lloyd.assign(line.select(*four), four, LINE_CENTERS)),
        "lloyd_step": lambda: baselines.lloyd_from(line, four, LINE_CENTERS, max_iter=1),
        "recursive_line_k3_d2_m6": lambda: fit(line, two, 3, 6),
        "recursive_line_k9_d4_m6": lambda: fit(line, four, 9, 6),
        "recursive_mixture_k3_d2_m1": lambda: fit(blobs, x2, 3, 1),
        "recursive_mixture_k3_d2_m6": lambda: fit(blobs, x2, 3, 6),
        "recursive_mixture_k9_d8_m6": lambda: fit(blobs8, x8, 9, 6),
        "kmeanspp_mixture_k3_d2": lambda: baselines.kmeans_pp(blobs, x2, 3, ["id"]),
        "kmeanspp_mixture_k9_d8": lambda: baselines.kmeans_pp(blobs8, x8, 9, ["id"]),
        "minibatch_mixture_k3_d2_b1000": lambda: baselines.mini_batch_kmeans(blobs, x2, 3, 1000, ["id"]),
        "minibatch_mixture_k9_d8_b1000": lambda: baselines.mini_batch_kmeans(blobs8, x8, 9, 1000, ["id"]),
        "sample_rows": lambda: consume(sampling.sample_rows(raw.select(*ids), n // 2, ids)),
        "prepare": lambda: consume(prepare.Preparer(ids=["l_orderkey"], target="l_linestatus").fit(
            raw.select("l_orderkey", "l_returnflag", *LINE, "l_linestatus")).transform(raw)),
        "internal_metrics": lambda: [
            metrics.calinski_harabasz(blobs, x2, "y"), metrics.davies_bouldin(blobs, x2, "y")],
        "agreement": lambda: metrics.agreement(
            lloyd.assign(lloyd.assign(line, four, LINE_CENTERS), four, LINE_OTHER, "other"), "prediction", "other"),
    }
    only = sys.argv[1:]
    seconds = {}
    for name, run in queries.items():
        if only and name not in only:
            continue
        run()
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], notes[-1] if notes and name.startswith("recursive") else "", file=sys.stderr)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "rows": n}))
    spark.stop()


if __name__ == "__main__":
    main()
