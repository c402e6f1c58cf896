"""Cluster quality: internal metrics, agreement between two labelings, and relative errors.

Rows are only ever aggregated (per cluster, per label pair); what reaches the driver is a handful of
scalars.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from ..functions.vectors import feature_columns
from .blocks import add_distances, expected_mutual_information, widest_ratio
from .joins import lookup
from .lloyd import as_centers, assign

#: Fewest rows that make a group, and rows per batch that a pair of groups returns.
SILHOUETTE_BLOCK_ROWS = 4096
#: Bytes of raw doubles in a group of rows that is compared with other groups in one task, and its rows at most.
GROUP_BYTES, GROUP_ROWS = 64 * 1024 * 1024, 40_000
#: Most tasks for pairs of groups.
PAIR_TASKS = 4000
#: Labels whose sums a task holds at once.
LABELS_AT_ONCE = 32
#: Widest vectors whose statistics are unrolled into one expression per dimension.
UNROLLED_DIMS = 16


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


# ---------------------------------------------------------------- internal metrics

def sse(df: DataFrame, features, centers) -> float:
    """Clustering error: sum over rows of the squared distance to the nearest centre.

    A row with a null, NaN or infinite feature is an error.
    """
    labelled = assign(df.select(*_names(features)), features, centers, "__k", "__d2")
    total, bad = labelled.agg(F.sum("__d2"), F.count_if(F.col("__d2").isNull())).first()
    if bad:
        raise ValueError("features contain null, NaN or infinite values")
    return total


def label_means(df: DataFrame, features, label: str) -> DataFrame:
    """(label, n, m0..): the ideal centre of every label."""
    xs = feature_columns(df, features)
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m{j}") for j, x in enumerate(xs)])


def _profile(df: DataFrame, features, label: str) -> tuple[DataFrame, int]:
    """(label, n, mean, within): per-cluster mean vector and within sum of squares, from running
    variances. Wide vectors go through one vector aggregate instead of two per dimension."""
    xs = feature_columns(df, features)
    grouped, n = df.groupBy(F.col(label).alias("label")), F.count(F.lit(1))
    if len(xs) <= UNROLLED_DIMS:
        spread = sum((F.var_pop(x) for x in xs[1:]), F.var_pop(xs[0]))
        return grouped.agg(n.alias("n"), F.array(*[F.avg(x) for x in xs]).alias("mean"), (n * spread).alias("within")), len(xs)
    summary = Summarizer.metrics("mean", "variance").summary(array_to_vector(F.array(*xs)))
    spread = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda total, v: total + v)
    return grouped.agg(n.alias("n"), summary.alias("s")).select(
        "label", "n", vector_to_array("s.mean").alias("mean"), ((F.col("n") - 1) * spread).alias("within")), len(xs)


def _gap(a: Column, b: Column) -> Column:
    """Squared distance between two array columns."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, v: total + v)


def calinski_harabasz(df: DataFrame, features, label: str) -> float:
    """Between- over within-cluster dispersion, each per degree of freedom."""
    profile, d = _profile(df, features, label)
    with _kept(profile) as p:
        weighted = Summarizer.mean(array_to_vector("mean"), F.col("n").cast("double"))
        total = p.agg(
            F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("within").alias("within"),
            vector_to_array(weighted).alias("mean")).first()
        k, n = total["k"], total["n"]
        if not 2 <= k < n:
            raise ValueError(f"needs 2 to n - 1 clusters, found {k} for {n} rows")
        between = p.agg(F.sum(F.col("n") * _gap(F.col("mean"), F.lit(list(total["mean"]))))).first()[0]
    if total["within"] == 0:
        return 1.0
    return (between / (k - 1)) / (total["within"] / (n - k))


def davies_bouldin(df: DataFrame, features, label: str) -> float:
    """Mean over clusters of the worst (spread + spread) / centre distance."""
    xs = feature_columns(df, features)
    profile, d = _profile(df, features, label)
    with _kept(profile) as p:
        k = p.count()
        if k < 2:
            raise ValueError("needs at least 2 clusters")
        rows = df.select(F.col(label).alias("label"), F.array(*xs).alias("x"))
        joined = lookup(rows.where(F.col("label").isNotNull()), p.select("label", "mean"), "label", k * (d + 9) * 8, how="inner")
        if d <= UNROLLED_DIMS:
            at = lambda name, j: F.get(F.col(name), F.lit(j))
            gap = sum(((at("x", j) - at("mean", j)) ** 2 for j in range(1, d)), (at("x", 0) - at("mean", 0)) ** 2)
        else:
            gap = _gap(F.col("x"), F.col("mean"))
        spread = joined.groupBy("label").agg(
            F.avg(F.sqrt(gap)).alias("spread"), F.first("mean").alias("mean"))
        with _kept(spread) as s:
            return _mean_worst_ratio(s, k, d)


def _mean_worst_ratio(spread: DataFrame, k: int, d: int) -> float:
    """Every centre against all others, group by group."""
    label_type = spread.schema["label"].dataType.simpleString()

    def worst(key: tuple, table: pa.Table) -> pa.Table:
        sides = pair_sides(table)
        if len(sides) == 1 and key[0].as_py() != key[1].as_py():
            return table.select(["label"]).append_column("worst", pa.array(np.zeros(table.num_rows)))
        spreads = [s.column("spread").to_numpy() for s in sides]
        means = [np.array(s.column("mean").to_pylist()).reshape(-1, d) for s in sides]
        found = [widest_ratio(spreads[i], means[i], spreads[-1 - i], means[-1 - i]) for i in range(len(sides))]
        return pa.table({"label": pa.chunked_array([c for s in sides for c in s.column("label").chunks], table.column("label").type),
                         "worst": np.concatenate(found)})

    groups = group_count(spread, k, d + 1)
    ratios = group_pairs(spread, [F.col("label")], groups).groupBy("p", "q").applyInArrow(worst, f"label {label_type}, worst double")
    return ratios.groupBy("label").agg(F.max("worst").alias("worst")).agg(F.avg("worst")).first()[0]


def group_count(df: DataFrame, rows: int, doubles_per_row: int) -> int:
    """Groups into which rows are hashed to be compared pairwise: enough that all cores have some pairs and
    that a group stays within ``GROUP_BYTES`` and ``GROUP_ROWS``."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-rows // SILHOUETTE_BLOCK_ROWS), max(
        math.ceil(math.sqrt(8 * cores)), math.ceil(rows / GROUP_ROWS), math.ceil(rows * doubles_per_row * 8 / GROUP_BYTES))))


def group_pairs(df: DataFrame, ids: Sequence[Column], groups: int) -> DataFrame:
    """Every row once for each pair (p, q), p <= q, that its group ``g`` is in."""
    mine = df.withColumn("g", F.pmod(F.xxhash64(*ids), F.lit(groups)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    return mine.withColumn("h", other).withColumns({"p": F.least("g", "h"), "q": F.greatest("g", "h")}).drop("h")


def by_pair(df: DataFrame, ids: Sequence[Column], groups: int, ordered: bool = False) -> GroupedData:
    """``group_pairs`` by pair. The work of a pair is quadratic, so pairs are spread over tasks by their number,
    not by their bytes. ``ordered`` has the rows of the smaller group of each pair come first."""
    tasks = min(PAIR_TASKS, groups * (groups + 1) // 2)
    dealt = group_pairs(df, ids, groups).repartition(tasks, "p", "q")
    return (dealt.sortWithinPartitions("p", "q", "g") if ordered else dealt).groupBy("p", "q")


def pair_sides(table: pa.Table) -> list[pa.Table]:
    """The rows of the one or two groups of a pair."""
    g = table.column("g").to_numpy()
    return [table.filter(pa.array(g == i)) for i in np.unique(g)]


def silhouette_samples(df: DataFrame, features, label: str, ids: Sequence[str]) -> DataFrame:
    """(ids.., label, silhouette) per row: exact, Euclidean, quadratic in the number of rows.

    Rows are hashed into G groups and copied G times, to every pair of groups. A task holds the first group of
    a pair, and the second streams past it in batches. A pair is compared tile by tile, each distance being
    computed once for both of its rows, and returns per row and label the sum of its distances - never the
    distances themselves. ``ids`` must identify a row.
    """
    xs = feature_columns(df, features)
    groups = group_count(df, df.count(), len(xs) + 4)
    rows = df.select(F.struct(*ids).alias("key"), F.col(label).alias("label"), F.array(*xs).alias("x"))
    key_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("key", "label"))
    layout = f"key {key_type}, own {label_type}, other {label_type}, total double, n bigint"
    schema = to_arrow_schema(StructType.fromDDL(layout))

    def sums(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, q = (k.as_py() for k in key)
        held, sides, found = [], None, []
        for batch in batches:
            mine = int((batch.column("g").to_numpy() == p).sum())
            if mine:
                if sides is not None:
                    raise RuntimeError("the rows of a pair of groups are out of order")
                held.append(batch.slice(0, mine))
            if mine == batch.num_rows or not held and sides is None:
                continue
            if sides is None:
                sides = _label_slices(pa.Table.from_batches(held))
                found, held = [_LabelTotals(a) for a in sides], []
            for b in _label_slices(pa.Table.from_batches([batch.slice(mine)])):
                for a, totals in zip(sides, found):
                    there, back = np.zeros((len(a.x), len(b.names))), np.zeros((len(b.x), len(a.names)))
                    add_distances(a.x, b.x, a.member, b.member, there, back)
                    yield from totals.add(b, there, schema)
                    yield from b.sums(a, back, schema)
        for totals in found:
            yield from totals.flush(schema)
        if p != q or not held:
            return
        sides, held = _label_slices(pa.Table.from_batches(held)), []
        for i, a in enumerate(sides):
            total = np.zeros((len(a.x), len(a.names)))
            add_distances(a.x, None, a.member, None, total, None)
            yield from a.sums(a, total, schema)
            for b in sides[i + 1:]:
                there, back = np.zeros((len(a.x), len(b.names))), np.zeros((len(b.x), len(a.names)))
                add_distances(a.x, b.x, a.member, b.member, there, back)
                yield from a.sums(b, there, schema)
                yield from b.sums(a, back, schema)

    per_label = (
        by_pair(rows, [F.col(f"key.{c}") for c in ids], groups, ordered=True).applyInArrow(sums, layout)
        .groupBy("key", "own", "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    mine = F.col("own") == F.col("other")
    per_row = per_label.groupBy("key", "own").agg(
        F.max(F.when(mine & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("b"))
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    score = F.when(F.col("a").isNull(), F.lit(0.0)).otherwise(score)
    return per_row.select("key.*", F.col("own").alias(label), score.alias("silhouette"))


class _LabelSlice:
    """The rows of some labels: ``key`` and ``label`` columns, a matrix ``x`` and one column of ``member`` a label."""

    def __init__(self, key: pa.Array, label: pa.Array, x: np.ndarray, names: pa.Array, codes: np.ndarray):
        self.key, self.label, self.x, self.names, self.codes = key, label, x, names, codes
        self.counts = np.bincount(codes, minlength=len(names)).astype("int64")

    @property
    def member(self) -> np.ndarray:
        return (self.codes[:, None] == np.arange(len(self.names))).astype("float64")

    def sums(self, others: "_LabelSlice | _LabelTotals", totals: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row for each own row and each label of ``others``."""
        width = len(others.names)
        for i in range(0, len(totals), SILHOUETTE_BLOCK_ROWS):
            part = totals[i:i + SILHOUETTE_BLOCK_ROWS]
            row, cycle = pa.array(np.repeat(np.arange(i, i + len(part)), width)), np.tile(np.arange(width), len(part))
            columns = [self.key.take(row), self.label.take(row), others.names.take(pa.array(cycle)),
                       pa.array(part.ravel()), pa.array(others.counts[cycle])]
            yield pa.Table.from_arrays(columns, names=schema.names).cast(schema).combine_chunks().to_batches()[0]


class _LabelTotals:
    """Sums of distances of the rows of ``one`` to each label that has streamed past."""

    def __init__(self, one: _LabelSlice):
        self.one, self.found = one, {}

    def add(self, others: _LabelSlice, totals: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Keep the sums for the end, or for when there are ``LABELS_AT_ONCE`` labels."""
        for j, name in enumerate(others.names.to_pylist()):
            total, n = self.found.get(name, (0.0, 0))
            self.found[name] = total + totals[:, j], n + int(others.counts[j])
        if len(self.found) >= LABELS_AT_ONCE:
            yield from self.flush(schema)

    def flush(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.found:
            self.names = pa.array(list(self.found), schema.field("other").type)
            self.counts = np.array([n for _, n in self.found.values()], "int64")
            totals, self.found = np.stack([t for t, _ in self.found.values()], axis=1), {}
            yield from self.one.sums(self, totals, schema)


def _label_slices(side: pa.Table) -> list[_LabelSlice]:
    """The rows of a group, at most ``LABELS_AT_ONCE`` labels at a time."""
    side = side.combine_chunks()
    label = side.column("label").combine_chunks()
    coded = label.dictionary_encode()
    if coded.null_count:
        raise ValueError("a label is null")
    codes, names = coded.indices.to_numpy(), coded.dictionary
    out = []
    for first in range(0, len(names), LABELS_AT_ONCE):
        at = np.flatnonzero((codes >= first) & (codes < first + LABELS_AT_ONCE))
        own = side if len(at) == side.num_rows else side.take(pa.array(at)).combine_chunks()
        x = own.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
        out.append(_LabelSlice(own.column("key").combine_chunks(), own.column("label").combine_chunks(), x,
                               names.slice(first, LABELS_AT_ONCE), codes[at] - first))
    return out


def silhouette(df: DataFrame, features, label: str, ids: Sequence[str]) -> float:
    """Mean exact silhouette."""
    return silhouette_samples(df, features, label, ids).agg(F.avg("silhouette")).first()[0]


def silhouette_sq(df: DataFrame, features, label: str) -> float:
    """Silhouette with squared distances: linear time, but another number than ``silhouette``."""
    vectors = df.select(array_to_vector(F.array(*feature_columns(df, features))).alias("features"),
                        F.col(label).cast("double").alias("prediction"))
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(vectors)


# ---------------------------------------------------------------- agreement of two labelings

def contingency(df: DataFrame, reference: str, predicted: str) -> DataFrame:
    """(reference, predicted, n): how often each label pair occurs."""
    return df.groupBy(F.col(reference).alias("reference"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def _margins(table: DataFrame) -> DataFrame:
    """Cells (gid 0), row margins (1), column margins (2) and total (3) of a contingency table."""
    return table.cube("reference", "predicted").agg(F.sum("n").alias("n"), F.grouping_id().alias("gid"))


def _facts(margins: DataFrame) -> dict:
    n, gid = F.col("n").cast("double"), F.col("gid")
    columns = []
    for g, name in enumerate(("cells", "rows", "columns")):
        columns += [
            F.count_if(gid == g).alias(f"{name}_count"),
            F.coalesce(F.sum(F.when(gid == g, n * (n - 1) / 2)), F.lit(0.0)).alias(f"{name}_pairs"),
            F.coalesce(F.sum(F.when(gid == g, n * F.log(n))), F.lit(0.0)).alias(f"{name}_nlogn"),
        ]
    facts = margins.agg(F.max(F.when(gid == 3, F.col("n"))).alias("n"), *columns).first().asDict()
    if not facts["n"]:
        raise ValueError("cannot compare labelings of an empty table")
    total = facts["n"]
    for name in ("cells", "rows", "columns"):
        facts[f"{name}_entropy"] = math.log(total) - facts[f"{name}_nlogn"] / total
    facts["mi"] = max(0.0, facts["rows_entropy"] + facts["columns_entropy"] - facts["cells_entropy"])
    return facts


def _ari(f: dict) -> float:
    n_pairs = f["n"] * (f["n"] - 1) / 2
    if f["cells_pairs"] == f["rows_pairs"] == f["columns_pairs"]:
        return 1.0
    expected = f["rows_pairs"] * f["columns_pairs"] / n_pairs
    return (f["cells_pairs"] - expected) / (0.5 * (f["rows_pairs"] + f["columns_pairs"]) - expected)


def _nmi(f: dict) -> float:
    if f["rows_count"] == f["columns_count"] == 1:
        return 1.0
    mean = 0.5 * (f["rows_entropy"] + f["columns_entropy"])
    return f["mi"] / mean if mean > 0 else 0.0


def _ami(f: dict, expected: Callable[[], float]) -> float:
    if f["rows_count"] == f["columns_count"] == 1:
        return 1.0
    chance = expected()
    mean = 0.5 * (f["rows_entropy"] + f["columns_entropy"])
    gap, eps = mean - chance, float(np.finfo(float).eps)
    return (f["mi"] - chance) / (min(gap, -eps) if gap < 0 else max(gap, eps))


def _expected_mi(margins: DataFrame, total: int) -> float:
    """Expected mutual information of two random labelings with these margins.

    It depends on the margin values only, and n rows admit at most sqrt(2n) different group sizes,
    so equal sizes are folded first; that also bounds the broadcast list.
    """
    sizes = margins.where(F.col("gid").isin(1, 2)).groupBy("gid", "n").agg(F.count(F.lit(1)).alias("times"))
    right = sizes.where("gid = 2").select("n", "times").toPandas()
    table = margins.sparkSession.sparkContext.broadcast((right["n"].to_numpy(), right["times"].to_numpy()))

    def expected(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            value = [
                times * expected_mutual_information(size, *table.value, total)
                for size, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(value, pa.float64())], names=["emi"])

    left = sizes.where("gid = 1").select("n", "times")
    return left.mapInArrow(expected, "emi double").agg(F.sum("emi")).first()[0]


def agreement(df: DataFrame, reference: str, predicted: str) -> dict:
    """AMI, ARI and NMI of two label columns from one contingency aggregation."""
    with _kept(_margins(contingency(df, reference, predicted))) as margins:
        facts = _facts(margins)
        return {
            "adjusted_mutual_info": _ami(facts, lambda: _expected_mi(margins, facts["n"])),
            "adjusted_rand": _ari(facts),
            "normalized_mutual_info": _nmi(facts),
        }


def agreement_of_counts(counts: np.ndarray) -> dict:
    """The same from a small contingency table (reference x predicted)."""
    total, facts = int(counts.sum()), {"n": int(counts.sum())}
    margins = [m[m > 0] for m in (counts.sum(axis=1), counts.sum(axis=0))]
    for name, n in zip(("cells", "rows", "columns"), (counts[counts > 0], *margins)):
        facts |= {f"{name}_count": len(n), f"{name}_pairs": float((n * (n - 1) / 2).sum()),
                  f"{name}_entropy": math.log(total) - float((n * np.log(n)).sum()) / total}
    facts["mi"] = max(0.0, facts["rows_entropy"] + facts["columns_entropy"] - facts["cells_entropy"])
    sizes, times = np.unique(margins[1].astype(int), return_counts=True)
    return {
        "adjusted_mutual_info": _ami(facts, lambda: sum(
            expected_mutual_information(int(n), sizes, times, total) for n in margins[0])),
        "adjusted_rand": _ari(facts),
        "normalized_mutual_info": _nmi(facts),
    }


def adjusted_rand(df: DataFrame, reference: str, predicted: str) -> float:
    return _ari(_facts(_margins(contingency(df, reference, predicted))))


def normalized_mutual_info(df: DataFrame, reference: str, predicted: str) -> float:
    return _nmi(_facts(_margins(contingency(df, reference, predicted))))


def adjusted_mutual_info(df: DataFrame, reference: str, predicted: str) -> float:
    return agreement(df, reference, predicted)["adjusted_mutual_info"]


def accuracy(df: DataFrame, reference: str, predicted: str) -> float:
    """Share of rows whose labels are equal as numbers; cluster indexes are not matched to classes.

    A row without one of the labels is an error.
    """
    same = F.col(reference) == F.col(predicted)
    share, bad = df.agg(F.avg(same.cast("double")), F.count_if(same.isNull())).first()
    if bad:
        raise ValueError("labels contain nulls")
    return share


def std_error_of(df: DataFrame, features, exact_centers, approx_centers) -> float:
    """(E_exact - E_approx) / E_exact over the rows, both errors from one scan."""
    xs = feature_columns(df, features, np.asarray(exact_centers).shape[-1])
    points = df.select(*[x.alias(f"x{j}") for j, x in enumerate(xs)])
    names = points.columns
    both = assign(assign(points, names, as_centers(exact_centers), "__k", "__e"),
                  names, as_centers(approx_centers), "__k", "__a")
    exact, approx = both.agg(F.sum("__e"), F.sum("__a")).first()
    return (exact - approx) / exact if exact else 0.0


def _names(features) -> list[str]:
    return [features] if isinstance(features, str) else list(features)
