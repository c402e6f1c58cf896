"""Feature preparation: encode categories, impute missing values, scale, encode the target.

``fit`` gathers one histogram of all categorical columns in a single aggregation; codes, modes,
medians, means and random draws all come from it. ``transform`` is a chain of dictionary joins and one
projection. Per column, left to right, a value is first imputed and then scaled, so that regression
imputation sees scaled columns on its left and raw ones on its right.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from pathlib import PurePosixPath

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType
from pyspark.storagelevel import StorageLevel

from ..functions.randomness import keyed_hash
from ..session import BOUNDED_BYTES, Scratch
from .joins import lookup
from .sampling import with_running_total

# Fixed option values.
CATEGORICAL_OPTIONS = ("int", "onehot")
SCALE_OPTIONS = ("min-max", "standardisation", "stardardisation", "mean", "unit", "max-abs", "none")
IMPUTE_OPTIONS = ("most_frequent", "median", "mean", "constant", "random", "linear_regression", "logistic_regression")
MISSING = "?"

_ENTRY_BYTES = 64  # of a dictionary row, besides its text


# ---------------------------------------------------------------- scalers

def scale_facts(df: DataFrame, columns: Sequence[str]) -> dict[str, dict[str, float]]:
    """Min, max, mean, population deviation and largest magnitude of many columns in one pass."""
    facts = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_pop, "maxabs": lambda c: F.max(F.abs(c))}
    row = df.agg(*[
        fn(F.col(c).cast("double")).alias(f"{i}_{name}") for i, c in enumerate(columns) for name, fn in facts.items()
    ]).first()
    return {c: {name: row[f"{i}_{name}"] for name in facts} for i, c in enumerate(columns)}


def scaled(x: Column, method: str, facts: dict[str, float] | None = None) -> Column:
    """One scaled value; a constant column maps to 0."""
    x = x.cast("double")
    if method == "none":
        return x
    if method == "unit":
        return F.signum(x)
    if method == "min-max":
        shift, span = facts["min"], facts["max"] - facts["min"] if facts["max"] is not None else None
    elif method in ("standardisation", "stardardisation", "mean"):
        shift, span = facts["mean"], facts["std"]
    elif method == "max-abs":
        shift, span = None, facts["maxabs"]
    else:
        raise ValueError(f"unknown scaling {method!r}; use one of {SCALE_OPTIONS}")
    if not span:
        return x * F.lit(0.0)
    return (x if shift is None else x - F.lit(shift)) / F.lit(span)


def to_unit_box(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min-max scale columns to [-1, 1], the default root box of the cells."""
    facts = scale_facts(df, columns)
    return df.withColumns({c: F.lit(2.0) * scaled(F.col(c), "min-max", facts[c]) - F.lit(1.0) for c in columns})


# ---------------------------------------------------------------- dictionaries

def histogram(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """(column, number, value, n): value counts of several columns in one aggregation.

    ``numeric`` columns are ordered by number, the others by string; null counts as the missing mark.
    """
    entries = []
    for c in columns:
        number = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        entries.append(F.struct(
            F.lit(c).alias("column"), number.alias("number"),
            F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("value")))
    return df.select(F.inline(F.array(*entries))).groupBy("column", "number", "value").agg(
        F.count(F.lit(1)).alias("n"))


def dictionary(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """Add to a histogram the ``code`` (rank of the value in its column, from 0) and ``before``, the
    number of observed (not missing) rows with smaller codes. Sorted and numbered in parallel."""
    seen = F.when(F.col("value") == MISSING, F.lit(0)).otherwise(F.col("n"))
    indexed = with_running_total(counts, ["column", "number", "value"], seen, scratch)
    first = indexed.groupBy("column").agg(F.min("idx").alias("__i"), F.min("before").alias("__b"))
    coded = indexed.join(F.broadcast(first), "column").select(
        "column", "number", "value", "n",
        (F.col("idx") - F.col("__i")).cast("int").alias("code"), (F.col("before") - F.col("__b")).alias("before"))
    return scratch.write(coded, "dictionary", "column")


def column_facts(table: DataFrame) -> dict[str, dict]:
    """Per column: dictionary size, observed rows, missing code, and mode / mean / median of the codes."""
    seen = F.col("value") != MISSING
    observed = table.groupBy("column").agg(F.coalesce(F.sum(F.when(seen, F.col("n"))), F.lit(0)).alias("m"))
    end = F.col("before") + F.col("n")
    rows = (
        table.join(F.broadcast(observed), "column").groupBy("column").agg(
            F.count(F.lit(1)).alias("size"), F.first("m").alias("m"),
            F.sum(F.octet_length("value") + _ENTRY_BYTES).alias("bytes"),
            F.max(F.when(~seen, F.col("code"))).alias("missing"),
            F.min_by("code", F.when(seen, F.struct(-F.col("n"), F.col("code")))).alias("most_frequent"),
            (F.sum(F.when(seen, F.col("code") * F.col("n"))) / F.first("m")).alias("mean"),
            ((F.min(F.when(seen & (end > F.floor((F.col("m") - 1) / 2)), F.col("code")))
              + F.min(F.when(seen & (end > F.floor(F.col("m") / 2)), F.col("code")))) / 2).alias("median"),
        ).collect())
    return {row["column"]: row.asDict() for row in rows}


def encode_column(df: DataFrame, table: DataFrame, column: str, table_bytes: int, by_number: bool = False) -> DataFrame:
    """Replace a column by its code; ``table_bytes`` is the size of its dictionary."""
    key = F.col(column).cast("double") if by_number else F.coalesce(F.col(column).cast("string"), F.lit(MISSING))
    entries = table.where(F.col("column") == column).select(
        F.col("number" if by_number else "value").alias("__key"), F.col("code").alias("__code"))
    joined = lookup(df.withColumn("__key", key), entries, "__key", table_bytes)
    return joined.select(*[F.col("__code").alias(c) if c == column else F.col(c) for c in df.columns])


def impute_random(df: DataFrame, table: DataFrame, column: str, facts: dict, ids: Sequence[str], seed: int,
                  method: str = "xxhash64") -> DataFrame:
    """Fill missing codes with draws from the observed values, in proportion to their counts.

    A missing row draws a rank below the number of observed rows and looks up the value whose rank
    interval contains it. Intervals are cut into equal buckets, which makes this an equi-join on
    uniformly distributed keys, however unequal the counts are.
    """
    m, size = facts["m"], facts["size"]
    if facts["missing"] is None or not m:
        return df
    width = max(1, m // (4 * size))
    ranges = (
        table.where((F.col("column") == column) & (F.col("value") != MISSING))
        .select(F.col("code").alias("__draw"), F.col("before").alias("__lo"), (F.col("before") + F.col("n")).alias("__hi"))
        .withColumn("__bucket", F.explode(F.sequence(
            F.floor(F.col("__lo") / width), F.floor((F.col("__hi") - 1) / width)))))
    missing = F.col(column) == facts["missing"]
    rank = F.pmod(keyed_hash(f"{seed}|{column}", ids, method), F.lit(m))
    rows = df.withColumn("__rank", F.when(missing, rank)).withColumn(
        "__bucket", F.floor(F.col("__rank") / width))
    inside = [F.col("a.__bucket") == F.col("b.__bucket"), F.col("__rank") >= F.col("__lo"), F.col("__rank") < F.col("__hi")]
    filled = [F.coalesce("__draw", c).alias(c) if c == column else F.col(f"a.{c}") for c in df.columns]
    if (5 * size + 4) * _ENTRY_BYTES <= BOUNDED_BYTES:
        return rows.alias("a").join(F.broadcast(ranges.alias("b")), inside, "left").select(*filled)
    drawn = rows.where(F.col("__rank").isNotNull()).alias("a").join(ranges.alias("b"), inside).select(*filled)
    return rows.where(F.col("__rank").isNull()).select(*df.columns).unionByName(drawn)


# ---------------------------------------------------------------- pipeline

@dataclass
class Preparer:
    """Plan of the preparation.

    ``target`` names the label column (``None``: every column is a feature). ``ids`` are columns that
    identify a row; they pass through unchanged and key the random imputation.
    """

    categorical: str = "int"
    scale: str = "min-max"
    impute: str = "most_frequent"
    target: str | None = None
    ids: Sequence[str] = ()
    fill_value: float = 0.0
    seed: int = 0
    hash_method: str = "xxhash64"

    def __post_init__(self):
        for value, options in ((self.categorical, CATEGORICAL_OPTIONS), (self.scale, SCALE_OPTIONS),
                               (self.impute, IMPUTE_OPTIONS)):
            if value not in options:
                raise ValueError(f"{value!r} is not supported; use one of {options}")
        if self.impute == "random" and not self.ids:
            raise ValueError("random imputation needs ids")

    def fit(self, df: DataFrame) -> "PreparedModel":
        passing = set(self.ids)
        features = [c for c in df.columns if c != self.target and c not in passing]
        strings = [c for c in features if isinstance(df.schema[c].dataType, StringType)]
        model = PreparedModel(self, features, strings, Scratch(df.sparkSession))
        coded = list(strings)
        if self.target:
            coded.append(self.target)
            model.numeric_target = isinstance(df.schema[self.target].dataType, NumericType)
        if coded:
            numeric = [self.target] if model.numeric_target else []
            model.table = dictionary(histogram(df, coded, numeric), model.scratch)
            model.facts = column_facts(model.table)
        if self.categorical == "onehot" and strings:
            if sum(model.facts[c]["bytes"] for c in strings) > BOUNDED_BYTES:
                raise ValueError("too many distinct values to turn each into a column; use categorical='int'")
            rows = model.table.where(F.col("column").isin(strings)).select("column", "value", "code").collect()
            for row in sorted(rows, key=lambda r: (r["column"], r["code"])):
                model.categories.setdefault(row["column"], []).append(row["value"])
        model._fit_steps(df)
        return model


@dataclass
class PreparedModel:
    """Fitted preparation; ``transform`` keeps ids and other columns as they are."""

    plan: Preparer
    features: list[str]
    strings: list[str]
    scratch: Scratch
    numeric_target: bool = False
    table: DataFrame | None = None
    facts: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    steps: list = field(default_factory=list)

    def _fit_steps(self, df: DataFrame) -> None:
        """Imputation and scaling steps in column order. Only regression imputation, which depends on
        the columns already finished, needs a fit of its own; all other statistics share one pass."""
        plan = self.plan
        onehot = plan.categorical == "onehot"
        scalable = [c for c in self.features if not (onehot and c in self.strings)]
        current, pending = self._encode(df), []
        for c in scalable:
            if not onehot and c in self.strings and self.facts[c]["missing"] is not None:
                if plan.impute.endswith("regression"):
                    current = self._scale_step(current, pending)
                    pending = []
                    others = [f for f in self.features if f != c]
                    current = self._add(current, ("model", c, self._regression(current, c, others), others))
                else:
                    current = self._add(current, ("fill", c))
            pending.append(c)
        self._scale_step(current, pending)

    def _scale_step(self, current: DataFrame, columns: list[str]) -> DataFrame:
        if not columns or self.plan.scale == "none":
            return current
        facts = scale_facts(current, columns) if self.plan.scale != "unit" else {}
        return self._add(current, ("scale", {c: facts.get(c) for c in columns}))

    def _add(self, current: DataFrame, step: tuple) -> DataFrame:
        self.steps.append(step)
        return self._apply(current, step)

    def _regression(self, current: DataFrame, column: str, others: list[str]):
        missing = self.facts[column]["missing"]
        train = VectorAssembler(inputCols=others, outputCol="__x").transform(
            current.where(F.col(column) != missing).withColumn("__y", F.col(column).cast("double"))
        ).select("__x", "__y").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            shared = dict(featuresCol="__x", labelCol="__y", predictionCol="__p")
            if self.plan.impute == "linear_regression":
                return LinearRegression(**shared, solver="auto").fit(train)
            # Unit penalty on the summed loss, i.e. 1/n on the mean loss.
            return LogisticRegression(
                **shared, regParam=1.0 / self.facts[column]["m"], elasticNetParam=0.0, standardization=False,
                family="multinomial", maxIter=1000, tol=1e-12).fit(train)
        finally:
            train.unpersist()

    def _encode(self, df: DataFrame) -> DataFrame:
        if self.plan.categorical == "int":
            for c in self.strings:
                df = encode_column(df, self.table, c, self.facts[c]["bytes"])
        else:
            out = []
            for c in df.columns:
                if c in self.categories:
                    value = F.coalesce(F.col(c), F.lit(MISSING))
                    out += [F.when(value == v, 1).otherwise(0).alias(f"{c}_{v}") for v in self.categories[c]]
                else:
                    out.append(F.col(c))
            df = df.select(*out)
        return df

    def _apply(self, df: DataFrame, step: tuple) -> DataFrame:
        if step[0] == "scale":
            return df.withColumns({c: scaled(F.col(c), self.plan.scale, f) for c, f in step[1].items()})
        column = step[1]
        facts = self.facts[column]
        missing = F.col(column) == facts["missing"]
        if step[0] == "model":
            _, _, fitted, others = step
            assembled = VectorAssembler(inputCols=others, outputCol="__x", handleInvalid="keep").transform(df)
            return (
                fitted.setPredictionCol("__p").transform(assembled)
                .withColumn(column, F.when(missing, F.col("__p")).otherwise(F.col(column).cast("double")))
                .select(*df.columns))
        if self.plan.impute == "random":
            return impute_random(df, self.table, column, facts, self.plan.ids, self.plan.seed, self.plan.hash_method)
        value = self.plan.fill_value if self.plan.impute == "constant" else facts[self.plan.impute]
        return df.withColumn(column, F.when(missing, F.lit(value).cast("double")).otherwise(F.col(column).cast("double")))

    def transform(self, df: DataFrame) -> DataFrame:
        out = self._encode(df)
        for step in self.steps:
            out = self._apply(out, step)
        target = self.plan.target
        if target and target in df.columns:
            out = encode_column(out, self.table, target, self.facts[target]["bytes"], self.numeric_target)
        return out

    @property
    def feature_names(self) -> list[str]:
        """Feature columns after ``transform``, one-hot blocks in place of their source column."""
        names = []
        for c in self.features:
            names += [f"{c}_{v}" for v in self.categories[c]] if c in self.categories else [c]
        return names

    @property
    def n_targets(self) -> int:
        """Number of distinct target values."""
        return self.facts[self.plan.target]["size"]

    def logistic_moments(self, df: DataFrame) -> DataFrame:
        """Whether the logistic imputation models are optimal for ``df``, the table they were fitted on.

        (column, code, feature, observed, predicted) for every class of every imputed column. ``observed`` is the
        number of rows of the class (feature ``intercept``) or the sum of a feature over them; ``predicted`` is the
        same under the predicted probabilities, plus the coefficient, which is the gradient of the penalty. The loss
        is convex, and its gradient is the difference of the two: a model is the optimum if they are equal. Rows
        whose value is missing take no part. One aggregation for each model.
        """
        current, parts = self._encode(df), []
        for step in self.steps:
            if step[0] == "model" and self.plan.impute == "logistic_regression":
                parts.append(self._moments(current, *step[1:]))
            current = self._apply(current, step)
        if not parts:
            raise ValueError("no column was imputed by logistic regression")
        return reduce(DataFrame.unionByName, parts)

    def _moments(self, df: DataFrame, column: str, fitted, others: list[str]) -> DataFrame:
        known = VectorAssembler(inputCols=others, outputCol="__x").transform(
            df.where(F.col(column) != self.facts[column]["missing"]))
        scored = fitted.setProbabilityCol("__odds").transform(known)
        by_class = scored.select(F.col(column).alias("__y"), *others, F.posexplode(vector_to_array("__odds")).alias("code", "p"))
        own = (F.col("__y") == F.col("code")).cast("double")
        terms = {"intercept": F.lit(1.0), **{c: F.col(c).cast("double") for c in others}}
        sums = by_class.groupBy("code").agg(*[
            F.sum(share * x).alias(f"{name}{i}") for i, x in enumerate(terms.values()) for name, share in (("o", own), ("p", F.col("p")))])
        weights = F.array(*[F.array(*[F.lit(float(w)) for w in row]) for row in fitted.coefficientMatrix.toArray()])
        rows = [
            F.struct(F.lit(name).alias("feature"), F.col(f"o{i}").alias("observed"),
                     (F.col(f"p{i}") + (F.get(F.get(weights, F.col("code")), F.lit(i - 1)) if i else F.lit(0.0))).alias("predicted"))
            for i, name in enumerate(terms)]
        return sums.select(F.lit(column).alias("column"), "code", F.inline(F.array(*rows)))

    def mapping(self) -> DataFrame:
        """(column, value, code) of every encoded column."""
        return self.table.select("column", "value", "code")


def dataset_name(path: str) -> str:
    """File stem of a dataset path."""
    return PurePosixPath(path).stem
