"""Nearest-centre assignment and (weighted) Lloyd iterations.

Points are DataFrames with columns ``x0..x{d-1}`` and a weight ``w``. Centres are a small K x d array
on the driver. A step is one map-side pass, whatever the size: every task reduces its rows to K partial
sums, and only those are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import all_finite, feature_columns, squared_distance
from ..session import Scratch
from .blocks import gap_floor, largest_moves, move_centers, nearest_in_block
from .packed import Boundary, coordinates, counted_pass, model_sums, pack, pack_tiled
from .packed import write as write_blocks

#: Largest K x d for which distances are unrolled into generated code; beyond it Arrow batches win.
UNROLL_LIMIT = 72
#: Bytes of points that a task may iterate over alone, and how many times the last movement a margin has to hold.
BOUNDARY_BYTES, MARGIN_FACTOR = 64 << 20, 3.0
#: Passes over packed points before gaps are counted, and models that go on by their bounds at a time.
SHARED_STEPS, MODELS_AT_ONCE = 2, 4


@dataclass
class LloydResult:
    centers: np.ndarray
    n_iter: int
    n_rows: int


def as_centers(centers, dims: int | None = None) -> np.ndarray:
    """Validate a K x d array of centres."""
    array = np.asarray(centers, dtype=float)
    if array.ndim != 2 or not np.isfinite(array).all():
        raise ValueError("centres must be a finite K x d array")
    if dims is not None and array.shape[1] != dims:
        raise ValueError(f"the table has {dims} features but the centres have {array.shape[1]}")
    return array


def assign(
    df: DataFrame, features, centers, prediction: str = "prediction", distance: str | None = None
) -> DataFrame:
    """Append the index of the nearest centre (ties: lowest index) and, on request, the squared distance.

    A projection without shuffle, valid for batch and streaming frames. Both are null for a row with a
    null, NaN or infinite feature; an array of another width than the centres is an error.
    """
    size = np.asarray(centers).shape[-1]
    xs = feature_columns(df, features, size)
    centers = as_centers(centers, len(xs))
    valid = all_finite(xs)
    if centers.size > UNROLL_LIMIT:
        near = _nearest_in_arrow(centers)(*xs)
        wide = df.withColumn("__near", near).withColumn("__best", F.col("__near.square"))
        label = F.col("__near.label")
    else:
        squares = [f"__q{i}" for i in range(len(centers))]
        # Separate projections: the distances are evaluated once and then only compared.
        wide = df.select("*", *[squared_distance(xs, c).alias(q) for q, c in zip(squares, centers)])
        wide = wide.withColumn("__best", F.least(*squares) if len(squares) > 1 else F.col(squares[0]))
        label = F.lit(len(centers) - 1)
        for i in range(len(centers) - 2, -1, -1):
            label = F.when(F.col(squares[i]) == F.col("__best"), F.lit(i)).otherwise(label)
    extra = [F.when(valid, label).cast("int").alias(prediction)]
    if distance:
        extra.append(F.when(valid, F.col("__best")).alias(distance))
    return wide.select(*[c for c in df.columns if c not in (prediction, distance)], *extra)


def _nearest_in_arrow(centers: np.ndarray):
    @F.pandas_udf("label int, square double")
    def nearest(*columns: pd.Series) -> pd.DataFrame:
        labels, best = nearest_in_block([c.to_numpy(dtype=float, na_value=np.nan) for c in columns], centers)
        return pd.DataFrame({"label": labels, "square": best})

    return nearest


def point_frame(df: DataFrame, features, weight: str | None = None, keep: Iterable = ()) -> DataFrame:
    """Project a table to the point layout ``x0.., w`` plus extra columns."""
    xs = feature_columns(df, features)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return df.select(*[x.alias(f"x{j}") for j, x in enumerate(xs)], w.alias("w"), *keep)


def farthest_points(points: DataFrame, centers: np.ndarray, m: int) -> list[tuple[np.ndarray, float, int]]:
    """The ``m`` points farthest from their centre as (x, weight, label); a distributed top-m."""
    xs = [f"x{j}" for j in range(centers.shape[1])]
    top = (
        assign(points.select(*xs, "w"), xs, centers, "k", "d2")
        .where(F.col("d2") > 0)
        .orderBy(F.desc("d2"), *xs)
        .limit(m)
        .collect()
    )
    return [(np.array([row[x] for x in xs]), row["w"], row["k"]) for row in top]


def weighted_lloyd(
    points: DataFrame,
    centers,
    max_iter: int = 300,
    tol: float = 1e-4,
    n_rows: int | None = None,
    variance: float | None = None,
) -> LloydResult:
    """Lloyd from given centres over weighted points, a map-side pass per iteration.

    ``tol`` is relative to the mean feature variance, as in common k-means implementations. Callers
    that know the point count and variance pass them to save one aggregation.
    """
    return lloyd_models(points, [centers], max_iter, tol, n_rows, variance)[0]


def lloyd_models(points: DataFrame, models, max_iter: int = 300, tol: float = 1e-4, n_rows: int | None = None,
                 variance: float | None = None, packed: DataFrame | None = None) -> list[LloydResult]:
    """Lloyd from several sets of centres over the same points; a pass serves all that have not ended yet.

    The points are packed into tiled blocks first, unless a caller gives them ``packed``. After ``SHARED_STEPS``
    passes they also count the gaps of the points. When those that the coming movements of a set may touch are few,
    it goes on by its own bounds for as long as they hold, see ``_last_model``. Few points are iterated over in one task.
    """
    xs = coordinates(points)
    models = [as_centers(m, len(xs)) for m in models]
    if n_rows is None or variance is None:
        n_rows, variance = point_facts(points)
    scratch, tasks = Scratch(points.sparkSession), 0
    ended, turns, shared = [False] * len(models), [0] * len(models), 0
    size, written = n_rows * 8 * (len(xs) + 1), bool(packed)
    if not packed:
        packed = pack(points, len(xs)) if size <= BOUNDARY_BYTES else pack_tiled(points, len(xs))

    def each(work, some):
        with ThreadPoolExecutor(MODELS_AT_ONCE) as pool:
            list(pool.map(inheritable_thread_target(points.sparkSession)(work), some))

    def whole(i):
        models[i], made, ended[i] = Boundary.of_all(packed, models[i]).iterate(models[i], max_iter - turns[i], tol * variance)
        turns[i] += made

    def last(i, counts, moves):
        models[i], turns[i], ended[i] = _last_model(
            packed, models[i], turns[i], max_iter, tol * variance, counts, moves, n_rows, scratch, tasks,
            lambda at, m: farthest_points(points, at, m), f"model{i}-")

    try:
        while active := [i for i, end in enumerate(ended) if not end and turns[i] < max_iter]:
            if size <= BOUNDARY_BYTES:
                if not written and len(active) > 1:
                    packed, written = write_blocks(packed, scratch, "packed", n_rows, len(xs) + 1), True
                each(whole, active)
                active = [i for i in active if not ended[i] and turns[i] < max_iter]
                if not active:
                    break
            elif not written:
                packed, written = write_blocks(packed, scratch, "packed", n_rows, len(xs) + 1), True
            tasks, now, open_ = tasks or packed.rdd.getNumPartitions(), [models[i] for i in active], []
            if size <= BOUNDARY_BYTES or shared < SHARED_STEPS:
                found = [(sums, None) for sums in model_sums(packed, now, tasks, squares=False)]
            else:
                found = counted_pass(packed, now, tasks)
            shared += 1
            for i, at, (sums, counts) in zip(active, now, found):
                models[i] = move_centers(sums, at, lambda m, at=at: farthest_points(points, at, m))
                turns[i] += 1
                ended[i] = float(((models[i] - at) ** 2).sum()) <= tol * variance
                if counts is not None and not ended[i]:
                    open_.append((i, counts, largest_moves(at, models[i])))
            each(lambda one: last(*one), open_)
    finally:
        scratch.drop()
    return [LloydResult(m, turn, n_rows) for m, turn in zip(models, turns)]


def _last_model(packed: DataFrame, centers: np.ndarray, turn: int, max_iter: int, tol: float, counts: np.ndarray, moves: float,
                n_rows: int, scratch: Scratch, tasks: int, farthest, name: str = "") -> tuple[np.ndarray, int, bool]:
    """Lloyd by bounds, from ``turn`` steps on: the centres at the end, the number of steps, whether they converged.

    ``counts`` are those of the gaps, ``moves`` the last movement. If the points that the coming movements may touch
    are few, a pass over all points sets them apart as a ``Boundary``. Later steps read only them: in a pass each, or,
    if they take no more than ``BOUNDARY_BYTES``, all steps in one task. It ends early, or at once, when the
    centres move too far for that.
    """
    row_bytes, boundary, alone = 8 * (centers.shape[1] + 1), None, True
    margin, rows = _margin(counts, moves, n_rows, row_bytes)
    if rows is None:
        return centers, turn, False
    while turn < max_iter and (boundary is None or boundary.holds(centers)):
        if boundary is None:
            boundary = Boundary(packed, centers, margin, scratch, f"{name}boundary{turn}", tasks)
            sums = boundary.sums
        else:
            if alone and rows * row_bytes <= BOUNDARY_BYTES:
                centers, made, ended = boundary.iterate(centers, max_iter - turn, tol)
                turn += made
                if ended:
                    return centers, turn, True
                alone = bool(made)
                continue
            sums = boundary.step(centers)
        before, turn, alone = centers, turn + 1, True
        centers = move_centers(sums, before, lambda m: farthest(before, m))
        if float(((centers - before) ** 2).sum()) <= tol:
            return centers, turn, True
    return centers, turn, False


def _margin(counts: np.ndarray, moves: float, n_rows: int, row_bytes: int) -> tuple[float, int | None]:
    """The largest margin with few points within it, and their number at the last count; no number if it is too
    narrow for the movements to come."""
    few = max(BOUNDARY_BYTES // row_bytes, n_rows // 8)
    below = np.concatenate([[0], np.cumsum(counts)[:-1]])
    fitting = max(c for c in range(len(counts)) if below[c] <= few)
    margin = gap_floor(fitting)
    return margin, int(below[fitting]) if margin >= MARGIN_FACTOR * moves else None


class PackedPoints:
    """The points of a table, packed once for several fits and measures."""

    def __init__(self, df: DataFrame, features):
        self.points, self.scratch = point_frame(df, features), Scratch(df.sparkSession)
        self.dims = len(coordinates(self.points))
        self.n_rows, self.variance = point_facts(self.points)
        self.table = write_blocks(pack_tiled(self.points, self.dims), self.scratch, "packed", self.n_rows, self.dims + 1)
        self.tasks = self.table.rdd.getNumPartitions()

    def __enter__(self) -> "PackedPoints":
        return self

    def __exit__(self, *_) -> None:
        self.scratch.drop()


def point_facts(points: DataFrame) -> tuple[int, float]:
    """Row count and mean per-feature variance; rejects non-finite features."""
    xs = coordinates(points)
    row = points.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~all_finite([F.col(x) for x in xs])).alias("bad"),
        (sum(F.var_pop(x) for x in xs) / F.lit(len(xs))).alias("variance"),
    ).first()
    if not row["n"]:
        raise ValueError("cannot fit an empty table")
    if row["bad"]:
        raise ValueError("features contain null, NaN or infinite values")
    return row["n"], row["variance"]
