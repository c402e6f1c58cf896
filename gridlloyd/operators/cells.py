"""Grid cells: a d-dimensional quadtree as closed-form columns and one aggregation.

At depth ``i`` every dimension of the root box is halved ``i`` times. Membership is a chain of strict
``x > midpoint`` tests, so the cell coordinate of a row is a closed form of its value, the parent of
a cell is a one-bit right shift, and (count, sum) add up from children to parents. One ``groupBy`` at
the deepest level therefore yields the whole tree.

Grouping uses packed keys: the coordinates of several dimensions share one BIGINT, so the hash
aggregate and the shuffle carry a few longs instead of d integers. The key of an ancestor at depth
``i`` is the leaf key with the low ``leaf - i`` bits of every coordinate cleared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import isfinite
from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import all_finite, feature_columns
from ..session import Scratch
from .joins import lookup
from .sampling import with_running_total

#: Halvings of the box that doubles can tell apart.
MAX_DEPTH = 52
#: Deepest level whose coordinates are INT; those of deeper levels are BIGINT.
_INT_DEPTH = 31
UNIT_BOUNDS = (-1.0, 1.0)


def cell_coordinate(x: Column, depth: int, bounds: tuple[float, float] = UNIT_BOUNDS) -> Column:
    """Coordinate (BIGINT in [0, 2^depth)) of value ``x``; values outside stay in the boundary cell."""
    lo, hi = (float(b) for b in bounds)
    if (lo, hi) != UNIT_BOUNDS:
        x = F.lit(2.0) * (x - F.lit(lo)) / F.lit(hi - lo) - F.lit(1.0)
    half = 2 ** (depth - 1)
    inside = F.least(F.greatest(x, F.lit(-1.0)), F.lit(1.0))
    return F.greatest(F.ceil(inside * F.lit(float(half))) + F.lit(half - 1), F.lit(0).cast("bigint"))


def data_bounds(df: DataFrame, features) -> tuple[tuple[float, float], ...]:
    """The smallest and largest value of every dimension, over the rows whose features are all finite; one aggregate.

    A dimension with a single value gets a box of width 1 or of that value's size above it, so that its rows share
    one cell. A table without such rows has no box and is an error, as is a range too wide for doubles.
    """
    if df.isStreaming:
        raise ValueError("the box of a stream cannot be known ahead; give bounds")
    xs = feature_columns(df, features)
    ends = df.where(all_finite(xs)).agg(*[f(x) for x in xs for f in (F.min, F.max)]).first()
    if ends[0] is None:
        raise ValueError("no row has finite features, so there is no box")
    pairs = [(lo, hi if hi > lo else lo + max(1.0, abs(lo))) for lo, hi in zip(ends[::2], ends[1::2])]
    if not all(isfinite(hi - lo) for lo, hi in pairs):
        raise ValueError("the range of a feature is too wide for doubles; scale the features")
    return tuple(pairs)


def box(df: DataFrame, features, bounds=UNIT_BOUNDS) -> tuple[tuple[float, float], ...]:
    """(low, high) of every dimension: ``bounds`` is one pair for all, a pair for each, or "auto" for ``data_bounds``."""
    return data_bounds(df, features) if _is_auto(bounds) else _pairs(bounds, len(feature_columns(df, features)))


def with_cell(df: DataFrame, features, depth: int, bounds=UNIT_BOUNDS, cell: str = "cell") -> DataFrame:
    """Append the cell of every row at ``depth`` as ARRAY<INT>, or ARRAY<BIGINT> beyond depth 31; a
    projection, no shuffle."""
    _check_depth(depth)
    xs = feature_columns(df, features)
    at = [cell_coordinate(x, depth, b) for x, b in zip(xs, box(df, features, bounds))]
    return df.withColumn(cell, F.array(*[c.cast(_coordinate_type(depth)) for c in at]))


def hypercube_id(cell: Column, dims: int) -> Column:
    """Position of a cell inside its parent; dimension 0 is the least significant bit."""
    bits = [F.shiftleft(F.get(cell, F.lit(j)).cast("bigint").bitwiseAND(F.lit(1)), j) for j in range(dims)]
    return reduce(lambda a, b: a + b, bits)


def cell_path(cell: Column, dims: int, depth: int) -> Column:
    """ARRAY<BIGINT> of hypercube ids from depth 1 down to ``depth``; its order is the order in which
    the tree lists its cells."""
    ids = []
    for i in range(1, depth + 1):
        bits = [F.shiftleft(F.shiftright(F.get(cell, F.lit(j)).cast("bigint"), depth - i).bitwiseAND(F.lit(1)), j)
                for j in range(dims)]
        ids.append(reduce(lambda a, b: a + b, bits))
    return F.array(*ids)


def with_cell_ordinal(
    df: DataFrame, features, depth: int, bounds=UNIT_BOUNDS, cell: str = "cell", ordinal: str = "ordinal"
) -> DataFrame:
    """Append the cell of every row and the cell's position among all non-empty cells of that depth."""
    scratch = Scratch(df.sparkSession)
    dims = len(feature_columns(df, features))
    located = with_cell(df, features, depth, bounds, cell)
    found = located.select(cell).distinct().withColumn("__path", cell_path(F.col(cell), dims, depth))
    numbered = scratch.write(
        with_running_total(found, ["__path"], F.lit(1), scratch, ordinal).select(cell, ordinal), "ordinals")
    return lookup(located, numbered, cell, numbered.count() * (dims + 4) * 8)


def leaf_stats(df: DataFrame, features, depth: int, bounds=UNIT_BOUNDS) -> DataFrame:
    """(w0.., n, s0..): packed key, row count and per-dimension sum of every non-empty cell.

    Rows with a null, NaN or infinite feature are gathered under a null key for the caller to reject.
    """
    _check_depth(depth)
    xs = feature_columns(df, features)
    words = _pack([cell_coordinate(x, depth, b) for x, b in zip(xs, box(df, features, bounds))], depth)
    words[0] = F.when(all_finite(xs), words[0])
    return df.groupBy(*[w.alias(f"w{i}") for i, w in enumerate(words)]).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{j}") for j, x in enumerate(xs)]
    )


def roll_up(leaf: DataFrame, dims: int, leaf_depth: int, depths: Sequence[int]) -> DataFrame:
    """Statistics of all ancestors at ``depths`` in one pass over the leaf cells, with a depth column.

    Each leaf contributes one row per requested depth; the map-side half of the aggregation folds
    them before the shuffle, so coarse levels cost next to nothing.
    """
    words = _word_count(dims, leaf_depth)
    masks = F.array(*[
        F.struct(
            F.lit(i).alias("depth"),
            *[F.lit(m).cast("bigint").alias(f"m{w}") for w, m in enumerate(_masks(dims, leaf_depth, i))],
        )
        for i in depths
    ])
    return (
        leaf.select("*", F.inline(masks))
        .groupBy("depth", *[F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")).alias(f"w{w}") for w in range(words)])
        .agg(F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(dims)])
    )


def cell_stats(df: DataFrame, features, depth: int, bounds=UNIT_BOUNDS) -> DataFrame:
    """(depth, cell, n, sum, mean) of every non-empty cell of one depth; one shuffle."""
    dims = len(feature_columns(df, features))
    return _describe(leaf_stats(df, features, depth, bounds).withColumn("depth", F.lit(depth)), dims, depth)


def levels(df: DataFrame, features, depth: int, bounds=UNIT_BOUNDS) -> DataFrame:
    """(depth, cell, n, sum, mean) of all depths 1..``depth`` from a single scan of the rows.

    Both branches of the union start from the same leaf aggregation, which Spark computes once.
    """
    dims = len(feature_columns(df, features))
    leaf = leaf_stats(df, features, depth, bounds)
    tree = leaf.withColumn("depth", F.lit(depth))
    if depth > 1:
        tree = tree.unionByName(roll_up(leaf, dims, depth, range(1, depth)))
    return _describe(tree, dims, depth)


def geometry(stats: DataFrame, dims: int, bounds=UNIT_BOUNDS) -> DataFrame:
    """Append the box of every cell: arrays ``lo``, ``hi`` and the split point ``threshold``.

    ``bounds`` are those that the cells were made with, a pair for all dimensions or for each."""
    pairs = _pairs(bounds, dims)
    parts = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("depth")).cast("double")
    side = [F.lit(high - low) / parts for low, high in pairs]
    at = [F.lit(low) + F.get("cell", F.lit(j)).cast("double") * side[j] for j, (low, _) in enumerate(pairs)]
    return (
        stats.withColumn("lo", F.array(*at))
        .withColumn("hi", F.array(*[a + s for a, s in zip(at, side)]))
        .withColumn("threshold", F.array(*[a + s / F.lit(2.0) for a, s in zip(at, side)]))
    )


def instance_ratio_by_depth(tree: DataFrame) -> DataFrame:
    """(depth, n_cells, n_rows, instance_ratio) of a ``levels`` table."""
    return tree.groupBy("depth").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.sum("n").alias("n_rows"),
        (F.count(F.lit(1)) / F.sum("n")).alias("instance_ratio"),
    )


class CellLevels:
    """Levels of one table, written to the shared folder and built as they are asked for."""

    def __init__(self, df: DataFrame, features, bounds=UNIT_BOUNDS):
        self.df, self.features, self.bounds = df, features, box(df, features, bounds)
        self.dims = len(feature_columns(df, features))
        self.scratch = Scratch(df.sparkSession)
        self.cells: dict[int, int] = {}
        self.variance: dict[int, float] = {}
        self.n_rows = 0
        self._lock = Lock()
        self._leaf: tuple[int, DataFrame] | None = None
        self._tables: list[tuple[list[int], int, DataFrame]] = []

    def require(self, depth: int, deepest: int = 0) -> None:
        """Make level ``depth`` available. Should the rows have to be scanned, cells are formed down to
        ``deepest``, from which later levels are rolled up without another scan.

        When the leaf cells are few against the rows, all levels in between come from one roll-up.
        Otherwise every level is about as large as the table, and each is built only when asked for. Several fits may
        ask at the same time.
        """
        with self._lock:
            self._make(depth, deepest)

    def _make(self, depth: int, deepest: int) -> None:
        if depth in self.cells:
            return
        if self._leaf is None or depth > self._leaf[0]:
            deepest = min(MAX_DEPTH, max(depth, deepest))
            leaf = self.scratch.write(leaf_stats(self.df, self.features, deepest, self.bounds), f"leaf{deepest}")
            self._leaf = (deepest, leaf)
            self._register([deepest], deepest, leaf.withColumn("depth", F.lit(deepest)))
        at, leaf = self._leaf
        if depth in self.cells:
            return
        compact = 2 * self.cells[at] <= self.n_rows
        missing = [i for i in range(depth, at) if i not in self.cells] if compact else [depth]
        upper = self.scratch.write(roll_up(leaf, self.dims, at, missing), f"above{at}-{depth}", "depth")
        self._register(missing, at, upper)

    def first_with(self, count: int, ahead: int = 0) -> int | None:
        """The first level with at least ``count`` cells, or ``None`` if there is none down to ``MAX_DEPTH``.

        The descent ends early once every row has a cell of its own. Rows that crowd into few cells, as when
        outliers set the box, are scanned again for twice the depth, so a handful of times at most.
        """
        depth = 1
        while True:
            self.require(depth, ahead + max(1, 2 * (depth - 1)))
            leaf, _ = self._leaf
            if self.cells[leaf] >= count or leaf == MAX_DEPTH:
                low, high = depth, leaf  # cells never get fewer with depth
                while low < high:
                    middle = (low + high) // 2
                    self.require(middle)
                    low, high = (low, middle) if self.cells[middle] >= count else (middle + 1, high)
                self.require(low)
                return low if self.cells[low] >= count else None
            if self.cells[leaf] == self.n_rows:
                return None
            depth = leaf + 1

    def _register(self, depths: list[int], packed: int, table: DataFrame) -> None:
        spread = sum(F.var_pop(F.col(f"s{j}") / F.col("n")) for j in range(self.dims)) / F.lit(self.dims)
        facts = table.groupBy("depth").agg(
            F.count(F.lit(1)).alias("cells"), F.sum("n").alias("rows"), spread.alias("variance"),
            F.count_if(F.col("w0").isNull()).alias("bad"),
        ).collect()
        if not facts:
            raise ValueError("cannot fit an empty table")
        if any(row["bad"] for row in facts):
            raise ValueError("features contain null, NaN or infinite values")
        for row in facts:
            self.cells[row["depth"]], self.variance[row["depth"]] = row["cells"], row["variance"]
            self.n_rows = row["rows"]
        self._tables.append((depths, packed, table))

    def points(self, *depths: int) -> DataFrame:
        """Representatives of some levels: means ``x0..``, weight ``w``, ``depth``, packed keys ``w0..``.
        The filter on the depth prunes the scan to the files of these levels."""
        frames = []
        for covered, packed, table in self._tables:
            wanted = [i for i in depths if i in covered]
            if wanted:
                keys = [f"w{i}" for i in range(_word_count(self.dims, packed))]
                frames.append(table.where(F.col("depth").isin(wanted)).select(
                    *[(F.col(f"s{j}") / F.col("n")).alias(f"x{j}") for j in range(self.dims)],
                    F.col("n").cast("double").alias("w"), "depth", *keys))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def coordinates(self, depth: int) -> list[Column]:
        """Cell coordinates of a ``points`` frame of that depth."""
        packed = next(packed for covered, packed, _ in self._tables if depth in covered)
        return _unpack(self.dims, packed, depth)

    def drop(self) -> None:
        self.scratch.drop()


def _is_auto(bounds) -> bool:
    return isinstance(bounds, str) and bounds == "auto"


def _pairs(bounds, dims: int) -> tuple[tuple[float, float], ...]:
    if isinstance(bounds, str):
        raise ValueError(f"{bounds!r} is no box; give a pair for all dimensions or for each")
    nested = len(bounds) > 0 and not isinstance(bounds[0], (int, float))
    pairs = tuple((float(lo), float(hi)) for lo, hi in (bounds if nested else [bounds] * dims))
    if len(pairs) != dims or not all(lo < hi and isfinite(hi - lo) for lo, hi in pairs):
        raise ValueError(f"bounds need a low and a higher high for each of {dims} dimensions")
    return pairs


def _coordinate_type(depth: int) -> str:
    return "int" if depth <= _INT_DEPTH else "bigint"


def _check_depth(depth: int) -> None:
    if not 1 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be in 1..{MAX_DEPTH}, not {depth}")


def _per_word(depth: int) -> int:
    return 63 // depth


def _word_count(dims: int, depth: int) -> int:
    return -(-dims // _per_word(depth))


def _pack(coordinates: Sequence[Column], depth: int) -> list[Column]:
    per = _per_word(depth)
    words = []
    for start in range(0, len(coordinates), per):
        parts = [F.shiftleft(c, depth * j) for j, c in enumerate(coordinates[start:start + per])]
        words.append(reduce(Column.bitwiseOR, parts))
    return words


def _unpack(dims: int, packed_depth: int, depth: int) -> list[Column]:
    per = _per_word(packed_depth)
    return [
        F.shiftright(F.col(f"w{j // per}"), packed_depth * (j % per) + packed_depth - depth)
        .bitwiseAND(F.lit(2**depth - 1))
        .cast(_coordinate_type(depth))
        for j in range(dims)
    ]


def _masks(dims: int, leaf_depth: int, depth: int) -> list[int]:
    per = _per_word(leaf_depth)
    keep = (2**depth - 1) << (leaf_depth - depth)
    return [
        int(sum(keep << (leaf_depth * j) for j in range(min(per, dims - start))))
        for start in range(0, dims, per)
    ]


def _describe(tree: DataFrame, dims: int, packed_depth: int) -> DataFrame:
    per = _per_word(packed_depth)
    cell = [
        F.shiftright(F.col(f"w{j // per}"), packed_depth * (j % per))
        .bitwiseAND(F.lit(2**packed_depth - 1))
        .cast(_coordinate_type(packed_depth))
        for j in range(dims)
    ]
    up = F.lit(packed_depth) - F.col("depth")
    shifted = [F.call_function("shiftright", c, up) for c in cell]
    return tree.select(
        "depth",
        F.array(*shifted).alias("cell"),
        "n",
        F.array(*[F.col(f"s{j}") for j in range(dims)]).alias("sum"),
        F.array(*[F.col(f"s{j}") / F.col("n") for j in range(dims)]).alias("mean"),
    )
