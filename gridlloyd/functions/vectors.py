"""Column expressions over feature vectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def feature_columns(df: DataFrame, features: str | Sequence[str], size: int | None = None) -> list[Column]:
    """One DOUBLE expression per dimension.

    ``features`` names numeric columns, or a single array / ML-vector column; for the latter ``size``
    saves looking at one row to learn the width. A row of another width raises an error when it is read;
    a null array yields nulls.
    """
    names = [features] if isinstance(features, str) else list(features)
    if len(names) == 1:
        dtype = df.schema[names[0]].dataType
        column = F.col(names[0])
        if isinstance(dtype, VectorUDT):
            column = vector_to_array(column)
        if isinstance(dtype, (VectorUDT, ArrayType)):
            if size is None:
                head = df.where(column.isNotNull()).select(F.size(column).alias("size")).head(1)
                if not head:
                    raise ValueError(f"cannot infer the width of {names[0]} from an empty table")
                size = head[0]["size"]
            same = column.isNull() | (F.size(column) == size)
            checked = F.when(same, column).otherwise(F.raise_error(F.lit(f"{names[0]} must hold {size} values in every row")))
            return [F.get(checked, F.lit(j)).cast("double") for j in range(size)]
    return [F.col(name).cast("double") for name in names]


def squared_distance(xs: Sequence[Column], center: Sequence[float]) -> Column:
    """Squared Euclidean distance between a row and a constant point."""
    return reduce(add, [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(xs, center)])


def euclidean_norm(xs: Sequence[Column], center: Sequence[float] | None = None) -> Column:
    """Row-wise Euclidean norm of (row - center)."""
    return F.sqrt(squared_distance(xs, center if center is not None else [0.0] * len(xs)))


def all_finite(xs: Sequence[Column]) -> Column:
    """True when no value is null, NaN or infinite (anything else times zero is zero)."""
    return F.coalesce(reduce(add, [x * F.lit(0.0) for x in xs]) == F.lit(0.0), F.lit(False))


def bits_to_int(bits: Sequence[Column]) -> Column:
    """Pack boolean columns into a BIGINT; the first one is the least significant bit."""
    return reduce(add, [F.shiftleft(b.cast("bigint"), j) for j, b in enumerate(bits)])


def int_to_bits(value: Column, width: int) -> list[Column]:
    """The ``width`` lowest bits of an integer column as booleans, least significant first."""
    return [F.shiftright(value, j).bitwiseAND(F.lit(1)) == 1 for j in range(width)]
