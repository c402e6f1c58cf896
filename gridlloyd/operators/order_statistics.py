"""Exact order statistics of numeric columns without a sort."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of one counting pass, and rows of a bin that are few enough to be looked at one by one.
BINS, FEW_ROWS = 4096, 10_000


def ranked_values(df: DataFrame, column: str, ranks: Sequence[int]) -> dict[int, float]:
    """The value of each rank (from 0) among the non-null values of a column.

    The range is cut into bins and counted; a bin that holds a wanted rank is cut again until it has one
    value or few rows. What reaches the driver is bounded, whatever the number of rows or of equal values.
    """
    x = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    ends = x.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n")).first()
    found: dict[int, float] = {}
    open_ranges = [(ends["low"], ends["high"], 0, ends["n"], sorted({r for r in ranks if 0 <= r < ends["n"]}))]
    while open_ranges:
        low, high, below, n, wanted = open_ranges.pop()
        width = (high - low) / BINS if wanted else 0.0
        if width <= 0 or low + width == low:
            found.update((r, low) for r in wanted)
            continue
        inside = x.where(F.col("x").between(low, high))
        if n <= FEW_ROWS:
            values = sorted(row["x"] for row in inside.collect())
            found.update((r, values[r - below]) for r in wanted)
            continue
        bin_of = F.least(F.floor((F.col("x") - low) / width), F.lit(BINS - 1))
        for row in sorted(inside.groupBy(bin_of.alias("b")).agg(
                F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()):
            here = [r for r in wanted if below <= r < below + row["n"]]
            if here:
                open_ranges.append((row["low"], row["high"], below, row["n"], here))
            below += row["n"]
    return found


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Exact quantiles, interpolated linearly between neighbouring values; null for a column without any."""
    n = df.select(F.count(F.col(column).cast("double"))).first()[0]
    if not n:
        return [None] * len(shares)
    places = [share * (n - 1) for share in shares]
    values = ranked_values(df, column, [f(p) for p in places for f in (floor, ceil)])
    return [values[floor(p)] + (p - floor(p)) * (values[ceil(p)] - values[floor(p)]) for p in places]
