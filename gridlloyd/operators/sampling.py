"""Exact sampling and global numbering without a single-task sort."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.randomness import HASH_BITS, keyed_hash
from ..session import Scratch

#: Up to this many rows a top-n heap per task is cheaper than finding the cut-off first.
DIRECT_ROWS = 1000
_DIGIT = 12


def sample_rows(df: DataFrame, n: int, ids: Sequence[str], seed: int = 0, method: str = "xxhash64") -> DataFrame:
    """Exactly ``n`` rows, uniformly and without replacement: the rows with the smallest keyed hashes.

    For larger ``n`` the n-th smallest hash is located by counting hash prefixes (a few map-side
    aggregations of at most 4096 groups), so that the sample itself is a plain filter: no sort, no
    shuffle of rows. ``ids`` must identify a row.
    """
    return smallest_rows(df, n, keyed_hash(seed, ids, method), ids)


def smallest_rows(df: DataFrame, n: int, h: Column, ids: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the smallest hash ``h``, equal hashes in the order of ``ids``."""
    if n < 0:
        raise ValueError("n must not be negative")
    order = [h, *[F.col(c) for c in ids]]
    if n <= DIRECT_ROWS:
        return df.orderBy(*order).limit(n)
    keyed = df.select(order[0].alias("h"), *ids)
    shift, prefix, below = HASH_BITS, 0, 0
    while shift > 0:
        inside = keyed.where(F.shiftright("h", shift) == prefix) if shift < HASH_BITS else keyed
        shift -= _DIGIT
        counts = sorted(inside.groupBy(F.shiftright("h", shift).alias("p")).count().collect())
        if below + sum(c for _, c in counts) <= n:
            if shift == HASH_BITS - _DIGIT:
                return df
        for prefix, count in counts:
            if below + count >= n:
                break
            below += count
        if n - below <= DIRECT_ROWS:
            break
    last = (
        keyed.where(F.shiftright("h", shift) == prefix).orderBy("h", *ids).limit(n - below)
        .agg(F.max(F.struct("h", *ids)).alias("cut")).first()["cut"])
    types = {f.name: f.dataType for f in df.schema}
    limit = F.struct(F.lit(last["h"]).cast("bigint").alias("h"), *[F.lit(last[c]).cast(types[c]).alias(c) for c in ids])
    return df.where(F.struct(order[0].alias("h"), *ids) <= limit)


def sample_columns(df: DataFrame, n: int, seed: int = 0, among: Sequence[str] | None = None) -> DataFrame:
    """A random subset of ``n`` columns; the scan then reads only those."""
    names = list(among if among is not None else df.columns)
    return df.select(*random.Random(seed).sample(names, n))


def with_running_total(df: DataFrame, order: Sequence[Column | str], weight: Column, scratch: Scratch,
                       index: str = "idx", before: str | None = "before", folder: str = "") -> DataFrame:
    """Number rows 0.. in sort order and append the summed weight of all rows before each, if ``before`` names it.

    A range-partitioned sort is written once; every part then needs only the totals of the parts
    before it, a list as short as the number of parts.
    """
    part = F.shiftright("__at", 33)
    ordered = df.withColumn("__weight", weight).sort(*order).withColumn("__at", F.monotonically_increasing_id())
    table = scratch.write(ordered, folder or f"ordered-{index}").withColumn("__part", part)
    totals = table.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.sum("__weight").alias("w")).collect()
    offsets, rows, weights = [], 0, 0
    for row in sorted(totals):
        offsets.append((row["__part"], rows, weights))
        rows, weights = rows + row["n"], weights + row["w"]
    spark = df.sparkSession
    starts = spark.createDataFrame(offsets, "__part bigint, __rows bigint, __sum bigint")
    found = table.join(F.broadcast(starts), "__part").withColumn(
        index, F.col("__rows") + F.col("__at").bitwiseAND(F.lit(2**33 - 1)))
    if before:
        inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn(before, F.col("__sum") + F.coalesce(F.sum("__weight").over(inside), F.lit(0)))
    return found.drop("__part", "__at", "__rows", "__sum", "__weight")
