"""Random choices keyed on row identity.

``rand()`` depends on the physical row order, so a recomputed task may draw other numbers. Here every
number is a hash of (seed, row id): the same row draws the same number on any cluster and in any
retry. ``md5`` is available in every SQL engine; ``xxhash64`` is cheaper per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def keyed_hash(seed: int | str, ids: Sequence[str | Column], method: str = "xxhash64") -> Column:
    """Uniform BIGINT in [0, 2^60) from a seed and the row id."""
    columns = [F.col(c) if isinstance(c, str) else c for c in ids]
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(str(seed)), *columns), 64 - HASH_BITS)
    if method == "md5":
        text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns])
        return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method {method!r}; use 'xxhash64' or 'md5'")


def keyed_uniform(seed: int | str, ids: Sequence[str | Column], method: str = "xxhash64") -> Column:
    """Uniform DOUBLE in (0, 1)."""
    return (keyed_hash(seed, ids, method) + F.lit(0.5)) / F.lit(float(2**HASH_BITS))


def keyed_normal(seed: int | str, ids: Sequence[str | Column], method: str = "xxhash64") -> Column:
    """Standard normal DOUBLE (Box-Muller on two keyed uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(keyed_uniform(f"{seed}|a", ids, method)))
    return radius * F.cos(F.lit(2.0 * pi) * keyed_uniform(f"{seed}|b", ids, method))
