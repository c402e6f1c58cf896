"""Lookup joins by proven size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BOUNDED_BYTES


def lookup(df: DataFrame, table: DataFrame, key: str, table_bytes: int, how: str = "left") -> DataFrame:
    """Join a lookup table with unique keys, ``table_bytes`` being the size of its values.

    A table of proven small size is broadcast. A larger one meets the rows in a sort-merge join; there
    Spark splits the partitions of keys that hold a large share of ``df`` (adaptive skew join).
    """
    small = table_bytes <= BOUNDED_BYTES
    return df.join(F.broadcast(table) if small else table.hint("shuffle_merge"), key, how)
