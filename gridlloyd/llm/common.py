"""What the corpus operators share: Arrow-batched columns, byte buffers of texts, balanced joins.

Rules that hold for all of them: a null text counts as empty; rows with equal or null ids are all
kept; extra columns pass through, and a column with the name of an output column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a task works on at a time.
SLICE_BYTES = 2 << 20
#: A key is hot if it holds more than one row in so many; hence there are fewer hot keys than this.
HOT_SHARE = 1000
_SALTS = 4096


def slices(batch: pa.RecordBatch, name: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``size`` bytes of the column; a longer row is its own run."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype("int64")
    total = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + size, "right")))
        yield batch.slice(start, end - start)
        start = end


def texts(column: pa.Array) -> list[str]:
    return [v or "" for v in column.to_pylist()]


def raw_texts(column: pa.Array) -> list[bytes]:
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def joined(values: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts in one byte array, a newline after each, with the start and end of every text."""
    ends = np.cumsum(np.fromiter((len(v) + 1 for v in values), "int64", len(values))) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).astype("int64") if len(values) else np.zeros(0, "int64")
    return np.frombuffer(b"\n".join([*values, b""]), "uint8"), starts, ends


def same_name(a: str, b: str) -> bool:
    return a.lower() == b.lower()


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns of ``df`` other than ``names``."""
    return [c for c in df.columns if not any(same_name(c, n) for n in names)]


def map_columns(df: DataFrame, source: str, outputs: str, fn: Callable[[pa.Array], Sequence[pa.Array]],
                drop: Sequence[str] = (), with_batch: bool = False, size: int = SLICE_BYTES) -> DataFrame:
    """Append the columns ``outputs`` (DDL), computed by ``fn`` from Arrow slices of ``size`` bytes of the column ``source``.

    The other columns pass through, except ``drop`` and those that an output replaces.
    """
    new = StructType.fromDDL(outputs)
    kept = without(df, [f.name for f in new] + list(drop))
    schema = StructType([df.schema[c] for c in kept] + list(new))

    def run(batches):
        for batch in batches:
            for part in slices(batch, source, size):
                made = fn(part) if with_batch else fn(part.column(source))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *made], names=schema.names)

    return df.mapInArrow(run, schema)


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], weight: str, total: int,
                spread: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to a table with unique keys, whatever share of the rows a key holds.

    ``weight`` is a column of ``right`` that counts the key's rows in ``left``, ``total`` the sum of all
    rows. Keys with more than a ``HOT_SHARE``-th of the rows, so fewer than ``HOT_SHARE`` of them, are
    broadcast; the rest meet in a shuffle, into which the rows of hot keys are dealt by ``spread``.
    """
    values = [c for c in right.columns if c not in keys]
    is_hot = F.col(weight) * HOT_SHARE > F.lit(total)
    hot = right.where(is_hot).select(*keys, F.struct(*values).alias("__hot"))
    zero = F.when(F.col(weight) < 0, 1).otherwise(0).cast("long")  # not a literal: the salt has to stay a join key
    cold = right.where(~is_hot).select(*keys, F.struct(*values).alias("__cold"), zero.alias("__salt"))
    dealt = left.join(F.broadcast(hot), list(keys), "left").withColumn(
        "__salt", F.when(F.col("__hot").isNull(), F.lit(0).cast("long"))
        .otherwise(1 + F.pmod(F.xxhash64(*spread), F.lit(_SALTS))))
    found = dealt.join(cold.hint("shuffle_merge"), [*keys, "__salt"], "left")
    if how == "inner":
        found = found.where(F.coalesce("__hot", "__cold").isNotNull())
    return found.select(*left.columns, *[
        F.coalesce(F.col(f"__hot.{v}"), F.col(f"__cold.{v}")).alias(v) for v in values])


def same_or_null(left: DataFrame, right: DataFrame, names: Sequence[str]):
    """Join condition under which null equals null."""
    condition = F.lit(True)
    for n in names:
        condition = condition & left[n].eqNullSafe(right[n])
    return condition
