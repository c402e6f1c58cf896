"""Importance resampling: texts are drawn by how much likelier a target model makes them than a raw one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import joined, map_columns, raw_texts, slices, without
from .rolling import MULTIPLIER, RangeHashes, mixed

#: Hash buckets of the n-gram models.
BUCKETS = 10_000
#: Labelled rows that the target model is fitted on, at most; by the hash of the id.
MAX_LABELLED = 100_000
#: Bins of one step of the search for the k-th largest key, and candidates that end it.
_BINS, _CANDIDATES = 4096, 10_000
_SPACE, _WORD, _MARK = 0, 1, 2
_CLASS = np.array([
    _WORD if b >= 128 or chr(b).isalnum() or chr(b) == "_" else _SPACE if chr(b) in " \t\n\x0b\x0c\r" else _MARK
    for b in range(256)], "uint8")


def ngram_buckets(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams of tokens, the text of each, and the tokens of each text.

    A token is a run of word characters or of marks; case counts.
    """
    data, starts, ends = joined(values)
    kind = _CLASS[data]
    edge = kind[1:] != kind[:-1]
    begin = np.flatnonzero((kind > 0) & np.concatenate([[True], edge]))
    end = np.flatnonzero((kind > 0) & np.concatenate([edge, [True]])) + 1
    hashes = RangeHashes(data)(begin, end)
    owner = np.searchsorted(starts, begin, "right") - 1
    pairs = mixed(hashes[:-1] * np.uint64(MULTIPLIER) + hashes[1:])[owner[:-1] == owner[1:]]
    buckets = (np.concatenate([hashes, pairs]) % np.uint64(BUCKETS)).astype("int64")
    return (buckets, np.concatenate([owner, owner[:-1][owner[:-1] == owner[1:]]]),
            np.bincount(owner, minlength=len(values)))


def _target_ids(labels: DataFrame, id_type: str) -> DataFrame:
    """Ids of labelled rows of quality 1 that are not toxic, from a sample of bounded size."""
    sample = labels.where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    return sample.groupBy(F.col("doc_id").cast(id_type).alias("__labelled")).agg(
        F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and t = 0").select("__labelled")


def log_ratios(df: DataFrame, targets: DataFrame, doc_id: str, text: str) -> np.ndarray:
    """Log of target over raw probability of each bucket, counted over all texts, with one added to each count.

    Every task sends one count per bucket and model; ``targets`` is broadcast, its size being bounded.
    """
    marked = df.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(
        F.broadcast(targets), F.col("__id") == F.col("__labelled"), "left")
    marked = marked.select("__text", F.col("__labelled").isNotNull().alias("__target"))

    def run(batches):
        raw, target = np.zeros(BUCKETS, "int64"), np.zeros(BUCKETS, "int64")
        for batch in batches:
            for part in slices(batch, "__text"):
                buckets, owner, _ = ngram_buckets(raw_texts(part.column(0)))
                raw += np.bincount(buckets, minlength=BUCKETS)
                chosen = part.column(1).to_numpy(zero_copy_only=False).astype(bool)[owner]
                target += np.bincount(buckets[chosen], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)],
                                         names=["bucket", "raw", "target"])

    counts = marked.mapInArrow(run, "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    table = np.zeros((2, BUCKETS))
    for row in counts.collect():  # at most BUCKETS rows
        table[:, row["bucket"]] = row["target"], row["raw"]
    smooth = np.log(table + 1) - np.log(table.sum(axis=1, keepdims=True) + BUCKETS)
    return smooth[0] - smooth[1]


def _cut_off(keys: DataFrame, k: int) -> float:
    """The k-th largest ``key``, found by counting ever finer bins in Spark."""
    ends = keys.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
    low, high, above = ends["low"], ends["high"], 0
    inside = F.lit(True)
    while True:
        width = (high - low) / _BINS
        if width <= 0 or low + width == low:
            return low
        bin_of = F.least(F.floor((F.col("key") - low) / width), F.lit(_BINS - 1))
        counts = sorted(keys.where(inside).groupBy(bin_of.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect(), reverse=True)
        for row in counts:
            if above + row["n"] >= k:
                break
            above += row["n"]
        low, high = row["low"], row["high"]
        inside = F.col("key").between(low, high)
        if row["n"] <= _CANDIDATES:
            rest = sorted((r["key"] for r in keys.where(inside).select("key").collect()), reverse=True)
            return rest[k - above - 1]


def resample(df: DataFrame, labels: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text",
             seed: int = 0, size: int | None = None) -> DataFrame:
    """Per row, instead of its text: ``log_weight``, ``gumbel_key`` and ``kept``, whether it is in the sample.

    ``log_weight`` is the log of the target model's over the raw model's probability of the text's n-grams.
    The target model counts the texts labelled as of quality 1 and not toxic (``MAX_LABELLED`` labels at
    most), the raw one all texts. Adding Gumbel noise, a hash of seed and id, and taking the ``size``
    largest keys draws without replacement in proportion to the weights. By default ``size`` is the share
    of quality 1 among the labels, times the rows.

    Rows without a token (null, empty) have weight and key null and are not kept. Equal rows have equal
    keys; if the last place falls to a tie, all of the tie are kept. Without labels of the target kind the
    target model is uniform.
    """
    id_type = df.schema[doc_id].dataType.simpleString()
    ratios = df.sparkSession.sparkContext.broadcast(log_ratios(df, _target_ids(labels, id_type), doc_id, text))

    def fn(column: pa.Array):
        buckets, owner, tokens = ngram_buckets(raw_texts(column))
        weights = np.bincount(owner, weights=ratios.value[buckets], minlength=len(column))
        return [pa.array(weights, mask=tokens == 0)]

    uniform = (F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    weighed = map_columns(df, text, "log_weight double", fn, drop=[text])
    weighed = weighed.select(*without(weighed, ["gumbel_key", "kept", "log_weight"]), "log_weight", (
        F.col("log_weight") - F.log(-F.log(uniform))).alias("gumbel_key"))
    weighed = scratch.write(weighed, "weighed")
    if size is None:
        share = labels.agg((F.sum((F.col("quality") == 1).cast("long")) / F.count("quality")).alias("s")).first()["s"]
        size = round((share or 0.0) * weighed.count())
    keys = weighed.where("gumbel_key is not null").select(F.col("gumbel_key").alias("key"))
    least = _cut_off(keys, size) if 0 < size <= keys.count() else float("-inf") if size else float("inf")
    return weighed.withColumn("kept", F.coalesce(F.col("gumbel_key") >= F.lit(least), F.lit(False)))
