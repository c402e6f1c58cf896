"""Line deduplication: two Bloom filters find suspects, and only suspects are shuffled and confirmed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import join_unique, map_columns, raw_texts, slices, without

#: Most bits of a filter (64 MiB). Beyond, more lines are suspects than need be; results stay exact.
MAX_FILTER_BITS = 1 << 29
#: Filter bits for each row of the table.
BITS_PER_ROW = 256
#: Bits of a filter segment, the unit in which filters are merged.
SEGMENT_BITS = 1 << 20
_SALTS = 16
_SPACES = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least: int) -> bytes | None:
    """The line stripped of white space and lower-cased (A-Z); None below ``least`` code points."""
    key = line.strip(_SPACES).lower()
    if len(key) < least or len(key) < 4 * least and len(key.decode()) < least:
        return None
    return blake2b(key, digest_size=16).digest()


def _digests(value: bytes, least: int) -> set[bytes]:
    keys = {line_key(line, least) for line in value.split(b"\n")}
    keys.discard(None)
    return keys


def _numbers(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def _bits(numbers: np.ndarray, bits: int) -> np.ndarray:
    """The two filter bits of each key."""
    return (numbers.astype("uint64") & np.uint64(bits - 1)).astype("int64")


_FILTER = "segment int, salt int, once binary, twice binary"


def _segments(once: np.ndarray, twice: np.ndarray, salt: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Sorted bit places of both filters, cut into segments."""
    for s in np.unique(once // SEGMENT_BITS).tolist():
        yield s, salt, *[
            (x[np.searchsorted(x, s * SEGMENT_BITS):np.searchsorted(x, (s + 1) * SEGMENT_BITS)] - s * SEGMENT_BITS)
            .astype("<u4").tobytes() for x in (once, twice)]


def _filter_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["segment", "salt", "once", "twice"])


def _task_filters(text: str, bits: int, least: int):
    """The filters of a task's lines: all keys in the first, keys of two rows or more in the second."""
    def run(batches):
        found, salt = [np.zeros((0, 2), "<i8")], 0
        for batch in batches:
            for part in slices(batch, text):
                digests = [d for v in raw_texts(part.column(text)) for d in _digests(v, least)]
                if digests:
                    found.append(_numbers(digests))
        keys, counts = np.unique(np.concatenate(found), axis=0, return_counts=True)
        if len(keys):
            salt = int(keys[0, 1]) % _SALTS
            rows = list(_segments(np.unique(_bits(keys, bits)), np.unique(_bits(keys[counts > 1], bits)), salt))
            for i in range(0, len(rows), 64):
                yield _filter_batch(rows[i:i + 64])

    return run


def _folded(batches) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Both filters by segment: a bit seen in two filters of a segment counts as seen twice."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, first, second in zip(*(batch.column(c).to_pylist() for c in ("segment", "once", "twice"))):
            o = once.setdefault(segment, np.zeros(SEGMENT_BITS, bool))
            t = twice.setdefault(segment, np.zeros(SEGMENT_BITS, bool))
            places = np.frombuffer(first, "<u4")
            t[places[o[places]]] = True
            t[np.frombuffer(second, "<u4")] = True
            o[places] = True
    return once, twice


def _merge(batches):
    """Fold filters segment by segment."""
    once, twice = _folded(batches)
    for segment in once:
        yield _filter_batch([(segment, 0, *[
            np.flatnonzero(x[segment]).astype("<u4").tobytes() for x in (once, twice)])])


def _merge_to_maps(batches):
    """Fold filters segment by segment into the bit maps of what was seen twice."""
    for segment, seen in _folded(batches)[1].items():
        packed = np.packbits(seen, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([packed], pa.binary())], names=["segment", "map"])


def twice_filter(df: DataFrame, text: str, bits: int, least: int) -> bytes:
    """The filter of keys seen twice, as a bit map of ``bits`` bits.

    Each task sends the set bits of its own two filters; they are folded in two levels, by segment and
    salt, then by segment. The driver receives a bit map of bounded size, whatever the input.
    """
    parts = df.select(text).mapInArrow(_task_filters(text, bits, least), _FILTER)
    parts = parts.repartition("segment", "salt").mapInArrow(_merge, _FILTER)
    maps = parts.repartition("segment").mapInArrow(_merge_to_maps, "segment int, map binary")
    whole = bytearray(bits // 8)
    width = SEGMENT_BITS // 8
    for row in maps.collect():
        at = row["segment"] * width
        whole[at:at + width] = row["map"][:len(whole) - at]
    return bytes(whole)


@lru_cache(maxsize=1)
def _bitmap(content: bytes) -> np.ndarray:
    return np.frombuffer(content, "uint8")


def drop_repeated_lines(df: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text",
                        least: int = 10) -> DataFrame:
    """Append ``n_lines`` (before dropping), ``n_dropped`` and ``clean_text``, the other lines in order.

    A line counts by its key: stripped of white space, A-Z lower-cased. Keys of at least ``least`` code
    points that two documents or more hold lose their lines everywhere but in the document with the
    smallest id, which keeps all of them.

    A first pass fills a Bloom filter with the keys seen and another with those seen twice; the second,
    of bounded size, is broadcast. A second pass sends only (id, 128-bit digest of the key) of suspects;
    aggregation confirms them and finds the smallest id, and documents meet the keys they lose by id. A
    key that a third of all documents share is pre-aggregated, and its rows are dealt over all tasks.

    Rows with equal ids are one document; null ids count as one document after all others. A null or
    empty text is one empty line. All rows stay.
    """
    rows = df.count()
    bits = min(MAX_FILTER_BITS, max(SEGMENT_BITS, 1 << (rows * BITS_PER_ROW).bit_length()))
    content = df.sparkSession.sparkContext.broadcast(twice_filter(df, text, bits, least))

    def suspects(batches):
        seen = _bitmap(content.value)
        for batch in batches:
            for part in slices(batch, text):
                owners, digests = [], []
                for i, value in enumerate(raw_texts(part.column(text))):
                    keys = _digests(value, least)
                    digests += keys
                    owners += [i] * len(keys)
                if not digests:
                    continue
                numbers = _numbers(digests)
                places = _bits(numbers, bits)
                hit = ((seen[places >> 3] >> (places & 7).astype("uint8")) & 1).all(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("__id").take(pa.array(np.array(owners)[hit])),
                     *[pa.array(np.ascontiguousarray(numbers[hit, j])) for j in (0, 1)]], names=["__id", "d1", "d2"])

    id_type = df.schema[doc_id].dataType.simpleString()
    found = scratch.write(df.select(F.col(doc_id).alias("__id"), text).mapInArrow(
        suspects, f"__id {id_type}, d1 bigint, d2 bigint"), "suspects")
    groups = (
        found.groupBy("d1", "d2").agg(F.min("__id").alias("first"), F.max("__id").alias("last"),
                                      F.count("__id").alias("named"), F.count(F.lit(1)).alias("copies"))
        .where("first < last or (named > 0 and named < copies)").select("d1", "d2", "first", "copies"))
    lost = join_unique(found, groups, ["d1", "d2"], "copies", max(found.count(), 1), ["__id", "d1"])
    lost = lost.where(F.col("first").isNotNull() & ~F.col("__id").eqNullSafe(F.col("first")))
    drops = lost.groupBy("__id").agg(F.collect_set(F.struct("d1", "d2")).alias("__drop"))
    both = df.join(drops, df[doc_id].eqNullSafe(drops["__id"]), "left").drop("__id")

    def fn(part: pa.RecordBatch):
        out, n_lines, n_dropped = [], [], []
        for value, drop in zip(raw_texts(part.column(text)), part.column("__drop").to_pylist()):
            lines = value.split(b"\n")
            n_lines.append(len(lines))
            if drop:
                gone = {np.array([d["d1"], d["d2"]], "<i8").tobytes() for d in drop}
                lines = [line for line in lines if line_key(line, least) not in gone]
            n_dropped.append(n_lines[-1] - len(lines))
            out.append(b"\n".join(lines))
        return [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]

    cleaned = map_columns(both, text, "n_lines bigint, n_dropped bigint, clean_text string", fn, drop=["__drop"],
                          with_batch=True)
    return cleaned.select(*without(cleaned, ["__drop"]))
