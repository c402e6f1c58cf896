"""Benchmark decontamination: word windows of test items are found in documents and cut out."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined, map_columns, raw_texts, slices
from .rolling import MULTIPLIER, RangeHashes, mixed

#: Most windows of test items in one broadcast block; their texts take some 100 bytes each.
BLOCK_WINDOWS = 250_000
#: Bytes of text hashed at a time; the arrays of ``RangeHashes`` take some 40 times as many, and a worker keeps them.
HASHED_BYTES = 1 << 18
_LOWER = np.arange(256, dtype="uint8")
_LOWER[ord("A"):ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0"):ord("9") + 1] = _IN_WORD[ord("a"):ord("z") + 1] = _IN_WORD[128:] = True
_FILTER_BITS = 20


@dataclass
class Words:
    """The normalised words of some texts: byte array, start and end of each word, word range of each text."""

    bytes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, values: list[bytes]) -> Words:
        raw, text_starts, text_ends = joined(values)
        low = _LOWER[raw]
        inside = _IN_WORD[low]
        edges = np.diff(np.concatenate([[False], inside, [False]]).astype("int8"))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        return cls(low, starts, ends, np.searchsorted(starts, text_starts), np.searchsorted(starts, text_ends),
                   RangeHashes(low)(starts, ends))

    def windows(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on; meaningless where the text ends before."""
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.zeros(0, "uint64")
        total = np.zeros(n, "uint64")
        for j in range(length):
            total = total * np.uint64(MULTIPLIER) + self.hashes[j:j + n]
        return mixed(total)

    def text(self, i: int, length: int) -> bytes:
        return b" ".join(self.bytes[self.starts[k]:self.ends[k]].tobytes() for k in range(i, i + length))


def item_windows(benchmark: DataFrame, size: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The distinct windows of each item: ``item``, ``window`` (normalised words), ``length``."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, text, HASHED_BYTES):
                rows = set()
                words = Words.of(raw_texts(part.column(1)))
                for item, a, b in zip(part.column(0).to_pylist(), words.first.tolist(), words.last.tolist()):
                    length = min(size, b - a)
                    if length and item is not None:
                        rows.update((item, words.text(i, length), length) for i in range(a, b - length + 1))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.int32()))],
                        names=["item", "window", "length"])

    return benchmark.select(F.col(item_id).cast("string"), text).mapInArrow(
        run, "item string, window binary, length int").distinct()


class Block:
    """Some windows of items, by length: a hash set and, for verifying, the items of each window's words."""

    def __init__(self, rows: list[tuple[str, bytes, int]]):
        self.items: dict[bytes, list[str]] = {}
        for item, window, _ in rows:
            self.items.setdefault(bytes(window), []).append(item)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({r[2] for r in rows}):
            windows = sorted({bytes(r[1]) for r in rows if r[2] == length})
            hashes = np.unique(np.concatenate([Words.of([w]).windows(length) for w in windows]))
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.by_length[length] = (hashes, seen)

    def hits(self, words: Words) -> Iterator[tuple[int, int, int, list[str]]]:
        """Text, first word, length and items of every verified occurrence."""
        for length, (hashes, seen) in self.by_length.items():
            found = words.windows(length)
            maybe = np.flatnonzero(seen[found >> np.uint64(64 - _FILTER_BITS)])
            maybe = maybe[hashes[np.minimum(np.searchsorted(hashes, found[maybe]), len(hashes) - 1)] == found[maybe]]
            owner = np.searchsorted(words.first, maybe, "right") - 1
            whole = maybe + length <= words.last[owner]
            for i, d in zip(maybe[whole].tolist(), owner[whole].tolist()):
                items = self.items.get(words.text(i, length))
                if items:
                    yield d, i - int(words.first[d]), length, items


def blocks(benchmark: DataFrame, size: int, item_id: str = "item_id",
           text: str = "text") -> list[tuple[str, Broadcast]]:
    """The test windows in named broadcast blocks of about ``BLOCK_WINDOWS``; more windows make more blocks."""
    context = benchmark.sparkSession.sparkContext
    windows = item_windows(benchmark, size, item_id, text).persist()
    count = -(-windows.count() // BLOCK_WINDOWS)
    part = F.pmod(F.xxhash64("item", "window"), F.lit(max(count, 1)))
    made = [(uuid.uuid4().hex, context.broadcast([tuple(r) for r in windows.where(part == i).collect()]))
            for i in range(count)]
    windows.unpersist()
    return made


def scan(df: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """Append what of each text occurs in test items, after lower-casing A-Z and cutting it into words.

    A window is ``size`` consecutive words of an item, or all words of a shorter one. Appended:
    ``n_words``; ``hit_words``, the places of words inside any occurrence of a window; ``items``, the ids
    of the items with occurring windows, sorted as strings. The windows are broadcast in blocks of bounded
    size, and every text goes past one block after another in a single pass; hash hits are verified word
    by word. A null or empty text has no words; items that are null, have a null id or no words match
    nothing; equal rows get equal results.
    """
    return _scanned(df, blocks(benchmark, size, item_id, item_text), text, cut=False)


def scan_and_remove(df: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text", item_id: str = "item_id",
                    item_text: str = "text") -> DataFrame:
    """What ``remove_spans`` makes of ``scan``, in the worker that found the hits last.

    Two operators in a row hold two Python workers per core and the texts between them twice.
    """
    return _scanned(df, blocks(benchmark, size, item_id, item_text), text, cut=True)


def _scanned(df: DataFrame, made: list[tuple[str, Broadcast]], text: str, cut: bool) -> DataFrame:
    outputs = "n_words bigint, hit_words array<int>, items array<string>"
    made = made or [("", None)]
    for i, (name, rows) in enumerate(made):
        last = cut and i == len(made) - 1
        df = map_columns(df, text, outputs + ", clean_text string" * last, _scanner(name, rows, text, i == 0, last),
                         with_batch=True, size=HASHED_BYTES)
    return df


def _scanner(name: str, rows: Broadcast | None, text: str, first: bool, cut: bool):
    """Adds the hits of one block to those of the blocks before; with ``cut`` the texts without them, too."""
    def fn(part: pa.RecordBatch):
        values = raw_texts(part.column(text))
        words = Words.of(values)
        empty = [()] * part.num_rows
        places = [set(x) for x in (empty if first else part.column("hit_words").to_pylist())]
        items = [set(x) for x in (empty if first else part.column("items").to_pylist())]
        for d, i, length, which in _block(name, rows).hits(words) if rows else ():
            places[d].update(range(i, i + length))
            items[d].update(which)
        hits = [sorted(x) for x in places]
        return [pa.array(words.last - words.first), pa.array(hits, pa.list_(pa.int32())),
                pa.array(map(sorted, items), pa.list_(pa.string())), *([_cut(values, hits)] if cut else [])]

    return fn


@lru_cache(maxsize=1)
def _block(name: str, rows: Broadcast) -> Block:
    """The hash set of a broadcast, made once in a worker."""
    return Block(rows.value)


def remove_spans(df: DataFrame, text: str = "text", places: str = "hit_words") -> DataFrame:
    """Append ``clean_text``: the text without its hit words and what lies between neighbouring ones.

    A newline takes the place of each removed run.
    """
    def fn(part: pa.RecordBatch):
        return [_cut(raw_texts(part.column(text)), part.column(places).to_pylist())]

    return map_columns(df, text, "clean_text string", fn, with_batch=True)


def _cut(values: list[bytes], hits: list[list[int] | None]) -> pa.Array:
    """The texts without their hit words and what lies between neighbouring ones."""
    out = []
    for value, hit in zip(values, hits):
        if not hit:
            out.append(value)
            continue
        words, at = Words.of([value]), np.array(hit)
        new = np.concatenate([[True], np.diff(at) != 1])
        begin, end = words.starts[at[new]], words.ends[at[np.concatenate([new[1:], [True]])]]
        kept = [value[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(value)])]
        out.append(b"\n".join(kept))
    return pa.array(out, pa.binary()).cast(pa.string())
