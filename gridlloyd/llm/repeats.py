"""Removal of repeated byte strings: suffixes sorted to a limited depth, most significant digits first.

Only suffixes that agree in their first ``depth`` bytes matter, so ordering stops there, and a group that
gets down to one member is dropped at once. Sorting every suffix would move each byte ``depth`` times; so
suffixes are sorted in bundles. Every window of ``depth`` bytes has an anchor, the place inside it with
the smallest hash of ``CORE`` bytes (leftmost if tied), which depends on the window's bytes alone; the
windows of a text that share an anchor follow one another and make a bundle. The digits are

1. the core, the ``CORE`` bytes at the anchor, which all windows of the bundle contain: a bundle whose
   core occurs nowhere else holds no repeated window;
2. the span, all bytes of the bundle with the anchor's place in it: in bundles of equal spans every
   window is repeated;
3. for what is left, the ends of repeated runs, each window's own bytes, compared among the bundles of
   one core: equal groups are exactly the repeated windows.

Digits are compared by 64-bit hashes. Among bundles of one core a span or window is told apart by one such
hash, its bytes are not compared.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import HOT_SHARE, join_unique, joined, map_columns, raw_texts, slices, without
from .rolling import RangeHashes

#: Bytes of a core. Shorter cores make fewer bundles but meet by chance more often.
CORE = 56
#: Bytes of text that are hashed at a time.
_CHUNK = 2 << 20
#: Rows of whole groups that a task sorts out at a time, more only if one group has more.
_ROWS = 500_000
_PLACE_BITS = 24
_REPEATED, _OPEN, _PARTNER, _HOT = 0, 1, 2, 1
#: Rows of a hot core that are compared in one task before the rest of its windows are counted together.
_DEAL_ROWS = 20_000
#: Bytes of bundles that a task compares at a time, more only if one group has more.
_PART_BYTES = 8 << 20


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` keys from each place on, by doubling."""
    low, reach = keys.copy(), 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[:-rest], low[rest:]) if rest else low


def bundles(values: list[bytes], depth: int):
    """Per bundle: index of its text, first window, number of windows, core and span."""
    cut = [(i, at, v[at:at + _CHUNK + depth - 1]) for i, v in enumerate(values)
           for at in range(0, max(len(v) - depth + 1, 0), _CHUNK)]
    group, size = [], 0
    for piece in cut:
        group.append(piece)
        size += len(piece[2])
        if size >= _CHUNK:
            yield _bundles(group, depth)
            group, size = [], 0
    if group:
        yield _bundles(group, depth)


def _bundles(pieces: list[tuple[int, int, bytes]], depth: int) -> tuple[np.ndarray, ...]:
    data, starts, ends = joined([p[2] for p in pieces])
    hashes = RangeHashes(data)
    cores = hashes.every(CORE)
    places = np.uint64((1 << _PLACE_BITS) - 1)
    low = _lowest(cores & ~places | np.arange(len(cores), dtype="uint64"), depth - CORE + 1)
    edges = np.zeros(len(low) + 1, "int8")
    edges[starts] += 1
    edges[np.minimum(ends - depth + 1, len(low))] -= 1
    window = np.flatnonzero(np.cumsum(edges[:-1]))
    anchor = (low[window] & places).astype("int64")
    first = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(window) != 1)]) if len(window) else []
    at = np.flatnonzero(first)
    count = np.diff(np.append(at, len(window)))
    begin, anchor = window[at], anchor[at]
    owner = np.searchsorted(starts, begin, "right") - 1
    span = hashes(begin, begin + count - 1 + depth)
    span ^= ((anchor - begin) * 0x100000001B3 + count).astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
    text = np.array([p[0] for p in pieces])[owner]
    return text, begin - starts[owner] + np.array([p[1] for p in pieces])[owner], count, cores[anchor], span


def _pack(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """First window and number of windows in one integer; the last two bits are for the kind."""
    return first << 20 | count << 2


def _table(df: DataFrame, doc_id: str, text: str, depth: int, id_type: str) -> DataFrame:
    """All bundles: ``id``, ``hash`` (of the text), ``place``, ``core``, ``span``."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _CHUNK):
                for text_at, first, count, core, span in bundles(raw_texts(part.column("text")), depth):
                    rows = pa.array(text_at)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(rows), part.column("hash").take(rows), pa.array(_pack(first, count)),
                         pa.array(core.view("int64")), pa.array(span.view("int64"))],
                        names=["id", "hash", "place", "core", "span"])

    keyed = df.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    return keyed.mapInArrow(run, f"id {id_type}, hash bigint, place bigint, core bigint, span bigint")


def _frequent(df: DataFrame, column: str) -> list[int]:
    """The values with more than a ``HOT_SHARE``-th of the rows, by a sketch of bounded size.

    A value that the sketch misses only makes a larger group.
    """
    found = df.agg(F.expr(f"approx_top_k({column}, {HOT_SHARE}, {10 * HOT_SHARE})").alias("top"),
                   F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in found["top"] or [] if x["count"] * HOT_SHARE > found["n"]]


def sort_bundles(table: DataFrame, id_type: str) -> DataFrame:
    """Bundles that may hold repeated windows: ``id``, ``hash``, ``core`` and ``place`` with its kind.

    Kinds: repeated as a whole; open; or partner, a repeated one that open ones have to be compared with.
    Groups meet by core and are told apart by span in the task. A span that holds a large share of all
    bundles is counted with map-side combination instead and its bundles are never shuffled; a core that
    does is dealt out by span.
    """
    common = (
        table.where(F.col("span").isin(_frequent(table, "span"))).groupBy("core", "span")
        .agg(F.count(F.lit(1)).alias("m"), F.first("id").alias("id"), F.first("hash").alias("hash"), F.first("place").alias("place"))
        .where("m > 1").collect())  # no longer than the list
    known = F.col("span").isin([r["span"] for r in common]) & F.col("core").isin([r["core"] for r in common])
    whole = table.where(known).select("id", "hash", "core", "place")
    partners = table.sparkSession.createDataFrame(
        [(r["id"], r["hash"], r["place"] | _PARTNER, r["core"], r["span"]) for r in common], table.schema)
    rest = table.where(~known).unionByName(partners)
    is_hot = F.col("core").isin(_frequent(table, "core"))
    dealt = rest.select("id", "hash", "core", "span", F.when(
        is_hot, F.col("place").bitwiseOR(F.lit(_HOT))).otherwise(F.col("place")).alias("place"))
    is_hot = F.col("place").bitwiseAND(F.lit(_HOT)) != 0
    dealt = dealt.repartition("core", F.when(is_hot, F.col("span")).otherwise(F.lit(0).cast("bigint")))
    dealt = dealt.sortWithinPartitions("core", "span")

    def run(batches):
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < _ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            core = rows.column("core").to_numpy()
            cut = int(np.searchsorted(core, core[-1]))  # the last group may go on
            if cut:
                yield from _kinds(rows.slice(0, cut))
            held = [rows.slice(cut)]
        if held:
            yield from _kinds(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return dealt.mapInArrow(run, f"id {id_type}, hash bigint, core bigint, place bigint").unionByName(whole)


def _kinds(rows: pa.RecordBatch):
    """Tell the kinds of bundles sorted by core and span."""
    core, span, place = (rows.column(c).to_numpy() for c in ("core", "span", "place"))
    partner, hot, place = place & _PARTNER != 0, place & _HOT != 0, place & ~3
    if not len(core):
        return
    new_core = np.concatenate([[True], core[1:] != core[:-1]])
    new_span = new_core | np.concatenate([[True], span[1:] != span[:-1]])
    by_core, by_span = np.cumsum(new_core) - 1, np.cumsum(new_span) - 1
    several = np.bincount(by_core)[by_core] > 1
    repeated = (np.bincount(by_span)[by_span] > 1) | partner
    live = several | hot
    is_open = live & ~repeated
    has_open = (np.bincount(by_core, weights=is_open)[by_core] > 0) | hot
    keep = live & ~partner
    partners = new_span & repeated & has_open
    for chosen, kind in ((keep & repeated, _REPEATED), (is_open, _OPEN), (partners, _PARTNER)):
        at = pa.array(np.flatnonzero(chosen))
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [rows.column("id").take(at), rows.column("hash").take(at), rows.column("core").take(at),
                 pa.array(place[chosen] | kind)], names=["id", "hash", "core", "place"])


def _same(df: DataFrame, keys: DataFrame, doc_id: str) -> Column:
    return df[doc_id].eqNullSafe(keys["__id"]) & (df["__hash"] == keys["__text_hash"])


def _cut(value: bytes, first: np.ndarray, count: np.ndarray, depth: int) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, removed runs and the bytes left, given runs of repeated windows."""
    edges = np.zeros(len(value) + 1, "int64")
    np.add.at(edges, first, 1)
    np.add.at(edges, first + count - 1 + depth, -1)
    gone = np.cumsum(edges[:-1]) > 0
    steps = np.diff(np.concatenate([[False], gone]).astype("int8"))
    return len(value), int(gone.sum()), int((steps == 1).sum()), np.frombuffer(value, "uint8")[~gone].tobytes()


_RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _result(cuts, keep_bytes: bool):
    return [*(pa.array([c[i] for c in cuts], pa.int64()) for i in range(3)),
            pa.array([None if c[3] is None else sha256(c[3]).hexdigest() for c in cuts], pa.string()),
            pa.array([c[3] if keep_bytes else None for c in cuts], pa.binary())]


def remove_repeats(df: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", depth: int = 200,
                   keep_bytes: bool = True) -> DataFrame:
    """Remove every byte covered by a ``depth``-byte string that starts at another place too.

    Texts are UTF-8 bytes; strings do not cross texts and are judged before anything is removed. Appended:
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and, if ``keep_bytes``,
    ``kept``, the bytes left (null otherwise). All rows stay: rows with equal texts, equal ids or null ids
    are texts of their own, so a repeated long text is removed whole from each. A null text counts as
    empty, and a text shorter than ``depth`` keeps all its bytes.
    """
    if depth <= CORE:
        raise ValueError(f"depth must exceed {CORE}")
    id_type = df.schema[doc_id].dataType.simpleString()
    table = scratch.write(_table(df, doc_id, text, depth, id_type), "bundles")
    sorted_out = sort_bundles(table, id_type)
    kind = F.col("place").bitwiseAND(F.lit(3))
    lists = sorted_out.groupBy(F.col("id").alias("__id"), F.col("hash").alias("__text_hash")).agg(
        F.collect_list(F.when(kind == _REPEATED, F.col("place"))).alias("__whole"),
        F.collect_list(F.when(kind != _REPEATED, F.struct("place", "core"))).alias("__open"))
    hashed = df.select(*without(df, ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]),
                       F.xxhash64(text).alias("__hash"))
    with_lists = hashed.join(lists, _same(hashed, lists, doc_id), "left").drop("__id", "__text_hash")

    def first_cut(part: pa.RecordBatch):
        """The result of texts without open bundles; the bytes of open bundles and partners of the others."""
        cuts, parts, raws = [], [], []
        for value, whole, opened in zip(raw_texts(part.column(text)), part.column("__whole").to_pylist(),
                                        part.column("__open").to_pylist()):
            waits = any(o["place"] & 3 == _OPEN for o in opened or ())
            place = np.array(whole or [], "int64")
            cuts.append((None,) * 4 if waits else _cut(value, place >> 20, (place >> 2) & 0x3FFFF, depth))
            raws.append(value if waits else None)
            parts.append([{"place": o["place"], "core": o["core"], "bytes": value[
                o["place"] >> 20:(o["place"] >> 20) + (o["place"] >> 2 & 0x3FFFF) - 1 + depth]} for o in opened or ()])
        kind = pa.struct([("place", pa.int64()), ("core", pa.int64()), ("bytes", pa.binary())])
        return [*_result(cuts, keep_bytes), pa.array(raws, pa.binary()), pa.array(parts, pa.list_(kind))]

    staged = scratch.write(map_columns(
        with_lists, text, f"{_RESULT}, __raw binary, __parts array<struct<place: bigint, core: bigint, bytes: binary>>",
        first_cut, drop=["__open", *([] if keep_bytes else [text])], with_batch=True), "first-cut")

    parts = staged.where(F.size("__parts") > 0).select(
        F.col(doc_id).alias("id"), F.col("__hash").alias("hash"), F.inline("__parts"))
    marks = repeated_windows(parts, scratch, depth, id_type).groupBy(
        F.col("id").alias("__id"), F.col("hash").alias("__text_hash")).agg(F.collect_list("place").alias("__marks"))

    waiting = staged.where("__raw is not null")
    both = waiting.join(marks, _same(waiting, marks, doc_id), "left")

    def second_cut(part: pa.RecordBatch):
        cuts = []
        for value, whole, marked in zip(raw_texts(part.column("__raw")), part.column("__whole").to_pylist(),
                                        part.column("__marks").to_pylist()):
            place = np.array([*(whole or []), *(marked or [])], "int64")
            cuts.append(_cut(value, place >> 20, (place >> 2) & 0x3FFFF, depth))
        return _result(cuts, keep_bytes)

    done = map_columns(both, "__raw", _RESULT, second_cut, with_batch=True)
    names = without(done, ["__id", "__text_hash", "__hash", "__raw", "__whole", "__parts", "__marks"])
    return staged.where("__raw is null").select(*names).unionByName(done.select(*names))


def repeated_windows(parts: DataFrame, scratch: Scratch, depth: int, id_type: str) -> DataFrame:
    """The repeated windows of bundles given with their bytes: ``id``, ``hash``, ``place`` of runs of them.

    Bundles of one core meet in a task. A core that holds a large share of all is dealt over several: each
    finds the windows that repeat among its own rows, and then one row for each window a task has seen is
    counted over all tasks.
    """
    total = parts.count()
    counted = parts.groupBy("core").agg(F.count(F.lit(1)).alias("rows"))
    hot = F.broadcast(counted.where(F.col("rows") * HOT_SHARE > total).where(F.col("rows") > _DEAL_ROWS))
    hands = F.ceil(F.col("rows") / _DEAL_ROWS)
    deal = F.when(F.col("rows").isNull(), F.lit(-1).cast("bigint")).otherwise(F.pmod(F.xxhash64("hash", "place"), hands))
    dealt = parts.join(hot, "core", "left").select("id", "hash", "place", "core", "bytes", deal.alias("deal"))
    dealt = dealt.repartition("core", "deal").sortWithinPartitions("core", "deal")

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for rows in slices(batch, "bytes", _PART_BYTES):
                held.append(rows)
                size += rows.nbytes
                if size < _PART_BYTES:
                    continue
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                starts = _group_starts(table)
                cut = int(starts[-1])  # the last group may go on
                if cut:
                    yield from _compare(table.slice(0, cut), starts[:-1], depth)
                held = [table.slice(cut)]
                size = held[0].nbytes if cut else size
        if held:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            if table.num_rows:
                yield from _compare(table, _group_starts(table), depth)

    found = scratch.write(
        dealt.mapInArrow(run, f"id {id_type}, hash bigint, place bigint, core bigint, own bigint"), "windows")
    asked = found.where("own is not null")
    groups = asked.groupBy("core", "own").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    late = join_unique(asked, groups, ["core", "own"], "m", max(asked.count(), 1), ["hash", "place"], how="inner")
    return found.where("own is null").select("id", "hash", "place").unionByName(late.select("id", "hash", "place"))


def _group_starts(rows: pa.RecordBatch) -> np.ndarray:
    core, deal = rows.column("core").to_numpy(), rows.column("deal").to_numpy()
    return np.concatenate([[0], np.flatnonzero((core[1:] != core[:-1]) | (deal[1:] != deal[:-1])) + 1])


def _compare(rows: pa.RecordBatch, starts: np.ndarray, depth: int):
    """Runs of windows that repeat within a group; for dealt groups also one row per distinct window."""
    place = rows.column("place").to_numpy()
    count = (place >> 2) & 0x3FFFF
    data, begins, _ = joined(rows.column("bytes").to_pylist())
    row = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    own = RangeHashes(data)(begins[row] + step, begins[row] + step + depth).view("int64")
    group = np.searchsorted(starts, row, "right") - 1
    order = np.lexsort((own, group))
    new = np.concatenate([[True], (own[order][1:] != own[order][:-1]) | (group[order][1:] != group[order][:-1])])
    size = np.diff(np.append(np.flatnonzero(new), len(order)))
    times = np.empty(len(order), "int64")
    times[order] = np.repeat(size, size)
    hit = times > 1
    begin = np.flatnonzero(hit & np.concatenate([[True], ~hit[:-1] | (row[1:] != row[:-1])]))
    end = np.flatnonzero(hit & np.concatenate([~hit[1:] | (row[1:] != row[:-1]), [True]])) + 1
    where = _pack((place[row[begin]] >> 20) + step[begin], end - begin)
    yield _found(rows, row[begin], where, None)
    chosen = order[new]
    chosen = chosen[rows.column("deal").to_numpy()[row[chosen]] >= 0]
    if len(chosen):
        yield _found(rows, row[chosen], _pack((place[row[chosen]] >> 20) + step[chosen], np.ones(len(chosen), "int64")), own[chosen])


def _found(rows: pa.RecordBatch, at: np.ndarray, place: np.ndarray, own: np.ndarray | None) -> pa.RecordBatch:
    take = pa.array(at)
    return pa.RecordBatch.from_arrays(
        [rows.column("id").take(take), rows.column("hash").take(take), pa.array(place), rows.column("core").take(take),
         pa.nulls(len(at), pa.int64()) if own is None else pa.array(own)], names=["id", "hash", "place", "core", "own"])
