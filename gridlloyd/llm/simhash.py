"""SimHash near-duplicates: fingerprints, a binary trie self-join within a Hamming distance, components."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import join_unique, map_columns, raw_texts

BITS = 64
#: Most fingerprints that one pair of trie nodes brings to a task, unless a hot subtree cannot be split.
NODE_ROWS = 200_000
#: Hot subtrees there can be; the limit above rises with the input so that there are no more.
HOT_NODES = 10_000
#: Node pairs a task holds at a time.
_FRONTIER = 1 << 18
#: Pairs of leaves that are compared directly rather than by descending further.
_FEW = 8
_hash = partial(xxhash.xxh64_intdigest, seed=42)


def _fingerprint(value: bytes, width: int) -> int:
    words = value.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(width, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - width + 1]
    hashes = np.array([_hash(line[a:b]) for a, b in zip(starts.tolist(), ends[width - 1:].tolist())], "uint64")
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes."""
    counts = np.zeros(BITS, "int64")
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at:at + (1 << 14)].astype(">u8").view("uint8").reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype="int64")
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", width: int = 4) -> DataFrame:
    """Append ``fingerprint``, the 64-bit SimHash as a signed integer, in one pass without a shuffle.

    Texts are lower-cased (A-Z), cut at ASCII white space and hashed by shingles of ``width`` words,
    repeats included; fewer words are one shingle, and no words (null, empty) give zero.
    """
    def fn(column: pa.Array):
        made = np.array([_fingerprint(v, width) for v in raw_texts(column)], "uint64")
        return [pa.array(made.view("int64"))]

    return map_columns(df, text, "fingerprint bigint", fn)


class Forest:
    """Union-find over 0..n-1 with vectorised root look-up."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if np.array_equal(p, q):
                self.parent = p
                return p
            p = q

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Link the components of a[i] and b[i] by hooking the larger root to the smaller."""
        while len(a):
            roots = self.roots()
            x, y = roots[a], roots[b]
            apart = x != y
            if not apart.any():
                return
            a, b = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            parent = roots.copy()
            np.minimum.at(parent, b, a)
            self.parent = parent


def trie_links(values: np.ndarray, budget: int, starts: np.ndarray | None = None, top: int = 0) -> np.ndarray:
    """Component of each value (as the place of one of its members) under links of ``budget`` bits or fewer.

    ``values`` are distinct unsigned integers in order, the leaves of a binary trie; a node is a run of the
    array. Pairs of nodes of one depth descend together, from the pair (root, root), adding up the bits in
    which their paths differ; a pair over the budget is dropped with all below it. Budgets are raised step
    by step, and a pair whose leaves are all in one component already is dropped too, so that a dense
    group is not walked pair by pair. With ``starts`` the array holds several tries, one from each start,
    whose values agree in the ``top`` leading bits.
    """
    forest = Forest(len(values))
    starts = np.zeros(1, "int64") if starts is None else starts
    for allowed in range(1, budget + 1):
        _walk(values, allowed, forest, starts, np.append(starts[1:], len(values)), BITS - 1 - top)
    return forest.roots()


def _walk(values: np.ndarray, budget: int, forest: Forest, starts: np.ndarray, ends: np.ndarray, bit: int) -> None:
    stack = [(bit, starts, ends, starts, ends, np.zeros(len(starts), "int64"))]
    while stack:
        bit, *pairs = stack.pop()
        if len(pairs[0]) > _FRONTIER:
            half = len(pairs[0]) // 2
            stack += [(bit, *(x[:half] for x in pairs)), (bit, *(x[half:] for x in pairs))]
            continue
        a0, a1, b0, b1, spent = pairs
        # Leaves that are one component need no more links.
        roots = forest.roots()
        changes = np.concatenate([[0], np.cumsum(roots[1:] != roots[:-1])])
        one = (changes[a1 - 1] == changes[a0]) & (changes[b1 - 1] == changes[b0]) & (roots[a0] == roots[b0])
        few = ~one & ((a1 - a0) * (b1 - b0) <= _FEW)
        if few.any():
            _compare(values, budget, forest, a0[few], a1[few], b0[few], b1[few])
        go = ~one & ~few
        if bit < 0 or not go.any():
            continue
        a0, a1, b0, b1, spent = (x[go] for x in (a0, a1, b0, b1, spent))
        # In a run the leaves with this bit unset come first.
        ones = np.concatenate([[0], np.cumsum(values >> np.uint64(bit) & np.uint64(1))]).astype("int64")
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        other = a0 != b0
        below = (
            (a0, am, b0, bm, spent), (am, a1, bm, b1, spent), (a0, am, bm, b1, spent + 1),
            tuple(x[other] for x in (am, a1, b0, bm, spent + 1)))
        made = [np.concatenate(x) for x in zip(*below)]
        keep = (made[0] < made[1]) & (made[2] < made[3]) & (made[4] <= budget)
        if keep.any():
            stack.append((bit - 1, *(x[keep] for x in made)))


def _compare(values, budget, forest, a0, a1, b0, b1) -> None:
    width_a, width_b = a1 - a0, b1 - b0
    many = width_a * width_b
    which = np.repeat(np.arange(len(many)), many)
    place = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
    x, y = a0[which] + place // width_b[which], b0[which] + place % width_b[which]
    near = (x != y) & (np.bitwise_count(values[x] ^ values[y]) <= budget)
    forest.join(x[near], y[near])


def _rotations(budget: int) -> list[tuple[int, int]]:
    """Fields (first bit from the top, width) that together make up the fingerprint, one more than the budget."""
    fields = budget + 1
    cuts = [BITS * i // fields for i in range(fields + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _rotated(value: Column, field: tuple[int, int]) -> Column:
    """The value turned so that the field comes first."""
    return F.shiftleft(value, field[0]).bitwiseOR(F.shiftrightunsigned(value, BITS - field[0])) if field[0] else value


def links(distinct: DataFrame, distance: int, total: int) -> DataFrame:
    """Edges ``u``, ``v`` between fingerprints whose components are those of all links within ``distance``.

    Two fingerprints within ``distance`` bits agree in one of ``distance`` + 1 fields at least. So each
    field has a trie with its own bits on top, in which the budget of the top levels is zero: what shares
    a field meets in one task, which joins that subtree with itself. A subtree of too many fingerprints
    is split at its next levels into pairs of nodes within the budget, dealt to tasks of their own. A task
    returns a spanning forest, not all links, so a dense group costs no more edges than it has members.
    """
    fields = _rotations(distance)
    turned = distinct.select(F.explode(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("field"), F.shiftrightunsigned(_rotated(F.col("fingerprint"), f), BITS - f[1]).alias("top"),
                 _rotated(F.col("fingerprint"), f).alias("value")) for i, f in enumerate(fields)])).alias("x")).select("x.*")
    limit = max(NODE_ROWS, len(fields) * total // HOT_NODES)
    sizes = turned.groupBy("field", "top").count().where(F.col("count") > limit)  # at most HOT_NODES rows
    split = F.ceil(F.log2(F.col("count") / limit)).cast("int") + 2
    sized = turned.join(F.broadcast(sizes.select("field", "top", split.alias("deeper"))), ["field", "top"], "left")
    node = F.when(F.col("deeper").isNull(), F.lit(0).cast("bigint")).otherwise(F.expr(
        f"shiftrightunsigned(shiftleft(value, element_at(array({', '.join(str(f[1]) for f in fields)}), cast(field + 1 as int))), 64 - deeper)"))
    nodes = sized.withColumn("node", node)
    partners = F.when(F.col("deeper").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.expr(
        f"filter(sequence(0L, shiftleft(1L, deeper) - 1), o -> bit_count(o ^ node) <= {distance})"))
    units = nodes.withColumn("other", F.explode(partners)).select(
        "field", "top", F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "value")
    by_unit = units.repartition("field", "top", "a", "b").sortWithinPartitions("field", "top", "a", "b", "value")
    back = np.array([f[0] for f in fields], "uint64")

    def run(batches):
        for field, values, starts in _units(batches):
            root = trie_links(values, distance, starts, min(f[1] for f in fields))
            # Members in a row, not a star: no fingerprint gets many edges.
            chain = np.lexsort((np.arange(len(values)), root))
            linked = np.flatnonzero(root[chain[1:]] == root[chain[:-1]])
            if len(linked):
                turn = back[field]
                values = (values >> turn) | np.where(turn > 0, values << ((np.uint64(BITS) - turn) % np.uint64(BITS)), np.uint64(0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[chain[linked + k]].view("int64")) for k in (0, 1)], names=["u", "v"])

    return by_unit.mapInArrow(run, "u bigint, v bigint")


def _units(batches):
    """Runs of whole units from sorted batches: the field and value of each row, and where units start."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in ("field", "top", "a", "b", "value")], axis=1))
        if sum(map(len, held)) < NODE_ROWS:
            continue
        rows = np.concatenate(held)
        cut = _unit_starts(rows)[-1]  # the last unit may go on
        if cut:
            yield _unit_arrays(rows[:cut])
        held = [rows[cut:]]
    if sum(map(len, held)):
        yield _unit_arrays(np.concatenate(held))


def _unit_starts(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1])


def _unit_arrays(rows: np.ndarray):
    return rows[:, 0], np.ascontiguousarray(rows[:, 4]).view("uint64"), _unit_starts(rows)


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``node``, ``root`` for every end of an edge, by contraction.

    In each round a node hooks to the neighbour whose hash is smallest, if that is smaller than its own;
    hooked nodes are replaced by their targets and loops vanish. Hashes change from round to round, so
    chains shrink geometrically. Every round is written, which cuts the lineage.
    """
    rounds = []
    edges = scratch.write(edges.where("u <> v").distinct(), f"{name}-edges-0")
    while edges.take(1):
        i = len(rounds)
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        key = F.xxhash64("v", F.lit(i))
        hooks = both.groupBy("u").agg(F.min_by("v", key).alias("best"), F.min(key).alias("key"))
        hooks = scratch.write(hooks.select(F.col("u").alias("node"), F.when(
            F.col("key") < F.xxhash64("u", F.lit(i)), F.col("best")).otherwise(F.col("u")).alias("next")), f"{name}-hooks-{i}")
        rounds.append(hooks)
        moved = edges.join(hooks.select(F.col("node").alias("u"), F.col("next").alias("nu")), "u")
        moved = moved.join(hooks.select(F.col("node").alias("v"), F.col("next").alias("nv")), "v")
        ends = moved.select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v")).where("u <> v").distinct()
        edges = scratch.write(ends, f"{name}-edges-{i + 1}")
    if not rounds:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    # From the last round back: where a target went on to is looked up among the fewer nodes of later rounds.
    result = rounds[-1].select("node", F.col("next").alias("root"))
    for i in range(len(rounds) - 2, -1, -1):
        onward = result.select(F.col("node").alias("next"), "root")
        result = scratch.write(rounds[i].join(onward, "next", "left").select(
            "node", F.coalesce("root", "next").alias("root")), f"{name}-roots-{i}")
    return result


def near_duplicates(df: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", width: int = 4,
                    distance: int = 4) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, ``fingerprint`` (16 hex digits), ``component_id`` and ``root``.

    Fingerprints link at ``distance`` differing bits or fewer; a component is all rows whose fingerprints
    are reachable, named by its smallest id (null if all its ids are null) and by its ``root`` fingerprint.
    Rows with equal texts, ids or nulls all stay; rows without words share fingerprint zero. Copies are
    one leaf of the trie, whatever their number.
    """
    keys = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("__text"))
    marked = fingerprints(keys, "__text", width).select("doc_id", "text_hash", "fingerprint")
    marked = scratch.write(marked, "fingerprints")
    distinct = scratch.write(
        marked.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least")), "distinct")
    edges = links(distinct.select("fingerprint"), distance, distinct.count())
    roots = components(edges, scratch).withColumnRenamed("node", "fingerprint")
    rooted = scratch.write(distinct.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")), "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    whole = join_unique(rooted, named, ["root"], "members", max(distinct.count(), 1), ["fingerprint"])
    final = whole.select("fingerprint", "copies", "root", "component_id")
    found = join_unique(marked, final, ["fingerprint"], "copies", max(marked.count(), 1), ["doc_id", "text_hash"])
    return found.select("doc_id", "text_hash", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        "component_id", "root")


def keep_one(df: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", width: int = 4,
             distance: int = 4) -> DataFrame:
    """The rows of ``df`` that stay when every component keeps one: that with the smallest id.

    Of several rows with that id one stays, by the hash of the text. Components are found by
    ``near_duplicates``; only ids and hashes are shuffled to choose, then texts once to apply the choice.
    """
    return keep_first(df, near_duplicates(df, scratch, doc_id, text, width, distance), doc_id, text)


def keep_first(df: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``df`` with the smallest id of their component, one for each ``root`` of ``found``."""
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.first("doc_id").alias("__id"), F.min("text_hash").alias("__hash"))
    keys = first.select("__id", "__hash")
    hashed = df.withColumn("__text_hash", F.xxhash64(text))
    stay = hashed.join(keys, hashed[doc_id].eqNullSafe(keys["__id"]) & (hashed["__text_hash"] == keys["__hash"]), "left_semi")
    return stay.dropDuplicates([doc_id, "__text_hash"]).drop("__text_hash")
