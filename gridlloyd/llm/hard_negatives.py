"""Hard negatives: clusters of anchors share one candidate list, sorted once by an angular upper bound."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..session import BOUNDED_BYTES, Scratch
from .inner_products import (
    SHARD_BYTES, BestLists, are_exact, as_long, big_products, centers_of, facts, fewest_of_equals, matrix, sampled,
    valid_rows, whole,
)

#: Anchors of a cluster on average, clusters there can be, and anchors that a task works on.
CLUSTER_ANCHORS, MAX_CLUSTERS, ANCHOR_BLOCK = 64, 256, 512
#: Rows of a shard, unless wide vectors allow fewer.
SHARD_ROWS = 20_000
#: List entries that the members of a cluster look at in their first and in their largest step.
_FIRST_STEP, _LARGEST_STEP = 256, 4096
_ANCHOR = ["anchor_id", "anchor_hash"]


def _angles(norm: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Angles to a unit vector; a zero vector has the angle zero."""
    return np.arccos(np.clip(np.divide(inner, norm, out=np.ones_like(norm), where=norm > 0), -1.0, 1.0))


def walk(candidates: np.ndarray, anchors: np.ndarray, take: Callable[[np.ndarray, np.ndarray, np.ndarray], None],
         needed: Callable[[np.ndarray], np.ndarray]) -> None:
    """Let all anchors of a cluster walk one list of the candidates, each until it is certain to need no more.

    With t the widest angle between an anchor and the direction of the cluster, |u| |v| cos(max(0, angle(v) - t))
    bounds the score of any member u with candidate v. The list is sorted by |v| cos(...), once for the
    cluster. ``take`` gets anchors, candidates and their scores; ``needed`` says which score still matters
    to an anchor, and it leaves as soon as its bound for the rest of the list is lower.
    """
    size = np.sqrt((anchors**2).sum(axis=1))
    unit = anchors / np.maximum(size, 1e-300)[:, None]
    direction = unit.sum(axis=0)
    length = np.sqrt((direction**2).sum())
    if length:
        direction = direction / length
    widest = _angles(size, anchors @ direction).max() + 1e-6
    norm = np.sqrt((candidates**2).sum(axis=1))
    apart = np.maximum(0.0, _angles(norm, candidates @ direction) - widest)
    bound = norm * np.cos(apart) + 1e-9 * norm
    order = np.argsort(-bound, kind="stable")
    active, at, step = np.arange(len(anchors)), 0, _FIRST_STEP
    while at < len(order) and len(active):
        limit = np.floor(size[active] * bound[order[at]] * (1 + 1e-9) + 1e-6)
        active = active[limit >= needed(active)]
        part = order[at:at + step]
        if len(active):
            take(active, part, (anchors[active] @ candidates[part].T).astype("int64"))
        at, step = at + step, min(2 * step, _LARGEST_STEP)


def _arrays(table: pa.Table, ids: str, dims: int):
    return table.column(ids).to_numpy(), table.column("label").to_numpy(), matrix(table.column("embedding"), dims)


def _labelled(labels: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Vectors with their label in front, in two parts that doubles hold exactly."""
    return np.column_stack([labels >> 32, labels & 0xFFFFFFFF, x])


def _candidates(table: pa.Table, dims: int, k: int):
    ids, labels, x = _arrays(table, "vec_id", dims)
    keep = fewest_of_equals(ids, _labelled(labels, x), k + 1)
    return ids[keep], labels[keep], x[keep]


def _scored(candidates: np.ndarray, anchors: np.ndarray, take, needed) -> None:
    if are_exact(anchors, candidates):
        walk(whole(candidates), whole(anchors), take, needed)
    else:
        take(np.arange(len(anchors)), np.arange(len(candidates)), as_long(big_products(anchors, candidates)))


def _positives(k: int, dims: int):
    """The best rows of the anchor's label in one shard."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        own, label, a = _arrays(anchors, "anchor_id", dims)
        ids, labels, x = _candidates(rows, dims, k)
        best = BestLists(len(own), k)

        def take(active, part, scores):
            same = (labels[part][None, :] == label[active][:, None]) & (ids[part][None, :] != own[active][:, None])
            i, j = np.nonzero(same & (scores >= best.scores[active, -1][:, None]))
            best.add(active[i], scores[i, j], ids[part][j])

        if len(ids) and len(own):
            _scored(x, a, take, lambda active: best.scores[active, -1])
        query, score, found = best.triples()
        return pa.table([*[anchors.column(c).take(pa.array(query)) for c in _ANCHOR], pa.array(found), pa.array(score)],
                        names=[*_ANCHOR, "vec_id", "score"])

    return run


def _negatives(k: int, dims: int, low: int, high: int):
    """For each positive of an anchor the best rows of other labels inside its window, in one shard."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        own, label, a = _arrays(anchors, "anchor_id", dims)
        ids, labels, x = _candidates(rows, dims, k)
        slots = [(i, s, p) for i, ps in enumerate(anchors.column("positives").to_pylist()) for s, p in enumerate(ps)]
        anchor = np.array([i for i, *_ in slots], dtype=int)
        score = np.array([p["score"] for *_, p in slots], dtype="int64")
        floor = np.array([-(-low * p["score"] // 100) for *_, p in slots], dtype=object)
        ceiling = np.array([high * p["score"] // 100 for *_, p in slots], dtype=object)
        floor, ceiling = (as_long(w) if len(w) else w.astype("int64") for w in (floor, ceiling))
        best = BestLists(len(slots), k)

        def least(pairs):
            return np.maximum(floor[pairs], best.scores[pairs, -1])

        def needed(active):
            lowest = np.full(len(own), np.iinfo("int64").max)
            np.minimum.at(lowest, anchor, least(np.arange(len(slots))))
            return lowest[active]

        def take(active, part, scores):
            row = np.full(len(own), -1)
            row[active] = np.arange(len(active))
            pairs = np.flatnonzero(row[anchor] >= 0)
            other = labels[part][None, :] != label[active][:, None]
            for some in np.array_split(pairs, max(1, len(pairs) * len(part) // (1 << 20))):
                s, o = scores[row[anchor[some]]], other[row[anchor[some]]]
                i, j = np.nonzero(o & (s <= ceiling[some][:, None]) & (s >= least(some)[:, None]))
                best.add(some[i], s[i, j], ids[part][j])

        if len(ids) and len(slots):
            _scored(x, a, take, needed)
        pair, negative, found = best.triples()
        positive = np.array([p["vec_id"] for *_, p in slots], dtype="int64")
        slot = np.array([s for _, s, _ in slots], dtype="int32")
        return pa.table(
            [*[anchors.column(c).take(pa.array(anchor[pair])) for c in _ANCHOR], pa.array(slot[pair]), pa.array(positive[pair]),
             pa.array(score[pair]), pa.array(found), pa.array(negative)],
            names=[*_ANCHOR, "slot", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _valid(df: DataFrame, ids: str) -> DataFrame:
    return df.mapInArrow(lambda batches: (b.take(valid_rows(b, "embedding", ids)) for b in batches), df.schema)


def _fewer(df: DataFrame, dims: int, k: int) -> DataFrame:
    """Of the rows of a batch with equal labels and vectors only those with the ``k`` + 1 smallest ids."""
    def run(batches):
        for batch in batches:
            x = _labelled(batch.column("label").to_numpy(), matrix(batch.column("embedding"), dims))
            yield batch.take(pa.array(fewest_of_equals(batch.column("vec_id").to_numpy(), x, k + 1)))

    return df.mapInArrow(run, df.schema)


def _clustered(anchors: DataFrame, directions: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            label = (whole(matrix(batch.column("embedding"), directions.shape[1])) @ directions.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(label.astype("int32"))], names=[*batch.schema.names, "cluster"])

    return anchors.mapInArrow(run, StructType(list(anchors.schema)).add("cluster", IntegerType()))


def mine_hard_negatives(rows: DataFrame, anchors: DataFrame, scratch: Scratch, positives: int = 5, negatives: int = 5,
                        low: int = 80, high: int = 100, vec_id: str = "vec_id", embedding: str = "embedding",
                        label: str = "label") -> DataFrame:
    """Negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``.

    A score is the inner product of integer vectors (see ``inner_products``, also for nulls, odd widths and
    huge values); rows with a null label take no part either. Positives are the ``positives`` best other rows
    of the anchor's label; negatives the ``negatives`` best rows of other labels whose score is ``low`` to ``high``
    percent of the positive's. Ties go to the smaller id. Rows with the anchor's id are not its positives; rows
    equal in id, label and integers count once. Without anchors, positives or negatives nothing is returned;
    other columns are ignored. Labels are integers.

    Anchors are clustered by direction (centres from at most 4096 of them; they decide only who walks
    together), large clusters cut into blocks; rows are dealt to shards by the hash of their id. A task takes
    one block and one shard, sorts the shard once for the block and walks it.
    """
    def laid_out(df, name):
        return _valid(df.where(F.col(label).isNotNull()).select(
            F.col(vec_id).cast("long").alias(name), F.col(label).cast("long").alias("label"), F.col(embedding).alias("embedding")), name)

    base, asked = laid_out(rows, "vec_id"), laid_out(anchors, "anchor_id")
    n, dims = facts(base, "embedding")
    asked = asked.withColumn("anchor_hash", F.xxhash64("label", "embedding")).dropDuplicates(_ANCHOR)
    asked = scratch.write(asked, "anchors")
    total, width = facts(asked, "embedding")
    dims = max(dims, width)
    count = max(1, min(MAX_CLUSTERS, total // CLUSTER_ANCHORS, BOUNDED_BYTES // (8 * dims)))
    sample = sampled(asked, "anchor_id", "embedding", dims)
    with np.errstate(over="ignore", invalid="ignore"):
        sample = np.nan_to_num(sample / np.maximum(np.sqrt((sample**2).sum(axis=1)), 1e-300)[:, None])
    grouped = scratch.write(_clustered(asked, centers_of(sample, count)), "clustered")
    before, blocks = 0, []  # one entry a cluster, so at most MAX_CLUSTERS
    for row in sorted(grouped.groupBy("cluster").count().collect()):
        blocks.append((row["cluster"], -(-row["count"] // ANCHOR_BLOCK), before))
        before += blocks[-1][1]
    units = F.broadcast(rows.sparkSession.createDataFrame(blocks or [(0, 1, 0)], "cluster int, blocks long, before long"))
    shards = max(1, -(-n // max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * dims)))))
    blocked = grouped.join(units, "cluster").withColumn(
        "unit", F.col("before") + F.pmod(F.xxhash64(*_ANCHOR), "blocks")).drop("blocks", "before", "cluster")

    zero = F.lit(0).cast("long")

    def dealt(k):
        """A copy of the rows for each block of anchors."""
        few = _fewer(base, dims, k).withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
        return few.withColumn("unit", F.explode(F.sequence(zero, F.lit(max(before, 1) - 1).cast("long")))).groupBy("unit", "shard")

    def asking(df):
        return df.withColumn("shard", F.explode(F.sequence(zero, F.lit(shards - 1).cast("long")))).groupBy("unit", "shard")

    types = "anchor_id bigint, anchor_hash bigint, "
    hits = dealt(positives).cogroup(asking(blocked)).applyInArrow(
        _positives(positives, dims), types + "vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy(*_ANCHOR).orderBy(F.desc("score"), "vec_id"))
    best = hits.withColumn("rank", place).where(F.col("rank") <= positives).groupBy(*_ANCHOR).agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))  # at most so many each
    with_positives = scratch.write(blocked.join(best, _ANCHOR), "positives")
    found = dealt(negatives).cogroup(asking(with_positives)).applyInArrow(
        _negatives(negatives, dims, low, high),
        types + "slot int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    place = F.row_number().over(Window.partitionBy(*_ANCHOR, "slot").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
