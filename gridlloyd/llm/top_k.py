"""Exact top-k inner-product search: rows in balls around pivots, a ball tree in every task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..session import BOUNDED_BYTES, Scratch
from .ball_tree import BallTree, upper_bound
from .inner_products import (
    NO_ID, SHARD_BYTES, BestLists, are_exact, as_long, big_products, centers_of, facts, fewest_of_equals, matrix,
    nearest, sampled, valid_rows, whole,
)

#: Rows for one pivot, pivots there can be, and queries that a task works on.
PIVOT_ROWS, MAX_PIVOTS, QUERY_BLOCK = 2000, 1024, 1024
_FOUND = "array<struct<score: bigint, vec_id: bigint>>"


def _placed(rows: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """Every row with its nearest pivot and the distance; of the equal vectors of a batch ``k`` + 1 stay."""
    dims = pivots.shape[1]
    schema = StructType([rows.schema["vec_id"], rows.schema["embedding"]])
    schema = schema.add("pivot", IntegerType()).add("distance", DoubleType())

    def run(batches):
        for batch in batches:
            part = batch.take(valid_rows(batch, "embedding", "vec_id"))
            x = matrix(part.column("embedding"), dims)
            keep = fewest_of_equals(part.column("vec_id").to_numpy(), x, k + 1)
            label, distance = nearest(whole(x[keep]), pivots)
            part = part.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(label.astype("int32")), pa.array(distance)],
                                             names=schema.names)

    return rows.select("vec_id", "embedding").mapInArrow(run, schema)


def _search(k: int, dims: int, carried: list[str], fresh: bool):
    """The work of one task: a ball tree of its rows, searched for all of its queries."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        own, q = queries.column("query_id").to_numpy(), matrix(queries.column("embedding"), dims)
        ids, x = rows.column("vec_id").to_numpy(), matrix(rows.column("embedding"), dims)
        keep = fewest_of_equals(ids, x, k + 1)
        ids, x = ids[keep], x[keep]
        best = BestLists(len(q), k)
        best.start(queries.column("found").to_pylist())
        if len(ids) and are_exact(q, x):
            BallTree(whole(x), ids).search(whole(q), own, best)
        elif len(ids):
            scores = as_long(big_products(q, x))
            i, j = np.nonzero(ids[None, :] != own[:, None])
            best.add(i, scores[i, j], ids[j])
        query, score, found = best.triples(fresh)
        counts = np.bincount(query, minlength=len(q))
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]).astype("int32")),
            pa.StructArray.from_arrays([pa.array(score), pa.array(found)], names=["score", "vec_id"]))
        return pa.table([*[queries.column(c) for c in carried], lists], names=[*carried, "found"])

    return run


def _visit(placed: DataFrame, queries: DataFrame, parts: dict[int, int], blocks: dict[int, int], k: int, dims: int,
           carried: list[str], fresh: bool) -> DataFrame:
    """Search every (pivot, part) for the queries sent there. The queries of a part are cut into blocks, so
    a task holds one part and one block, however many queries want a part."""
    spark = placed.sparkSession
    units = spark.createDataFrame([(p, n, blocks.get(p, 0)) for p, n in parts.items()] or [(0, 1, 0)],
                                  "pivot int, parts long, blocks long")  # one row a pivot, so at most MAX_PIVOTS
    rows = placed.join(F.broadcast(units.where("blocks > 0")), "pivot").select(
        "pivot", F.pmod(F.xxhash64("vec_id"), "parts").alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "vec_id", "embedding")
    asked = queries.join(F.broadcast(units), "pivot").withColumn(
        "block", F.pmod(F.xxhash64("query_id", F.lit("block")), "blocks")).drop("parts", "blocks")
    schema = StructType([asked.schema[c] for c in carried]).add(StructField("found", StructType.fromDDL(f"found {_FOUND}")[0].dataType))
    unit = ["pivot", "part", "block"]
    return rows.groupBy(*unit).cogroup(asked.groupBy(*unit)).applyInArrow(_search(k, dims, carried, fresh), schema)


def _first_pivot(pivots: np.ndarray, radius: np.ndarray):
    """Append the pivot whose ball has the largest upper bound for a query."""
    def run(batches):
        for batch in batches:
            q = whole(matrix(batch.column("embedding"), pivots.shape[1]))
            best = _bounds(q, pivots, radius).argmax(axis=1) if len(q) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype("int32"))], names=[*batch.schema.names, "pivot"])

    return run


def _bounds(q: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
    m, p = len(q), len(pivots)
    with np.errstate(over="ignore", invalid="ignore"):
        norm = np.sqrt((q**2).sum(axis=1))
        flat = upper_bound(q, norm, np.repeat(np.arange(m), p), pivots, radius, np.tile(np.arange(p), m)).reshape(m, p)
    return np.where(np.isnan(flat), np.inf, flat)


def _other_pivots(pivots: np.ndarray, radius: np.ndarray, least: np.ndarray, k: int):
    """A row for each pivot whose ball may still hold an entry of the query's list."""
    def run(batches):
        for batch in batches:
            best = BestLists(batch.num_rows, k)
            best.start(batch.column("found").to_pylist())
            bound = _bounds(whole(matrix(batch.column("embedding"), pivots.shape[1])), pivots, radius)
            last, last_id = best.scores[:, -1:], best.ids[:, -1:]
            query, pivot = np.nonzero((bound > last) | ((bound == last) & (least[None, :] < last_id)))
            part = batch.take(pa.array(query))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pivot.astype("int32"))], names=[*batch.schema.names, "pivot"])

    return run


def exact_top_k(rows: DataFrame, queries: DataFrame, scratch: Scratch, k: int = 5, vec_id: str = "vec_id",
                embedding: str = "embedding") -> DataFrame:
    """The ``k`` rows with the highest scores for each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    A score is the inner product of the integer vectors (see ``inner_products``, also for nulls, odd widths
    and huge values); ties go to the smaller id. Rows that carry the query's id are not its candidates.
    Rows equal in id and integers are one candidate, rows equal in id and vector one query. Without rows or
    queries the result is empty; other columns are ignored.

    Rows are dealt to balls around pivots (at most ``MAX_PIVOTS``, fitted on a sample of at most 4096 rows;
    they decide only where a row goes) and large balls into parts, the shards, of bounded size. A query first
    searches one part of its most promising ball. The score in its last place then goes along to all other
    shards whose bound still reaches it, and inside a shard from node to node.
    """
    base = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    n, dims = facts(base, "embedding")
    shard_rows = max(1, SHARD_BYTES // (8 * dims))
    most = max(1, min(MAX_PIVOTS, n // PIVOT_ROWS, BOUNDED_BYTES // (8 * dims)))
    pivots = centers_of(sampled(base, "vec_id", "embedding", dims), most)
    placed = scratch.write(_placed(base, pivots, k), "placed")
    radius, least, parts = np.zeros(len(pivots)), np.full(len(pivots), NO_ID), {}
    for row in placed.groupBy("pivot").agg(
            F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"), F.min("vec_id").alias("least")).collect():
        radius[row["pivot"]], least[row["pivot"]] = row["radius"] * (1 + 1e-9) + 1e-6, row["least"]
        parts[row["pivot"]] = -(-row["n"] // shard_rows)
    held = np.array(sorted(parts), dtype=int)  # pivots that have rows

    asked = queries.select(F.col(vec_id).cast("long").alias("query_id"), F.col(embedding).alias("embedding"))
    asked = asked.withColumn("query_hash", F.xxhash64("embedding")).dropDuplicates(["query_id", "query_hash"])
    asked = asked.mapInArrow(lambda batches: (b.take(valid_rows(b, "embedding", "query_id")) for b in batches), asked.schema)
    if len(held):
        first = _first_pivot(pivots[held], radius[held])
        number = F.array(*[F.lit(int(p)) for p in held])
        homed = asked.mapInArrow(first, StructType(list(asked.schema)).add("pivot", IntegerType())).withColumn("pivot", F.get(number, F.col("pivot")))
    else:
        homed = asked.withColumn("pivot", F.lit(0)).where("false")
    sizes = F.broadcast(placed.sparkSession.createDataFrame(list(parts.items()) or [(0, 1)], "pivot int, parts long"))
    homed = homed.join(sizes, "pivot").withColumn("part", F.pmod(F.xxhash64("query_id", F.lit("part")), "parts")).drop("parts")
    homed = scratch.write(homed.withColumn("found", F.array().cast(_FOUND)), "homed")
    carried = ["query_id", "query_hash", "embedding", "home", "home_part"]
    asking = homed.withColumn("home", F.col("pivot")).withColumn("home_part", F.col("part"))
    begun = scratch.write(
        _visit(placed, asking, parts, _blocks(homed, parts), k, dims, carried, fresh=False), "begun")

    other = _other_pivots(pivots[held], radius[held], least[held], k)
    sent = begun.mapInArrow(other, StructType(list(begun.schema)).add("pivot", IntegerType()))
    sent = scratch.write(sent.withColumn("pivot", F.get(number, F.col("pivot"))) if len(held) else sent.where("false"), "sent")
    counts = {r["pivot"]: -(-r["count"] // QUERY_BLOCK) for r in sent.groupBy("pivot").count().collect()}
    onward = sent.join(sizes, "pivot").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    onward = onward.where((F.col("pivot") != F.col("home")) | (F.col("part") != F.col("home_part")))
    names = ["query_id", "query_hash"]
    more = _visit(placed, onward, parts, counts, k, dims, names, fresh=True)
    hits = begun.select(*names, "found").unionByName(more).select(*names, F.inline("found"))
    place = F.row_number().over(Window.partitionBy(*names).orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _blocks(homed: DataFrame, parts: dict[int, int]) -> dict[int, int]:
    """Blocks of queries for each part of a pivot: its queries are spread over its parts."""
    return {r["pivot"]: -(-r["count"] // (QUERY_BLOCK * parts[r["pivot"]])) for r in homed.groupBy("pivot").count().collect()}
