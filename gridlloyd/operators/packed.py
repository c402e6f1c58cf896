"""Points packed column-wise into blocks of bytes, for the many passes of iterative fits.

A row of a packed table is a block: its number of points ``n`` and ``data``, the doubles of ``x0..`` and ``w``
one column after the other. Reading a block is a copy of bytes; decoding, conversion and row-wise work are
paid once. A tiled block has its points dealt into ``leaves`` of near ones, see ``blocks.tiled``; a leaf that lies
within one cluster needs no look at its points.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, fits_bound
from .blocks import (
    GAP_CLASSES, TILED_DIMS, Leaves, center_sums, gap_classes, label_sums, largest_moves, nearest_with_gap,
    point_sums, tiled, tiled_sums,
)

#: Bytes of packed points that are worth a task of their own, and of points that are tiled together.
TASK_BYTES, TILED_BYTES = 4 << 20, 24 << 20
#: Compression of tiled points: near points have much in common, and fewer bytes go to the Python workers.
CODEC = "lz4_raw"
#: Rows of an Arrow batch, if a session has the default.
BATCH_ROWS = 10_000
_DDL = "n int, data binary"


def coordinates(points: DataFrame) -> list[str]:
    return [c for c in points.columns if c[0] == "x" and c[1:].isdigit()]


def as_block(columns: Sequence[np.ndarray]) -> bytes:
    return np.concatenate([np.asarray(c, dtype="float64") for c in columns]).tobytes()


def from_blocks(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The blocks of a batch as arrays of ``width`` columns."""
    for value in batch.column("data"):
        yield np.frombuffer(value.as_buffer(), "float64").reshape(width, -1)


def pack(points: DataFrame, dims: int) -> DataFrame:
    """Points ``x0..``, ``w`` as blocks, one for each Arrow batch; a projection."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            block = as_block([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int32()), pa.array([block])], names=["n", "data"])

    return points.select(*[f"x{j}" for j in range(dims)], "w").mapInArrow(run, _DDL)


def pack_tiled(points: DataFrame, dims: int) -> DataFrame:
    """Points ``x0..``, ``w`` as tiled blocks; a projection. Boxes of wide points hardly ever lie within one cluster,
    so these are packed as they come."""
    if dims > TILED_DIMS:
        return pack(points, dims)
    most = TILED_BYTES // (8 * (dims + 1))

    def made(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        block, leaves = tiled(np.concatenate(held, axis=1))
        split = block.reshape(dims + 1, leaves.shape[1], -1)
        step = max(1, TASK_BYTES // (8 * (dims + 1) * split.shape[2]))
        for at in range(0, leaves.shape[1], step):
            part = split[:, at:at + step]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[0].size], pa.int32()), pa.array([pa.compress(part.tobytes(), CODEC, asbytes=True)]),
                 pa.array([leaves[:, at:at + step].tobytes()])],
                names=["n", "data", "leaves"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
                rows += batch.num_rows
            if rows >= most:
                yield from made(held)
                held, rows = [], 0
        if held:
            yield from made(held)

    return points.select(*[f"x{j}" for j in range(dims)], "w").mapInArrow(run, f"{_DDL}, leaves binary")


def block_columns(packed: DataFrame) -> list[str]:
    return ["n", "data", "leaves"] if "leaves" in packed.columns else ["data"]


def tiled_blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """The blocks of a batch with their leaves, if they are tiled."""
    if "leaves" not in batch.schema.names:
        yield from ((block, None) for block in from_blocks(batch, width))
        return
    for n, data, leaves in zip(batch.column("n").to_pylist(), batch.column("data"), batch.column("leaves")):
        block = np.frombuffer(pa.decompress(data.as_buffer(), n * width * 8, CODEC), "float64").reshape(width, n)
        yield block, np.frombuffer(leaves.as_buffer(), "float64").reshape(3 * width - 1, -1)


def write(packed: DataFrame, scratch: Scratch, name: str, n_rows: int, width: int) -> DataFrame:
    """The blocks as a written table, in no more tasks than its bytes are worth. Readers hold all blocks of a file, so
    files are kept small."""
    worth = max(1, -(-n_rows * width * 8 // TASK_BYTES))
    block = TASK_BYTES if "leaves" in packed.columns else BATCH_ROWS * width * 8
    return scratch.write(packed.coalesce(worth), name, maxRecordsPerFile=max(1, TASK_BYTES // block), compression="none")


def model_sums(packed: DataFrame, models: Sequence[np.ndarray], tasks: int, squares: bool = True) -> list[np.ndarray]:
    """For each set of centres K x (2 + d) sums over all points (see ``block_sums``), all in one pass. Without
    ``squares`` the squared distances are left out (0).

    Every task reduces its points to K partial rows a model. A shuffle adds them up, unless ``tasks`` proves
    them few enough for the driver.
    """
    dims = models[0].shape[1]
    names = ["weight", "sse"] + [f"s{j}" for j in range(dims)]
    sizes = [len(m) for m in models]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        totals = [np.zeros((k, 2 + dims)) for k in sizes]
        for batch in batches:
            for block, leaves in tiled_blocks(batch, dims + 1):
                for total, centers in zip(totals, models):
                    total += point_sums(block, centers, squares) if leaves is None else tiled_sums(block, leaves, centers, squares)
        yield _sum_rows(totals, names)

    partial = packed.select(*block_columns(packed)).mapInArrow(run, "model int, k int, " + ", ".join(f"{c} double" for c in names))
    if not fits_bound(tasks * sum(sizes), 8 * (4 + dims)):
        partial = partial.groupBy("model", "k").agg(*[F.sum(c).alias(c) for c in names])
    return _added(partial.toArrow(), sizes, dims)


def _sum_rows(totals: Sequence[np.ndarray], names: Sequence[str]) -> pa.RecordBatch:
    both = np.concatenate(totals)
    model = np.repeat(np.arange(len(totals), dtype="int32"), [len(t) for t in totals])
    k = np.concatenate([np.arange(len(t), dtype="int32") for t in totals])
    return pa.RecordBatch.from_arrays(
        [pa.array(model), pa.array(k), *[pa.array(both[:, j].copy()) for j in range(both.shape[1])]], names=["model", "k", *names])


def _added(rows: pa.Table, sizes: Sequence[int], dims: int) -> list[np.ndarray]:
    out = [np.zeros((k, 2 + dims)) for k in sizes]
    columns = np.stack([rows.column(j + 2).to_numpy() for j in range(2 + dims)], axis=1)
    for m, total in enumerate(out):
        own = rows.column("model").to_numpy() == m
        np.add.at(total, rows.column("k").to_numpy()[own], columns[own])
    return out


_PART = "part int, n int, data binary, numbers array<double>"
_BOUNDARY, _TOTAL, _SAFE, _COUNTS = range(4)
#: Parts of a set of centres, and points that are compared with it at once.
_PARTS, PART_POINTS = 4, 4096


def _parts(packed: DataFrame, models: Sequence[np.ndarray], margin: float | None) -> DataFrame:
    """For each set of centres the sums of all points and a count of their gaps from each task; with a ``margin`` also
    the sums of the points with larger gaps, and the other points themselves (of a single set)."""
    dims = models[0].shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total, safe = ([np.zeros((len(m), 2 + dims)) for m in models] for _ in range(2))
        counts = [np.zeros(GAP_CLASSES + 1) for _ in models]
        for batch in batches:
            for packed_block, leaves in tiled_blocks(batch, dims + 1):
                for i, centers in enumerate(models):
                    block = packed_block
                    if leaves is not None:
                        found = Leaves(leaves, centers, with_gap=True)
                        whole = found.gap > (margin or 0.0)
                        own = found.sums(whole)
                        total[i] += own
                        safe[i] += own
                        counts[i] += np.bincount(gap_classes(found.gap[whole]), minlength=GAP_CLASSES + 1) * (block.shape[1] // len(whole))
                        block = found.points(block, ~whole)
                    rest = []
                    for at in range(0, block.shape[1], PART_POINTS):
                        part = block[:, at:at + PART_POINTS]
                        labels, best, gaps = nearest_with_gap(part[:-1], centers)
                        own = label_sums(part[:-1], part[-1], labels, best, len(centers))
                        total[i] += own
                        if margin is None:
                            counts[i] += np.bincount(gap_classes(gaps), minlength=GAP_CLASSES + 1)
                            continue
                        near = ~(gaps > margin)
                        rest.append(part[:, near])
                        safe[i] += own - label_sums(rest[-1][:-1], rest[-1][-1], labels[near], best[near], len(centers))
                    if rest:
                        rest = np.concatenate(rest, axis=1)
                        yield _part([(_BOUNDARY, rest.shape[1], rest.tobytes(), None)])
        for i in range(len(models)):
            at = i * _PARTS
            yield _part([(at + _TOTAL, 0, None, total[i].ravel()), (at + _SAFE, 0, None, safe[i].ravel()), (at + _COUNTS, 0, None, counts[i])])

    return packed.select(*block_columns(packed)).mapInArrow(run, _PART)


def _part(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["part", "n", "data", "numbers"])


def _numbers(parts: DataFrame, tasks: int, size: int) -> dict[int, np.ndarray]:
    """The added-up numbers of each part."""
    some = parts.where(F.col("part") != _BOUNDARY).select("part", "numbers")
    if fits_bound(tasks, 3 * size):
        out: dict[int, np.ndarray] = {}
        for row in some.collect():
            out[row["part"]] = out.get(row["part"], 0) + np.array(row["numbers"])
        return out
    added = some.select("part", F.posexplode("numbers").alias("at", "v")).groupBy("part", "at").agg(F.sum("v").alias("v"))
    return {part: np.array([r["v"] for r in sorted(rows, key=lambda r: r["at"])])
            for part, rows in _by_part(added.collect()).items()}


def _by_part(rows) -> dict[int, list]:
    out: dict[int, list] = {}
    for row in rows:
        out.setdefault(row["part"], []).append(row)
    return out


def counted_pass(packed: DataFrame, models: Sequence[np.ndarray], tasks: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each set of centres K x (2 + d) sums over all points, and how many points there are in each class of gaps;
    the gaps are lower bounds."""
    most = max(m.size + 2 * len(m) for m in models)
    found = _numbers(_parts(packed, models, None), tasks, len(models) * max(most, GAP_CLASSES + 1))
    return [(found[i * _PARTS + _TOTAL].reshape(len(m), -1), found[i * _PARTS + _COUNTS]) for i, m in enumerate(models)]


class Boundary:
    """The points that can change their cluster, while all others are known by the sums of their clusters.

    At the centres it is made for, every point has a gap: how much farther the second-nearest centre is than
    the nearest. As long as the two largest movements of centres add up to no more than ``margin``, points
    with larger gaps keep their cluster. ``sums`` are those of all points at these centres.
    """

    def __init__(self, packed: DataFrame, centers: np.ndarray, margin: float, scratch: Scratch, name: str, tasks: int):
        self.centers, self.margin = centers.copy(), margin
        k, dims = centers.shape
        parts = scratch.write(_parts(packed, [centers], margin), name, compression="none")
        found = _numbers(parts, tasks, max(k * (2 + dims), GAP_CLASSES + 1))
        self.sums, self.safe = found[_TOTAL].reshape(k, -1), found[_SAFE].reshape(k, -1)
        self.points = parts.where(F.col("part") == _BOUNDARY).select("data")
        self.tasks = tasks

    @classmethod
    def of_all(cls, packed: DataFrame, centers: np.ndarray) -> "Boundary":
        """All of few points, however far the centres move."""
        whole = cls.__new__(cls)
        whole.centers, whole.margin, whole.tasks = centers.copy(), np.inf, 1
        whole.safe, whole.points = np.zeros((len(centers), 2 + centers.shape[1])), packed.select(*block_columns(packed)).repartition(1)
        return whole

    def holds(self, centers: np.ndarray) -> bool:
        return largest_moves(self.centers, centers) <= self.margin

    def step(self, centers: np.ndarray) -> np.ndarray:
        """Sums at new centres; squared distances (column 1) are those of the safe points at the centres before."""
        return self.safe + model_sums(self.points, [centers], self.tasks, squares=False)[0]

    def iterate(self, centers: np.ndarray, steps: int, tol: float) -> tuple[np.ndarray, int, bool]:
        """Up to ``steps`` Lloyd steps in one task that holds the boundary: new centres, steps made, and whether
        they converged. It ends early when the margin is used up or a cluster runs empty."""
        width = centers.shape[1] + 1

        def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
            blocks = [b for batch in batches for b, _ in tiled_blocks(batch, width)]
            now, made, shift = centers, 0, np.inf
            while made < steps and shift > tol and self_holds(now):
                sums = safe.copy()
                for block in blocks:
                    sums += center_sums(block, now)
                if (sums[:, 0] <= 0).any():
                    break
                moved = sums[:, 1:] / sums[:, :1]
                shift, now, made = float(((moved - now) ** 2).sum()), moved, made + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([now.ravel()], pa.list_(pa.float64())), pa.array([made], pa.int32()), pa.array([shift <= tol])],
                names=["centers", "made", "ended"])

        origin, margin, safe = self.centers, self.margin, np.delete(self.safe, 1, axis=1)

        def self_holds(now):
            return largest_moves(origin, now) <= margin

        row = self.points.coalesce(1).mapInArrow(run, "centers array<double>, made int, ended boolean").first()
        return np.array(row["centers"]).reshape(centers.shape), row["made"], row["ended"]
