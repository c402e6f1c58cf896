"""Numeric helpers that run inside tasks, on column-wise numpy blocks.

Kept free of Spark imports so that Python workers load them quickly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa


#: Up to so many clusters a matrix product adds the rows of each up faster than counting does.
_PRODUCT_CLUSTERS = 32


def nearest_in_block(xs: Sequence[np.ndarray], centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels (ties: lowest index) and squared distances of one column-wise block."""
    return _nearest(xs, centers, False)[:2]


def nearest_with_gap(xs: Sequence[np.ndarray], centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, squared distances, and gaps: by how much the second-nearest centre is farther, at least."""
    return _nearest(xs, centers, True)


def _nearest(xs, centers, with_gap):
    if len(centers) == 1 or not len(xs[0]):
        return np.zeros(len(xs[0]), dtype=np.int32), _squares(xs, centers[0]), np.full(len(xs[0]), np.inf)
    points = xs if isinstance(xs, np.ndarray) else np.stack(xs)
    labels, gaps = _ranked(points, centers, with_gap)
    difference = points - centers.T[:, labels]
    return labels.astype(np.int32), np.einsum("ij,ij->j", difference, difference), gaps


def _ranked(points: np.ndarray, centers: np.ndarray, with_gap: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Labels and, if asked for, gaps. A matrix product finds the nearest centre. It rounds differently from the sum
    of squares that defines the distance, so points whose two nearest centres are nearly as far are compared by that
    sum."""
    with np.errstate(all="ignore"):
        size, norm = (centers**2).sum(axis=1), np.einsum("ij,ij->j", points, points)
        score = (-2.0 * centers) @ points
        score += size[:, None]
        labels, at = score.argmin(axis=0), np.arange(points.shape[1])
        least = score[labels, at]
        score[labels, at] = np.inf
        second, error = score.min(axis=0), 1e-12 * (norm + size.max())
        unsure = np.flatnonzero(~(second - least > error))
        gaps = np.sqrt(np.maximum(second + norm - error, 0.0)) - np.sqrt(np.maximum(least + norm, 0.0) + error) if with_gap else None
    if len(unsure):
        labels[unsure] = _compared(points[:, unsure], centers)
    return labels, gaps


def _squares(xs: Sequence[np.ndarray], center: Sequence) -> np.ndarray:
    square = (xs[0] - center[0]) ** 2
    for x, c in zip(xs[1:], center[1:]):
        square += (x - c) ** 2
    return square


def _compared(xs: Sequence[np.ndarray], centers: np.ndarray) -> np.ndarray:
    best, labels = np.full(len(xs[0]), np.inf), np.zeros(len(xs[0]), dtype=np.int32)
    for k, center in enumerate(centers):
        square = _squares(xs, center)
        closer = square < best
        labels[closer] = k
        np.minimum(best, square, out=best)
    return labels


def block_sums(xs: Sequence[np.ndarray], w: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """K x (2 + d) sums of one block: weight, weighted squared distance, weighted coordinates."""
    return label_sums(xs, w, *nearest_in_block(xs, centers), len(centers))


def label_sums(xs: Sequence[np.ndarray], w: np.ndarray, labels: np.ndarray, best: np.ndarray, k: int) -> np.ndarray:
    if k <= _PRODUCT_CLUSTERS:
        rows = np.concatenate([np.ones((1, len(w))), best[None, :], np.asarray(xs)]) * w
        return (labels == np.arange(k)[:, None]).astype("float64") @ rows.T
    columns = [np.bincount(labels, w, k), np.bincount(labels, w * best, k)]
    columns += [np.bincount(labels, w * x, k) for x in xs]
    return np.stack(columns, axis=1)


#: Points of a block that are looked at together, so that they stay in the cache of a core.
_CACHED_POINTS = 2048


def center_sums(block: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """K x (1 + d) sums of a block of points and weights: weight and weighted coordinates. No squared distances are
    formed, and of the points no copies are made."""
    k = len(centers)
    total = np.zeros((k, len(block)))
    for at in range(0, block.shape[1], _CACHED_POINTS):
        points, w = block[:-1, at:at + _CACHED_POINTS], block[-1, at:at + _CACHED_POINTS]
        labels = _ranked(points, centers, False)[0] if k > 1 else np.zeros(len(w), "int64")
        if k <= _PRODUCT_CLUSTERS:
            member = (labels == np.arange(k)[:, None]) * w
            total[:, 0] += member.sum(axis=1)
            total[:, 1:] += member @ points.T
        else:
            total += np.stack([np.bincount(labels, w, k), *[np.bincount(labels, w * x, k) for x in points]], axis=1)
    return total


#: Points of a leaf, and the widest points whose boxes can be expected to lie within one cluster.
LEAF_POINTS, TILED_DIMS = 32, 8


def tiled(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The points of a block dealt into leaves, and the leaves.

    Every dimension in turn cuts what the dimensions before have made into slabs of as many points each. All leaves
    have the same number of points; those missing are copies without weight. A leaf is a column of 3d + 2 numbers: the
    middle and half the sides of its box, weight, weighted sums of coordinates, squared distances to their mean.
    """
    dims, n = len(block) - 1, block.shape[1]
    slabs = _slabs(block[:-1].std(axis=1), max(1, n // LEAF_POINTS))
    leaves = int(np.prod(slabs))
    order, made = np.arange(leaves * -(-n // leaves)).reshape(1, -1), 1
    for j in np.flatnonzero(slabs > 1):
        key = block[j][np.minimum(order, n - 1)]
        order = np.take_along_axis(order, key.argsort(axis=1), axis=1)
        made *= slabs[j]
        order = order.reshape(made, -1)
    order = order.ravel()
    points = block[:, np.minimum(order, n - 1)]
    points[-1, order >= n] = 0.0
    split = points.reshape(dims + 1, leaves, -1)
    low, high = split[:-1].min(axis=2), split[:-1].max(axis=2)
    middle = low + (high - low) / 2
    half = np.maximum(high - middle, middle - low)
    weight, total = split[-1].sum(axis=1), np.einsum("jlp,lp->jl", split[:-1], split[-1])
    mean = np.divide(total, weight, out=middle.copy(), where=weight > 0)
    spread = sum(((x - m[:, None]) ** 2 * split[-1]).sum(axis=1) for x, m in zip(split, mean))
    return points, np.vstack([middle, half, weight, total, spread])


def _slabs(spread: np.ndarray, leaves: int) -> np.ndarray:
    """Into how many slabs each dimension is cut: in proportion to its spread, about ``leaves`` in all."""
    slabs, cut = np.ones(len(spread), "int64"), np.flatnonzero(spread > 0)
    while len(cut):
        share = spread[cut] * np.exp((np.log(leaves) - np.log(spread[cut]).sum()) / len(cut))
        if (share >= 1).all():
            slabs[cut] = np.floor(share + 1e-9)
            break
        cut = cut[share >= 1]
    return slabs


class Leaves:
    """What is known of the leaves of a tiled block at some centres.

    ``labels`` are the centres nearest to their middles. ``sure`` are the leaves all of whose points are nearest to
    that centre, by a ``gap`` (see ``nearest_with_gap``) of at least so much.
    """

    def __init__(self, leaves: np.ndarray, centers: np.ndarray, with_gap: bool = False):
        dims = centers.shape[1]
        self.leaves, self.centers = leaves, centers
        middle, half = leaves[:dims], leaves[dims:2 * dims]
        with np.errstate(all="ignore"):
            size, reach = (centers**2).sum(axis=1), np.sqrt((half**2).sum(axis=0))
            norm = (middle**2).sum(axis=0)
            far = (-2.0 * centers) @ middle
            far += size[:, None]
            self.labels = far.argmin(axis=0)
            error = 1e-12 * ((np.sqrt(norm) + reach) ** 2 + size.max())
            lead = np.full(len(norm), np.inf)
            if with_gap:
                far = np.sqrt(np.maximum(far + norm, 0.0) + error) + reach
                gap = np.full(len(norm), np.inf)
            for k in range(len(centers)) if len(centers) > 1 else []:
                own = np.flatnonzero(self.labels == k)
                toward = 2.0 * (centers[k] - centers)
                least = toward @ middle[:, own] - np.abs(toward) @ half[:, own] + (size - size[k])[:, None] - error[own]
                least[k] = np.inf
                lead[own] = least.min(axis=0)
                if with_gap:
                    gap[own] = (least / (far[:, own] + far[k, own])).min(axis=0)
        self.sure = lead > 0
        self.gap = np.where(self.sure, gap, 0.0) if with_gap else None

    def sums(self, sure: np.ndarray) -> np.ndarray:
        """K x (2 + d) sums of the points of some sure leaves (see ``block_sums``)."""
        dims, k = self.centers.shape[1], len(self.centers)
        weight, total, spread = self.leaves[2 * dims, sure], self.leaves[2 * dims + 1:-1, sure], self.leaves[-1, sure]
        labels = self.labels[sure]
        mean = np.divide(total, weight, out=np.zeros_like(total), where=weight > 0)
        square = spread + weight * ((mean - self.centers.T[:, labels]) ** 2).sum(axis=0)
        return np.stack([np.bincount(labels, v, k) for v in (weight, square, *total)], axis=1)

    def points(self, block: np.ndarray, some: np.ndarray) -> np.ndarray:
        """The points and weights of some leaves."""
        return block.reshape(len(block), len(some), -1)[:, some].reshape(len(block), -1)


def point_sums(block: np.ndarray, centers: np.ndarray, squares: bool = True) -> np.ndarray:
    """``block_sums`` of points and weights, some points at a time; without ``squares`` these sums are 0."""
    if not squares:
        return np.insert(center_sums(block, centers), 1, 0.0, axis=1)
    parts = (block[:, at:at + _CACHED_POINTS] for at in range(0, block.shape[1], _CACHED_POINTS))
    return sum((block_sums(p[:-1], p[-1], centers) for p in parts), np.zeros((len(centers), len(block) + 1)))


def tiled_sums(block: np.ndarray, leaves: np.ndarray, centers: np.ndarray, squares: bool = True) -> np.ndarray:
    """``point_sums`` of a tiled block: leaves within one cluster are added up whole."""
    found = Leaves(leaves, centers)
    return found.sums(found.sure) + point_sums(found.points(block, ~found.sure), centers, squares)


def tiled_labels(block: np.ndarray, leaves: np.ndarray | None, models: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """(labels of each model, weights) of the leaves that lie within one cluster of every model, if the block is tiled,
    and of all other points."""
    labels, weight = [np.zeros(0, "int64")] * len(models), np.zeros(0)
    if leaves is not None:
        found = [Leaves(leaves, m) for m in models]
        sure = np.logical_and.reduce([f.sure for f in found])
        labels, weight = [f.labels[sure] for f in found], leaves[2 * len(block) - 2, sure]
        block = found[0].points(block, ~sure)
    for at in range(0, block.shape[1], _CACHED_POINTS):
        part = block[:, at:at + _CACHED_POINTS]
        labels = [np.concatenate([own, nearest_in_block(part[:-1], m)[0]]) for own, m in zip(labels, models)]
        weight = np.concatenate([weight, part[-1]])
    return labels, weight


#: Gaps are counted between powers of two from this exponent on, in so many classes above the first.
FIRST_GAP, GAP_CLASSES = -24, 30


def gap_classes(gaps: np.ndarray) -> np.ndarray:
    """Class of each gap: 0, or c from 2^(FIRST_GAP + c) on."""
    with np.errstate(divide="ignore", invalid="ignore"):
        step = np.floor(np.log2(gaps)) - FIRST_GAP
    return np.clip(np.nan_to_num(step, nan=0.0, posinf=GAP_CLASSES, neginf=0.0), 0, GAP_CLASSES).astype("int32")


def gap_floor(c: int) -> float:
    return 0.0 if c == 0 else 2.0 ** (FIRST_GAP + c)


def largest_moves(before: np.ndarray, after: np.ndarray) -> float:
    """The two largest distances between a centre and its successor, added up: what a gap has to exceed."""
    return float(np.sort(np.sqrt(((after - before) ** 2).sum(axis=1)))[-2:].sum()) * (1 + 1e-9)


def move_centers(sums: np.ndarray, centers: np.ndarray, farthest: Callable[[int], list]) -> np.ndarray:
    """New centres: weighted means; an empty cluster takes over the point farthest from its centre."""
    weight, total = sums[:, 0].copy(), sums[:, 2:].copy()
    empty = np.flatnonzero(weight == 0)
    if len(empty):
        for k, (x, w, label) in zip(empty, farthest(len(empty))):
            weight[label] -= w
            total[label] -= w * x
            weight[k] = w
            total[k] = w * x
    moved = centers.copy()
    filled = weight > 0
    moved[filled] = total[filled] / weight[filled, None]
    return moved


def largest_move(before: np.ndarray, after: np.ndarray) -> float:
    """Largest distance between a centre and its successor."""
    return float(np.sqrt(((after - before) ** 2).sum(axis=1)).max())


def widest_ratio(spread: np.ndarray, means: np.ndarray, other_spread: np.ndarray, other_means: np.ndarray) -> np.ndarray:
    """max over the other clusters of (spread + spread) / centre distance, for each cluster."""
    worst = np.zeros(len(spread))
    for i, (s, mean) in enumerate(zip(spread, means)):
        gap = np.sqrt(((other_means - mean) ** 2).sum(axis=1))
        ratio = np.divide(s + other_spread, gap, out=np.zeros(len(gap)), where=gap > 0)
        worst[i] = ratio.max() if len(ratio) else 0.0
    return worst


#: Rows and columns of the tiles in which distances are formed; a tile stays in the cache of a core.
TILE_ROWS, TILE_COLUMNS = 256, 512
#: Rows with equal members, on average, from which adding them up first is faster.
LONG_RUN = 4


def add_distances(x: np.ndarray, y: np.ndarray | None, x_member: np.ndarray, y_member: np.ndarray | None,
                  to_x: np.ndarray, to_y: np.ndarray | None) -> None:
    """Add to ``to_x`` each row's Euclidean distances to the rows of ``y``, summed over the members of each
    column of ``y_member``, and the other way round to ``to_y``. Without ``y`` the rows of ``x`` are compared
    with each other. A distance is formed once for both of its rows, and no more than a tile of them is held; of the
    rows of ``x``, if not compared with each other, no copy is made, so the larger side should be ``x``. Rows with equal
    members that follow each other are added up before they are dealt to the columns."""
    own, origin = y is None, x.mean(axis=0)
    y, y_member, to_y = (x, x_member, to_x) if own else (y, y_member, to_y)
    dims = x.shape[1]
    right = np.ones((len(y), dims + 2))
    np.subtract(y, origin, out=right[:, :dims])
    right[:, -1] = np.einsum("ij,ij->i", right[:, :dims], right[:, :dims])
    rows = TILE_COLUMNS if own else TILE_ROWS
    y_runs = [_runs(y_member[j:j + TILE_COLUMNS]) for j in range(0, len(y), TILE_COLUMNS)]
    for i in range(0, len(x), rows):
        a = slice(i, i + rows)
        x_runs = _runs(x_member[a])
        tile = x[a] - origin
        left = np.column_stack([-2.0 * tile, np.einsum("ij,ij->i", tile, tile), np.ones(len(tile))])
        for j in range(i if own else 0, len(y), TILE_COLUMNS):
            b = slice(j, j + TILE_COLUMNS)
            distance = left @ right[b].T
            np.sqrt(np.maximum(distance, 0.0, out=distance), out=distance)
            if own and i == j:
                np.fill_diagonal(distance, distance.diagonal() * 0.0)
                to_x[a] += _by_member(distance, y_member[b], y_runs[j // TILE_COLUMNS])
                continue
            to_x[a] += _by_member(distance, y_member[b], y_runs[j // TILE_COLUMNS])
            to_y[b] += _by_member(distance.T, x_member[a], x_runs)


def _runs(member: np.ndarray) -> np.ndarray:
    """Where the runs of equal rows begin."""
    return np.flatnonzero(np.append(True, (member[1:] != member[:-1]).any(axis=1)))


def _by_member(distance: np.ndarray, member: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """``distance @ member``; long runs of equal rows of ``member`` are added up first."""
    if len(runs) * LONG_RUN > len(member):
        return distance @ member
    return np.add.reduceat(distance, runs, axis=1) @ member[runs]


def expected_mutual_information(size: int, others: np.ndarray, times: np.ndarray, total: int) -> float:
    """Sum over groups of the other labeling of E[n/N log(N n / (a b))], n hypergeometric.

    Probabilities follow from ratios of neighbouring terms, starting at the mode and normalised at the
    end, so no large factorial is needed. Terms beyond 16 standard deviations plus 64 are below any
    double and are skipped.
    """
    result = 0.0
    for other, count in zip(others.tolist(), times.tolist()):
        low, high = max(0, size + other - total), min(size, other)
        mode = min(high, max(low, (size + 1) * (other + 1) // (total + 2)))
        share = other / total
        deviation = np.sqrt(size * share * (1 - share) * (total - size) / max(1, total - 1))
        width = int(16 * deviation) + 64
        up = np.arange(mode, min(high, mode + width), dtype=float)
        down = np.arange(mode, max(low, mode - width), -1.0)
        log_up = np.cumsum(np.log((size - up) * (other - up)) - np.log((up + 1) * (total - size - other + up + 1)))
        log_down = np.cumsum(np.log(down * (total - size - other + down)) - np.log((size - down + 1) * (other - down + 1)))
        n = np.concatenate([[mode], up + 1, down - 1])
        weight = np.exp(np.concatenate([[0.0], log_up, log_down]))
        keep = n > 0
        n, weight, norm = n[keep], weight[keep], weight.sum()
        value = n / total * (np.log(n) + np.log(total) - np.log(size) - np.log(other))
        result += count * float((weight * value).sum() / norm)
    return result


class BatchState:
    """Progress of mini-batch k-means between batches: centre-sized, whatever the data size."""

    def __init__(self, centers, counts, smoothing, steps=0, error=np.nan, best=np.inf, stale=0, done=False):
        self.centers, self.counts, self.smoothing = centers.copy(), counts.copy(), smoothing
        self.steps, self.error, self.best, self.stale, self.done = steps, error, best, stale, done

    def absorb(self, sums: np.ndarray, patience: int) -> None:
        """Fold the ``block_sums`` of one batch into the running means and update the stopping rule."""
        weight = sums[:, 0]
        hit = weight > 0
        self.counts += weight
        rate = (weight[hit] / self.counts[hit])[:, None]
        self.centers[hit] += rate * (sums[hit, 2:] / weight[hit, None] - self.centers[hit])
        self.steps += 1
        if self.steps == 1:  # the error of the bare seeds says nothing about progress
            return
        error = sums[:, 1].sum() / weight.sum()
        self.error = error if np.isnan(self.error) else self.error + self.smoothing * (error - self.error)
        self.stale = 0 if self.error < self.best else self.stale + 1
        self.best = min(self.best, self.error)
        self.done = self.stale >= patience

    def numbers(self) -> list[float]:
        """The state as doubles."""
        return [*self.centers.ravel(), *self.counts, self.smoothing, self.steps, self.error, self.best, self.stale, self.done]

    @staticmethod
    def of(numbers: Sequence[float], k: int) -> "BatchState":
        *rest, smoothing, steps, error, best, stale, done = numbers
        centers, counts = np.array(rest[:-k]).reshape(k, -1), np.array(rest[-k:])
        return BatchState(centers, counts, smoothing, int(steps), error, best, int(stale), bool(done))
