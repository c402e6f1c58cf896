"""Synthetic Gaussian mixtures with a fixed overlap of the closest pair of centres."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.randomness import keyed_normal

MAX_OVERLAP = 0.05


def mixture_centers(k: int, d: int, seed: int = 0) -> np.ndarray:
    """K centres, uniform in [-1, 1]^d."""
    return np.random.default_rng(seed).uniform(-1.0, 1.0, (k, d))


def overlap_sigma(centers: np.ndarray, overlap: float = MAX_OVERLAP) -> float:
    """Deviation at which two normals as far apart as the closest distinct centres overlap by ``overlap``.

    Two equal normals at distance m overlap by 2 Phi(-m / (2 sigma)), which is solved for sigma.
    """
    gaps = [np.linalg.norm(a - b) for i, a in enumerate(centers) for b in centers[i + 1:]]
    gaps = [g for g in gaps if g > 0]
    if not gaps:
        raise ValueError("needs at least two distinct centres")
    return float(min(gaps) / (2.0 * NormalDist().inv_cdf(1.0 - overlap / 2.0)))


def normal_overlap(gap: float, sigma: float) -> float:
    """Shared area of two normals of deviation ``sigma`` whose means are ``gap`` apart."""
    return 2.0 * NormalDist().cdf(-gap / (2.0 * sigma))


def gaussian_mixture(
    source: SparkSession | DataFrame, k: int, d: int, n: int | None = None, seed: int = 0, normalize: bool = True,
    replica: int = 0, id_col: str = "id", centers=None, sigma: float | None = None, method: str = "xxhash64",
) -> DataFrame:
    """(id, x0.., y): isotropic blobs with rows split evenly over the centres.

    ``source`` is a session (``n`` rows with ids 0..n-1) or a table whose BIGINT column ``id_col`` names
    the rows. Every value is a function of (seed, replica, id), so replicas differ only in their seed
    and any part can be recomputed alone. ``normalize`` divides each column by its largest magnitude.
    """
    ids = source.range(n).select("id") if isinstance(source, SparkSession) else source.select(F.col(id_col).alias("id"))
    key = f"{seed}|{replica}"
    if centers is None:
        centers = np.random.default_rng([seed, replica]).uniform(-1.0, 1.0, (k, d))
    centers = np.asarray(centers, dtype=float)
    if sigma is None:
        sigma = overlap_sigma(centers)
    y = F.pmod(F.col("id"), F.lit(k)).cast("int")
    rows = ids.withColumn("y", y)
    values = []
    for j in range(d):
        center = F.get(F.lit(centers[:, j].tolist()), F.col("y"))
        values.append((center + F.lit(sigma) * keyed_normal(f"{key}|{j}", ["id"], method)).alias(f"x{j}"))
    rows = rows.select("id", *values, "y")
    return max_abs_scaled(rows, [f"x{j}" for j in range(d)]) if normalize else rows


def max_abs_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Divide columns by their largest magnitude (found by one aggregation)."""
    top = df.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in columns]).first()
    return df.withColumns({c: F.col(c) / F.lit(top[c]) if top[c] else F.col(c) for c in columns})
