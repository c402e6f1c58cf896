"""Polynomial hashes of byte ranges, all at once: differences of running sums, moved to place 0."""

from __future__ import annotations

import numpy as np

#: Odd, so that it has an inverse modulo 2^64.
MULTIPLIER = 0x9E3779B97F4A7C15
_STEP = 1 << 18
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the multiplier and of its inverse modulo 2^64, at least n of each."""
    size = -(-n // _STEP) * _STEP
    if len(_POWERS.get("up", ())) < size:
        for name, base in (("up", MULTIPLIER), ("down", pow(MULTIPLIER, -1, 1 << 64))):
            factors = np.full(size, base, "uint64")
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class RangeHashes:
    """Hashes of ranges of a byte array that do not depend on where a range stands."""

    def __init__(self, data: np.ndarray):
        up, self._down = _powers(max(len(data), 1))
        self._sums = np.zeros(len(data) + 1, "uint64")
        np.cumsum((data.astype("uint64") + np.uint64(1)) * up[:len(data)], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def every(self, length: int) -> np.ndarray:
        """The hash of the range of this length from each place on where one fits."""
        n = max(len(self._sums) - length, 0)
        return mixed((self._sums[length:] - self._sums[:n]) * self._down[:n])
