"""Hashes of any runs of a sequence, from prefix sums."""

from __future__ import annotations

import numpy as np

from lakeaudit.llm.common import BASE, mixed

_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


class Sums:
    """64-bit hashes of values[start:end] for any starts and ends."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, values: np.ndarray):
        n = len(values)
        if len(Sums._powers) <= n:
            one, size = np.ones(1, np.uint64), max(2 * n, 1 << 14)
            Sums._powers = np.cumprod(np.concatenate([one, np.full(size, BASE)]))
            Sums._inverses = np.cumprod(np.concatenate([one, np.full(size, _INVERSE)]))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(values + BASE) * Sums._powers[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * Sums._inverses[starts])

    def all_of(self, width: int) -> np.ndarray:
        """Hashes of all runs of ``width`` values."""
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * Sums._inverses[:n]) if n > 0 else np.empty(0, np.uint64)
