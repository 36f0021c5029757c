"""One integer support threshold for every miner."""

from __future__ import annotations

import math


def min_count(min_support: float, n: int) -> int:
    """Smallest count whose share reaches ``min_support``; the slack absorbs float error (0.07 * 100)."""
    return max(1, math.ceil(min_support * n - 1e-9))


def mllib_support(count: int, n: int) -> float:
    """A fraction that MLlib rounds up to exactly ``count`` of ``n``."""
    return (count - 0.5) / n
