"""Rolling hashes and local minima over arrays, for content-defined anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd, so that it has an inverse modulo 2**64.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
#: Positions looked at a time; longer texts go block by block.
BLOCK = 1 << 18


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def windows(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash (modulo 2**64, ``base`` odd) of every ``width`` neighbours of ``values``."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up = powers(base, len(values))
    down = powers(pow(base, -1, 1 << 64), n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up, dtype=np.uint64)])
    return (sums[width:] - sums[:n]) * down


def mixed(values: np.ndarray) -> np.ndarray:
    """A second, independent-looking value for each hash (the splitmix64 finaliser)."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def minima(hashes: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every window of ``width`` hashes, where its first minimum is.

    Yields (position of the first window of a block, positions of the minima). The choice
    depends on the content of the window alone.
    """
    n = len(hashes) - width + 1
    low = np.uint64((1 << 24) - 1)
    for at in range(0, n, BLOCK):
        part = hashes[at : min(n, at + BLOCK) + width - 1]
        best = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while reach < width:
            step = min(reach, width - reach)
            best = np.minimum(best[:-step], best[step:])
            reach += step
        yield at, (best & low).astype(np.int64) + at
