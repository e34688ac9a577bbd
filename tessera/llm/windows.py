"""Repeated windows of a sequence, found by way of minimizers.

A window is ``length`` consecutive symbols (bytes, or words by their hash) of
one row. Its minimizer is the least hash of its ``seed`` consecutive symbols.
Equal windows have equal minimizers, and neighbouring windows mostly share
theirs, so windows travel as runs (start, number of windows, minimizer) to
the owner of their minimizer, where all their equals arrive too.
"""

from __future__ import annotations

import numpy as np

from tessera.llm.common import mix64, powers

_SYMBOL_BASE = 0xD6E8FEB86659FD93  # odd
_SYMBOL_INVERSE = pow(_SYMBOL_BASE, -1, 1 << 64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return np.empty(0, values.dtype)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    blocks = padded.reshape(rows, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n - width + 1], forward[width - 1:n])


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Sums of ``symbols[i] * base**i``, from which :func:`range_hash` hashes any range."""
    sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum(symbols * powers(_SYMBOL_BASE, len(symbols)), out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range of symbols; equal ranges have equal hashes, wherever they are."""
    return mix64((sums[ends] - sums[starts]) * powers(_SYMBOL_INVERSE, len(sums))[starts])


def runs(symbols: np.ndarray, bounds: np.ndarray, length: int, seed: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimizer in the rows between ``bounds``.

    Returns row, start in the row, number of windows, minimizer, and the
    hash of all the symbols of each run (its windows and what they cover).
    A run ends where its minimizer's place does, so windows that repeat
    within one row are in different runs, and no run has more than
    ``length - seed + 1`` windows.
    """
    n = len(symbols)
    empty = np.empty(0, np.int64)
    if n < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    sums = prefix_sums(symbols)
    k = n - seed + 1
    seeds = mix64((sums[seed:] - sums[:k]) * powers(_SYMBOL_INVERSE, k))
    least = sliding_min(seeds, length - seed + 1)  # of the window that starts at each symbol
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:len(least)]
    inside = np.arange(len(least)) + length <= bounds[1:][row]
    change = np.ones(len(least), dtype=bool)
    change[1:] = ((least[1:] != least[:-1]) | (seeds[:len(least) - 1] == least[:-1])
                  | (row[1:] != row[:-1]) | ~inside[:-1])
    first = np.flatnonzero(change & inside)
    stop = np.ones(len(least), dtype=bool)
    stop[:-1] = change[1:] | ~inside[1:]
    last = np.flatnonzero(stop & inside)
    return (row[first], first - bounds[row[first]], last - first + 1, least[first],
            range_hash(sums, first, last + length))


def covered(starts: np.ndarray, stops: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """Which of ``n`` positions the half-open ranges cover, and the number of maximal covered runs."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, stops, -1)
    inside = np.cumsum(step[:n]) > 0
    return inside, int(np.count_nonzero(inside & ~np.concatenate(([False], inside[:-1])))) if n else 0
