"""Golomb-Rice codes of sorted whole numbers, in numpy."""

from __future__ import annotations

import numpy as np


def rice_parameter(span: int, n: int) -> int:
    """Bits of the remainder that suit ``n`` numbers spread over ``span``."""
    return max(0, int(np.floor(np.log2(max(span / max(n, 1), 1)))))


def encode(sorted_values: np.ndarray, low: int, k: int) -> bytes:
    """Code ascending uint64 values, the first as its distance from ``low``.

    Each gap is its quotient by 2**k in unary (ones and a zero) followed, in
    a block of its own, by ``k`` bits of remainder.
    """
    if not len(sorted_values):
        return b""
    gaps = np.diff(sorted_values, prepend=np.uint64(low))
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1)
    unary = np.ones(int(ends[-1]), dtype=np.uint8)
    unary[ends - 1] = 0
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def decode(code: bytes, n: int, low: int, k: int) -> np.ndarray:
    """The ``n`` values of :func:`encode`."""
    if not n:
        return np.empty(0, dtype=np.uint64)
    raw = np.frombuffer(code, dtype=np.uint8)
    tail = (n * k + 7) // 8
    unary = np.unpackbits(raw[: len(raw) - tail])
    ends = np.flatnonzero(unary == 0)[:n]
    gaps = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    gaps <<= np.uint64(k)
    if k:
        rest = np.unpackbits(raw[len(raw) - tail:])[: n * k].reshape(n, k)
        for j in range(k):
            gaps |= rest[:, j].astype(np.uint64) << np.uint64(k - 1 - j)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(low)
