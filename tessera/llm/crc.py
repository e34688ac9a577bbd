"""CRC-32 of joined byte strings from the CRCs of their parts."""

from __future__ import annotations

import functools

import numpy as np

POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected


@functools.cache
def byte_table() -> np.ndarray:
    """What each low byte adds when a register moves on by one byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def append_byte(crcs: np.ndarray, byte: int) -> np.ndarray:
    """CRCs of the strings with one byte more."""
    state = ~crcs.astype(np.uint32)
    return ~((state >> 8) ^ byte_table()[(state ^ np.uint32(byte)) & 0xFF])


def _times(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A 32 x 32 bit matrix (``rows[i]``: the image of bit i) by each of ``vectors``."""
    out = np.zeros(len(vectors), dtype=np.uint32)
    for i in range(32):
        out ^= np.where((vectors >> np.uint32(i)) & 1, rows[i], np.uint32(0)).astype(np.uint32)
    return out


@functools.cache
def _power(k: int) -> np.ndarray:
    """The matrix that moves a register on by 2**k zero bytes."""
    if k:
        half = _power(k - 1)
        return _times(half, half)
    unit = np.left_shift(np.uint32(1), np.arange(32, dtype=np.uint32))
    return ((unit >> 8) ^ byte_table()[unit & 0xFF]).astype(np.uint32)


@functools.lru_cache(maxsize=4096)
def shift_table(n: int) -> np.ndarray:
    """4 x 256: what each byte of a CRC becomes after ``n`` zero bytes."""
    out = np.left_shift(np.tile(np.arange(256, dtype=np.uint32), (4, 1)), np.arange(0, 32, 8, dtype=np.uint32)[:, None])
    flat = out.reshape(-1)
    for k in range(n.bit_length()):
        if n >> k & 1:
            flat = _times(_power(k), flat)
    return flat.reshape(4, 256)


def combine(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of first + second; ``lengths`` are the byte lengths of the second parts."""
    if not len(first):
        return np.empty(0, dtype=np.uint32)
    known, at = np.unique(lengths, return_inverse=True)
    out = second.astype(np.uint32)
    first = first.astype(np.uint32)
    for start in range(0, len(known), 1024):  # tables of so many lengths at a time
        tables = np.stack([shift_table(int(n)) for n in known[start: start + 1024]])
        mine = np.flatnonzero((at >= start) & (at < start + 1024)) if len(known) > 1024 else slice(None)
        row, c = at[mine] - start, first[mine]
        out[mine] ^= (tables[row, 0, c & 0xFF] ^ tables[row, 1, (c >> 8) & 0xFF]
                      ^ tables[row, 2, (c >> 16) & 0xFF] ^ tables[row, 3, c >> 24])
    return out
