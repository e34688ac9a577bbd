"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

LANES = 4096  # positions whose common prefixes advance together


def eight_bytes(text: np.ndarray, pad: int = 0) -> np.ndarray:
    """The eight bytes from each position as one big-endian number, zeros past the end."""
    n = len(text) + pad
    padded = np.zeros(n + 8, dtype=np.uint64)
    padded[:len(text)] = text
    out = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j:j + n]
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a byte array in order.

    Suffixes are sorted by eight bytes first. Then only groups that are
    still tied are sorted on, by the group of the suffix as many bytes
    further as are known to agree; what is known doubles each time.
    """
    n = len(text)
    key = eight_bytes(text)
    sa = np.argsort(key).astype(np.int64)
    new = np.ones(n, dtype=bool)
    new[1:] = key[sa[1:]] != key[sa[:-1]]
    place = np.arange(n)
    first = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = first
    at, h = place, 8
    tail = np.flatnonzero(sa + 8 > n)
    if len(tail):  # its zeros tie with zero bytes: split such groups by length
        group = np.isin(first, first[tail])
        own = np.flatnonzero(group)
        order = np.lexsort((np.minimum(n - sa[own], 8), first[own]))
        sa[own] = sa[own][order]
        length = np.minimum(n - sa[own], 8)
        split = np.ones(len(own), dtype=bool)
        split[1:] = (first[own][1:] != first[own][:-1]) | (length[1:] != length[:-1])
        new[own] = split
        first = np.maximum.accumulate(np.where(new, place, 0))
        rank[sa] = first
    while True:
        alone = new[at].copy()
        alone[:-1] &= new[at[1:]] | (at[1:] != at[:-1] + 1)
        at = at[~alone]
        if not len(at):
            return sa
        i = sa[at]
        follow = np.where(i + h < n, rank[np.minimum(i + h, n - 1)] + 1, 0)
        both = (first[at] << 32) | follow
        order = np.argsort(both)
        sa[at] = i[order]
        both = both[order]
        start = np.ones(len(at), dtype=bool)
        start[1:] = both[1:] != both[:-1]
        new[at] = start
        first[at] = np.maximum.accumulate(np.where(start, at, 0))
        rank[sa[at]] = first[at]
        h *= 2


def common_prefixes(text: np.ndarray, sa: np.ndarray, enough: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in order, counted up to ``enough`` or a little more.

    Kasai's rule: the suffix one byte further shares at most one byte less
    than this one, so comparison goes on where it was. Texts are walked in
    lanes side by side; a lane starts from nothing.
    """
    n = len(text)
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = np.arange(n)
    before = np.full(n, -1, dtype=np.int64)  # by position: the start of the suffix that comes just before
    before[sa[1:]] = sa[:-1]
    words = eight_bytes(text, enough + 16)
    span = -(-n // min(LANES, max(n // 64, 1)))
    i = np.arange(0, n, span)
    stop = np.minimum(i + span, n)
    h = np.zeros(len(i), dtype=np.int64)
    out = np.zeros(n, dtype=np.int64)
    while len(i):
        j = before[i]
        lone = j < 0
        differ = words[i + h] ^ words[np.where(lone, 0, j) + h]
        same = (h < enough) & ~lone & (differ == 0)
        add = np.where(same, 8, np.where((h < enough) & ~lone, _leading_bytes(differ), 0))
        h = np.where(lone, 0, np.minimum(h + add, n - np.maximum(i, j)))  # zeros past the end don't count
        done = ~same | (i + h >= n) | (j + h >= n)
        out[i[done]] = h[done]
        h = np.where(done, np.maximum(h - 1, 0), h)
        i = i + done
        going = i < stop
        if not going.all():
            i, stop, h = i[going], stop[going], h[going]
    result = np.zeros(n, dtype=np.int64)
    result[rank] = out
    return result


def _leading_bytes(differ: np.ndarray) -> np.ndarray:
    """Whole zero bytes at the high end of each nonzero number."""
    out = np.zeros(len(differ), dtype=np.int64)
    for j in range(1, 8):
        out += (differ >> np.uint64(64 - 8 * j)) == 0
    return out
