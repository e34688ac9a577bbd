"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import drop_folder, scratch

# Fixed value: a word is a run of characters other than space and \t \n \v \f \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a data folder, by whatever path Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def word_count(col: str) -> Column:
    """Words of a text column as long; null has none."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def id_crc(col: str) -> Column:
    """CRC-32 of the id written as text; a null id counts as empty text (0)."""
    return F.coalesce(F.crc32(F.col(col).cast("string")), F.lit(0)).cast("long")


def written(spark: SparkSession, df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    path = path or scratch(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the folder of a frame from :func:`written` that nothing will read any more."""
    drop_folder(df.sparkSession, df.scratch_path)


def posix_folder(path: str) -> str:
    """The folder of a ``file:`` URI or plain path, made if missing.

    Raises for other schemes: memory mapping needs a mounted folder.
    """
    scheme, sep, rest = path.partition(":")
    if sep and scheme != "file" and "/" not in scheme:
        raise ValueError(f"a mounted shared folder is needed to map files, not {path}")
    folder = "/" + rest.lstrip("/") if sep and scheme == "file" else path
    os.makedirs(folder, exist_ok=True)
    return folder


# ---- numpy over concatenated texts -------------------------------------------------

MIX = np.uint64(0x9E3779B97F4A7C15)  # odd: multiplying by it permutes the 64-bit numbers


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): one to one, spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}  # of this process; as long as the longest chunk of text so far


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1), np.uint64(base), dtype=np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(have)
    return have[:n]


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 values as their gaps, in as few whole bytes each as the largest gap needs."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(gaps[1:].max() if len(gaps) > 1 else 0).bit_length() + 7) // 8)
    rest = gaps[1:].view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + gaps[:1].tobytes() + np.ascontiguousarray(rest.T).tobytes()


def unpack_sorted(code: bytes) -> np.ndarray:
    """The values of :func:`pack_sorted`."""
    if not code:
        return np.empty(0, dtype=np.uint64)
    width, first = code[0], np.frombuffer(code, "<u8", 1, 1)
    planes = np.frombuffer(code, np.uint8, offset=9).reshape(width, -1)
    gaps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    gaps[:, :width] = planes.T
    return np.cumsum(np.concatenate([first, gaps.reshape(-1).view("<u8")]), dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Small whole numbers, compressed."""
    return zlib.compress(np.ascontiguousarray(values, dtype="<u4").tobytes(), 1)


def unpack_counts(code: bytes) -> np.ndarray:
    """The numbers of :func:`pack_counts`."""
    return np.frombuffer(zlib.decompress(code), dtype="<u4")


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of several counted lists, and the sums of their counts."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else np.empty(0, np.int64)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column without nulls, and each row's offsets in them."""
    import pyarrow as pa
    arr = column.cast(pa.large_binary())
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset: arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def row_ranges(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes each, or one longer row."""
    out, a, n = [], 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        out.append((a, b))
        a = b
    return out


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# a fixed pseudo-random number for each byte
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * MIX)
_BASE = 0x9E3779B97F4A7C55  # odd
_INVERSE = pow(_BASE, -1, 1 << 64)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes other than space and \\t..\\r) of the rows between offsets.

    Returns each word's 64-bit hash, its start and end in ``data`` and, per
    row, the number of words before it (one more entry than rows). Equal
    words have equal hashes.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    part = data[lo:hi]
    if lower:
        part = _LOWER[part]
    inside = ~_SPACE[part]
    cut = np.zeros(len(part) + 1, dtype=bool)  # a word also ends where its row ends
    cut[offsets - lo] = True
    before = np.zeros(len(part), dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.zeros(len(part), dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    sums = np.zeros(len(part) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[part] * powers(_BASE, len(part)), out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * powers(_INVERSE, len(part) + 1)[starts])
    counts = np.searchsorted(starts, offsets - lo)
    return hashes, starts + lo, ends + lo, counts
