"""WARC records as bytes: writing one, and reading a damaged archive piece by piece."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

# Fixed values of the format.
VERSION = b"WARC/1.1"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER_MAGIC = b"\x1f\x8b\x08"
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
RECORD_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()
PIECE = 1 << 20  # bytes decompressed at a time


class Record(NamedTuple):
    """A record that passed its checks, and the bytes [start, end) of the archive that hold it."""

    start: int
    end: int
    headers: dict[str, str]
    block: bytes


class Gap(NamedTuple):
    """Bytes [start, end) of the archive that are in no valid record, and why."""

    start: int
    end: int
    reason: str


def digest(data: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def render(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record: version line, named fields (line breaks in values become spaces), block, end."""
    lines = [VERSION.decode()] + [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in headers]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + RECORD_END + block + RECORD_END


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own, ending in a zero byte.

    The last byte of a member is the highest of its size; records of 16 MiB
    and more, where it isn't zero, are followed by an empty member.
    """
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    out = z.compress(record) + z.flush()
    return out if out.endswith(b"\x00") else out + EMPTY_MEMBER


def _parse(data: bytes, at: int) -> tuple[Record | None, str]:
    """The plain record at ``at``, or None and the check that it fails."""
    line = VERSION_LINE.match(data, at)
    if not line:
        return None, "no version line"
    stop = data.find(RECORD_END, line.end() - 2)
    if stop < 0:
        return None, "header does not end"
    headers: dict[str, str] = {}
    name = ""
    for raw in data[line.end(): stop].split(b"\r\n"):
        text = raw.decode("utf-8", "replace")
        if raw[:1] in (b" ", b"\t") and name:  # a folded line
            headers[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            return None, "malformed header"
        headers[name] = value.strip()
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        return None, "no content length"
    if not headers.get("warc-record-id"):
        return None, "no record id"
    first = stop + len(RECORD_END)
    last = first + int(size)
    if last > len(data):
        return None, "truncated block"
    if data[last: last + len(RECORD_END)] != RECORD_END:
        return None, "content length does not fit"
    block = data[first: last]
    kind, _, stated = headers.get("warc-block-digest", "").partition(":")
    if stated and kind.lower() == "sha1" and stated != digest(block):
        return None, "block digest differs"
    return Record(at, last + len(RECORD_END), headers, block), ""


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The gzip member at ``at``, unpacked, and where it ends; or the check that it fails."""
    z, out, pos = zlib.decompressobj(31), [], at
    try:
        while not z.eof and pos < len(data):
            out.append(z.decompress(data[pos: pos + PIECE]))
            pos += PIECE
    except zlib.error as e:
        return b"", at, f"broken member: {str(e).split(':')[0]}"
    if not z.eof:
        return b"", at, "truncated member"
    return b"".join(out), min(pos, len(data)) - len(z.unused_data), ""


def _member_records(data: bytes, at: int) -> tuple[list[Record | Gap], int, str]:
    """What the member at ``at`` holds, each with the member's own place; or the check that it fails."""
    raw, end, why = _inflate(data, at)
    if why:
        return [], at, why
    found: list[Record | Gap] = []
    for x in salvage(raw, members=False):
        if isinstance(x, Gap):
            found.append(Gap(at, end, f"in member: {x.reason}"))
        else:
            found.append(x._replace(start=at, end=end))
    return found, end, ""


def salvage(data: bytes, members: bool = True) -> Iterator[Record | Gap]:
    """Every valid record of an archive in order, and the gaps between them.

    Where a record or gzip member fails a check (version line, header, length,
    record id, end mark, CRC, size, block digest), the bytes from there are
    quarantined up to the next place at which a member unpacks or a version
    line begins a record that passes; reading goes on there. Records and
    gaps cover all bytes. Zero bytes between records are padding, no gap. A
    failing record inside a member that unpacks gives a gap of the whole
    member's place; the member's other records are read.
    """
    at, bad, reason = 0, -1, ""
    while at < len(data):
        found: list[Record | Gap] = []
        if members and data.startswith(MEMBER_MAGIC, at):
            found, end, why = _member_records(data, at)
        elif members and data[at] == 0 and bad < 0:
            rest = re.compile(rb"\x00+").match(data, at)
            at = rest.end()
            continue
        else:
            record, why = _parse(data, at)
            if record:
                found, end = [record], record.end
        if not why:
            if bad >= 0:
                yield Gap(bad, at, reason)
                bad = -1
            yield from found
            at = end
            continue
        if bad < 0:
            bad, reason = at, why
        following = (START if members else VERSION_LINE).search(data, at + 1)
        at = following.start() if following else len(data)
    if bad >= 0:
        yield Gap(bad, len(data), reason)
