"""WARC: records, salvage of damaged archives, revisits, round trips."""

import base64
import gzip
import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import warc
from tessera.llm.warc_format import Gap, Record, member, render, salvage

SCHEMA = "page_id long, url string, html string, sha string, n_bytes long, copy int, fp long, suspect boolean, salt int"


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page(i, html, url="http://a.example/"):
    return (i, url, html, "x", 7, 7, 7, True, 7)


PAGES = [
    page(1, "<p>one</p>"), page(2, "<p>two</p>"), page(3, "<p>one</p>", None), page(4, None), page(5, ""),
    page(6, "<p>one</p>", "http://b.example/\r\nWARC/1.1"), page(7, "straße à la carte"), page(7, "straße à la carte"),
    page(7, "straße à la carte", "http://c.example/"), page(None, "nobody"), page(None, "nobody"), page(None, None),
    page(8, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), page(9, "y" * 3_000_000),
]


def brute(rows, least=0):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    want = Counter()
    for html, ids in groups.items():
        body = html.encode()
        own = (len(body), b32(body))
        if len(body) < least:
            want.update((i, *own, "response", None) for i in ids)
            continue
        keep = max((i for i in ids if i is not None), default=None)
        ids = list(ids)
        ids.remove(keep)
        want[(keep, *own, "response", None)] += 1
        want.update((i, *own, "revisit", keep) for i in ids)
    return want


def round_trip(spark, pages, path, **kw):
    warc.write_warc(pages, path, **kw)
    read = warc.read_warc(spark, path)
    assert warc.gaps(read).collect() == []
    return read


@pytest.mark.parametrize("least", [0, 1, 10, 1_000_000])
def test_odd_rows(spark, scratch, least):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    read = round_trip(spark, pages, f"{scratch}/w{least}", least_bytes=least, archive_bytes=300)
    got = Counter(tuple(r) for r in warc.page_records(read).collect())
    assert got == brute([r[:3] for r in PAGES], least)
    held = {r.payload_digest: bytes(r.payload) for r in read.where("record_type = 'response'").collect()}
    assert set(held.values()) == {(r[2] or "").encode() for r in PAGES}
    assert all(b32(v) == k for k, v in held.items())
    ids = [r.record_id for r in read.collect()]
    assert len(set(ids)) == len(ids) == len(PAGES)


def test_no_rows(spark, scratch):
    read = round_trip(spark, spark.createDataFrame([], SCHEMA), f"{scratch}/none")
    assert warc.page_records(read).collect() == []


def test_a_third_of_all_rows_alike(spark, scratch):
    rows = [page(i, "hot" if i % 3 == 0 else f"page {i % 400}") for i in range(1500)]
    read = round_trip(spark, spark.createDataFrame(rows, SCHEMA).repartition(6), f"{scratch}/hot", archive_bytes=20_000)
    assert Counter(tuple(r) for r in warc.page_records(read).collect()) == brute([r[:3] for r in rows])


def test_a_record_of_more_than_16_mib(spark, scratch):
    rows = [page(1, "z" * (17 << 20)), page(2, "small")]
    read = round_trip(spark, spark.createDataFrame(rows, SCHEMA).coalesce(1), f"{scratch}/big")
    assert Counter(tuple(r) for r in warc.page_records(read).collect()) == brute([r[:3] for r in rows])


def test_archives_are_plain_gzip(spark, scratch):
    warc.write_warc(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), f"{scratch}/gz")
    for (content,) in spark.read.format("binaryFile").load(f"{scratch}/gz").select("content").collect():
        text = gzip.decompress(bytes(content))
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")


def records(n, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        block = bytes(rng.randrange(256) for _ in range(rng.randrange(200)))
        out.append(render([("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:page:{i}:0>"),
                           ("WARC-Block-Digest", f"sha1:{b32(block)}")], block))
    return out


def covers(found, size):
    at = 0
    for x in found:
        assert x.start >= at or isinstance(x, Record)
        at = max(at, x.end)
    return at == size


@settings(max_examples=150, deadline=None)
@given(st.booleans(), st.integers(0, 5), st.randoms(use_true_random=False))
def test_all_records_outside_the_damage_are_read(packed, kind, rng):
    parts = [member(r) if packed else r for r in records(9, rng.randrange(1000))]
    hurt = rng.randrange(9)
    x = bytearray(parts[hurt])
    if kind == 0:
        x[rng.randrange(len(x))] ^= 1 << rng.randrange(8)
    elif kind == 1:
        del x[rng.randrange(len(x)):]
    elif kind == 2:
        x[rng.randrange(len(x)):] = b""
        x += bytes(rng.randrange(256) for _ in range(50))
    elif kind == 3:
        x = bytearray(b"junk WARC/1.1\r\n \x1f\x8b\x08 junk") + x
    elif kind == 4:
        x = bytearray()
    parts[hurt] = bytes(x)
    data = b"".join(parts)
    found = list(salvage(data))
    ids = {f.headers["warc-record-id"] for f in found if isinstance(f, Record)}
    # a cut plain record may take bytes of the next one for its own, which its digest then tells
    must = {f"<urn:page:{i}:0>" for i in range(9) if i != hurt}
    assert must <= ids
    gaps = [f for f in found if isinstance(f, Gap)]
    assert covers(found, len(data))
    if kind == 3:
        assert f"<urn:page:{hurt}:0>" in ids and len(gaps) == 1
    if kind == 5:
        assert not gaps and len(ids) == 9


def test_reasons_and_places():
    a, b, c = records(3)
    assert [type(x) for x in salvage(a + b"\x00\x00" + member(b) + c)] == [Record, Record, Record]
    (gap,) = [x for x in salvage(member(a)[:-9]) if isinstance(x, Gap)]
    assert gap == Gap(0, len(member(a)) - 9, "truncated member")
    broken = b.replace(b"Content-Length", b"Content_Length")
    found = list(salvage(a + broken + c))
    assert found[1] == Gap(len(a), len(a) + len(broken), "no content length") and found[2].start == len(a) + len(broken)
    # one member of several records, one of them bad: the others are read
    whole = gzip.compress(a + broken + c)
    found = list(salvage(whole))
    assert [type(x) for x in found] == [Record, Gap, Record] and found[1].reason == "in member: no content length"
    assert list(salvage(b"")) == [] and list(salvage(b"\x00" * 9)) == []
    assert list(salvage(b"nothing here")) == [Gap(0, 12, "no version line")]


def test_a_record_that_lost_its_id_is_a_gap():
    a, b, c = records(3)
    for hurt in (b.replace(b"WARC-Record-ID", b"WARC-Record-HD"), b.replace(b"<urn:page:1:0>", b"")):
        found = list(salvage(a + hurt + c))
        assert [x.headers["warc-record-id"] for x in found if isinstance(x, Record)] == ["<urn:page:0:0>", "<urn:page:2:0>"]
        assert found[1] == Gap(len(a), len(a) + len(hurt), "no record id") and covers(found, len(a + hurt + c))


def test_damaged_files_through_spark(spark, scratch, tmp_path):
    rows = [page(i, f"page {i} " * 50) for i in range(60)]
    path = f"{scratch}/damaged"
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, archive_bytes=4000)
    rng, files, lost = random.Random(5), [], 0
    for n, (content,) in enumerate(spark.read.format("binaryFile").load(path).select("content").collect()):
        data = bytearray(content)
        if n % 2:
            at = rng.randrange(20, len(data) - 200)
            data[at: at + 30] = bytes(30)
            lost += 1
        (tmp_path / f"{n}.warc.gz").write_bytes(bytes(data))
        files.append(n)
    assert lost > 1
    read = warc.read_warc(spark, str(tmp_path), pattern="*.warc.gz")
    gaps = warc.gaps(read).collect()
    assert {g.archive.rsplit("/", 1)[-1] for g in gaps} == {f"{n}.warc.gz" for n in files if n % 2}
    got = {r.page_id for r in warc.page_records(read).collect()}
    assert len(got) >= 60 - 2 * lost and got <= set(range(60))
    assert all(g.end > g.start and g.reason for g in gaps)
