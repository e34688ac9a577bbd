"""WARC: pages written as archives with revisit records, and a reader that salvages damaged ones.

An archive is a file of gzip members, one for each record. Spark's text
writer puts the bytes of an archive into a file of any store that Spark can
write, and its binary reader reads them; no file is opened by other means.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import load, release, written
from tessera.llm.exchange import mark_suspects
from tessera.llm.warc_format import REVISIT_PROFILE, Gap, digest, member, render, salvage
from tessera.session import scratch

ARCHIVE_BYTES = 16 << 20  # of an archive, about; a longer record has one of its own
SALTS = 64  # parts over which the revisits of one payload are spread
DATE = "1970-01-01T00:00:00Z"  # of records, as pages carry none: reruns write the same bytes
NONE = 0  # smallest payload, in bytes, that is deduplicated

_READ = ("archive string, start long, end long, reason string, record_id string, record_type string, "
         "target_uri string, payload_bytes long, payload_digest string, refers_to_id string, payload binary")
_READ_ARROW = pa.schema([
    ("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()),
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string()),
    ("payload", pa.binary())])


def _payload(html_col: str) -> Column:
    return F.coalesce(F.col(html_col), F.lit("")).cast("binary")


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least_bytes: int = NONE) -> DataFrame:
    """One row for each record to write: page_id, url, sha, n_bytes, copy, refers_to, payload.

    Of pages with equal payloads (SHA-1 and length) of at least
    ``least_bytes`` bytes, that with the largest id, and of its rows that
    with the largest url, is the response (payload set, refers_to null);
    the others name it in refers_to and have no payload. Null ids are
    smaller than any other. Of rows alike in id, url and payload, copy 1
    to n, the first is the response. A null refers_to with a null payload is
    a revisit of a page without an id.

    Only digests are grouped. Pages whose digest occurs once, which a
    filter of fixed size tells, pass without a shuffle; of the others a
    second filter lets the responses' payloads through, which are joined by
    page. The rows of one payload are spread over ``SALTS`` parts.
    """
    spark = pages.sparkSession
    rows = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                         _payload(html_col).alias("payload"))
            .withColumns({"sha": F.unhex(F.sha1("payload")), "n_bytes": F.length("payload").cast("long")}))
    keys, own, none = ["sha", "n_bytes"], ["page_id", "url", "sha", "n_bytes"], F.lit(None)
    groups = (rows.groupBy(*keys)
              .agg(F.max(F.struct("page_id", "url")).alias("best"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    groups = written(spark, groups.select(*keys, F.col("best.page_id").alias("keep_id"),
                                          F.col("best.url").alias("keep_url")))
    by_payload = F.xxhash64(*keys)
    marked = mark_suspects(rows.withColumn("fp", by_payload), groups.select(by_payload.alias("fp")))
    single = marked.where(~F.col("suspect")).select(
        *own, F.lit(1).cast("long").alias("copy"), none.cast("long").alias("refers_to"), "payload")

    # how often each page occurs among the suspects, and which of its records is its group's response
    counted = (marked.where("suspect").groupBy(*own).agg(F.count(F.lit(1)).alias("times"))
               .withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))))
    spread = groups.select("*", (F.col("n_bytes") >= least_bytes).alias("grouped"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    best = F.col("page_id").eqNullSafe(F.col("keep_id")) & F.col("url").eqNullSafe(F.col("keep_url"))
    copies = written(spark, counted.join(spread, [*keys, "salt"], "left").select(
        *own, F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"),
        F.col("keep_id").alias("refers_to"), best.alias("best"), (~F.coalesce("grouped", F.lit(False))).alias("alone"))
        .select(*own, "copy", "refers_to", (F.col("alone") | (F.col("best") & (F.col("copy") == 1))).alias("response")))
    revisits = copies.where(~F.col("response")).select(*own, "copy", "refers_to", none.cast("binary").alias("payload"))
    heads = copies.where("response").select(*[F.col(c).alias(f"h_{c}") for c in own], "copy")
    by_page = F.xxhash64(*own)
    wanted = mark_suspects(rows.withColumn("fp", by_page), copies.where("response").select(by_page.alias("fp")))
    same = F.lit(True)
    for c in own:
        same = same & F.col(c).eqNullSafe(F.col(f"h_{c}"))
    # rows alike are one here, and their copies those of heads
    payloads = wanted.where("suspect").groupBy(*own).agg(F.first("payload").alias("payload"))
    responses = payloads.join(heads, same).select(*own, "copy", none.cast("long").alias("refers_to"), "payload")
    out = single.unionByName(responses).unionByName(revisits)
    out.scratch_tables = [groups, copies]
    return out


def _uri(page_id: int | None, url: str | None, sha: bytes, copy: int) -> str:
    """A record id that names its page; the rest tells the page's records apart."""
    rest = digest(f"{url}\x00{copy}\x00".encode() + sha)
    return f"<urn:page:{'null' if page_id is None else page_id}:{base64.b32decode(rest).hex()[:16]}>"


def _records(date: str, archive_bytes: int):
    """Rows of :func:`with_types` to archives: one binary row for each, without its last byte (a zero)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["value"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "sha", "n_bytes", "copy", "refers_to", "payload")]
            for i in range(batch.num_rows):  # one record at a time: batches hold whole pages
                page_id, url, sha, n, copy, refers, payload = (c[i].as_py() for c in columns)
                packed = member(_record(page_id, url, sha, n, copy, refers, payload, date))
                if held and size + len(packed) > archive_bytes:
                    yield archive()
                    held, size = [], 0
                held.append(packed)
                size += len(packed)
        if held:
            yield archive()

    return run


def _record(page_id, url, sha, n, copy, refers, payload, date) -> bytes:
    """A response record with its payload, or a revisit record without one."""
    target = url if url is not None else f"urn:page:{page_id}"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n").encode()
    block = http if payload is None else http + payload
    headers = [("WARC-Type", "revisit" if payload is None else "response"),
               ("WARC-Record-ID", _uri(page_id, url, sha, copy)), ("WARC-Date", date),
               ("WARC-Target-URI", target), ("Content-Type", "application/http;msgtype=response"),
               ("WARC-Block-Digest", f"sha1:{digest(block)}"),
               ("WARC-Payload-Digest", f"sha1:{base64.b32encode(sha).decode()}")]
    if payload is None:
        headers += [("WARC-Profile", REVISIT_PROFILE),
                    ("WARC-Refers-To", f"<urn:page:{'null' if refers is None else refers}:0>")]
    return render(headers, block)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least_bytes: int = NONE, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> None:
    """Write ``pages`` as archives (gzip members, one a record) into the new folder ``path``.

    Every row becomes one record, by :func:`with_types`; the payload is the
    html in UTF-8 (null: empty). A null url is written as ``urn:page:<id>``,
    line breaks in it as spaces. No rows give a folder without archives.
    Each archive is one row of Spark's text writer, whose separator is the
    zero byte that every archive ends with; so files are committed as any
    other job's, and a lost executor's are written again.
    """
    typed = with_types(pages, id_col, url_col, html_col, least_bytes)
    (typed.mapInArrow(_records(date, archive_bytes), "value binary")
     .select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path))
    for table in typed.scratch_tables:
        release(table)


def _http_payload(block: bytes) -> tuple[bytes, int | None]:
    """The entity of an HTTP message and the length that its header states."""
    head, end, body = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", head)
    return (body if end else b""), int(stated[1]) if stated else None


def _rows(archive: str, data: bytes, with_payload: bool) -> Iterator[tuple]:
    for x in salvage(data):
        if isinstance(x, Gap):
            yield (archive, x.start, x.end, x.reason, None, None, None, None, None, None, None)
            continue
        h, body, n, stated = x.headers, x.block, len(x.block), _stated_digest(x.headers)
        kind = h.get("warc-type")
        if h.get("content-type", "").startswith("application/http"):
            body, length = _http_payload(x.block)
            n = length if kind == "revisit" and length is not None else len(body)
        if kind != "revisit":
            own = digest(body)
            if stated and stated != own:
                yield (archive, x.start, x.end, "payload digest differs", None, None, None, None, None, None, None)
                continue
            stated = own
        yield (archive, x.start, x.end, None, h.get("warc-record-id"), kind, h.get("warc-target-uri"), n, stated,
               h.get("warc-refers-to"), body if with_payload and kind != "revisit" else None)


def _stated_digest(headers: dict[str, str]) -> str | None:
    """The bare SHA-1 of the payload that a record's header states."""
    kind, _, value = headers.get("warc-payload-digest", "").partition(":")
    return value if value and kind.lower() == "sha1" else None


def _reader(with_payload: bool, per_batch: int = 1 << 24):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for row in _rows(path.as_py(), content.as_py(), with_payload):
                    held.append(row)
                    size += 500 + len(row[-1] or b"")
                    if size >= per_batch:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _READ_ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_READ_ARROW)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True, pattern: str = "*.txt") -> DataFrame:
    """Records and quarantined gaps of the archives in a folder, compressed by members or plain.

    A row with a null ``reason`` is a record that passed every check
    (members' CRC and size, version line, header, length, record id, end
    mark, block and payload digest); any other is a gap: bytes [start, end) of
    ``archive`` in no valid record, and the first check that failed. After a
    failure reading goes on at the next valid member or version line, so
    later records are recovered. Archives are the files whose names match
    ``pattern`` (the writer's by default); none give no rows. A task holds
    the archives of one scan partition: ``spark.sql.files.maxPartitionBytes``,
    or one longer archive.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(path))
    return files.select("path", "content").mapInArrow(_reader(with_payload), _READ)


def gaps(read: DataFrame) -> DataFrame:
    """The quarantine log of :func:`read_warc`: archive, start, end, reason."""
    return read.where(F.col("reason").isNotNull()).select("archive", "start", "end", "reason")


def _page_of(record_id: Column) -> Column:
    found = F.regexp_extract(record_id, r"^<urn:page:(-?\d+|null):[0-9a-f]+>$", 1)
    return F.when(found.isNotNull() & ~found.isin("", "null"), found).cast("long")


def page_records(read: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record read."""
    return (read.where(F.col("reason").isNull())
            .select(_page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    _page_of(F.col("refers_to_id")).alias("refers_to")))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives in the shared folder, and what reading them back gives."""
    path = scratch(spark)
    write_warc(load(spark, sf_dir, "pages"), path)
    return page_records(read_warc(spark, path, with_payload=False))


ORACLE = """
with p as (select page_id, url, coalesce(html, '') as body from pages),
d as (select page_id, url, strlen(body) as payload_bytes, sha1(body) as hex from p),
r as (select *, count(*) over g as n,
        row_number() over (partition by hex, payload_bytes
                           order by page_id desc nulls last, url desc nulls last) as k,
        first_value(page_id) over (partition by hex, payload_bytes
                                   order by page_id desc nulls last, url desc nulls last) as keep_id
      from d window g as (partition by hex, payload_bytes)),
digits as (select *, [('0x' || substr(hex, 5 * i + 1, 5))::bigint for i in range(8)] as fives from r)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         cast((fives[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31 as integer) + 1, 1)), '') as payload_digest,
       case when k = 1 then 'response' else 'revisit' end as record_type,
       case when k = 1 then null else keep_id end as refers_to
from digits
"""
