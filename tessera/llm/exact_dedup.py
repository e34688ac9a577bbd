"""Exact deduplication by a Golomb-coded fingerprint exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import load, text_or_empty
from tessera.llm.exchange import FINGERPRINT_BITS, mark_suspects, repeated_fingerprints


def fingerprint(text_col: str, bits: int = FINGERPRINT_BITS):
    """The first ``bits`` bits of the XXH64 hash of the text, as a whole number."""
    return F.shiftrightunsigned(F.xxhash64(text_or_empty(text_col)), 64 - bits)


def _messages(owners: int, bits: int):
    """Sender: sorted distinct fingerprints of its rows, coded for each owner's range."""
    width = -(-(1 << bits) // owners)

    def send(part: int, seq: int, held: list[np.ndarray]) -> pd.DataFrame:
        values, times = np.unique(np.concatenate(held).astype(np.uint64), return_counts=True)
        cuts = np.searchsorted(values, np.arange(owners + 1, dtype=np.uint64) * np.uint64(width))
        out = []
        for o in range(owners):
            own = values[cuts[o]: cuts[o + 1]]
            if len(own):
                k = golomb.rice_parameter(width, len(own))
                out.append((o, f"{part}-{seq}", len(own), k, golomb.encode(own, o * width, k),
                            np.packbits(times[cuts[o]: cuts[o + 1]] > 1).tobytes()))
        return pd.DataFrame(out, columns=["owner", "sender", "n", "k", "code", "twice"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0
        for pdf in batches:
            held.append(pdf["fp"].to_numpy())
            n += len(pdf)
            if n >= PER_MESSAGE:
                yield send(part, seq, held)
                seq, held, n = seq + 1, [], 0
        if n:
            yield send(part, seq, held)

    return run


def _bitmaps(owners: int, bits: int):
    """Owner: for each sender, which of its fingerprints somebody else (or itself, twice) has too."""
    width = -(-(1 << bits) // owners)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        low = int(pdf["owner"].iat[0]) * width
        sent = [golomb.decode(c, n, low, k) for c, n, k in zip(pdf["code"], pdf["n"], pdf["k"])]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8))[:n].astype(bool) for t, n in zip(pdf["twice"], pdf["n"])]
        values, times = np.unique(np.concatenate(sent), return_counts=True)
        times[np.searchsorted(values, np.concatenate([v[t] for v, t in zip(sent, twice)]))] = 2
        maps = [np.packbits(times[np.searchsorted(values, v)] > 1).tobytes() for v in sent]
        return pd.DataFrame({"owner": pdf["owner"], "sender": pdf["sender"], "bitmap": maps})

    return run


def _suspects(owners: int, bits: int):
    """Sender again: its fingerprints whose bit is set."""
    width = -(-(1 << bits) // owners)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for o, n, k, code, bitmap in zip(pdf["owner"], pdf["n"], pdf["k"], pdf["code"], pdf["bitmap"]):
                own = golomb.decode(code, n, int(o) * width, k)
                hit = np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n].astype(bool)
                yield pd.DataFrame({"fp": own[hit].astype(np.int64)})

    return run


def suspect_fingerprints(docs: DataFrame, text_col: str = "text", bits: int = FINGERPRINT_BITS) -> DataFrame:
    """Fingerprints (column fp, each once) that more than one row of ``docs`` has."""
    total = docs.select(F.count(F.lit(1))).first()[0]
    return repeated_fingerprints(docs.select(fingerprint(text_col, bits).alias("fp")), total, bits)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Only texts whose fingerprint may occur twice are shuffled, and there rows
    are grouped by the text itself, byte for byte, copies being counted
    before the shuffle. Of equal texts the row with the largest id stays.

    A null text equals the empty one. Null ids are smaller than any other; a
    group of null ids has a null keep_id. Of rows alike in text and id exactly
    one is kept. An empty table gives no rows; other columns are ignored.
    """
    fp = fingerprint(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), fp.alias("fp"))
    marked = mark_suspects(rows, suspect_fingerprints(docs, text_col))
    verified = (marked.where("suspect").groupBy("fp", "text")
                .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                .select("fp", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    each = (marked.select("doc_id", "fp", F.sha2("text", 256).alias("text_sha256"))
            .groupBy("doc_id", "fp", "text_sha256").agg(F.count(F.lit(1)).alias("n")))
    return (each.join(verified, ["fp", "text_sha256"], "left")
            .select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
                    .alias("keep_id"), F.coalesce("group_size", "n").alias("group_size"), "text_sha256",
                    F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row, that of the largest id, of each text; all its columns, unchanged.

    Rows that are no suspects pass without a shuffle. As :func:`exact_groups`
    for nulls; of rows alike in text and id, one of them stays.
    """
    names = docs.columns
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"),
                       text_or_empty(text_col).alias("text"), fingerprint(text_col).alias("fp"))
    marked = mark_suspects(rows, suspect_fingerprints(docs, text_col))
    single = marked.where(~F.col("suspect")).select("row")
    chosen = (marked.where("suspect").groupBy("fp", "text")
              .agg(F.max_by("row", F.struct("doc_id")).alias("row")).select("row"))
    return single.unionByName(chosen).select(*[F.col("row").getField(c).alias(c) for c in names])


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return exact_groups(load(spark, sf_dir, "documents"))


ORACLE = """
with g as (
  select coalesce(text, '') as t, max(doc_id) as keep_id, count(*) as group_size from documents group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
from documents join g on coalesce(text, '') = t
"""
