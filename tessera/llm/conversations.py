"""Conversations as a prefix trie: which beginnings they share, and what sharing them saves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import zfast_trie
from tessera.llm.common import load, release, text_or_empty, written
from tessera.operators.sequence import in_chunks

STRIDE = 100  # a conversation's beginning comes from the one at the next lower multiple
FIRSTS = 6  # fewer than so many turns come from there
IDS = 1 << 16  # ids of ends that are joined into one text
EDGE = 1 << 10  # depths of an edge that one row expands to at once

_ID = "struct<a:bigint,b:bigint,d:bigint>"


def _xor(c: Column) -> Column:
    return F.bit_xor(c)


def running(rows: DataFrame, key: str, order: list[str], rows_known: int | None = None, **values: tuple) -> DataFrame:
    """``rows`` with running aggregates along ``order`` within ``key``; each value is (column, "sum" or "xor").

    Rows are cut into chunks by row counts, so that a key of very many rows
    is spread; each chunk runs on its own and one row for a chunk that goes
    on with a key carries what came before: as many rows as chunks at most.
    """
    chunks = in_chunks(rows, [key, *order], rows=rows_known)
    by = [F.col(c).asc_nulls_first() for c in order]
    upto = Window.partitionBy("__b", key).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    so_far = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    how = {"sum": F.sum, "xor": _xor}
    local = chunks.withColumns({n: how[kind](c).over(upto) for n, (c, kind) in values.items()})
    totals = chunks.groupBy(key, "__b").agg(*[how[kind](c).alias(n) for n, (c, kind) in values.items()])
    before = totals.select(F.col(key).alias("__key"), F.col("__b").alias("__chunk"),
                           *[how[kind](n).over(so_far).alias(f"__past_{n}") for n, (_, kind) in values.items()])
    carried = before.where(F.coalesce(*[F.col(f"__past_{n}") for n in values]).isNotNull())
    joined = local.join(F.broadcast(carried), (F.col(key) == F.col("__key")) & (F.col("__b") == F.col("__chunk")), "left")

    def total(n: str, kind: str) -> Column:
        past = F.coalesce(F.col(f"__past_{n}"), F.lit(0).cast("long"))
        return (F.col(n) + past if kind == "sum" else F.col(n).bitwiseXOR(past)).alias(n)

    return joined.select(*rows.columns, *[total(n, kind) for n, (_, kind) in values.items()])


def numbered_turns(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """conv_id, k (from 1, by turn), t1, t2 (hashes of role and text) and points (code points of the text).

    Null turns come first; turns alike in number are ordered by role, then
    by the SHA-256 of their text. Null roles and texts are empty. Rows
    without a conv_id belong to no conversation. Texts are not shuffled.
    """
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    rows = convs.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("sha"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), text, role).alias("t2"), F.length(text).cast("long").alias("points"))
    ranked = running(rows, "conv_id", ["turn", "role", "sha"], k=(F.lit(1).cast("long"), "sum"))
    return ranked.select("conv_id", "k", "t1", "t2", "points")


def beginnings(turns: DataFrame, stride: int = STRIDE, firsts: int = FIRSTS) -> DataFrame:
    """conv_id, h (turns that it loses), base (conversation that it begins with), given (turns from there) and total.

    Conversation c begins with the first h turns of conversation c - c %
    stride (all if it has fewer, none if there is none), h being the CRC-32
    of c modulo ``firsts``; its own turns after its first h follow.
    """
    convs = turns.groupBy("conv_id").agg(F.max("k").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string")) % firsts
    base = F.col("conv_id") - F.col("conv_id") % stride
    bases = (turns.where((F.col("conv_id") % stride == 0) & (F.col("k") < firsts))
             .groupBy(F.col("conv_id").alias("b_id")).agg(F.max("k").alias("b_n")))
    given = F.least("h", F.coalesce("b_n", F.lit(0)))
    return (convs.withColumns({"h": h, "base": base}).join(bases, F.col("base") == F.col("b_id"), "left")
            .select("conv_id", "h", "base", given.alias("given"),
                    (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")))


def rebuilt_turns(turns: DataFrame, heads: DataFrame, stride: int = STRIDE, firsts: int = FIRSTS) -> DataFrame:
    """The turns (conv_id, d, t1, t2, points) of the conversations with other :func:`beginnings` (``heads``)."""
    source = (turns.where((F.col("conv_id") % stride == 0) & (F.col("k") < firsts))
              .select(F.col("conv_id").alias("b_id"), F.col("k").alias("d"), "t1", "t2", "points"))
    given = heads.join(source, (F.col("base") == F.col("b_id")) & (F.col("d") <= F.col("given")))
    own = (turns.join(heads.select("conv_id", "h", "given"), "conv_id").where("k > h")
           .withColumn("d", F.col("given") + F.col("k") - F.col("h")))
    columns = ["conv_id", "d", "t1", "t2", "points"]
    return given.select(*columns).unionByName(own.select(*columns))


def hashed_prefixes(turns: DataFrame, rows: int | None = None) -> DataFrame:
    """s, d, x1, x2 (128-bit hash of the first d turns), points (of turn d) and points_to (of the first d).

    The hash is the exclusive or of the hashes of (place, turn), so it runs
    along a conversation and is carried from chunk to chunk. ``rows`` is
    their number, where the caller knows it.
    """
    hashed = running(turns, "conv_id", ["d"], rows_known=rows, x1=(F.xxhash64("d", "t1", "t2"), "xor"),
                     x2=(F.xxhash64("t2", "d", "t1"), "xor"), points_to=(F.col("points"), "sum"))
    return hashed.select(F.col("conv_id").alias("s"), "d", "x1", "x2", "points", "points_to")


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the ids of each sequence, whose parts come in order."""
    current, sha = None, None
    for pdf in batches:
        out = []
        for x1, x2, n, ids in zip(pdf["x1"], pdf["x2"], pdf["total"], pdf["ids"]):
            if (x1, x2, n) != current:
                if current:
                    out.append((*current, sha.hexdigest()))
                current, sha = (x1, x2, n), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pd.DataFrame(out, columns=["x1", "x2", "total", "ends_sha256"])
    if current:
        yield pd.DataFrame([(*current, sha.hexdigest())], columns=["x1", "x2", "total", "ends_sha256"])


def ends(convs: DataFrame, ids_at_once: int = IDS) -> DataFrame:
    """x1, x2, total and ends_sha256 of each sequence: of its conversations' ids, ascending, comma-joined.

    Ids are joined for ranges of ``ids_at_once`` numbers, so no group is
    longer; a sequence with ids in several ranges is hashed part by part, in
    order, without being held.
    """
    key = ["x1", "x2", "total"]
    parts = (convs.groupBy(*key, F.floor(F.col("conv_id") / ids_at_once).alias("part"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    times = parts.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    several = times.where("n > 1").select(*key)
    one = (parts.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first(F.sha2("ids", 256)).alias("ends_sha256"))
           .where("n = 1").select(*key, "ends_sha256"))
    long = (parts.join(several, key, "left_semi").repartition(*key).sortWithinPartitions(*key, "part")
            .mapInPandas(_streamed, "x1 long, x2 long, total long, ends_sha256 string"))
    return one.unionByName(long)


def _id(a: str, b: str, d: str) -> Column:
    return F.struct(F.col(a).alias("a"), F.col(b).alias("b"), F.col(d).alias("d"))


def _subtrees(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Sums (and the least conversation) over each node's subtree, by doubling the distance that they reach.

    ``nodes`` are id, up (the parent's id; null for the root) and values w,
    wp, edge, leaf, least. After k rounds a node holds the values of its
    descendants less than 2**k edges away and knows its ancestor at 2**k.
    """
    sums = ["w", "wp", "edge", "leaf"]
    table = written(spark, nodes)
    while not table.where("up is not null").isEmpty():
        given = (table.where("up is not null").groupBy(F.col("up").alias("g_id"))
                 .agg(*[F.sum(c).alias(f"g_{c}") for c in sums], F.min("least").alias("g_least")))
        ups = table.where("up is not null").select(F.col("id").alias("u_id"), F.col("up").alias("u_up"))
        zero = F.lit(0).cast("long")
        grown = (table.join(given, F.col("id") == F.col("g_id"), "left")
                 .join(ups, F.col("up") == F.col("u_id"), "left")
                 .select("id", F.col("u_up").alias("up"), *[(F.col(c) + F.coalesce(f"g_{c}", zero)).alias(c) for c in sums],
                         F.least("least", "g_least").alias("least")))
        following = written(spark, grown)
        release(table)
        table = following
    return table


def prefix_nodes(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """One row for each node of the trie of ``convs`` (conv_id, total), whose turns ``prefixes`` hash.

    Conversations of equal turns are one string with several members; the
    strings go into a z-fast trie (:mod:`tessera.llm.zfast_trie`), members
    and savings are summed over its subtrees, and its edges are expanded
    into the nodes of every depth. Columns as :func:`conversation_trie`.
    """
    spark, zero = convs.sparkSession, F.lit(0).cast("long")
    last = prefixes.select("s", F.col("d").alias("p_d"), "x1", "x2", "points_to")
    whole = (convs.join(last, (F.col("conv_id") == F.col("s")) & (F.col("total") == F.col("p_d")), "left")
             .select("conv_id", "total", *[F.coalesce(c, zero).alias(c) for c in ("x1", "x2", "points_to")]))
    whole = written(spark, whole)
    strings = written(spark, whole.groupBy("x1", "x2", "total").agg(
        F.min("conv_id").alias("s"), F.count(F.lit(1)).alias("n"), F.first("points_to").alias("points_to")))
    ours = written(spark, prefixes.join(strings.select("s"), "s", "left_semi"))
    nodes = zfast_trie.build(strings.select("s", "total"), ours)

    # ids, parents and values of the nodes, the root among them
    above = ours.select(F.col("s").alias("q_s"), F.col("d").alias("q_d"), F.col("x1").alias("q_1"),
                        F.col("x2").alias("q_2"), F.col("points_to").alias("to_plen"))
    here = ours.select(F.col("s").alias("r_s"), F.col("d").alias("r_d"), F.col("points_to").alias("to_len"))
    placed = (nodes.join(above, (F.col("rep") == F.col("q_s")) & (F.col("plen") == F.col("q_d")), "left")
              .join(here, (F.col("rep") == F.col("r_s")) & (F.col("len") == F.col("r_d")))
              .select("rep", "len", "plen", _id("e1", "e2", "len").alias("id"), F.struct(
                  F.coalesce("q_1", zero).alias("a"), F.coalesce("q_2", zero).alias("b"), F.col("plen").alias("d"))
                  .alias("up"), F.coalesce("to_plen", zero).alias("to_plen"), "to_len"))
    root = (whole.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
            .select(F.lit(None).cast("long").alias("rep"), zero.alias("len"), F.lit(-1).cast("long").alias("plen"),
                    F.struct(zero.alias("a"), zero.alias("b"), zero.alias("d")).alias("id"),
                    F.lit(None).cast(_ID).alias("up"), zero.alias("to_plen"), zero.alias("to_len")))
    placed = written(spark, placed.unionByName(root))
    children = placed.where("up is not null").groupBy(F.col("up").alias("k_id")).agg(F.count(F.lit(1)).alias("n_children"))
    members = strings.select(_id("x1", "x2", "total").alias("m_id"), "n", "s", "points_to")
    valued = (placed.join(children, F.col("id") == F.col("k_id"), "left")
              .join(members, F.col("id") == F.col("m_id"), "left")
              .select("id", "up", F.coalesce("n", zero).alias("w"), F.coalesce(F.col("n") * F.col("points_to"), zero).alias("wp"),
                      (F.col("to_len") - F.col("to_plen")).alias("edge"),
                      F.when(F.col("n_children").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("leaf"),
                      F.col("s").alias("least")))
    totals = _subtrees(spark, valued)

    total = totals.select(F.col("id").alias("t_id"), "w", "wp", F.col("edge").alias("edges"), "leaf", "least")
    parent = totals.select(F.col("id").alias("o_id"), F.col("least").alias("up_least"))
    full = written(spark, placed.join(total, F.col("id") == F.col("t_id"))
                   .join(children, F.col("id") == F.col("k_id"), "left")
                   .join(parent, F.col("up") == F.col("o_id"), "left")
                   .drop("t_id", "k_id", "o_id", "up"))
    # edges expanded: a row for each depth, in two steps, as an edge can be very long
    blocks = full.withColumn("block", F.explode(F.sequence(zero, F.floor((F.col("len") - F.col("plen") - 1) / EDGE))))
    first = F.col("plen") + 1 + F.col("block") * EDGE
    deep = blocks.withColumn("depth", F.explode(F.sequence(first, F.least(first + EDGE - 1, F.col("len")))))
    each = ours.select(F.col("s").alias("v_s"), F.col("d").alias("v_d"), (F.col("points_to") - F.col("points")).alias("to_above"))
    deep = (deep.join(each, (F.col("rep") == F.col("v_s")) & (F.col("depth") == F.col("v_d")), "left")
            .withColumn("to_above", F.coalesce("to_above", zero)))
    at_end = F.col("depth") == F.col("len")
    below = F.col("edges") - (F.col("to_len") - F.col("to_plen"))  # texts on edges further down, each once
    saved = (F.col("wp") - F.col("w") * F.col("to_above")) - (below + F.col("to_len") - F.col("to_above"))
    rows = deep.select(
        F.col("least").alias("conv_id"), "depth",
        F.when(F.col("depth") == 0, F.lit(None).cast("long")).when(F.col("depth") == F.col("plen") + 1, F.col("up_least"))
        .otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("w").alias("n_convs"), F.when(at_end, F.coalesce("n_children", zero)).otherwise(F.lit(1)).alias("n_children"),
        F.col("leaf").alias("n_leaves"), saved.alias("saved_tokens"), F.when(at_end, F.col("id")).alias("end_id"))
    digests = ends(whole).select(_id("x1", "x2", "total").alias("d_id"), "ends_sha256")
    out = written(spark, rows.join(digests, F.col("end_id") == F.col("d_id"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
    for table in (whole, strings, ours, nodes, placed, totals, full):
        release(table)
    return out


def conversation_trie(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", stride: int = STRIDE, firsts: int = FIRSTS) -> DataFrame:
    """Nodes of the prefix trie of the conversations that :func:`rebuilt_turns` gives.

    A node of depth d is a sequence of d turns with which a conversation
    begins, from the root (d = 0) on; those conversations are its members.
    Per node: conv_id (smallest member), depth, parent_conv_id (of the node
    above; null for the root), n_convs, n_children, n_leaves (childless
    nodes in its subtree, itself included), saved_tokens (over its subtree,
    each node's n_convs - 1 times the code points of its last text) and
    ends_sha256 (of the comma-joined ids, ascending, of members of exactly d
    turns; of the empty string if none).

    Turns are equal when role and text are (null: empty), told by 128-bit
    hashes. Nulls, ties and rows without conv_id as :func:`numbered_turns`;
    repeated rows are turns of their own. No rows give no nodes, not even a
    root. Other columns are ignored.
    """
    spark = convs.sparkSession
    turns = written(spark, numbered_turns(convs, conv_col, turn_col, role_col, text_col))
    heads = written(spark, beginnings(turns, stride, firsts))
    again = rebuilt_turns(turns, heads, stride, firsts)
    n = heads.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    prefixes = written(spark, hashed_prefixes(again, n))
    out = prefix_nodes(heads.select("conv_id", "total"), prefixes)
    for table in (turns, prefixes, heads):
        release(table)
    return out


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations."""
    return conversation_trie(load(spark, sf_dir, "conversations"))


ORACLE = """
with crc as (  -- CRC-32 of the decimal id
  select conv_id, xor(list_reduce(
    list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
    lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)),
      lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 6 as h
  from (select distinct conv_id from conversations where conv_id is not null)),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
                            sha256(coalesce(text, ''))) as k
  from conversations where conv_id is not null),
rebuilt as (
  select crc.conv_id, k as o, role, text from crc join turns on turns.conv_id = crc.conv_id - crc.conv_id % 100 and k <= h
  union all
  select conv_id, k + 10 as o, role, text from crc join turns using (conv_id) where k > h),
placed as (select conv_id, row_number() over (partition by conv_id order by o) as depth, length(text) as points,
                  md5(role || chr(0) || text) as turn from rebuilt),
prefixes as (
  select conv_id, depth, points,
         md5(string_agg(turn, '') over (partition by conv_id order by depth rows unbounded preceding)) as node from placed
  union all select conv_id, 0, 0, 'root' from crc),
linked as (select *, lag(node) over (partition by conv_id order by depth) as up,
                  max(depth) over (partition by conv_id) as total from prefixes),
nodes as (select depth, node, any_value(up) as up, any_value(points) as points, count(*) as n_convs, min(conv_id) as conv_id,
                 sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = total), '')) as ends_sha256
          from linked group by depth, node),
kids as (select up, count(*) as n from nodes where up is not null group by up),
leaves as (select l.node, count(distinct e.node) as n
           from linked l join linked e on e.conv_id = l.conv_id and e.depth = e.total
           where e.node not in (select up from kids) group by l.node),
saved as (select l.node, sum((u.n_convs - 1) * u.points)::bigint as saved
          from nodes u join linked l on l.conv_id = u.conv_id and l.depth <= u.depth group by l.node)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(kids.n, 0) as n_children,
       leaves.n as n_leaves, saved.saved as saved_tokens, n.ends_sha256
from nodes n left join nodes p on p.node = n.up left join kids on kids.up = n.node
join leaves on leaves.node = n.node join saved on saved.node = n.node
"""
