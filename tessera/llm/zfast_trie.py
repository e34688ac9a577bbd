"""A z-fast trie of many sequences, as tables: nodes hashed by handle, located by fat binary search.

A *string* is a sequence of symbols; table ``prefixes`` (s, d, x1, x2, ...)
holds a 128-bit hash of the first d symbols of string s, for d from 1 to its
length. A node is a maximal path without branches or string ends: it stands
for the prefix of string ``rep`` of length ``len`` (its extent) and the edge
down from length ``plen``. Its handle is the prefix of the length in (plen,
len] that the highest power of two divides: the two-fattest. The node table
is keyed by the hash of the handle, so a string finds the deepest node whose
handle it begins with in a number of lookups logarithmic in its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import release, written

BATCHES = (1 / 8, 1.0)  # share of the strings in the trie after each batch
BLOCK = 1 << 10  # depths of a string whose nodes are put in order together
_NODES = ("rep long, len long, plen long, f long, h1 long, h2 long, c1 long, c2 long, e1 long, e2 long")


def two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the highest power of two divides, for 0 <= a < b."""
    top = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return b.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), top))


def _hash_at(df: DataFrame, prefixes: DataFrame, s: str, d: Column, x1: str, x2: str) -> DataFrame:
    """``df`` with the hash of the first ``d`` symbols of string ``s`` (null beyond its length)."""
    p = prefixes.select(F.col("s").alias("p_s"), F.col("d").alias("p_d"), F.col("x1").alias(x1), F.col("x2").alias(x2))
    return df.join(p, (F.col(s) == F.col("p_s")) & (d == F.col("p_d")), "left").drop("p_s", "p_d")


def _keyed(nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Nodes (rep, len, plen) with the hashes of handle (h), first symbol of the edge (c) and extent (e)."""
    places = F.array(F.struct(F.lit("h").alias("kind"), two_fattest(F.col("plen"), F.col("len")).alias("d")),
                     F.struct(F.lit("c").alias("kind"), (F.col("plen") + 1).alias("d")),
                     F.struct(F.lit("e").alias("kind"), F.col("len").alias("d")))
    each = (nodes.select("rep", "len", "plen", F.explode(places).alias("at"))
            .select("rep", "len", "plen", "at.kind", "at.d"))
    each = _hash_at(each, prefixes, "rep", F.col("d"), "x1", "x2")

    def of(kind: str, value: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(value)))

    return each.groupBy("rep", "len", "plen").agg(
        of("h", "d").alias("f"), of("h", "x1").alias("h1"), of("h", "x2").alias("h2"), of("c", "x1").alias("c1"),
        of("c", "x2").alias("c2"), of("e", "x1").alias("e1"), of("e", "x2").alias("e2"))


def _common(df: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Positions (s, total, rep, len, plen, l): ``l`` is how many symbols string s shares with the extent.

    ``df`` has (s, total, rep, len, plen, lo): the first ``lo`` symbols are known
    to agree. Only depths beyond them are compared.
    """
    end = F.least("total", "len")
    open_ = df.where(F.col("lo") < end).select("s", "rep", "lo", end.alias("end"))
    a = prefixes.select(F.col("s").alias("a_s"), "d", "x1", "x2")
    mine = (open_.join(a, (F.col("s") == F.col("a_s")) & (F.col("d") > F.col("lo")) & (F.col("d") <= F.col("end")))
            .select("s", "rep", "d", "x1", "x2"))
    b = prefixes.select(F.col("s").alias("b_s"), F.col("d").alias("b_d"), F.col("x1").alias("b_1"), F.col("x2").alias("b_2"))
    met = mine.join(b, (F.col("rep") == F.col("b_s")) & (F.col("d") == F.col("b_d"))
                    & (F.col("x1") == F.col("b_1")) & (F.col("x2") == F.col("b_2")))
    shared = met.groupBy("s").agg(F.max("d").alias("m"))
    return (df.join(shared, "s", "left")
            .select("s", "total", "rep", "len", "plen", F.coalesce("m", "lo").alias("l")))


def _locate(spark: SparkSession, strings: DataFrame, nodes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Where each string (s, total) leaves the trie: its exit node and the symbols shared (see :func:`_common`).

    The fat binary search keeps an interval (a, b] of lengths for each
    string and looks its prefix of the interval's two-fattest length up
    among the handles: a hit moves a to that node's extent, a miss moves b
    below. All strings search at once, one lookup join a step; those that
    are through wait aside.
    """
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    active = strings.select("s", "total", zero.alias("a"), F.col("total").alias("b"), null.alias("rep"), zero.alias("len"),
                            zero.alias("plen"), zero.alias("lo"), zero.alias("e1"), zero.alias("e2"))
    handles = nodes.select(*[F.col(c).alias(f"n_{c}") for c in ("rep", "len", "plen", "f", "h1", "h2", "e1", "e2")])
    steps, through = [], []
    while True:
        f = two_fattest(F.col("a"), F.col("b"))
        probe = _hash_at(active.withColumn("f", f), prefixes, "s", F.col("f"), "x1", "x2")
        tried = probe.join(handles, (F.col("x1") == F.col("n_h1")) & (F.col("x2") == F.col("n_h2"))
                           & (F.col("f") == F.col("n_f")), "left")
        hit = F.col("n_rep").isNotNull()

        def known(new: str, old: str) -> Column:
            return F.when(hit, F.col(new)).otherwise(F.col(old)).alias(old)

        step = written(spark, tried.select(
            "s", "total", F.when(hit, F.least("n_len", "b")).otherwise(F.col("a")).alias("a"),
            F.when(hit, F.col("b")).otherwise(F.col("f") - 1).alias("b"),
            known("n_rep", "rep"), known("n_len", "len"), known("n_plen", "plen"), known("n_f", "lo"),
            known("n_e1", "e1"), known("n_e2", "e2")))
        steps.append(step)
        through.append(step.where("a >= b"))
        active = step.where("a < b")
        if active.isEmpty():
            break
    found = through[0]
    for more in through[1:]:
        found = found.unionByName(more)
    # does the string go through the node's whole extent, and is there an edge for its next symbol?
    found = _hash_at(found, prefixes, "s", F.col("len"), "y1", "y2")
    found = _hash_at(found, prefixes, "s", F.col("len") + 1, "z1", "z2")
    whole = (F.col("len") == 0) | F.coalesce((F.col("y1") == F.col("e1")) & (F.col("y2") == F.col("e2")), F.lit(False))
    edges = nodes.select(F.col("rep").alias("k_rep"), F.col("len").alias("k_len"), F.col("plen").alias("k_plen"),
                         F.col("c1").alias("k_1"), F.col("c2").alias("k_2"))
    found = found.withColumn("whole", whole).join(
        edges, F.col("whole") & (F.col("z1") == F.col("k_1")) & (F.col("z2") == F.col("k_2"))
        & (F.col("len") == F.col("k_plen")), "left")
    down = F.col("k_rep").isNotNull()
    at = written(spark, found.select(
        "s", "total", F.when(down, F.col("k_rep")).otherwise(F.col("rep")).alias("rep"),
        F.when(down, F.col("k_len")).otherwise(F.col("len")).alias("len"),
        F.when(down, F.col("len")).otherwise(F.col("plen")).alias("plen"),
        F.when(down, F.col("len") + 1).when(F.col("whole"), F.col("len")).otherwise(F.col("lo")).alias("lo")))
    out = written(spark, _common(at, prefixes))
    for table in [*steps, at]:
        release(table)
    return out


def _above(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` (s, l, d, ...) with plen: the next smaller d of the same s, or l if there is none.

    Depths are compared within blocks of them; one row for each block that
    holds any carries the last one of the block before, so a string of very
    many nodes is spread.
    """
    rows = rows.withColumn("block", F.floor(F.col("d") / block))
    within = F.lag("d").over(Window.partitionBy("s", "block").orderBy("d"))
    last = rows.where(F.col("total") >= block).groupBy("s", "block").agg(F.max("d").alias("last"))
    before = last.select(F.col("s").alias("b_s"), F.col("block").alias("b_block"),
                         F.lag("last").over(Window.partitionBy("s").orderBy("block")).alias("before"))
    return (rows.withColumn("within", within)
            .join(before, (F.col("s") == F.col("b_s")) & (F.col("block") == F.col("b_block")), "left")
            .withColumn("plen", F.coalesce("within", "before", "l")))


def _insert(spark: SparkSession, at: DataFrame, nodes: DataFrame, prefixes: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes with the strings at positions ``at`` (of :func:`_locate`) in the trie.

    Edges are split where strings leave or end. Beyond that place all
    prefixes of a string are new, and whatever strings share one have left
    at the same place. So one grouping by hash finds the new extents: the
    prefixes where a string ends or from which strings go on differently.
    """
    p = prefixes.select(F.col("s").alias("p_s"), "d", "x1", "x2")
    paths = (at.where("l < total").select("s", "total", "l").join(p, (F.col("s") == F.col("p_s")) & (F.col("d") > F.col("l")))
             .drop("p_s"))
    paths = written(spark, _hash_at(paths, prefixes, "s", F.col("d") + 1, "n1", "n2"))
    extents = (paths.groupBy("d", "x1", "x2").agg(
        F.min("s").alias("rep"), F.max(F.col("d") == F.col("total")).alias("ends"),
        ((F.min("n1") != F.max("n1")) | (F.min("n2") != F.max("n2"))).alias("parts"))
        .where("ends or parts").select("d", "x1", "x2", "rep"))
    below = (_above(paths.join(extents, ["d", "x1", "x2"]).select("s", "total", "l", "d", "rep"), block)
             .where("s = rep").select("rep", F.col("d").alias("len"), "plen"))
    cuts = at.where("plen < l and l < len").select("rep", "len", "plen", "l").distinct()
    edge = Window.partitionBy("rep", "len").orderBy("l")
    cuts = cuts.withColumns({"above": F.lag("l").over(edge), "lowest": F.lead("l").over(edge).isNull()})
    upper = F.struct(F.col("l").alias("len"), F.coalesce("above", "plen").alias("plen"))
    lower = F.when(F.col("lowest"), F.struct(F.col("len").alias("len"), F.col("l").alias("plen")))
    split = (cuts.select("rep", F.explode(F.array(upper, lower)).alias("part")).where("part is not null")
             .select("rep", "part.len", "part.plen"))
    new = _keyed(below.unionByName(split), prefixes)
    gone = at.where("plen < l and l < len").select("rep", "len").distinct()
    grown = written(spark, nodes.join(gone, ["rep", "len"], "left_anti").unionByName(new))
    for table in (paths, at, nodes):
        release(table)
    return grown


def build(strings: DataFrame, prefixes: DataFrame, batches: tuple[float, ...] = BATCHES,
          block: int = BLOCK) -> DataFrame:
    """The nodes but the root: rep, len, plen, f, h1, h2, c1, c2, e1, e2.

    ``strings`` are (s, total): different strings, which may begin alike or be
    a beginning of another; those of length 0 end at the root and need no
    node. Every end of a string is the extent of a node. Strings are
    inserted in batches, whose members a hash of s chooses; each batch is
    located in the trie so far. ``h``, ``c`` and ``e`` are the hashes of the
    handle (of length f), of the prefix one symbol into the edge, and of the
    extent. The result is a written table.
    """
    spark = strings.sparkSession
    nodes = written(spark, spark.createDataFrame([], _NODES))
    share = F.pmod(F.xxhash64("s"), F.lit(1 << 20)) / float(1 << 20)
    low, planted, zero = 0.0, False, F.lit(0).cast("long")
    for high in batches:
        batch = written(spark, strings.where((F.col("total") > 0) & (share >= low) & (share < high)).select("s", "total"))
        if not batch.isEmpty():
            if planted:
                at = _locate(spark, batch, nodes, prefixes)
            else:  # every string leaves the empty trie at its root
                at = written(spark, batch.select("s", "total", F.lit(None).cast("long").alias("rep"),
                                                 *[zero.alias(c) for c in ("len", "plen", "l")]))
            nodes = _insert(spark, at, nodes, prefixes, block)
            planted = True
        release(batch)
        low = high
    return nodes
