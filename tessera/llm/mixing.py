"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import load, word_count, written

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
EPOCHS = 3  # a source, and so a document, is read at most so often
SEED = "mix"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Weight and target of each source; one row per source in, one row out.

    ``sizes`` has s_null, s_val and source_size. Targets share the total of
    all sizes by weight; a target stops at ``epochs`` times its source's
    size, and what is over is shared again by weight until none is above.
    That level is found in one ordered pass: with sources sorted by the time
    at which each is used up, the level is the first one not past its
    source's own time. The windows have one row per source.
    """
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     (F.pmod(F.row_number().over(Window.orderBy("s_null", "s_val")) - 1,
                             F.lit(len(weights))) + 1).cast("int"))
    named = sizes.select("*", w.cast("long").alias("weight"))
    full = F.col("source_size") * F.lit(epochs)
    timed = named.select("*", (full.cast("double") / F.col("weight")).alias("used_up"))
    order = Window.orderBy("used_up", "s_null", "s_val")
    prior = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum(full).over(prior), F.lit(0))).cast("double")
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(prior), F.lit(0))))
    levels = timed.select("*", level.alias("level"), F.row_number().over(order).alias("k"))
    chosen = F.min(F.when(F.col("used_up") >= F.col("level"), F.struct("k", "level"))).over(every)["level"]
    return levels.select(
        "s_null", "s_val", "weight", "source_size",
        F.least(full.cast("double"), F.col("weight") * chosen).alias("target"),
        chosen.alias("horizon"), F.sum("source_size").over(every).alias("budget"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, *,
             size: Column | None = None, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text") -> DataFrame:
    """How often each document is taken: doc_id, source, size, source_size, target, times, n.

    A document in epoch ``e`` of its source (0, 1, ...) ends at the virtual
    time (e * source size + words of its source up to and with it) / weight,
    in an order shuffled by a hash of its id. All such entries sorted by
    virtual time make the mix; it is cut before the first entry that would
    pass the total of all sizes. ``times`` is the number of a document's
    entries before the cut, 0 to ``epochs``.

    Sums run over hash buckets of a source, never over a whole source in one
    task. The cut is found from a histogram of virtual time; only its one
    bucket, about the square root of all entries, is sorted row by row. The
    cut itself, one row, is read to the driver.

    Rows alike in id, source and size are one unit of ``n`` rows, taken
    together. A null id or source is a value of its own (null sources come
    last); a null text has no words. Documents without words are taken as
    soon as their virtual time is reached and add nothing.
    """
    size = word_count(text_col) if size is None else size
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
    units = written(docs.sparkSession, rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    units = (units.select("*", F.col("source").isNull().alias("s_null"), F.coalesce("source", F.lit("")).alias("s_val"),
                     (F.col("size") * F.col("n")).alias("words"),
                     F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                                       F.col("size").cast("string"))).alias("key")))
    sizes = units.groupBy("s_null", "s_val").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, epochs)
    total = units.select(F.count(F.lit(1))).first()[0]
    digits = max(1, math.ceil(math.log(math.sqrt(max(total, 1)), 16)))  # of the hash: about sqrt(rows) buckets
    units = units.withColumn("bucket", F.substring("key", 1, digits))
    before = Window.partitionBy("s_null", "s_val").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (units.groupBy("s_null", "s_val", "bucket").agg(F.sum("words").alias("b"))
              .select("s_null", "s_val", "bucket", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("start")))
    upto = (Window.partitionBy("s_null", "s_val", "bucket").orderBy("key", "doc_id")
            .rowsBetween(Window.unboundedPreceding, 0))
    timed = (units.withColumn("upto", F.sum("words").over(upto))
             .join(starts, ["s_null", "s_val", "bucket"]).join(targets, ["s_null", "s_val"])
             .select("doc_id", "source", "size", "n", "words", "key", "s_null", "s_val", "weight", "source_size",
                     "target", "horizon", "budget", (F.col("start") + F.col("upto")).alias("cum")))

    def ends(e: Column | int) -> Column:
        e = F.lit(e).cast("long") if isinstance(e, int) else e
        return (e * F.col("source_size") + F.col("cum")).cast("double") / F.col("weight")

    bins = max(1024, math.ceil(math.sqrt(epochs * max(total, 1))))

    def bin_of(vt: Column) -> Column:
        return F.when(F.col("horizon") > 0, F.least(F.floor(vt / F.col("horizon") * F.lit(bins)),
                                                    F.lit(2 * bins))).otherwise(F.lit(0)).cast("long")

    entries = (timed.withColumn("e", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long"))))
               .withColumn("vt", ends(F.col("e"))).withColumn("bin", bin_of(F.col("vt"))))
    hist = entries.groupBy("bin").agg(F.sum("words").alias("b"), F.max("budget").alias("budget"))
    run = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    over = (hist.select("bin", "b", "budget", F.sum("b").over(run).alias("upto"))
            .where(F.col("upto") > F.col("budget")).orderBy("bin").limit(1)
            .select("bin", (F.col("upto") - F.col("b")).alias("base")).first())
    if over is None:  # nothing has words: every entry fits
        return timed.select("doc_id", "source", "size", "source_size", "target",
                            F.lit(epochs).cast("long").alias("times"), "n")
    place = ["vt", "key", "s_null", "s_val", "e"]
    line = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, 0)
    cut = (entries.where(F.col("bin") == over["bin"])
           .select(*place, "budget", (F.sum("words").over(line) + F.lit(over["base"])).alias("upto"))
           .where(F.col("upto") > F.col("budget")).orderBy(*place).limit(1).first())
    limit = F.struct(F.lit(cut["vt"]).alias("vt"), F.lit(cut["key"]).alias("key"),
                     F.lit(cut["s_null"]).alias("s_null"), F.lit(cut["s_val"]).alias("s_val"),
                     F.lit(cut["e"]).cast("long").alias("e"))
    times = sum((F.when(F.struct(ends(e).alias("vt"), F.col("key"), F.col("s_null"), F.col("s_val"),
                                 F.lit(e).cast("long").alias("e")) < limit, 1).otherwise(0)
                 for e in range(epochs)), start=F.lit(0).cast("long"))
    return timed.select("doc_id", "source", "size", "source_size", "target", times.alias("times"), "n")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    plan = mix_plan(docs, **options)
    return (plan.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")))


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                  **options) -> DataFrame:
    """The mix itself: each input row as often as it is taken, with all its columns.

    Rows are matched to the plan by id, source and size, so that nulls and
    repeated ids need no special case.
    """
    plan = (mix_plan(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
            .where(F.col("times") > 0).select("doc_id", "source", "size", "times"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("r_id"), F.col(source_col).alias("r_source"),
                       word_count(text_col).alias("r_size"))
    on = (F.col("r_id").eqNullSafe(F.col("doc_id")) & F.col("r_source").eqNullSafe(F.col("source"))
          & (F.col("r_size") == F.col("size")))
    return (rows.join(plan, on).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("k"))
            .select("row.*"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 5, 2, 1, repeating, at most three times each."""
    return mix_report(load(spark, sf_dir, "documents"))


ORACLE = """
with rows as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size
  from documents),
units as (
  select doc_id, source, size, count(*) as n, source is null as s_null, coalesce(source, '') as s_val,
         size * count(*) as words, md5('mix|' || coalesce(cast(doc_id as varchar), 'null') || '|' || size) as key
  from rows group by doc_id, source, size),
named as (
  select s_null, s_val, sum(words)::bigint as source_size,
         [5, 2, 1][((row_number() over (order by s_null, s_val)) - 1) % 3 + 1] as weight
  from units group by s_null, s_val),
timed as (select *, cast(source_size * 3 as double) / weight as used_up from named),
levels as (
  select *, row_number() over (order by used_up, s_null, s_val) as k,
    cast(sum(source_size) over () - coalesce(sum(source_size * 3) over (order by used_up, s_null, s_val
      rows between unbounded preceding and 1 preceding), 0) as double)
    / (sum(weight) over () - coalesce(sum(weight) over (order by used_up, s_null, s_val
      rows between unbounded preceding and 1 preceding), 0)) as level
  from timed),
chosen as (select min_by(level, k) as horizon from levels where used_up >= level),
targets as (
  select s_null, s_val, weight, source_size, least(cast(source_size * 3 as double), weight * horizon) as target
  from levels, chosen),
placed as (
  select u.*, t.weight, t.source_size, t.target,
         sum(words) over (partition by u.s_null, u.s_val order by key, doc_id
                          rows between unbounded preceding and current row) as cum
  from units u join targets t on u.s_null = t.s_null and u.s_val = t.s_val),
entries as (
  select p.*, e, cast(e * source_size + cum as double) / weight as vt
  from placed p, (select unnest([0, 1, 2]) as e)),
running as (
  select *, sum(words) over (order by vt, key, s_null, s_val, e
                             rows between unbounded preceding and current row) as upto,
         (select sum(source_size) from named) as budget
  from entries),
stop as (select min(case when upto > budget then struct_pack(vt := vt, key := key, s_null := s_null, s_val := s_val,
                                                             e := e) end) as cut from running),
taken as (
  select doc_id, source, size, n, source_size, target,
         count(*) filter (where cut is null
                          or struct_pack(vt := vt, key := key, s_null := s_null, s_val := s_val, e := e) < cut) as times
  from running, stop group by doc_id, source, size, n, source_size, target)
select doc_id, size, source_size, target, cast(size * times as bigint) as taken
from (select *, unnest(range(n)) as copy from taken)
"""
