"""Approximate nearest neighbours by inner product: a graph from NN-descent, searched greedily."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import load, release, written

NEIGHBOURS = 64  # of each node in the graph, whatever the number of rows
NEAREST = 20  # that a query returns
SETTLED = 0.001  # share of edges that are new, up to which NN-descent counts as converged
ORDERS = 6  # random orders whose blocks start the graph
BLOCK = 1024  # nodes that are compared with each other in the start
FROM_BLOCK = 24  # neighbours that a node takes from each block
BUCKET = 2000  # nodes whose lists of NEIGHBOURS are merged together, about
CENTRE = 512  # members of a node's surroundings that are compared in one piece, about
BEAM = 24  # best nodes whose neighbours a search visits
KEPT = 40  # best nodes that a search returns, to be scored exactly
QUERY_STEP = 20

_EDGES = "id long, other long, score float, fresh boolean"


# ---- vectors --------------------------------------------------------------------------

def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, not empty, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """One row for each different vector: id (its smallest row id), vector, code and scale.

    ``code`` holds the components as whole numbers of one byte, ``scale``
    what to multiply them by. They build and walk the graph; results are
    scored with the vectors themselves.
    """
    kept = vectors.where(usable(vector_col) & F.col(id_col).isNotNull())
    rows = kept.groupBy(F.col(vector_col).alias("vector")).agg(F.min(id_col).cast("long").alias("id"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            sizes = pdf["vector"].map(len)
            if sizes.nunique() > 1:
                raise ValueError("vectors of different lengths")
            x = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
            scale = np.abs(x).max(axis=1) / 127.0
            code = np.rint(x / scale[:, None]).astype(np.int8)
            yield pdf.assign(code=[c.tobytes() for c in code], scale=scale.astype(np.float32))

    kind = vectors.schema[vector_col].dataType.simpleString()
    return rows.select("id", "vector").mapInPandas(encode, f"id long, vector {kind}, code binary, scale float")


def _matrix(pdf: pd.DataFrame, code: str = "code", scale: str = "scale") -> np.ndarray:
    """Vectors from their codes."""
    flat = np.frombuffer(b"".join(pdf[code]), dtype=np.int8).reshape(len(pdf), -1)
    return flat.astype(np.float32) * pdf[scale].to_numpy(np.float32)[:, None]


def _bucket(col: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def _best(ids: np.ndarray, others: np.ndarray, scores: np.ndarray, fresh: np.ndarray, keep: int) -> pd.DataFrame:
    """The ``keep`` highest scores of each id, each pair once (as known, if it was known)."""
    order = np.lexsort((fresh, others, ids))
    ids, others, scores, fresh = ids[order], others[order], scores[order], fresh[order]
    first = np.ones(len(ids), dtype=bool)
    first[1:] = (ids[1:] != ids[:-1]) | (others[1:] != others[:-1])
    ids, others, scores, fresh = ids[first], others[first], scores[first], fresh[first]
    order = np.lexsort((others, -scores, ids))
    ids, others, scores, fresh = ids[order], others[order], scores[order], fresh[order]
    starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.empty(0, np.int64)
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    top = place < keep
    return pd.DataFrame({"id": ids[top], "other": others[top], "score": scores[top], "fresh": fresh[top]})


# ---- the start of the graph -----------------------------------------------------------

def _order_codes(order: int, dims: int, bits: int = 16) -> np.ndarray:
    """Directions whose signs sort the vectors; the same in every task."""
    return np.random.default_rng([order, dims]).standard_normal((dims, bits)).astype(np.float32)


def _with_orders(orders: int):
    """Each node once for each random order, with its place in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = _matrix(pdf)
            for o in range(orders):
                side = x @ _order_codes(o, x.shape[1])
                gray = (side > 0).astype(np.int64)
                binary = np.bitwise_xor.accumulate(gray, axis=1)  # neighbours in the order differ in few signs
                place = binary @ (1 << np.arange(binary.shape[1] - 1, -1, -1, dtype=np.int64))
                yield pd.DataFrame({"run": o, "place": place + (np.int64(o) << 32), "id": pdf["id"],
                                    "code": pdf["code"], "scale": pdf["scale"]})

    return run


def _blocks(keep: int, block: int):
    """The best neighbours of each node within its block of an order; no block passes the end of a partition."""

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part in np.array_split(np.arange(len(pdf)), max(1, len(pdf) // block)):
            own = pdf.iloc[part]
            if own["run"].iat[0] != own["run"].iat[-1]:
                parts = [p for _, p in own.groupby("run")]
            else:
                parts = [own]
            for p in parts:
                if len(p) < 2:
                    continue
                x, ids = _matrix(p), p["id"].to_numpy()
                scores = x @ x.T
                np.fill_diagonal(scores, -np.inf)
                k = min(keep, len(ids) - 1)
                top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                out.append(pd.DataFrame({"id": np.repeat(ids, k), "other": ids[top].ravel(),
                                         "score": np.take_along_axis(scores, top, axis=1).ravel(), "fresh": True}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "other": [], "score": [], "fresh": []})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if len(held) >= 8 * block:  # the last rows wait, so that no block is small
                yield pairs(held.iloc[:-2 * block])
                held = held.iloc[-2 * block:].reset_index(drop=True)
        if held is not None and len(held):
            yield pairs(held)

    return run


def _merged(edges: DataFrame, buckets: int, keep: int) -> DataFrame:
    """The best ``keep`` edges of each node, with its bucket."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        best = _best(pdf["id"].to_numpy(), pdf["other"].to_numpy(), pdf["score"].to_numpy(np.float32),
                     pdf["fresh"].to_numpy(bool), keep)
        return best.assign(least=best.groupby("id")["score"].transform("min"),
                           full=best.groupby("id")["id"].transform("size") >= keep)

    return (edges.withColumn("bucket", _bucket("id", buckets)).groupBy("bucket")
            .applyInPandas(run, _EDGES + ", least float, full boolean"))


def start_graph(nodes: DataFrame, buckets: int, total: int, keep: int = NEIGHBOURS) -> DataFrame:
    """First edges: in each of some random orders, blocks of neighbouring nodes are compared."""
    parts = max(1, total * ORDERS // (8 * BLOCK))
    placed = (nodes.select("id", "code", "scale")
              .mapInPandas(_with_orders(ORDERS), "run int, place long, id long, code binary, scale float")
              .repartitionByRange(parts, "place", "id").sortWithinPartitions("place", "id"))
    return _merged(placed.mapInPandas(_blocks(FROM_BLOCK, BLOCK), _EDGES), buckets, keep)


# ---- NN-descent -----------------------------------------------------------------------

def _local_join(keep: int):
    """Around each node, its neighbours are compared with each other; what betters a list is sent to it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["centre", "piece"], kind="stable")
        x, ids = _matrix(pdf), pdf["id"].to_numpy()
        fresh, bar = pdf["fresh"].to_numpy(bool), pdf["bar"].to_numpy(np.float32)
        key = pdf["centre"].to_numpy(), pdf["piece"].to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]),
                                              [True])))
        out, held = [], 0

        def best() -> list[tuple]:
            a, b, s = (np.concatenate(c) for c in zip(*out))
            top = _best(a, b, s, np.ones(len(a), bool), keep)
            return [(top["id"].to_numpy(), top["other"].to_numpy(), top["score"].to_numpy())]

        for lo, hi in zip(cuts[:-1], cuts[1:]):
            new = fresh[lo:hi]
            if hi - lo < 2 or not new.any():
                continue
            scores = x[lo:hi] @ x[lo:hi].T
            better = (scores > bar[lo:hi, None]) & (new[:, None] | new[None, :])
            np.fill_diagonal(better, False)
            i, j = np.nonzero(better)
            out.append((ids[lo + i], ids[lo + j], scores[i, j]))
            held += len(i)
            if held > 2_000_000:
                out = best()
                held = len(out[0][0])
        if not held:
            return pd.DataFrame({"id": [], "other": [], "score": [], "fresh": []})
        a, b, s = best()[0]
        return pd.DataFrame({"id": a, "other": b, "score": s, "fresh": True})

    return run


def descend(spark: SparkSession, nodes: DataFrame, graph: DataFrame, buckets: int, keep: int) -> DataFrame:
    """One round: neighbours of neighbours, over edges in both directions, become candidates.

    A node that very many others list (a hub) has its surroundings cut into
    pieces by hash, so that no task compares or holds an unbounded list.
    Vectors travel as one byte per component. A pair of members is compared
    only if an edge to one of them is new.
    """
    edges = graph.select("id", "other", "fresh")
    both = (edges.select(F.col("id").alias("centre"), F.col("other").alias("id"), "fresh")
            .unionByName(edges.select(F.col("other").alias("centre"), "id", "fresh"))
            .groupBy("centre", "id").agg(F.bool_or("fresh").alias("fresh")))
    hubs = (edges.groupBy(F.col("other").alias("centre")).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > CENTRE).select("centre", F.ceil(F.col("n") / F.lit(CENTRE)).alias("pieces")))
    bars = graph.groupBy("id").agg(F.min(F.when(F.col("full"), F.col("least"))).alias("bar"))
    members = (nodes.select("id", "code", "scale").join(bars, "id", "left")
               .withColumn("bar", F.coalesce("bar", F.lit(float("-inf")).cast("float"))))
    around = (both.join(hubs, "centre", "left")
              .withColumn("piece", F.pmod(F.xxhash64("id"), F.coalesce("pieces", F.lit(1))).cast("int"))
              .join(members, "id")
              .select(F.pmod(F.xxhash64("centre", "piece"), F.lit(buckets)).cast("int").alias("bucket"),
                      "centre", "piece", "id", "fresh", "code", "scale", "bar"))
    found = around.groupBy("bucket").applyInPandas(_local_join(keep), _EDGES)
    known = graph.select("id", "other", "score", F.lit(False).alias("fresh"))
    return written(spark, _merged(known.unionByName(found), buckets, keep))


def build_graph(spark: SparkSession, nodes: DataFrame, total: int, keep: int = NEIGHBOURS,
                settled: float = SETTLED) -> DataFrame:
    """Edges (id, other, score) of a graph in which every node lists near others.

    Rounds go on until at most ``settled`` of the edges are new. They do end:
    an edge only ever gives way to one of higher score.
    """
    buckets = max(2 * spark.sparkContext.defaultParallelism, math.ceil(total * keep / (BUCKET * NEIGHBOURS)))
    graph = written(spark, start_graph(nodes, buckets, total, keep))
    while True:
        edges, fresh = graph.agg(F.count(F.lit(1)), F.count_if("fresh")).first()
        if fresh <= settled * edges:
            break
        before, graph = graph, descend(spark, nodes, graph, buckets, keep)
        release(before)
    return graph.select("id", "other", "score")


# ---- search ---------------------------------------------------------------------------

def _scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            score = np.einsum("ij,ij->i", _matrix(pdf, "q_code", "q_scale"), _matrix(pdf))
            yield pd.DataFrame({"query": pdf["query"], "id": pdf["id"], "score": score, "visited": False})


def search(spark: SparkSession, nodes: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = BEAM,
           kept: int = KEPT) -> DataFrame:
    """(query, id) of the ``kept`` nodes that a greedy walk from each query's own node finds best.

    ``queries`` has query, the id of a node. Each round every query visits
    the unvisited ones among its ``beam`` best nodes: their neighbours, if
    not seen yet, are scored. It ends when no query has anything to visit;
    it does end, as every round visits nodes that were not visited before.
    Queries with nothing to visit rest.
    """
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    own = queries.join(graph.withColumnRenamed("id", "query"), "query")
    state = written(spark, own.select("query", F.col("other").alias("id"), "score", F.lit(False).alias("visited")))
    codes = nodes.select("id", "code", "scale")
    q_codes = (queries.join(codes.withColumnRenamed("id", "query"), "query")
               .withColumnsRenamed({"code": "q_code", "scale": "q_scale"}))
    steps = graph.select("id", "other")
    while True:
        ranked = written(spark, state.withColumn("best", F.row_number().over(order) <= beam))
        visit = ranked.where(F.col("best") & ~F.col("visited")).select("query", "id")
        if visit.limit(1).isEmpty():
            break
        # of all that is reached or known, what is not known yet
        reached = visit.join(steps, "id").select("query", F.col("other").alias("id"), F.lit(False).alias("known"))
        known = ranked.select("query", "id", F.lit(True).alias("known"))
        new = (reached.where("query <> id").unionByName(known).groupBy("query", "id")
               .agg(F.bool_or("known").alias("known")).where(~F.col("known")).select("query", "id"))
        scored = (new.join(codes, "id").join(q_codes, "query")
                  .mapInPandas(_scored, "query long, id long, score float, visited boolean"))
        # what was seen and is not among the best stays known, so that it is not scored again
        now = ranked.select("query", "id", "score", (F.col("visited") | F.col("best")).alias("visited"))
        state = written(spark, now.unionByName(scored))
    return state.withColumn("k", F.row_number().over(order)).where(F.col("k") <= kept).select("query", "id")


def _exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            a = np.stack(pdf["q_vector"].to_numpy()).astype(np.float64)
            b = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
            yield pd.DataFrame({"query": pdf["query"], "id": pdf["id"], "score": np.einsum("ij,ij->i", a, b)})


def nearest(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding",
            count: int = NEAREST, keep: int = NEIGHBOURS, settled: float = SETTLED) -> DataFrame:
    """query_id, rank, vec_id and score: the ``count`` rows of largest inner product found for each query row.

    Equal vectors are one node of the graph and are spread out again at the
    end: of each the ``count`` + 1 smallest ids can matter, as ties go to the
    smaller id. Scores are inner products of the original vectors in double
    precision. Rows with a null id, and vectors that are null, zero or not
    finite throughout, take no part; with fewer candidates all are returned;
    one usable row has none. All vectors must have one length. ``keep`` is
    the number of neighbours of each node in the graph.
    """
    spark = vectors.sparkSession
    nodes = written(spark, classes(vectors, id_col, vector_col))
    total = nodes.select(F.count(F.lit(1))).first()[0]
    rows = (vectors.where(usable(vector_col) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("row"), is_query.alias("is_query"),
                    F.col(vector_col).alias("vector")))
    members = written(spark, rows.join(nodes.select("id", "vector"), "vector").select("row", "is_query", "id"))
    asked = members.where("is_query")
    queries = asked.select(F.col("id").alias("query")).distinct()
    graph = build_graph(spark, nodes, total, keep, settled)
    found = search(spark, nodes, graph, queries, kept=max(KEPT, 2 * count))
    found = found.unionByName(queries.select("query", F.col("query").alias("id")))  # copies of the query's own vector
    vector = nodes.select("id", "vector")
    exact = written(spark, found.join(vector, "id")
                    .join(vector.toDF("query", "q_vector"), "query")
                    .mapInPandas(_exact, "query long, id long, score double"))
    first = Window.partitionBy("id").orderBy("row")
    few = members.select("id", "row", F.row_number().over(first).alias("k")).where(F.col("k") <= count + 1)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # the best rows of each node that is a query, then of each row that is one
    per_node = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = (exact.join(few.select("id", F.col("row").alias("vec_id")), "id")
            .withColumn("k", F.row_number().over(per_node)).where(F.col("k") <= count + 1)
            .select("query", "vec_id", "score"))
    return (asked.select(F.col("row").alias("query_id"), F.col("id").alias("query")).join(best, "query")
            .where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest embeddings of every embedding whose id is divisible by 20."""
    vectors = load(spark, sf_dir, "embeddings")
    return nearest(vectors, F.pmod(F.col("vec_id"), F.lit(QUERY_STEP)) == 0)
