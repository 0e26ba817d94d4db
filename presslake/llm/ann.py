"""Operator 4, approximate nearest neighbours: robust-pruned directed graphs.

Vectors are dealt into shards by a hash.  In each shard a directed graph is
built: for each vector in turn (a batch at a time) a greedy beam search through
the graph so far proposes neighbours, and relaxed distance pruning keeps
diverse ones: a candidate goes if a kept neighbour is closer to it, by the
factor ALPHA, than the vector itself is.  Edges are added both ways, and lists
that overflow are pruned again.  Every query then searches every shard's graph
with a beam, what it finds is scored exactly on the original vectors, and the
best of all shards are its answer.

Copies of a vector are one node that carries the smallest of their ids, as many
as an answer can need.  Spark deals vectors and queries to shards, and merges;
a task holds one shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.common import importable, stage

SHARD_ROWS = 8192     #: vectors of a shard, about
BLOCK_ROWS = 16_384    #: queries that a task searches for
TIE = 14               #: decimals to which equal cosines are a tie
DEGREE = 32           #: neighbours that pruning keeps
SLACK = 48            #: neighbours that a list may grow to before it is pruned
ALPHA = 1.2
BUILD_BEAM = 64
SEARCH_BEAM = 64
BATCH = 256
QUERY_STEP = 50       #: rows whose id is divisible by it are the queries


def _beam(x: np.ndarray, graph: np.ndarray, start: int, q: np.ndarray, width: int):
    """The ``width`` nearest vectors (ids and squared distances, nearest first,
    -1 and infinity where there are fewer) that a greedy beam search from
    ``start`` finds for each row of ``q``."""
    b, deg = len(q), graph.shape[1]
    ids = np.full((b, width), -1, np.int32)
    dist = np.full((b, width), np.inf, np.float32)
    done = np.ones((b, width), bool)
    seen = np.zeros((b, len(x)), bool)
    ids[:, 0], dist[:, 0], done[:, 0], seen[:, start] = start, 2 - 2 * (q @ x[start]), False, True
    rows = np.arange(b)
    while len(rows):
        first = np.argmin(done[rows], axis=1)
        open_ = ~done[rows, first]
        rows, first = rows[open_], first[open_]
        if not len(rows):
            break
        at = ids[rows, first]
        done[rows, first] = True
        near = graph[at]
        valid = near >= 0
        near = np.where(valid, near, start)   # the start is always seen
        new = valid & ~seen[rows[:, None], near]
        seen[rows[:, None], near] |= new
        d = 2 - 2 * np.einsum("brd,bd->br", x[near], q[rows])
        d[~new] = np.inf
        all_d = np.concatenate((dist[rows], d), axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        take = lambda old, more: np.take_along_axis(np.concatenate((old[rows], more), axis=1), order, 1)
        dist_rows = np.take_along_axis(all_d, order, 1)
        ids_rows, done_rows = take(ids, np.where(new, near, -1)), take(done, ~new)
        dist[rows], ids[rows], done[rows] = dist_rows, ids_rows, done_rows | (ids_rows < 0)
    return ids, dist


def _prune(x: np.ndarray, own: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse neighbours of each of ``own`` from candidates (-1: none)."""
    b, c = cand.shape
    valid = (cand >= 0) & (cand != own[:, None])
    xc = x[np.where(valid, cand, 0)]
    d = 2 - 2 * np.einsum("bcd,bd->bc", xc, x[own])
    d[~valid] = np.inf
    order = np.lexsort((cand, d), axis=1)
    cand, d, valid = (np.take_along_axis(a, order, 1) for a in (cand, d, valid))
    valid[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    xc = np.take_along_axis(xc, order[:, :, None], 1)
    between = 2 - 2 * np.matmul(xc, xc.transpose(0, 2, 1))
    out = np.full((b, degree), -1, np.int32)
    rows = np.arange(b)
    for k in range(degree):
        pick = np.argmax(valid, axis=1)
        some = valid[rows, pick]
        if not some.any():
            break
        out[some, k] = cand[rows, pick][some]
        valid &= ~(alpha * alpha * between[rows, pick] <= d) | ~some[:, None]
        valid[rows, pick] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, slack: int = SLACK, alpha: float = ALPHA,
                beam: int = BUILD_BEAM, batch: int = BATCH, seed: int = 0) -> tuple[np.ndarray, int]:
    """The graph of unit vectors ``x``: a row of neighbours (-1: none) for each,
    and the vector to start from (the one nearest to the mean)."""
    n = len(x)
    graph = np.full((n, slack), -1, np.int32)
    size = np.zeros(n, np.int64)
    start = int(np.argmax(x @ x.mean(axis=0)))
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != start]
    i, step = 0, 1
    while i < len(order):
        own = order[i:i + step]
        i, step = i + step, min(batch, 2 * step)
        ids, _ = _beam(x, graph, start, x[own], beam)
        kept = _prune(x, own, ids, degree, alpha)
        graph[own, :degree] = kept
        size[own] = (kept >= 0).sum(axis=1)
        # The same edges backwards, grouped by where they start.
        to, frm = kept.ravel(), np.repeat(own, degree)
        to, frm = to[kept.ravel() >= 0], frm[kept.ravel() >= 0]
        by = np.argsort(to, kind="stable")
        to, frm = to[by], frm[by]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        fits = size[nodes] + count <= slack
        place = np.arange(len(to)) - np.repeat(first, count)
        short = np.repeat(fits, count)
        graph[to[short], size[to[short]] + place[short]] = frm[short]
        size[nodes[fits]] += count[fits]
        full = np.flatnonzero(~fits)
        for s in range(0, len(full), batch):
            part = full[s:s + batch]
            new = np.full((len(part), int(count[part].max())), -1, np.int32)
            for r, k in enumerate(part):
                new[r, :count[k]] = frm[first[k]:first[k] + count[k]]
            again = _prune(x, nodes[part], np.concatenate((graph[nodes[part]], new), axis=1), degree, alpha)
            graph[nodes[part]] = -1
            graph[nodes[part], :degree] = again
            size[nodes[part]] = (again >= 0).sum(axis=1)
    return graph, start


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1 (scaled first, so that neither tiny nor huge ones are lost)."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def search_shard(vectors: np.ndarray, queries: np.ndarray, k: int, beam: int = SEARCH_BEAM):
    """For each query the ``k`` best (or all) of the vectors that beam search
    finds: row numbers (-1: none), best first; of equal cosines (to TIE
    decimals) the smaller row comes first."""
    v64, q64 = unit(vectors), unit(queries)
    x, q = v64.astype(np.float32), q64.astype(np.float32)
    graph, start = build_graph(x)
    found = []
    for i in range(0, len(q), BATCH):
        ids, _ = _beam(x, graph, start, q[i:i + BATCH], max(beam, k))
        cos = np.round(np.einsum("bkd,bd->bk", v64[np.maximum(ids, 0)], q64[i:i + BATCH]), TIE)
        cos[ids < 0] = -np.inf
        best = np.lexsort((ids, -cos), axis=1)[:, :k]
        found.append(np.take_along_axis(ids, best, 1))
    return np.concatenate(found)


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda e: e != 0)


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` nearest ``rows`` of each of ``queries`` (both: id, v) by
    cosine, other than rows of the query's own id.

    Returns query_id, rank, vec_id, score, best first; of cosines equal to TIE
    decimals the smaller id first.  Rows with a null id or a vector that is
    null, empty, zero or not finite take no part; vectors are compared with
    those of their own length only; repeated rows count once; a query without
    candidates has no rows.

    Vectors of one direction are one node of the graphs, whatever their length.
    A task holds one shard's vectors and one block of the queries: both have a
    size that doesn't grow with the table (the shard's graph is built again for
    each block, which costs about as much as searching half a block)."""
    good = rows.where(_usable(F.col("v")) & F.col("id").isNotNull()).select("id", "v")
    # Of each direction's members the k + 1 smallest ids: what any answer can need.
    once = lambda x, body: F.transform(F.array(x), body)[0]  # noqa: E731  x is computed once a row, not once an element
    num = lambda e: e.cast("double")
    length = lambda b: F.sqrt(F.aggregate("v", F.lit(0.0), lambda t, e: t + (num(e) / b) * (num(e) / b)))
    rounded = once(F.aggregate("v", F.lit(0.0), lambda t, e: F.greatest(t, F.abs(num(e)))), lambda b: once(
        F.lit(10.0 ** (TIE - 1)) / length(b), lambda g: F.transform("v", lambda e: F.rint(num(e) / b * g).cast("long"))))
    grain = good.select("id", "v", rounded.alias("_w"))
    # A direction goes by two 64-bit hashes of its rounded components.
    named = grain.select("id", "v", F.struct(F.size("v").alias("dim"), F.xxhash64("_w").alias("a"), F.xxhash64(F.lit(1), "_w").alias("b")).alias("way"))
    first = Window.partitionBy("way").orderBy("id")
    nodes = (named.withColumn("i", F.dense_rank().over(first)).where(F.col("i") <= k + 1)
             .groupBy("way").agg(F.array_sort(F.collect_set(F.struct("id", "v"))).alias("of")))
    nodes = stage(nodes.select("way", "of", "way.dim"), "vectors")
    shards = max(1, -(-nodes.count() // shard_rows))
    asked = queries.where(_usable(F.col("v")) & F.col("id").isNotNull()).select("id", "v").distinct().withColumn("dim", F.size("v"))
    blocks = max(1, -(-asked.count() // block_rows))
    dealt = (nodes.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "way"), F.lit(shards)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = (asked.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "id", "v"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(vectors, questions):
        import pandas as pd
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(vectors) and len(questions):
            members = [[(m["id"], np.asarray(m["v"], np.float64)) for m in of] for of in vectors["of"]]
            members.sort(key=lambda of: of[0][0])       # the same graph whatever the order of arrival; rows in the order of smallest ids
            every = unit(np.stack([vec for of in members for _, vec in of]))
            ids = [i for of in members for i, _ in of]
            count = np.array([len(of) for of in members])
            start = np.cumsum(count) - count
            q = np.stack([np.asarray(e, np.float64) for e in questions["v"]])
            found = search_shard(every[start], q, k + 1)
            asker, node = np.nonzero(found >= 0)
            node = found[asker, node]
            # Every member of a node that was found, with its own cosine.
            asker, size = np.repeat(asker, count[node]), count[node]
            row = np.arange(len(asker)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start[node], size)
            who = questions["id"].tolist()
            out = {"query_id": [who[i] for i in asker], "vec_id": [ids[i] for i in row], "score": np.einsum("ij,ij->i", unit(q)[asker], every[row])}
        return pd.DataFrame(out)

    importable(rows.sparkSession)
    parts = 4 * shards * blocks
    of = ["dim", "shard", "block"]
    found = (dealt.repartition(parts, *of).groupBy(*of).cogroup(asked.repartition(parts, *of).groupBy(*of))
             .applyInPandas(run, f"query_id {id_type}, vec_id {id_type}, score double"))
    each = found.where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", TIE)), "vec_id")
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_embeddings(rows: DataFrame, k: int = 5, step: int = QUERY_STEP) -> DataFrame:
    """Nearest neighbours of the rows of ``embeddings`` (vec_id, embedding)
    whose id is divisible by ``step``, among all rows."""
    data = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return nearest(data, data.where(F.col("id") % step == 0), k)
