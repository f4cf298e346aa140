"""Exact top-k inner products, by descending length with pruned partial sums.

Vectors become integers (``floor(scale * x)``). They are range-partitioned by
descending length into chunks (ties spread by a hash, so a vector that a
third of the rows hold fills many chunks evenly). The Gram matrix, summed by
Spark (dimension squared numbers, whatever the number of rows), gives the
rotation to singular directions; in it the first ``head`` coordinates carry
most of a product.

First the queries meet the chunk of the longest vectors: their k-th best
score there is a threshold that any answer must reach, and the threshold over
|q| is the least length that a vector needs. Queries are put into blocks by
that length, and a block meets only the chunks whose longest vector has it:
of all other pairs no row is shuffled. The pairs that are left are one group
each, and skip

* the rest of a chunk, once |q| |v| is below the threshold (v by descending
  length),
* single vectors whose partial sum over the first coordinates plus the
  product of the residual lengths (Cauchy-Schwarz) is below it.

What is left is scored exactly with integers. Only each pair's k best reach
the final ranking, so a query's rows are k per chunk at most. Nothing is
broadcast but the rotation.

Defined cases: null vectors, vectors with null or non-finite components and
null ids take no part; shorter vectors are padded with zeros; a row is no
candidate for a query of its own id; repeated rows are separate candidates;
of repeated query ids the smallest vector asks; ties go to the smaller id;
with fewer candidates than k all are returned; no rows give no rows. Scores
are exact while sums of products stay below 2^53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SCALE = 256
CHUNK, BLOCK = 8192, 2048
HEAD = 16
#: Vectors compared at a time within a chunk.
STEP = 2048


def integer_vectors(table: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``v`` (integers) and ``length`` (squared) of valid rows."""
    x = F.col(vector)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    v = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long"))
    rows = table.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine).select("vec_id", v.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e)
    return rows.withColumn("length", square)


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of integers as rows, padded with zeros."""
    a = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat, cut = a.values.to_numpy(zero_copy_only=False), a.offsets.to_numpy()
    size = np.diff(cut)
    if len(size) and (size == width).all():
        return flat[cut[0]:cut[-1]].reshape(-1, width)
    out = np.zeros((len(size), width), dtype=np.int64)
    for i, (s, n) in enumerate(zip(cut, size)):
        out[i, :n] = flat[s:s + n]
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Columns: the singular directions of all vectors, strongest first."""
    def run(batches):
        total = np.zeros((width, width))
        for b in batches:
            m = matrix(b.column("v"), width).astype(np.float64)
            total += m.T @ m
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (i.astype(np.int32), j.astype(np.int32), total)], names=["i", "j", "s"])

    sums = vectors.select("v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    gram = np.zeros((width, width))
    for i, j, s in sums.collect():  # width squared rows
        gram[i, j] = s
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def best_in_chunk(ids: np.ndarray, v: np.ndarray, query_ids: np.ndarray, q: np.ndarray, least: np.ndarray, turn: np.ndarray, k: int, head: int = HEAD) -> list[tuple[int, int, int]]:
    """(query id, id, score): the k best of one chunk for each query, if they
    reach its threshold ``least``."""
    order = np.lexsort((ids, -np.einsum("ij,ij->i", v.astype(np.float64), v.astype(np.float64))))
    ids, v = ids[order], v[order]
    fv, fq = v.astype(np.float64) @ turn, q.astype(np.float64) @ turn
    len_v, len_q = np.linalg.norm(fv, axis=1), np.linalg.norm(fq, axis=1)
    rest_v, rest_q = np.linalg.norm(fv[:, head:], axis=1), np.linalg.norm(fq[:, head:], axis=1)
    slack = 1e-9 * (len_v.max(initial=0) * len_q.max(initial=0)) + 1e-6
    least = least.copy()
    found_id = [np.zeros(0, dtype=np.int64)] * len(q)
    found = [np.zeros(0, dtype=np.int64)] * len(q)
    for at in range(0, len(v), STEP):
        live = np.flatnonzero(len_q * len_v[at] + slack >= least)
        if not len(live):
            break
        part = slice(at, at + STEP)
        bound = fv[part, :head] @ fq[live, :head].T + np.outer(rest_v[part], rest_q[live]) + slack
        for i, n in enumerate(live):
            near = at + np.flatnonzero(bound[:, i] >= least[n])
            near = near[ids[near] != query_ids[n]]
            if not len(near):
                continue
            score = np.concatenate([found[n], v[near] @ q[n]])
            who = np.concatenate([found_id[n], ids[near]])
            top = np.lexsort((who, -score))[:k]
            found_id[n], found[n] = who[top], score[top]
            if len(top) == k:
                least[n] = max(least[n], score[top[-1]])
    return [(int(query_ids[n]), int(i), int(s)) for n in range(len(q)) for i, s in zip(found_id[n], found[n])]


def blocked(queries: DataFrame, blocks: int) -> DataFrame:
    """Queries (``query_id``, ``q``, ``least``: a score that answers reach,
    or null) with ``need``, the squared length that an answer has at least,
    and ``block``: ranges of ascending ``need``."""
    square = F.aggregate("q", F.lit(0.0), lambda a, e: a + e.cast("double") * e)
    least = F.coalesce("least", F.lit(float("-inf")))
    # |q| |v| >= least, with room for rounding; a score of 0 or less needs nothing.
    need = F.when((least > 0) & (square > 0), least * least / square * (1.0 - 1e-9)).when(least > 0, F.lit(float("inf"))).otherwise(0.0)
    rows = queries.withColumns({"least": least, "need": need})
    return rows.repartitionByRange(blocks, "need", F.xxhash64("query_id")).withColumn("block", F.spark_partition_id())


def surviving_pairs(tops: DataFrame, queries: DataFrame) -> DataFrame:
    """(``chunk``, ``block``): the chunks whose longest vector (``top``,
    squared) has the length that some query of the block needs. One row per
    block reaches the driver (a few thousandths of the queries)."""
    needs = sorted((r["need"], r["block"]) for r in queries.groupBy("block").agg(F.min("need").alias("need")).collect())
    listed = F.array(*[F.struct(F.lit(float(n)).alias("need"), F.lit(b).alias("block")) for n, b in needs]) if needs else \
        F.array().cast("array<struct<need:double,block:int>>")
    met = F.filter(listed, lambda x: x["need"] <= F.col("top"))
    return tops.select("chunk", F.explode(met).alias("x")).select("chunk", F.col("x.block").alias("block"))


def top_k(table: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", scale: int = SCALE, chunk: int = CHUNK, block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for every row of
    ``is_query`` the k rows with the largest inner product."""
    rows = cut_lineage(integer_vectors(table, vector, scale), "topk-vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.count_if(is_query).alias("queries")).first()
    width, chunks = max(size["width"] or 0, 1), -(-max(size["n"], 1) // chunk)
    turn = rotation(rows, width)
    # Longest first; equal vectors are spread by a hash of their id.
    laid = rows.repartitionByRange(chunks, F.desc("length"), F.xxhash64("vec_id")).withColumn("chunk", F.spark_partition_id())
    laid = cut_lineage(laid.select("chunk", "vec_id", "v", "length"), "topk-chunks")
    blocks = -(-max(size["queries"], 1) // block)
    asked = cut_lineage(rows.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")), "topk-queries")
    turned = table.sparkSession.sparkContext.broadcast(turn)

    def meet(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if len(vectors) and len(queries):
            out = best_in_chunk(vectors.column("vec_id").to_numpy(), matrix(vectors.column("v"), width), queries.column("query_id").to_numpy(),
                                matrix(queries.column("q"), width), queries.column("least").to_numpy(), turned.value, k, head)
        return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(("query_id", "vec_id", "score"))})

    def search(some: DataFrame, queries: DataFrame, pairs: DataFrame) -> DataFrame:
        each = some.select("chunk", "vec_id", "v").join(pairs, "chunk")
        every = queries.join(pairs, "block")
        return (each.groupBy("chunk", "block").cogroup(every.groupBy("chunk", "block"))
                    .applyInArrow(meet, "query_id long, vec_id long, score long"))

    tops = cut_lineage(laid.groupBy("chunk").agg(F.max("length").alias("top")), "topk-tops")
    longest = tops.agg(F.max_by("chunk", F.struct("top", -F.col("chunk")))).first()[0]
    if longest is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    everywhere = asked.withColumns({"block": F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"), "least": F.lit(float("-inf"))})
    head_pairs = tops.filter(F.col("chunk") == longest).select("chunk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    first = cut_lineage(search(laid.filter(F.col("chunk") == longest), everywhere, head_pairs), "topk-first")
    reached = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("least"))
    armed = cut_lineage(blocked(asked.join(reached, "query_id", "left"), blocks), "topk-blocks")
    pairs = cut_lineage(surviving_pairs(tops.filter(F.col("chunk") != longest), armed), "topk-pairs")
    found = first.unionByName(search(laid, armed.drop("need"), pairs))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
