"""Exact top-k search by columnar branch and bound.

Candidates are stored dimension by dimension (vertical layout). A query adds up its
products one block of dimensions at a time; after each block a candidate's final
score lies within the norms of what remains of both vectors (Cauchy-Schwarz), so
candidates whose upper bound is below the k-th best lower bound are dropped and the
survivors compacted before the next block.

Candidates are cut into blocks of bounded size. Each candidate is moved once, to the task
that holds its block; the queries pass by every block in batches. A block returns at most
k rows per query, and the best k of all are kept per query. What is moved grows with the
rows plus queries times candidate blocks, and no task holds more than one block.

Edge cases: vectors that are null, empty or hold null or non-finite components take
no part; vectors meet only vectors of their own length; equal vectors and rows that
repeat a vec_id are candidates of their own, spread over the blocks (a query's own rows
are those with its vec_id); each row with the id of a query is asked once per id, by its smallest vector.
Blocks whose scores could pass 2**52 are added up in Python's integers and not pruned,
as floating bounds would not hold there; a returned score beyond 64 bits is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.vectors import best, block, finite, matrix, n_blocks, pass_by, slot
from ebbtide.session import settle

CANDIDATES = 8192  # rows of a block
QUERIES = 512  # rows that pass a block at a time
DIMS = 8  # dimensions added between two prunings
EXACT = 2.0**52  # scores up to which floating bounds are exact


class Block:
    """Candidates dimension by dimension, heavy dimensions first, and the norms of what remains of them."""

    def __init__(self, vertical: np.ndarray, ids: np.ndarray):
        self.ids, dims = ids, len(vertical)
        self.order = np.argsort(-np.abs(vertical.astype(np.float64)).mean(axis=1), kind="stable")
        self.vertical = vertical[self.order]
        self.cuts = list(range(0, dims, DIMS)) + [dims]
        square = self.vertical.astype(np.float64) ** 2
        # Norm of what remains of each candidate after each block of dimensions, rounded up.
        self.rest = np.sqrt(np.stack([square[c:].sum(axis=0) for c in self.cuts])) * (1 + 1e-9) + 1e-9

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int):
        """(query id, candidate ids, scores) of the best k candidates of each query."""
        vertical, ids, rest, cuts = self.vertical, self.ids, self.rest, self.cuts
        queries, n = queries[:, self.order], len(ids)
        # All sums lie within the product of the norms.
        large = len(queries) and n and np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1).max()) * rest[0].max() >= EXACT
        if large:
            vertical, queries = vertical.astype(object), queries.astype(object)
        for q, qid in zip(queries, query_ids.tolist(), strict=True):
            alive = np.flatnonzero(ids != qid)
            score = np.zeros(len(alive), object if large else np.int64)
            for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True), 1):
                part = vertical[lo:hi] if len(alive) == n else vertical[lo:hi, alive]
                for d in range(hi - lo):
                    score += q[lo + d] * part[d]
                if hi == cuts[-1] or len(alive) <= k or large:
                    continue
                slack = np.sqrt((q[hi:].astype(np.float64) ** 2).sum()) * (1 + 1e-9) * rest[b, alive]
                low = score - slack
                bar = np.partition(low, len(low) - k)[len(low) - k]
                keep = score + slack >= bar
                alive, score = alive[keep], score[keep]
            top = np.lexsort((ids[alive], -score))[:k]
            if large and any(not -(2**63) <= x < 2**63 for x in score[top]):
                raise OverflowError(f"a score of query {qid} does not fit in 64 bits")
            yield qid, ids[alive[top]], score[top].astype(np.int64)


def _search(vertical: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    return Block(vertical, ids).search(queries, query_ids, k)


def placed(vectors: DataFrame, every: int, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, DataFrame, int]:
    """Candidates with their block, queries once per block, and the number of blocks."""
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id IS NOT NULL").where(finite("v"))
    base = settle(base.select("id", F.transform("v", lambda x: F.floor(x * 256).cast("long")).alias("v"), F.size("v").alias("dim"), slot().alias("_slot")))
    blocks = n_blocks(base.count(), CANDIDATES)
    asked = base.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("_q")).select("id", "_q.dim", "_q.v")
    held = base.withColumn("_c", block("_slot", blocks)).drop("_slot")
    return held, asked.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), blocks


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): best inner products of floor(256 * x) for queries with id divisible by ``every``."""
    held, asked, blocks = placed(vectors, every, id_col, vec_col)

    def prepare(rows: pa.Table) -> Block:
        return Block(np.ascontiguousarray(matrix(rows["v"], np.int64).T), rows["id"].to_numpy())

    def answer(candidates: Block, queries: pa.Table) -> pa.Table:
        found = list(candidates.search(matrix(queries["v"], np.int64), queries["id"].to_numpy(), k))
        flat = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
        return pa.table({"query_id": flat(np.full(len(c), q, np.int64) for q, c, _ in found), "vec_id": flat(c for _, c, _ in found), "score": flat(s for *_, s in found)})

    # Twice as many partitions as blocks, so that few tasks hold several blocks.
    found = pass_by(held, asked, ["dim", "_c"], 2 * blocks, prepare, answer, "query_id long, vec_id long, score long", QUERIES)
    return best(found, k, F.col("score").desc(), F.col("vec_id")).select("query_id", "rank", "vec_id", "score")
