"""Nearest neighbours by an inverted multi-index.

Both halves of a vector are quantised by codebooks of their own; a vector's cell is
the pair of its nearest centroids. A query walks the pairs in order of summed
distance with a heap, until the cells it has visited hold ``SHARE`` of all rows (and at
least ``LEAST``), then all vectors of those cells are ranked by exact distance.

The codebooks are fitted by Lloyd steps on the ``SAMPLE`` rows with the smallest hash;
every row is indexed. Neighbouring cells share a block of entries, and a cell with more
rows than a block is cut. Each entry is moved once, to the task that holds its block;
queries go only to blocks that hold a cell they visit and pass by in batches. What is
moved grows with the rows plus the visits, and no task holds more than one block.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components
take no part; only the most frequent length is indexed by halves, and vectors of other
lengths meet those of their own length in one cell; repeated rows are entries of their
own; a query with fewer candidates than asked for gets them all.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.vectors import best, finite, matrix, n_blocks, pass_by, slot
from ebbtide.session import settle

CENTROIDS = 64  # per half
SAMPLE = 8192  # rows the codebooks are fitted on
LLOYD = 12
SHARE, LEAST = 0.5, 400  # of all rows; rows
ENTRIES = 4096  # rows of a block
QUERIES = 512  # rows that pass a block at a time


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(axis=1)[None, :] - 2 * x @ centroids.T).argmin(axis=1)


def codebook(x: np.ndarray, size: int) -> np.ndarray:
    """Centroids by Lloyd steps, started from spread-out rows."""
    rng = np.random.default_rng(42)
    x = np.unique(x, axis=0)
    if len(x) <= size:
        return x
    centroids = x[rng.choice(len(x), size, replace=False)]
    for _ in range(LLOYD):
        own = _nearest(x, centroids)
        for c in range(size):
            if (own == c).any():
                centroids[c] = x[own == c].mean(axis=0)
    return centroids


def walk(query: np.ndarray, books: tuple[np.ndarray, np.ndarray], held: np.ndarray, enough: int) -> list[int]:
    """Cells in order of summed centroid distance until they hold ``enough`` rows."""
    half = books[0].shape[1]
    dist = [((b - q) ** 2).sum(axis=1) for b, q in zip(books, (query[:half], query[half:]), strict=True)]
    order = [np.argsort(d, kind="stable") for d in dist]
    a, b = (d[o] for d, o in zip(dist, order, strict=True))
    heap, seen, cells, got = [(a[0] + b[0], 0, 0)], {(0, 0)}, [], 0
    while heap and got < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(order[0][i]) * len(b) + int(order[1][j])
        if held[cell]:
            cells.append(cell)
            got += int(held[cell])
        for n in ((i + 1, j), (i, j + 1)):
            if n[0] < len(a) and n[1] < len(b) and n not in seen:
                seen.add(n)
                heapq.heappush(heap, (a[n[0]] + b[n[1]], *n))
    return cells


def entry_blocks(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every cell: small cells share one, large ones are cut."""
    first, parts = np.zeros(len(held), np.int64), np.ones(len(held), np.int64)
    block = free = 0
    for c in np.flatnonzero(held).tolist():
        if held[c] > free:
            block, free = block + 1, ENTRIES
        first[c], parts[c] = block, max(1, -(-held[c] // ENTRIES))
        block += int(parts[c]) - 1
        free = free - held[c] if parts[c] == 1 else 0
    return first, parts


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): nearest found by Euclidean distance for queries with id divisible by ``every``."""
    spark = vectors.sparkSession
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id IS NOT NULL").where(finite("v"))
    base = settle(base.where(F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")).withColumn("_slot", slot()))
    common = base.groupBy("dim").count().orderBy(F.col("count").desc(), "dim").limit(1).collect()
    dim = common[0]["dim"] if common else 0

    def fit(table: pa.Table) -> pa.Table:
        x = matrix(table.sort_by("id")["v"], np.float64)
        half = x.shape[1] // 2
        return pa.table({"model": pa.array([pickle.dumps((codebook(x[:, :half], CENTROIDS) if half else np.zeros((1, 0)), codebook(x[:, half:], CENTROIDS)))], pa.binary())})

    sample = base.where(F.col("dim") == dim).orderBy(F.xxhash64(F.lit("fit"), "id"), "id").limit(SAMPLE)
    model = sample.withColumn("_one", F.lit(1)).groupBy("_one").applyInArrow(fit, "model binary").collect()
    books = pickle.loads(model[0]["model"]) if model else (np.zeros((1, 0)), np.zeros((1, 0)))
    shared = spark.sparkContext.broadcast(books)  # 2 * CENTROIDS half vectors

    def assign(batches):
        one, two = shared.value
        for batch in batches:
            cell = np.full(batch.num_rows, -1, np.int64)
            own = np.flatnonzero(batch.column("dim").to_numpy() == dim)
            if len(own):
                x = matrix(batch.column("v").take(pa.array(own)), np.float64)
                half = one.shape[1]
                cell[own] = _nearest(x[:, :half], one) * len(two) + _nearest(x[:, half:], two)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    index = settle(base.mapInArrow(assign, "id long, v array<double>, dim int, _slot long, cell long"))
    counts = index.groupBy("dim", "cell").count()
    held = np.zeros(len(books[0]) * len(books[1]), np.int64)
    for r in counts.where(F.col("dim") == dim).collect():  # at most CENTROIDS ** 2 cells
        held[r["cell"]] = r["count"]
    enough = max(LEAST, int(share * held.sum()), k + 1)
    first, parts = entry_blocks(held)
    shared_cells = spark.sparkContext.broadcast((held, first, parts))
    asked = index.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("_q")).select("id", "_q.*")

    def visit(batches):
        held, first, parts = shared_cells.value
        for batch in batches:
            rows = []
            for v in batch.column("v").to_pylist():
                cells = np.array(walk(np.array(v), shared.value, held, enough))
                seen = np.zeros(len(held), bool)
                seen[cells] = True
                blocks = np.unique(np.concatenate([np.arange(first[c], first[c] + parts[c]) for c in cells.tolist()]))
                rows.append((np.packbits(seen).tobytes(), blocks.tolist()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("id", "v", "dim")], pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                names=["id", "v", "dim", "seen", "_c"])

    common_visits = asked.where(F.col("dim") == dim).mapInArrow(visit, "id long, v array<double>, dim int, seen binary, _c array<long>").withColumn("_c", F.explode("_c"))
    others = counts.where(F.col("dim") != dim).select("dim", F.ceil(F.col("count") / ENTRIES).alias("_parts"))
    odd_visits = asked.where(F.col("dim") != dim).withColumn("seen", F.lit(None).cast("binary")).join(others, "dim").withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    # Entries go to their cell's block; a cell of more than ENTRIES rows has several.
    cells = spark.createDataFrame([(c, int(first[c]), int(parts[c])) for c in np.flatnonzero(held).tolist()], "cell long, _first long, _parts long")
    place = F.pmod(F.xxhash64(F.lit("block"), "_slot"), F.col("_parts"))
    common_rows = index.where(F.col("dim") == dim).join(F.broadcast(cells), "cell").withColumn("_c", F.col("_first") + place).drop("_first", "_parts")
    odd_rows = index.where(F.col("dim") != dim).join(others, "dim").withColumn("_c", place).drop("_parts")
    entries = common_rows.unionByName(odd_rows).drop("_slot")

    def prepare(rows: pa.Table):
        return matrix(rows["v"], np.float64), rows["id"].to_numpy(), rows["cell"].to_numpy()

    def answer(block, asking: pa.Table) -> pa.Table:
        x, ids, cell = block
        query, cand, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for q, qid, seen in zip(matrix(asking["v"], np.float64), asking["id"].to_numpy().tolist(), asking["seen"].to_pylist(), strict=True):
            mine = ids != qid
            if seen is not None:
                mine &= np.unpackbits(np.frombuffer(seen, np.uint8))[cell] == 1
            other = np.flatnonzero(mine)
            d = np.sqrt(((x[other] - q) ** 2).sum(axis=1))
            if len(d) > k:
                near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                other, d = other[near], d[near]
            top = np.lexsort((ids[other], d))[:k]
            query.append(np.full(len(top), qid, np.int64))
            cand.append(ids[other[top]])
            score.append(d[top])
        return pa.table({"query_id": np.concatenate(query), "vec_id": np.concatenate(cand), "score": np.concatenate(score)})

    visits = common_visits.unionByName(odd_visits)
    # Twice as many partitions as blocks, so that few tasks hold several blocks.
    partitions = 2 * (n_blocks(index.count(), ENTRIES) + 1)
    found = pass_by(entries, visits, ["dim", "_c"], partitions, prepare, answer, "query_id long, vec_id long, score double", QUERIES)
    return best(found, k, F.col("score"), F.col("vec_id")).select("query_id", "rank", "vec_id", "score")
