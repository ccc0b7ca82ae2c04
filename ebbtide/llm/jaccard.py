"""Exact Jaccard self-join of shingle sets, size-aware: light sets by subsets, heavy ones by lists.

Two sets with J >= 3/4 share at least ceil(3n/4) of the n shingles of either. So

* a document is out when fewer than ceil(3n/4) of its shingles occur in any other
  row; a bitmap over all shingles (a count-min row saturated at two) overestimates
  that number, so nobody is lost;
* with shingles in one global order, rare ones first, linked sets share a shingle
  among their first n - ceil(3n/4) + 1 (heavy: an inverted list per shingle), and a
  pair of shingles among one more (light: a list per enumerated 2-subset).

The boundary between light and heavy is the size with the smallest expected cost.
Equal sets are one node, so copies never meet. Candidates are verified in three steps:
every node against the most central node of each of its lists; then, after connected
components, nodes of lists that still hold several components against a few more
central ones; then all pairs of one list that are still in different components and
whose places in it allow the threshold. A pair inside one component needs no check, so a group of n near copies costs about n checks
per list instead of n*n/2, and no link between components is missed.

Edge cases: null or word-free texts have an empty set and link with nothing; fewer
than five words form one shingle; rows repeating a doc_id are nodes of their own and
share the id; a null doc_id takes part and names a component only if all its ids are null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.components import components
from ebbtide.llm.sketches import allows_two, repeated
from ebbtide.llm.words import U, Runs, hash_words, mix
from ebbtide.llm.names import field
from ebbtide.session import bound_batches, settle

SHINGLE = 5
NUM, DEN = 3, 4  # the threshold 0.75 as a fraction, so that comparisons are exact
MAX_LOG_WIDTH = 30  # bitmap of all shingles: 128 MB at most, however large the corpus
LOG_LEVELS = 22  # cells of the sketch that tells how common a shingle is (4 MB)
COMMON = 32  # a cell below this count is not common
HUBS = 8  # central nodes of a list that a still unlinked node is checked against before the full pass
LIGHT_MAX = 24  # sizes tried as boundary between light and heavy
LIST_COST = 4.0  # expected cost of scanning one inverted list, in keys written
BLOCK = 1024  # nodes of one list that meet another block of it in one group
ROWS = 500


def _need(n):
    return -(-NUM * n // DEN)


def _sets(blobs: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, letters A-Z in lower case."""
    words, bounds = hash_words(blobs, lower=True)
    runs, out = Runs(words), []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi == lo:
            out.append(np.zeros(0, U))
        else:
            width = min(SHINGLE, hi - lo)
            out.append(np.unique(runs.hash(np.arange(lo, hi - width + 1), width)))
    return out


def _node(shingles: np.ndarray) -> int:
    """64-bit name of a set; equal sets have equal names."""
    if not len(shingles):
        return 0
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(shingles ^ U(0x8BB84B93962EACC9)).sum() ^ U(len(shingles))], U)).view(np.int64)[0])


def _sliced(batches, rows: int = ROWS):
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _texts(batch) -> list:
    return batch.column("_text").to_pylist()


def shingle_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node) of every row of (_doc, _text)."""

    def run(batches):
        for batch in _sliced(batches):
            sets = _sets(_texts(batch))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("_doc"), "n": pa.array([len(s) for s in sets], pa.int64()), "node": pa.array([_node(s) for s in sets], pa.int64()),
            })

    return docs.mapInArrow(run, "doc_id long, n long, node long")


def _candidate_sets(docs: DataFrame, tokens: int) -> DataFrame:
    """(node, n, shingles, maybe): sets of which enough shingles may occur elsewhere, with the flags of those."""
    log_width = min(MAX_LOG_WIDTH, max(20, math.ceil(math.log2(2 * tokens + 1))))
    bits = docs.sparkSession.sparkContext.broadcast(repeated(docs, lambda batch: (np.concatenate(_sets(_texts(b)) or [np.zeros(0, U)]) for b in _sliced([batch])), 1, log_width))

    def run(batches):
        for batch in _sliced(batches):
            rows = []
            for s in _sets(_texts(batch)):
                if not len(s):
                    continue
                maybe = allows_two(bits.value, s)
                if maybe.sum() >= _need(len(s)):
                    rows.append((_node(s), len(s), s.tobytes(), np.packbits(maybe).tobytes()))
            node, n, sets, flags = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({"node": pa.array(node, pa.int64()), "n": pa.array(n, pa.int64()), "shingles": pa.array(sets, pa.binary()), "maybe": pa.array(flags, pa.binary())})

    sets = settle(docs.mapInArrow(run, "node long, n long, shingles binary, maybe binary"))
    bits.destroy()
    return sets


def _levels(sets: DataFrame) -> np.ndarray:
    """How common a shingle's cell is among the candidate sets: the logarithm of its count, 0 below COMMON."""

    def count(batches):
        for batch in _sliced(batches, 10000):
            data = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), U)
            cell, n = np.unique((data >> U(64 - LOG_LEVELS)).astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cell), "n": pa.array(n)})

    total = sets.select("shingles").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    out = np.zeros(1 << LOG_LEVELS, np.uint8)
    for r in total.toLocalIterator():
        out[r["cell"]] = min(255, int(math.log2(r["n"])))
    return out


def light_boundary(sizes: DataFrame) -> int:
    """Largest size whose sets are joined by subsets: the one of least expected cost."""
    count = {r["n"]: r["count"] for r in sizes.where(F.col("n").between(1, LIGHT_MAX)).groupBy("n").count().collect()}

    def cost(bound: int) -> float:
        total = 0.0
        for n, k in count.items():
            if n <= bound:
                total += k * math.comb(n - _need(n) + 2, 2)
            if n > bound or n >= _need(bound + 1):
                total += k * (n - _need(n) + 1) * (1 + LIST_COST)
        return total

    return min(range(2, LIGHT_MAX + 1), key=lambda x: (cost(x), x))


def _keys(sets: DataFrame, levels, bound: int) -> DataFrame:
    """(key, node, n, pos, rank): inverted lists of single shingles and of 2-subsets.

    ``pos`` is the place of the (first) shingle in the set's order. ``rank`` is small for
    central nodes, which have few shingles of their own.
    """

    def run(batches):
        for batch in _sliced(batches):
            keys, places, counts, own_rows = [], [], [], []
            for r in batch.to_pylist():
                s, n = np.frombuffer(r["shingles"], U), r["n"]
                maybe = np.unpackbits(np.frombuffer(r["maybe"], np.uint8))[:n].astype(bool)
                own = s[maybe]
                order = np.lexsort((own, levels.value[own >> U(64 - LOG_LEVELS)]))
                own, alone = own[order], n - int(maybe.sum())  # shingles that occur nowhere else come first
                if n > bound or n >= _need(bound + 1):
                    keys.append(own[: max(0, n - _need(n) + 1 - alone)])
                    places.append(alone + np.arange(len(keys[-1])))
                if n <= bound:
                    head = own[: max(0, n - _need(n) + 2 - alone)]
                    i, j = np.triu_indices(len(head), 1)
                    keys.append(mix(np.minimum(head[i], head[j]) * U(3) + mix(np.maximum(head[i], head[j]))))
                    places.append(alone + i)
                counts.append(sum(map(len, keys)))
                own_rows.append((r["node"], n, ((alone << 14) // n << 48) | (r["node"] >> 16 & (1 << 48) - 1)))
            if own_rows:
                times = np.diff(counts, prepend=0)
                node, n, rank = (np.repeat(np.array(x, np.int64), times) for x in zip(*own_rows, strict=True))
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(np.concatenate(keys).view(np.int64)), "node": pa.array(node), "n": pa.array(n.astype(np.int32)),
                    "pos": pa.array(np.concatenate(places).astype(np.int32)), "rank": pa.array(rank),
                })

    return sets.mapInArrow(run, "key long, node long, n int, pos int, rank long")


def _may_link(n, pos, m, at):
    """Whether two sets whose first common shingle stands at these places can still reach the threshold."""
    return (NUM + DEN) * np.minimum(n - pos, m - at) >= NUM * (n + m)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")

    def run(batches):
        for batch in _sliced(batches):
            a, b = [], []
            for x, y, sx, sy in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sa", "sb")), strict=True):
                x_set, y_set = np.frombuffer(sx, U), np.frombuffer(sy, U)
                joined = np.concatenate([x_set, y_set])
                joined.sort()
                common = int((joined[1:] == joined[:-1]).sum())
                if DEN * common >= NUM * (len(joined) - common):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _across(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of one list (key, node, n, pos, part) in different parts that can reach the threshold.

    A pair that does has a first common shingle, and passes the test on sizes and
    places in that shingle's list.

    A list of more than BLOCK nodes is cut into blocks, and every two blocks meet in a
    partition row range of their own; the rows stream through, one such range at a time.
    """
    many = lists.groupBy("key").agg(F.count("*").alias("_m"))
    cut = lists.join(many, "key").withColumn("_k", F.ceil(F.col("_m") / BLOCK).cast("int")).withColumn("_own", F.expr("cast(pmod(xxhash64(node), _k) as int)"))
    met = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    met = met.select("key", F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"), "_own", "node", "n", "pos", "part")

    def pairs(group: np.ndarray):
        lo, hi, own, node, n, pos, part = group.T
        a_side = own == lo[0]
        b_side = own == hi[0]
        ia, ib = np.flatnonzero(a_side), np.flatnonzero(b_side)
        for i in ia:
            ok = (part[ib] != part[i]) & _may_link(n[ib], pos[ib], n[i], pos[i])
            if lo[0] == hi[0]:
                ok &= node[ib] > node[i]
            j = ib[ok]
            if len(j):
                yield np.minimum(node[j], node[i]), np.maximum(node[j], node[i])

    def run(batches):
        rest = None
        def done(table):
            found = list(pairs(table))
            if found:
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate([x for x, _ in found])), "b": pa.array(np.concatenate([y for _, y in found]))})

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "_lo", "_hi", "_own", "node", "n", "pos", "part")], axis=1)
            rows = rows if rest is None else np.concatenate([rest, rows])
            if not len(rows):
                continue
            edge = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            cuts = [0, *edge.tolist()]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                yield from done(rows[i:j, 1:])
            rest = rows[cuts[-1] :]
        if rest is not None and len(rest):
            yield from done(rest[:, 1:])

    dealt = met.repartition("key", "_lo", "_hi").sortWithinPartitions("key", "_lo", "_hi")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _apart(lists: DataFrame, parts: DataFrame) -> DataFrame:
    """The lists, with each node's part, that hold nodes of more than one part."""
    labelled = lists.join(parts.select(F.col("a").alias("node"), F.col("b").alias("part")), "node", "left").withColumn("part", F.coalesce("part", "node"))
    several = labelled.groupBy("key").agg(F.min("part").alias("_x"), F.max("part").alias("_y")).where("_x < _y").select("key")
    return labelled.join(several, "key", "left_semi")


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(schema))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id."""
    spark = docs.sparkSession
    bound_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("binary").alias("_text"))
    texts = base.select("_text")
    sizes = settle(shingle_sizes(base))
    tokens = sizes.agg(F.sum("n")).first()[0] or 0
    labels = _empty(spark, "node long, comp long")
    if tokens:
        sets = _candidate_sets(texts, tokens)
        levels = spark.sparkContext.broadcast(_levels(sets))
        keys = settle(_keys(sets, levels, light_boundary(sizes)))
        levels.destroy()
        sets = sets.select("node", "n", "shingles").dropDuplicates(["node"])
        hubs = keys.groupBy("key").agg(F.min_by("node", "rank").alias("hub"), F.min_by("n", "rank").alias("hub_n"), F.min_by("pos", "rank").alias("hub_pos"), F.min("node").alias("_x"), F.max("node").alias("_y"))
        lists = settle(keys.join(hubs.where("_x < _y").drop("_x", "_y"), "key").dropDuplicates(["key", "node"]))
        fits = (NUM + DEN) * F.least(F.col("n") - F.col("pos"), F.col("hub_n") - F.col("hub_pos")) >= NUM * (F.col("n") + F.col("hub_n"))
        pair = [F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")]
        first = lists.where((F.col("node") != F.col("hub")) & fits).select(*pair).distinct()
        needed = settle(sets.join(lists.select("node").distinct(), "node", "left_semi"))
        linked = settle(_verified(first, needed))
        lists, parts = lists.drop("hub", "hub_n", "hub_pos"), components(linked)
        # Nodes still apart from their lists' central nodes are checked against a few of these ...
        rest = settle(_apart(lists, parts))
        central = F.row_number().over(Window.partitionBy("key").orderBy("rank", "node"))
        heads = rest.withColumn("_place", central).where(F.col("_place") <= HUBS).select("key", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("pos").alias("hub_pos"), F.col("part").alias("hub_part"))
        again = rest.join(heads, "key").where((F.col("part") != F.col("hub_part")) & fits).select(*pair).distinct()
        linked = settle(linked.unionByName(_verified(again, needed)))
        # ... and what remains apart meets in full.
        rest = settle(_across(_apart(lists, components(linked))))
        linked = linked.unionByName(_verified(rest, needed))
        labels = components(linked).select(F.col("a").alias("node"), F.col("b").alias("comp"))
    filled = sizes.where("n > 0")
    members = filled.groupBy("node").agg(F.min("doc_id").alias("_least")).join(labels, "node", "left").select("node", "_least", F.coalesce("comp", "node").alias("comp"))
    heads = members.groupBy("comp").agg(F.min("_least").alias("component_id"))
    named = members.join(heads, "comp").select("node", "component_id")
    alone = sizes.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return filled.join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their component, and those without an id; the caller's columns as they are."""
    heads = similar_documents(docs, id_col, text_col).where("doc_id = component_id").select(F.col("doc_id").alias("_head")).distinct()
    rows = docs.select(F.struct(*[field(c) for c in docs.columns]).alias("_row"), F.col(id_col).cast("long").alias("_doc"))
    kept = rows.join(heads, F.col("_doc") == F.col("_head"), "left_semi").unionByName(rows.where("_doc IS NULL"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
