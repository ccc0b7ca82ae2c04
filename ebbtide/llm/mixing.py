"""Mixing sources to target weights by subset-sum budget fitting.

Targets share the total size by weight; a source never gives more than ``MAX_REPEAT``
times its size, and the excess is reshared by weight. A source gives every document
as many whole copies as fit; the remaining budget is met by one more copy of some
documents: documents are counted by exact length, every length first gives its
proportional share, the longest lengths that still fit close most of the gap, and a
bounded-knapsack table over the remaining lengths hits the last ``EXACT`` words or less. Which
documents of a length are taken follows from a seeded hash of the id and text.

Edge cases: a null text has size 0; a document without words is never taken; a null
source is one source, last in order; an empty table gives no rows; equal rows share a
hash, and ties within it are resolved by counting them together with their id, so
reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.names import field
from ebbtide.session import settle

WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
MAX_REPEAT = 3
EXACT = 1 << 16  # words of the budget that the knapsack table covers
SLICES = 256  # hash ranges by which documents of one length are counted
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text) -> F.Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(seed: int, id_col: str, text_col: str) -> F.Column:
    """Order in which the documents of a length are chosen."""
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) with its target: water filling in one pass over ordered ratios.

    A source is capped when the level that the sources after it can still share is not
    below its cap per weight; caps per weight grow along the order, so the capped ones
    come first. One row per source, so the windows without a key hold sources only.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * repeat
    every = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    rows = sources.withColumn("_rank", rank).withColumn("_w", w).withColumn("_cap", cap).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    rows = rows.withColumn("_total", F.sum(F.col("source_size")).over(Window.partitionBy()).cast("double")).withColumn("_weight", F.sum("_w").over(Window.partitionBy()))
    rows = rows.withColumn("_used", F.coalesce(F.sum("_cap").over(every), F.lit(0.0))).withColumn("_gone", F.coalesce(F.sum("_w").over(every), F.lit(0.0)))
    rows = rows.withColumn("_level", (F.col("_total") - F.col("_used")) / (F.col("_weight") - F.col("_gone")))
    rows = rows.withColumn("_capped", F.col("_ratio") <= F.col("_level"))
    # The level of the first source that isn't capped holds for all that aren't.
    level = F.min(F.when(~F.col("_capped"), F.struct("_ratio", "_rank", "_level"))).over(Window.partitionBy())["_level"]
    return rows.withColumn("target", F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_w") * level)).select("source", "source_size", "target")


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, exact: int = EXACT) -> np.ndarray:
    """How many documents of each length to take so that the sum comes closest to ``budget`` from below or hits it."""
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.copy()
    order = np.argsort(-lengths)
    # Each length's proportional share, less what the table needs to choose from.
    take = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    rest = budget - int((take * lengths).sum())
    for i in order.tolist():
        if rest <= exact:
            break
        n = min(int(counts[i] - take[i]), (rest - exact) // int(lengths[i]) if lengths[i] else 0)
        take[i] += max(n, 0)
        rest -= max(n, 0) * int(lengths[i])
    for i in order.tolist():  # lengths above the table's size may still fit once
        while rest > exact and lengths[i] and lengths[i] <= rest and take[i] < counts[i]:
            take[i] += 1
            rest -= int(lengths[i])
    # Bounded knapsack on the rest: counts as powers of two, reachable sums as bits.
    reach, via = 1, np.full(rest + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    mask = (1 << (rest + 1)) - 1
    for i in order[::-1].tolist():
        size, free, k = int(lengths[i]), int(counts[i] - take[i]), 1
        if size == 0 or size > rest:
            continue
        free = min(free, rest // size)
        while free > 0:
            k = min(k, free)
            new = (reach << (k * size)) & mask & ~reach
            if new:
                bits = np.frombuffer(new.to_bytes(rest // 8 + 1, "little"), np.uint8)
                via[np.flatnonzero(np.unpackbits(bits, bitorder="little", count=rest + 1))] = len(items)
                reach |= new
            items.append((i, k))
            free, k = free - k, 2 * k
        if reach >> rest & 1:
            break
    best = reach.bit_length() - 1
    while best:
        i, k = items[via[best]]
        take[i] += k
        best -= k * int(lengths[i])
    return take


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies (how often it is taken) and taken (words)."""
    base = settle(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"),
        row_hash(seed, id_col, text_col).alias("_hash"),
    ).withColumn("_slice", F.pmod("_hash", F.lit(SLICES)).cast("int")))
    # Counts by source, length and hash range: enough to rank without gathering a source.
    slices = settle(base.groupBy("source", "size", "_slice").agg(F.count("*").alias("n")))
    lengths = slices.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes)

    def fit(table: pa.Table) -> pa.Table:
        length, n = table["size"].to_numpy().astype(np.int64), table["n"].to_numpy().astype(np.int64)
        size, target = int(table["source_size"][0].as_py()), float(table["target"][0].as_py())
        whole = min(MAX_REPEAT, int(target // size)) if size else 0
        budget = 0 if not size or whole == MAX_REPEAT else max(0, round(target - whole * size))
        words = length > 0  # nothing is taken from a document without words
        more = np.where(words, fit_counts(length, n, budget), 0)
        return pa.table({"source": table["source"], "size": table["size"], "_whole": pa.array(np.where(words, whole, 0)), "_more": pa.array(more)})

    chosen = settle(_same(lengths, targets, ["source"]).groupBy("source").applyInArrow(fit, "source string, size long, _whole long, _more long"))
    # Per hash range: taken whole, not at all, or in part; only the range at the edge is ranked.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("n"), F.col("_more") - F.col("_before")))
    plan = _same(slices.withColumn("_before", before), chosen, ["source", "size"]).withColumn("_part", part)
    plan = plan.where("_whole > 0 OR _part > 0").select("source", "size", "_slice", "_whole", "_part", "n")
    rows = _same(base, plan, ["source", "size", "_slice"], "left").withColumn("_whole", F.coalesce("_whole", F.lit(0)))
    rows = rows.withColumn("_extra", F.when(F.col("_part") == F.col("n"), 1).when(F.coalesce("_part", F.lit(0)) == 0, 0))
    sure = rows.where("_extra IS NOT NULL").withColumn("copies", F.col("_whole") + F.col("_extra"))
    edge = rows.where("_extra IS NULL")
    place = F.row_number().over(Window.partitionBy("source", "size", "_slice").orderBy("_hash", "doc_id"))
    edge = edge.withColumn("copies", F.col("_whole") + F.when(place <= F.col("_part"), 1).otherwise(0))
    taken = sure.select("doc_id", "source", "size", "copies", "_hash").unionByName(edge.select("doc_id", "source", "size", "copies", "_hash"))
    full = _same(taken, targets, ["source"])
    return full.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "_hash")


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null equal to null; the keys stay once."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(other, on, how).drop(*[f"_r_{k}" for k in keys])


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; equal rows share their copies."""
    copies = mix(docs, id_col, text_col, source_col, seed).groupBy("_hash").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    rows = docs.select(F.struct(*[field(c) for c in docs.columns]).alias("_row"), row_hash(seed, id_col, text_col).alias("_hash")).join(copies.where("_copies > 0"), "_hash")
    place = F.row_number().over(Window.partitionBy("_hash").orderBy("_hash")) - 1
    share = F.expr("cast(_copies div _rows as int)") + F.when(place < F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    rows = rows.withColumn("_times", share).where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
