"""Blocks of vectors that meet in bounded groups."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """Whether an array has at least one component and all of them are finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & (F.size(column) > 0), F.lit(False))


def matrix(column, dtype) -> np.ndarray:
    """Rows of a list column of one length as a matrix."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(flat), -1)


def slot() -> Column:
    """Number of a row, to be settled: places rows that repeat an id in different blocks."""
    return F.monotonically_increasing_id()


def block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), column), F.lit(max(1, blocks))).cast("int")


def n_blocks(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def best(found: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of each query_id with their rank; Spark keeps k per task before the shuffle."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def pass_by(held: DataFrame, passing: DataFrame, keys: Sequence[str], parts: int, prepare: Callable, answer: Callable[..., pa.Table], schema: str, rows: int) -> DataFrame:
    """``answer(prepare(held rows of a key), passing rows of the key)``, at most ``rows`` passing rows at a time.

    Every held row is moved once, to the task of its key. The rows of a key arrive sorted,
    held ones first, so a task holds the held rows of one key and one batch of passing rows,
    however many pass. Keys are whole numbers without nulls.
    """
    both = held.withColumn("_passes", F.lit(0)).unionByName(passing.withColumn("_passes", F.lit(1)), allowMissingColumns=True)
    met = both.repartition(parts, *keys).sortWithinPartitions(*keys, "_passes")

    def run(batches):
        key, kept, ready = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(k).to_numpy() for k in (*keys, "_passes")])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                *now, passes = marks[:, a].tolist()
                if now != key:
                    key, kept, ready = now, [], None
                part = pa.Table.from_batches([batch.slice(a, b - a)])
                if not passes:
                    kept.append(part)
                    continue
                if kept:
                    ready, kept = prepare(pa.concat_tables(kept).combine_chunks()), []
                for i in range(0, len(part) if ready is not None else 0, rows):
                    yield from answer(ready, part.slice(i, rows)).to_batches()

    return met.mapInArrow(run, schema)
