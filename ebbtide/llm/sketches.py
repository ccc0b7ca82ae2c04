"""Count-min sketches built per task and merged in two levels of groups."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.words import U, mix

LOG_BLOCK = 19
FLUSH = 1 << 20  # hashes that a task holds before it emits them
FAN = 64  # task sketches that one merge reads at most, level by level
_SCHEMA = "_part long, _block int, _once binary, _twice binary"


def cell_of(hashes: np.ndarray, row: int, log_width: int) -> np.ndarray:
    return (mix(hashes + U(0x632BE59BD9B4E019 * (row + 1) % (1 << 64))) >> U(64 - log_width)).astype(np.int64)


def _pack(bits: np.ndarray) -> bytes:
    return zlib.compress(bits.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)


def _emit(hashes: np.ndarray, depth: int, log_width: int) -> Iterator[pa.RecordBatch]:
    block, part = 1 << LOG_BLOCK, TaskContext.get().partitionId()
    for row in range(depth):
        cells = np.sort(cell_of(hashes, row, log_width))
        cuts = np.searchsorted(cells, np.arange(0, (1 << log_width) + 1, block))
        for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if lo == hi:
                continue
            own = cells[lo:hi] - b * block
            once, twice = np.zeros(block, bool), np.zeros(block, bool)
            once[own] = True
            twice[own[1:][own[1:] == own[:-1]]] = True
            yield pa.RecordBatch.from_pydict({
                "_part": pa.array([part], pa.int64()), "_block": pa.array([row * len(cuts[:-1]) + b], pa.int32()),
                "_once": pa.array([_pack(np.packbits(once))], pa.binary()), "_twice": pa.array([_pack(np.packbits(twice))], pa.binary()),
            })


def _merge(table: pa.Table) -> pa.Table:
    once = twice = None
    for a, b in zip(table["_once"].to_pylist(), table["_twice"].to_pylist(), strict=True):
        a, b = _unpack(a), _unpack(b)
        once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
    return pa.table({"_part": table["_part"][:1], "_block": table["_block"][:1], "_once": pa.array([_pack(once)], pa.binary()), "_twice": pa.array([_pack(twice)], pa.binary())})


def repeated(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], depth: int, log_width: int) -> list[np.ndarray]:
    """One bitmap per sketch row: the cells whose count, saturated at two, is two.

    ``hashes`` gives the items of a batch. The result has depth * 2**log_width bits,
    whatever the input: callers bound log_width.
    """

    def count(batches):
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for found in hashes(batch):
                held.append(found)
                size += len(found)
                if size >= FLUSH:
                    yield from _emit(np.concatenate(held), depth, log_width)
                    held, size = [], 0
        if size:
            yield from _emit(np.concatenate(held), depth, log_width)

    level = rows.mapInArrow(count, _SCHEMA)
    tasks = max(1, rows.rdd.getNumPartitions())
    while tasks > 1:
        tasks = -(-tasks // FAN)
        level = level.withColumn("_part", F.col("_part") % tasks).groupBy("_block", "_part").applyInArrow(_merge, _SCHEMA)
    blocks = {r["_block"]: _unpack(r["_twice"]) for r in level.groupBy("_block").applyInArrow(_merge, _SCHEMA).select("_block", "_twice").toLocalIterator()}
    per, empty = 1 << (log_width - LOG_BLOCK), np.zeros(1 << (LOG_BLOCK - 3), np.uint8)
    return [np.concatenate([blocks.get(d * per + b, empty) for b in range(per)]) for d in range(depth)]


def allows_two(bitmaps: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Whether the estimate, the minimum over the sketch's rows, is two or more."""
    log_width = (len(bitmaps[0]) * 8).bit_length() - 1
    out = np.ones(len(hashes), bool)
    for row, bits in enumerate(bitmaps):
        cell = cell_of(hashes, row, log_width)
        out &= (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return out
