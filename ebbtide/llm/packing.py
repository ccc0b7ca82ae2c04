"""Sum-of-squares packing of token sequences.

A task reads its documents in order and keeps a level array: how many open windows
are filled to each level. Whole windows are cut off a document at once; its remainder
goes to the level that keeps the sum of squared counts of partially filled windows
smallest. When the task ends, what is left in open windows is laid end to end and cut
at the window size, and the last rest is cut into powers of two, so no sequence needs
padding. Nothing is shuffled: tasks pack on their own and number their sequences
apart (task number in the high bits), and at most ``window`` open levels with their
pieces are held per task.

Edge cases: a null or empty text is the end mark alone; equal rows are packed as rows
of their own; a null doc_id keeps its tokens.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.unit_encoder import encoder, merges_agree
from ebbtide.session import bound_batches

WINDOW = 1024
END_ID = 0
TASK_BITS = 36
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_BYTES = 1 << 20  # bytes of text encoded at a time, or one document


class LevelArray:
    """Open windows by fill level, and the sum-of-squares rule."""

    def __init__(self, window: int):
        self.window, self.count = window, np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def place(self, size: int) -> tuple[int, int | None]:
        """Level to put ``size`` tokens on (0: a new window), and the window taken from it."""
        n, top = self.count, self.window - size
        # Moving a window from level h to h+size changes the sum by 2*(n[h+size]-n[h]+1); a full window leaves the array.
        level = np.flatnonzero(n[: top + 1])
        change = n[level + size] - n[level] + 1.0
        change[level == top] = 0.5 - n[top]
        best, least = 0, n[size] + 0.5 if size < self.window else 0.0
        if len(level):
            k = int(change.argmin())
            if change[k] <= least:
                best = int(level[k])
        if best:
            n[best] -= 1
            return best, self.open[best].pop()
        return 0, None

    def settle(self, level: int, window: int) -> None:
        if level < self.window:
            self.count[level] += 1
            self.open[level].append(window)


def _encoded(batches, path: str, fast: bool):
    """(doc_id, token ids with the end mark) of every row, in order."""
    end = np.array([END_ID], "<u4")
    for batch in batches:
        docs, sizes = batch.column("_doc").to_pylist(), pc.binary_length(batch.column("_text")).fill_null(0).to_numpy()
        group = (np.cumsum(sizes) - sizes) // _BYTES  # rows by where their text begins
        cuts = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            texts = [t or "" for t in batch.column("_text").slice(lo, hi - lo).to_pylist()]
            for doc, ids in zip(docs[lo:hi], encoder(path, fast).encode(texts), strict=True):
                yield doc, np.concatenate([ids, end])


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document, see SCHEMA."""
    bound_batches(docs.sparkSession)
    fast = merges_agree(tokenizer_path)
    base = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        levels, sequence = LevelArray(window), TaskContext.get().partitionId() << TASK_BITS
        held: dict[int, list[tuple]] = {}  # open window -> pieces (doc, start, ids, document's tokens)
        out: list[tuple] = []

        def emit(pieces) -> None:
            nonlocal sequence
            at = 0
            for doc, start, ids, total in pieces:
                out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, at))
                at += len(ids)
            sequence += 1

        def batch_out():
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])
            out.clear()
            return batch

        new = 0
        for doc, ids in _encoded(batches, tokenizer_path, fast):
            total, whole = len(ids), len(ids) // window * window
            for s in range(0, whole, window):
                emit([(doc, s, ids[s : s + window], total)])
            if whole < total:
                rest = (doc, whole, ids[whole:].copy(), total)
                level, k = levels.place(total - whole)
                if k is None:
                    k, new = new, new + 1
                held.setdefault(k, []).append(rest)
                level += total - whole
                levels.settle(level, k)
                if level == window:
                    emit(held.pop(k))
            if len(out) >= 20000:
                yield batch_out()
        # What is still open: one stream, cut at the window size, its end at powers of two.
        left = [p for k in sorted(held) for p in held[k]]
        total = sum(len(p[2]) for p in left)
        sizes = [window] * (total // window)
        rest = total % window
        while rest:
            sizes.append(1 << (rest.bit_length() - 1))
            rest -= sizes[-1]
        stream = iter(left)
        piece = next(stream, None)
        for size in sizes:
            pieces, free = [], size
            while free:
                doc, start, ids, n = piece
                pieces.append((doc, start, ids[:free], n))
                taken = len(pieces[-1][2])
                free -= taken
                piece = (doc, start + taken, ids[taken:], n) if taken < len(ids) else next(stream, None)
            emit(pieces)
            if len(out) >= 20000:
                yield batch_out()
        if out:
            yield batch_out()

    return base.mapInArrow(run, SCHEMA)
