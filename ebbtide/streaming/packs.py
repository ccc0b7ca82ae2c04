"""Counts per customer packed as binary, so that a stream's state holds few and short entries."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# --- fixed values: packing --------------------------------------------------------------------------
PACK_ROWS = 500_000  # rows that a task packs at once
EMIT_ROWS = 50_000  # rows of a batch given back to Spark, about
_HEAD, _SIZES = struct.Struct("<I3B"), (np.uint8, np.uint16, np.uint32, np.uint64)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (time, part, id, loyal) to one pack per time and part of what the task holds."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield _packed(held)
            held, n = [], 0
    if n:
        yield _packed(held)


def _packed(batches: Sequence[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches)
    name = rows.column_names[0]
    rows = rows.rename_columns(["time", "part", "id", "loyal"]).group_by(["time", "part", "id"], use_threads=False).aggregate([([], "count_all"), ("loyal", "sum")])
    rows = rows.sort_by([("time", "ascending"), ("part", "ascending")])
    time, part = rows["time"].cast(pa.int64()).to_numpy(), rows["part"].to_numpy()
    edges = [*np.flatnonzero(np.append(True, (time[1:] != time[:-1]) | (part[1:] != part[:-1]))).tolist(), len(time)]
    ids = pa.concat_arrays(rows["id"].chunks)
    unknown = ids.is_null().to_numpy(zero_copy_only=False)
    ids = pa.concat_arrays([ids.fill_null("").cast(pa.large_string())])
    at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
    text = ids.buffers()[2]
    text = memoryview(b"" if text is None else text)
    # Lengths are one more than the bytes of an id; 0 is NULL.
    columns = [np.where(unknown, 0, np.diff(at) + 1), *[rows[c].to_numpy() for c in ("count_all", "loyal_sum")]]
    blobs = [encode([c[a:b] for c in columns], text[at[a] : at[b]]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    first = pa.array(edges[:-1])
    return pa.RecordBatch.from_arrays([*[pa.concat_arrays(rows[c].chunks).take(first) for c in ("time", "part")], pa.array(blobs, pa.binary())], names=[name, "part", "pack"])


def encode(columns: Sequence[np.ndarray], text: bytes) -> bytes:
    """Lengths, calls and loyalty calls in as few bytes each as their largest value needs, and the ids' bytes."""
    kinds = [next(k for k, t in enumerate(_SIZES) if c.max() <= np.iinfo(t).max) for c in columns]
    return b"".join([_HEAD.pack(len(columns[0]), *kinds), *[c.astype(_SIZES[k]).tobytes() for c, k in zip(columns, kinds, strict=True)], text])


def decode(blob: bytes) -> tuple[list[np.ndarray], bytes]:
    n, *kinds = _HEAD.unpack_from(blob)
    columns, at = [], _HEAD.size
    for k in kinds:
        columns.append(np.frombuffer(blob, _SIZES[k], n, at))
        at += columns[-1].nbytes
    return columns, blob[at:]


def totals(blobs: Sequence[bytes]) -> pa.Table:
    """(id, n_calls, n_loyalty) of packs, added up per id."""
    parts = [decode(b) for b in blobs]
    lengths, calls, loyal = (np.concatenate([p[0][k] for p in parts]).astype(np.int64) for k in range(3))
    offsets = np.append(0, np.cumsum(np.maximum(lengths - 1, 0)))
    ids = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(b"".join(p[1] for p in parts)))
    if not lengths.all():
        ids = pc.if_else(pa.array(lengths > 0), ids, pa.scalar(None, pa.large_string()))
    rows = pa.table({"id": ids, "n_calls": calls, "n_loyalty": loyal}).group_by("id", use_threads=False).aggregate([("n_calls", "sum"), ("n_loyalty", "sum")])
    return pa.table({"id": rows["id"], "n_calls": rows["n_calls_sum"], "n_loyalty": rows["n_loyalty_sum"]})


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, start, end, n_calls, n_loyalty) of windows (start, end, packs)."""
    held, n = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            rows = totals(batch.column(2)[i].as_py())
            ends = [pa.repeat(batch.column(k)[i], len(rows)) for k in (0, 1)]
            held.append(pa.table([rows["id"], *ends, rows["n_calls"], rows["n_loyalty"]], names=["id", "start", "end", "n_calls", "n_loyalty"]))
            n += len(rows)
            if n >= EMIT_ROWS:
                yield from _emitted(held)
                held, n = [], 0
    if n:
        yield from _emitted(held)


def _emitted(tables: Sequence[pa.Table]) -> Iterator[pa.RecordBatch]:
    rows = pa.concat_tables(tables)
    for at in range(0, len(rows), EMIT_ROWS):
        part = rows.slice(at, EMIT_ROWS)
        part = part.set_column(0, "id", part["id"].cast(pa.string())).combine_chunks()
        yield from part.to_batches()
