"""Codes for vectors by product codebooks, searched through integer Walsh-Hadamard transforms.

Components become integers ``floor(4096 * x)`` and a vector is cut into eight equal
consecutive parts. Each part position has a codebook of up to 16 entries, refined by six
rounds of integer Lloyd steps. To find a part's nearest entry, parts and entries are
padded with zeros to a power of two n and transformed by the n x n Hadamard matrix, whose
rows are put in order of their sign changes (sequency), so the first coefficients hold
most of a smooth part. The transform multiplies every squared distance by n exactly;
squared differences are added coefficient by coefficient, and an entry leaves as soon as
its sum exceeds the full distance of the entry that looked best after the first ones.
All of it is integer arithmetic, so results do not depend on the order of rows.

A round is one pass over the settled integers: tasks return counts and sums per entry and
component, Spark adds them up by key, and only codebooks (16 rows of a vector's length)
come to the driver and go to the tasks. No vector is shuffled.

Edge cases: vectors that are null or hold null or non-finite components are dropped;
vectors of different lengths have codebooks of their own; a length that eight does not
divide is filled up with zeros; an empty vector has code zero and error zero. The seeds
of a codebook are the 16 smallest different ids (null last; of rows with one id the
smallest vector), fewer if there are fewer; equal rows count as rows of their own. A component
of 2**15 or more in size raises ValueError: below it all sums fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.vectors import matrix
from ebbtide.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 27  # components stay below this, so that n * n * (2 * LARGEST)**2 fits 63 bits up to n = 8; longer parts lower it
FIRST = 2  # coefficients summed for every entry before any of them leaves
_CELLS = 1 << 20  # components handled at a time


def hadamard(n: int) -> np.ndarray:
    """Hadamard matrix of a power of two, rows by their number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")]


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows of ``x`` in sequency order, by additions only."""
    rows, width = x.shape
    n = 1 << max(0, width - 1).bit_length()
    out = np.zeros((rows, n), np.int64)
    out[:, :width] = x
    step = 1
    while step < n:
        pairs = out.reshape(rows, n // (2 * step), 2, step)
        a, b = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0], pairs[:, :, 1] = a + b, a - b
        step *= 2
    return out[:, _sequency(n)]


def _sequency(n: int) -> np.ndarray:
    """Place of each row of the butterfly's output in order of sign changes."""
    order = np.arange(n)
    gray = order ^ (order >> 1)
    out = np.zeros(n, np.int64)
    bits = n.bit_length() - 1
    for k in range(bits):
        out |= ((gray >> k) & 1) << (bits - 1 - k)
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each row's nearest entry, ties to the smaller index."""
    x, c = transform(parts), transform(entries)
    n = x.shape[1]
    first = min(FIRST, n)
    head = np.zeros((len(x), len(c)), np.int64)
    for k in range(first):
        head += (x[:, k, None] - c[None, :, k]) ** 2
    guess = head.argmin(axis=1)
    bound = ((x - c[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(head <= bound[:, None])
    total = head[row, entry]
    for k in range(first, n):
        total += (x[row, k] - c[entry, k]) ** 2
        stay = total <= bound[row]
        if not stay.all():
            row, entry, total = row[stay], entry[stay], total[stay]
    begin = np.flatnonzero(np.diff(row, prepend=-1))  # every row keeps its guess at least
    least = np.minimum.reduceat(total, begin)
    hit = np.flatnonzero(total == np.repeat(least, np.diff(begin, append=len(row))))
    best = hit[np.diff(row[hit], prepend=-1) != 0]
    return entry[best], least // n


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """Rows of one length each, as matrices of bounded size whose width eight divides."""
    for batch in batches:
        sizes = batch.column("_v").value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes).tolist():
            own = batch.filter(pa.array(sizes == dim))
            step = max(1, _CELLS // max(1, dim))
            for at in range(0, own.num_rows, step):
                part = own.slice(at, step)
                x = matrix(part.column("_v"), np.int64) if dim else np.zeros((part.num_rows, 0), np.int64)
                yield part, dim, np.pad(x, ((0, 0), (0, -dim % PARTS)))


def _split(x: np.ndarray) -> list[np.ndarray]:
    width = x.shape[1] // PARTS
    return [x[:, p * width : (p + 1) * width] for p in range(PARTS)]


def _counts(base: DataFrame, books: dict[int, list[np.ndarray]]) -> list:
    """Rows (dim, part, entry, place, n, total) of all parts by nearest entry; place -1 counts alone."""
    shared = base.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        count: dict[int, np.ndarray] = {}
        total: dict[int, list[np.ndarray]] = {}
        for _, dim, x in _blocks(batches):
            book = shared.value[dim]
            if dim not in count:
                count[dim], total[dim] = np.zeros((PARTS, ENTRIES), np.int64), [np.zeros((ENTRIES, b.shape[1]), np.int64) for b in book]
            for p, part in enumerate(_split(x)):
                entry, _ = nearest(part, book[p])
                np.add.at(count[dim][p], entry, 1)
                np.add.at(total[dim][p], entry, part)
        out = []
        for dim, n in count.items():
            for p, e in zip(*np.nonzero(n), strict=True):
                out += [(dim, int(p), int(e), k, int(n[p, e]), int(s)) for k, s in enumerate(total[dim][p][e])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["dim", "part", "entry", "place", "n", "total"])

    cells = base.mapInArrow(run, "dim long, part long, entry long, place long, n long, total long")
    rows = cells.groupBy("dim", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()  # 16 x length numbers
    shared.unpersist()
    return rows


def _seeds(base: DataFrame) -> dict[int, list[np.ndarray]]:
    """First codebooks by length: parts of the smallest ids."""
    books = {}
    for (dim,) in base.select(F.size("_v")).distinct().collect():
        rows = base.where(F.size("_v") == dim).groupBy("_id").agg(F.min("_v").alias("_v")).orderBy(F.col("_id").asc_nulls_last()).limit(ENTRIES).collect()
        x = np.array([r["_v"] for r in rows], np.int64).reshape(len(rows), dim)
        books[dim] = [p.copy() for p in _split(np.pad(x, ((0, 0), (0, -dim % PARTS))))]
    return books


def codebooks(base: DataFrame) -> dict[int, list[np.ndarray]]:
    """Codebooks of every vector length after all rounds; ``base`` has _id and integer _v."""
    books = _seeds(base)
    for _ in range(ROUNDS if books else 0):
        for r in _counts(base, books):
            books[r["dim"]][r["part"]][r["entry"], r["place"]] = r["total"] // r["n"]
    return books


def digest_of(book: list[np.ndarray]) -> str:
    """Hash of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for part in book for v in part.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every row with a finite vector."""
    base = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("_label"), F.col(vec_col).cast("array<double>").alias("_x"))
    sound = base.where(F.col("_x").isNotNull() & ~F.exists("_x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))
    # Values out of range are kept as the limit here and refused below.
    whole = F.transform("_x", lambda x: F.floor(F.least(F.greatest(x, F.lit(-1e12)), F.lit(1e12)) * SCALE).cast("long"))
    base = settle(sound.select("_id", "_label", whole.alias("_v")))
    top, width = base.agg(F.max(F.greatest(F.array_max("_v"), -F.array_min("_v"))), F.max(F.size("_v"))).first()
    n = 1 << max(0, -(-(width or 0) // PARTS) - 1).bit_length()
    if top is not None and top >= LARGEST // max(1, n // 8):
        raise ValueError(f"a component of size {top / SCALE} is too large for 64-bit sums")
    books = codebooks(base)
    shared = vectors.sparkSession.sparkContext.broadcast((books, {dim: digest_of(book) for dim, book in books.items()}))

    def run(batches):
        for part, dim, x in _blocks(batches):
            book, digest = shared.value[0][dim], shared.value[1][dim]
            found = [nearest(p, b) for p, b in zip(_split(x), book, strict=True)]
            code = np.stack([e for e, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), part.column("_label"), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(sum(d for _, d in found), pa.int64()), pa.array([digest] * len(x), pa.string())],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"],
            )

    label_type = base.schema["_label"].dataType.simpleString()
    coded = settle(base.mapInArrow(run, f"vec_id long, label {label_type}, code string, error long, codebooks_sha256 string"))
    # One row per label, written, so that Spark sees its size and chooses the join by it.
    sums = settle(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left")
    return joined.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
