"""Removal of word windows that an earlier document already holds.

Pass 1 counts, in a count-min sketch per task, the anchor of every run of windows:
the smallest hash among the ten-word grams of a window. Equal windows have equal
anchors, so a window whose anchor is not estimated to repeat cannot repeat. The
sketches of all tasks are merged; counts saturate at two. Pass 2 emits only runs of
windows whose anchor is estimated repeated, and Spark groups them exactly: first as
whole runs, then window by window for the first holder of each run, because a run
may overlap a different run in part.

Edge cases: a null text has no words; texts shorter than a window keep all words; a
null doc_id has no order, so it keeps its words and removes nobody's; rows that
repeat a doc_id are judged each by its own text and never remove each other's words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.sketches import allows_two, repeated
from ebbtide.llm.words import Runs, hash_words, starts, word_spans
from ebbtide.session import settle

WINDOW = 50
GRAM = 10
DEPTH = 2
LOG_WIDTH = 26  # cells of one sketch row; the merged sketch of DEPTH * 2**LOG_WIDTH bits (16 MB) goes to every task
ROWS = 1000  # documents hashed at a time


def _runs(blobs, window: int):
    """Runs of consecutive windows with one anchor: text, first window, windows, anchor, run hash, word hashes."""
    words, bounds = hash_words(blobs)
    grams = min(GRAM, window)
    at, per = starts(bounds, window)
    if not len(at):
        return None
    runs = Runs(words)
    small = runs.hash(np.arange(len(words) - grams + 1), grams)
    width, have = window - grams + 1, 1  # sliding minimum by doubling
    while have < width:
        step = min(have, width - have)
        small = np.minimum(small[:-step], small[step:])
        have += step
    anchor = small[at]
    text = np.repeat(np.arange(len(per)), per)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(first, append=len(at))
    return runs, at, text[first], first, count, anchor[first], bounds


def _columns(batch: pa.RecordBatch, *names):
    return [batch.column(n).to_pylist() for n in names]


def _sliced(batches, rows: int = ROWS):
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def sketch(texts: DataFrame, window: int = WINDOW) -> list[np.ndarray]:
    """Merged sketch of the anchors of all runs of windows in column _text."""

    def anchors(batch):
        for part in _sliced([batch]):
            found = _runs(_columns(part, "_text")[0], window)
            if found is not None:
                yield found[5]

    return repeated(texts, anchors, DEPTH, LOG_WIDTH)


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(_doc, _print, _ranges): per text, first window and number of windows of each removed range.

    ``docs`` holds _doc, _text (binary) and _print, a fingerprint of the text.
    """
    spark = docs.sparkSession
    numbered = docs.where("_doc IS NOT NULL AND _text IS NOT NULL")
    bits = spark.sparkContext.broadcast(sketch(numbered.select("_text"), window))

    def emit(batches):
        for batch in _sliced(batches):
            blobs, doc, mark = _columns(batch, "_text", "_doc", "_print")
            found = _runs(blobs, window)
            if found is None:
                continue
            runs, at, text, first, count, anchor, bounds = found
            keep = allows_two(bits.value, anchor)
            text, first, count, anchor = text[keep], first[keep], count[keep], anchor[keep]
            if not len(text):
                continue
            run = runs.hash(at[first], count + window - 1)
            inner = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
            hashes = runs.hash(at[inner], window).astype("<u8").tobytes()
            cuts = np.concatenate([[0], np.cumsum(count)]) * 8
            yield pa.RecordBatch.from_pydict({
                "_doc": pa.array(np.asarray(doc, np.int64)[text]), "_print": pa.array(np.asarray(mark, np.int64)[text]),
                "_anchor": pa.array(anchor.view(np.int64)), "_run": pa.array(run.view(np.int64)),
                "_from": pa.array((at[first] - bounds[text]).astype(np.int64)), "_n": pa.array(count.astype(np.int64)),
                "_hashes": pa.array([hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            })

    rows = settle(numbered.mapInArrow(emit, "_doc long, _print long, _anchor long, _run long, _from long, _n long, _hashes binary"))
    bits.destroy()
    # First holder of each run; then only anchors with two different runs can hide partial overlaps.
    # All sides are settled, so that the joins read plain exchanges, whose large partitions Spark can split.
    holders = settle(rows.groupBy("_anchor", "_run").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last")))
    mixed = settle(holders.groupBy("_anchor").agg(F.count("*").alias("_kinds")).where("_kinds > 1"))
    known = settle(holders.join(mixed, "_anchor", "left").where("_first < _last OR _kinds > 1").drop("_last"))
    rows = settle(rows.join(known, ["_anchor", "_run"]))
    whole = rows.where("_first < _doc").select("_doc", "_print", "_from", "_n")

    def unfold(batches):
        for batch in _sliced(batches):
            doc, mark, anchor, start, blobs = _columns(batch, "_doc", "_print", "_anchor", "_from", "_hashes")
            count = np.array([len(b) // 8 for b in blobs], np.int64)
            hashes = np.frombuffer(b"".join(blobs), "<i8")
            at = np.arange(len(hashes)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(np.asarray(start, np.int64), count)
            yield pa.RecordBatch.from_pydict({
                "_doc": pa.array(np.repeat(np.asarray(doc, np.int64), count)), "_print": pa.array(np.repeat(np.asarray(mark, np.int64), count)),
                "_anchor": pa.array(np.repeat(np.asarray(anchor, np.int64), count)), "_from": pa.array(at), "_hash": pa.array(hashes),
            })

    single = rows.where("_first = _doc AND _kinds > 1").select("_doc", "_print", "_anchor", "_from", "_hashes").mapInArrow(unfold, "_doc long, _print long, _anchor long, _from long, _hash long")
    # A window is known by its hash and its anchor, 128 bits, as a run is by its own two hashes.
    least = settle(single.groupBy("_anchor", "_hash").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last")).where("_first < _last").drop("_last"))
    partial = single.join(least, ["_anchor", "_hash"]).where("_first < _doc").select("_doc", "_print", "_from", F.lit(1).cast("long").alias("_n"))
    return whole.unionByName(partial).groupBy("_doc", "_print").agg(F.collect_set(F.struct("_from", "_n")).alias("_ranges"))


def drop_repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, kept text (words joined by one space), n_words and n_removed."""
    base = docs.select(
        F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("binary").alias("_text"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("_print"),
    )
    found = repeated_windows(base, window)
    joined = base.join(found, (base["_doc"] == found["_doc"]) & (base["_print"] == found["_print"]), "left").select(base["_doc"], "_text", "_ranges")

    def keep(batches):
        for batch in _sliced(batches, 500):
            doc, blobs, ranges = _columns(batch, "_doc", "_text", "_ranges")
            texts, words, removed = [], [], []
            for blob, gone in zip(blobs, ranges, strict=True):
                blob = blob or b""
                start, end = word_spans(blob)
                drop = np.zeros(len(start) + 1, np.int64)
                for r in gone or ():
                    drop[r["_from"]] += 1
                    drop[r["_from"] + r["_n"] + window - 1] -= 1
                stay = np.cumsum(drop[:-1]) == 0
                texts.append(b" ".join([blob[a:b] for a, b in zip(start[stay].tolist(), end[stay].tolist(), strict=True)]))
                words.append(len(start))
                removed.append(int(len(start) - stay.sum()))
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc, pa.int64()), "text": pa.array([t.decode() for t in texts], pa.string()), "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64())})

    return joined.mapInArrow(keep, "doc_id long, text string, n_words long, n_removed long")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
