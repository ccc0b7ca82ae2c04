"""Ranked lexical search by presence masks.

A term is a maximal run of ASCII letters and digits and of characters beyond ASCII, A-Z in
lower case. One pass over the texts counts each document's terms and keeps the
occurrences of those that some item asks for (a forward index, written once; texts are
never shuffled). From it come the corpus statistics and, block by block of documents,
the results: every asked term of a block has a bitmap of the documents that hold it; the
bitmaps of an item's terms, transposed, give each document its mask of matched terms, and
documents with equal masks form a group. A mask's score is at most the sum of its terms'
largest impacts in the block. Groups are evaluated by that bound, highest first, until it
falls below the item's k-th best score; that score carries over to the task's next blocks.
Tasks return k documents per item; the best k of all are kept. All scores are integers.

Items are asked in runs of bounded size, so what goes to the tasks has a proven bound
(``ASKED`` different terms, or one item's terms); each run is one pass over the index.

Edge cases: null and term-free texts are no documents of the corpus; equal rows and rows
that repeat a doc_id are documents of their own (equal scores by doc_id, null last, then
by a hash of the text); of rows that repeat an item_id the smallest text counts; items
without terms, or whose terms no document holds, have no result. Texts are read in pieces
of about a million bytes that end between terms, so long ones need no long lists.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import bound_batches, settle

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_PIECE = re.compile(rb"(?s).{1,1000000}[0-9a-z\x80-\xff]*+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
ASKED = 1 << 18  # different terms of the items asked at a time
DOCS, POSTINGS = 1 << 15, 1 << 21  # documents and occurrences of a block
_EVALUATED = 64  # documents scored at a time


def terms(blob: bytes | None) -> Iterator[bytes]:
    """Terms of a UTF-8 text in order."""
    low = (blob or b"").translate(_LOWER)
    if len(low) <= 1_000_000:
        yield from TERM.findall(low)
    else:
        for piece in _PIECE.finditer(low):
            yield from TERM.findall(piece.group())


def _questions(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[tuple[bytes, int]]]]]:
    """Runs of (item_id, [(term, occurrences)]) with at most ASKED different terms, 4 * ASKED in all, or one item."""
    one = items.groupBy(F.col(id_col).cast("long").alias("item_id")).agg(F.min(F.col(text_col).cast("string")).alias("text"))
    run: list = []
    seen: set[bytes] = set()
    held = 0
    for row in one.select("item_id", F.col("text").cast("binary").alias("text")).toLocalIterator():
        count = Counter(terms(row["text"]))
        if not count:
            continue
        if run and (len(seen | count.keys()) > ASKED or held + len(count) > 4 * ASKED):
            yield run
            run, seen, held = [], set(), 0
        run.append((row["item_id"], sorted(count.items())))
        seen |= count.keys()
        held += len(count)
    if run:
        yield run


def forward_index(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tie, n, term, tf): terms of every document, and its asked ones by number with their occurrences."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"), F.col(text_col).cast("binary").alias("text")).where("text IS NOT NULL")

    def run(batches):
        find = shared.value.get
        for batch in batches:
            size, number, often, ends = [], [], [], [0]
            for blob in batch.column("text"):
                text = blob.as_py()
                if len(text) <= 1_000_000:
                    words = TERM.findall(text.translate(_LOWER))
                    n, count = len(words), Counter(map(find, words))
                else:
                    count = Counter(map(find, terms(text)))
                    n = count.total()
                count.pop(None, None)
                size.append(n)
                number += count.keys()
                often += count.values()
                ends.append(len(number))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (number, often)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(size, pa.int64()), *lists], names=["doc_id", "tie", "n", "term", "tf"])

    return base.mapInArrow(run, "doc_id long, tie long, n long, term array<int>, tf array<int>").where("n > 0")


class Block:
    """Asked terms of some documents, by term: the documents that hold it, its impacts there and its bitmap."""

    def __init__(self, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray, docs: int, words: int):
        norm = 75 + (25 * n.astype(object) * docs // words).astype(np.int64)  # the product may pass 64 bits
        doc = np.repeat(np.arange(len(n), dtype=np.int32), np.diff(ends))
        impact = 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 12 * norm[doc])
        order = np.argsort(term, kind="stable")  # documents stay in order within a term
        self.doc, self.impact, self.width = doc[order], impact[order], len(n)
        self.names, self.begin = np.unique(term[order], return_index=True)
        self.end = np.append(self.begin[1:], len(doc))
        self.top = np.maximum.reduceat(self.impact, self.begin) if len(doc) else np.zeros(0, np.int64)

    def find(self, term: np.ndarray) -> np.ndarray:
        """Places of those of the (ascending) terms that the block holds, -1 for the others."""
        at = np.searchsorted(self.names, term)
        at[at == len(self.names)] = 0
        return np.where(self.names[at] == term, at, -1) if len(self.names) else np.full(len(term), -1)

    def bitmap(self, place: int) -> np.ndarray:
        bits = np.zeros(self.width, bool)
        bits[self.doc[self.begin[place] : self.end[place]]] = True
        return np.packbits(bits, bitorder="little")

    def score(self, places, weights, docs: np.ndarray) -> np.ndarray:
        """Exact scores of ascending document numbers."""
        out = np.zeros(len(docs), np.int64)
        for p, w in zip(places, weights, strict=True):
            held = self.doc[self.begin[p] : self.end[p]]
            at = np.searchsorted(held, docs)
            at[at == len(held)] = 0
            hit = held[at] == docs
            out[hit] += w * self.impact[self.begin[p] + at[hit]]
        return out


def masks(bitmaps: list[np.ndarray], width: int) -> np.ndarray:
    """Transpose bitmaps of documents by term: one row of 64-bit words by document, bit t set if it holds term t."""
    out = np.zeros((width, -(-len(bitmaps) // 64)), np.uint64)
    for t, bits in enumerate(bitmaps):
        out[:, t // 64] |= np.unpackbits(bits, count=width, bitorder="little").astype(np.uint64) << np.uint64(t % 64)
    return out


def _groups(mask: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct masks as rows of booleans, the documents in order of their mask, and each mask's first place in that order."""
    order = np.lexsort(mask.T)
    rows = mask[order]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    bits = (rows[first][:, np.arange(count) // 64] >> (np.arange(count) % 64).astype(np.uint64)) & np.uint64(1)
    return bits.astype(bool), order, first


class Best:
    """The k best (score, doc_id, tie) of one item: a heap with the worst on top."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def bar(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc, tie: int) -> None:
        entry = (score, doc is not None, 0 if doc is None else -doc, -tie)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def rows(self):
        return [(s, -d if known else None, -t) for s, known, d, t in self.heap]


def search(block: Block, term: np.ndarray, weight: np.ndarray, best: Best, doc_id: list, tie: np.ndarray) -> int:
    """Put the block's best documents for one item into ``best``; returns how many were scored."""
    place = block.find(term)
    here = np.flatnonzero((place >= 0) & (weight > 0))
    if not len(here):
        return 0
    place, weight = place[here], weight[here]
    most = weight * block.top[place]
    if most.sum() < best.bar():
        return 0
    bitmaps = [block.bitmap(p) for p in place.tolist()]
    matched = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps), count=block.width, bitorder="little"))
    present, order, first = _groups(masks(bitmaps, block.width)[matched], len(place))
    order, after = matched[order], np.append(first[1:], len(matched))
    bound = present @ most
    scored = held = 0
    waiting: list[np.ndarray] = []

    def evaluate() -> None:
        nonlocal held
        docs = np.sort(np.concatenate(waiting))
        waiting.clear()
        held = 0
        score = block.score(place, weight, docs)
        for i in np.flatnonzero(score >= best.bar()).tolist():
            best.add(int(score[i]), doc_id[docs[i]], int(tie[docs[i]]))

    for g in np.argsort(-bound, kind="stable").tolist():
        size = int(after[g] - first[g])
        if waiting and held + size > _EVALUATED:
            evaluate()
        if bound[g] < best.bar():  # equal scores may still win by a smaller doc_id
            break
        waiting.append(order[first[g] : after[g]])
        held += size
        scored += size
    if waiting:
        evaluate()
    return scored


def _blocks(batches) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_id, tie, n, ends, term and tf of bounded runs of documents."""
    held: list[pa.RecordBatch] = []
    docs = postings = 0

    def out():
        table = pa.Table.from_batches(held).combine_chunks()
        lists = [table[c].combine_chunks() for c in ("term", "tf")]
        ends = np.append(0, np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False)))
        return table["doc_id"].to_pylist(), table["tie"].to_numpy(), table["n"].to_numpy(), ends, lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy()

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            held.append(part)
            docs += part.num_rows
            postings += len(part.column("term").flatten())
            if docs >= DOCS or postings >= POSTINGS:
                yield out()
                held, docs, postings = [], 0, 0
    if held:
        yield out()


def _answers(index: DataFrame, asked, vocabulary: list[bytes], docs: int, words: int, k: int) -> DataFrame:
    """(item_id, doc_id, tie, score): k rows per item and task."""
    spark = index.sparkSession
    df = {r["t"]: r["df"] for r in index.select(F.explode("term").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}  # at most one row per asked term
    number = {t: i for i, t in enumerate(vocabulary)}
    questions = []
    for item, count in asked:
        term = np.array([number[t] for t, _ in count], np.int32)
        weight = np.array([q * math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(number[t], 0) + 1))) for t, q in count], np.int64)
        questions.append((item, term, weight))
    shared = spark.sparkContext.broadcast(questions)

    def run(batches):
        best = [Best(k) for _ in shared.value]
        for doc_id, tie, n, ends, term, tf in _blocks(batches):
            block = Block(n, ends, term, tf, docs, words)
            for (_, wanted, weight), top in zip(shared.value, best, strict=True):
                search(block, wanted, weight, top, doc_id, tie)
        rows = [(item, doc, tie, score) for (item, *_), top in zip(shared.value, best, strict=True) for score, doc, tie in top.rows()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["item_id", "doc_id", "tie", "score"])

    return index.mapInArrow(run, "item_id long, doc_id long, tie long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k highest-scoring documents with a score above 0."""
    spark = docs.sparkSession
    found = []
    for asked in _questions(items, item_col, item_text):
        vocabulary = sorted({t for _, count in asked for t, _ in count})
        index = settle(forward_index(docs, vocabulary, id_col, text_col))
        n, words = index.agg(F.count("*"), F.sum("n")).first()
        if n:
            found.append(_answers(index, asked, vocabulary, n, words, k))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "tie"))
    return every.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
