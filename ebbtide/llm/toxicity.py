"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels belong to documents, tags to tokens. A token of a toxic document is labelled
toxic when one of its features (the word, or its first 4, 5 or 6 bytes) is far more
frequent in toxic documents of the fitting sample than in clean ones; all tokens of
clean documents are labelled clean. The field is fitted to these tokens by gradient
ascent on the conditional likelihood; scoring runs forward-backward over every whole
text. A document's score is a logistic function of its largest token marginal and of
the sum of marginals, fitted on the same sample, weighted back to the label shares.

Nothing but the text enters a score. Edge cases: null, empty and word-free texts get
the score of a text without any toxic token; rows may repeat; without labels of both
kinds every score is the share of toxic labels (0 without labels).

The fitting sample is bounded: ``SAMPLE`` labelled ids of each kind, the ones with the
smallest hash, one row each. It is fitted in one task, in slices of ``SLICE`` bytes whose
sums are added; beyond ``HELD`` bytes the features of a slice are taken anew in each step.
The model (about 1 MB) goes to every task. Forward-backward runs over segments of ``SEGMENT_TOKENS`` tokens side by side: a
first sweep gives each segment's transfer matrix, the matrices of a text are chained,
and a second sweep runs from the true incoming state, so the result is exact.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.names import field, free_name
from ebbtide.llm.words import U, affix_hashes, mix
from ebbtide.session import bound_batches

SAMPLE = 3000  # labelled rows of each kind that the field is fitted on
FOLDS, HELD_OUT = 5, 0  # rows with crc32(id) % FOLDS == HELD_OUT are never fitted on
LOG_FEATURES = 18
PREFIXES = (4, 5, 6)
SEGMENT_TOKENS = 128
SUPPORT, LIFT = 6, 20.0  # documents a marker feature occurs in, and its ratio of toxic to clean rates
STEPS, RATE, RIDGE = 60, 0.5, 1e-4
SPAN_AT = 0.5
_BATCH = 1 << 20  # bytes of text handled at a time
SLICE = 2 << 20  # bytes of text that the fit handles at a time; its sums run over all slices
HELD = 64 << 20  # bytes of features that the fit keeps between its steps


def fold(id_col) -> F.Column:
    return F.crc32(id_col.cast("string")) % FOLDS


@dataclass
class Field:
    weight: np.ndarray  # by hashed feature
    bias: float
    trans: np.ndarray  # log potentials (from, to); 0 clean, 1 toxic
    doc: np.ndarray  # intercept, slope of the largest marginal's log-odds, slope of log1p(sum)


def _features(hashes: list[np.ndarray]) -> np.ndarray:
    """Hashed feature numbers, one row per feature kind."""
    return np.stack([(mix(h + U(k * 0x51ED2701)) >> U(64 - LOG_FEATURES)).astype(np.int32) for k, h in enumerate(hashes)])


def tokenize(blobs: list[bytes]):
    """Features (kinds x tokens), bounds of each text, start and end bytes within the joined texts."""
    hashes, start, end, bounds, begins = affix_hashes(blobs, PREFIXES)
    return _features(hashes), bounds, start, end, begins


def _layout(bounds: np.ndarray):
    """Token positions as a (step, segment) matrix, its mask, and the first segment of each text."""
    counts = np.diff(bounds)
    segs = -(-counts // SEGMENT_TOKENS)
    first = np.concatenate([[0], np.cumsum(segs)])
    seg_doc = np.repeat(np.arange(len(counts)), segs)
    seg_start = bounds[:-1][seg_doc] + (np.arange(first[-1]) - first[:-1][seg_doc]) * SEGMENT_TOKENS
    seg_len = np.minimum(SEGMENT_TOKENS, bounds[1:][seg_doc] - seg_start)
    at = seg_start[None, :] + np.arange(SEGMENT_TOKENS)[:, None]
    mask = np.arange(SEGMENT_TOKENS)[:, None] < seg_len[None, :]
    return np.where(mask, at, 0), mask, first


def _sweep(odds, mask, trans, state, keep):
    """Forward pass of all segments; state is (..., 2, segments), normalised at every step."""
    kept = []
    a = trans
    for e, m in zip(odds, mask, strict=True):
        o, t = state[..., 0, :], state[..., 1, :]
        new = np.stack([o * a[0, 0] + t * a[1, 0], (o * a[0, 1] + t * a[1, 1]) * e], axis=-2)
        new /= new.sum(axis=-2, keepdims=True) if keep else new.sum(axis=(0, 1), keepdims=True)
        state = np.where(m, new, state)
        if keep:
            kept.append(state)
    return np.stack(kept) if keep else state


def _incoming(matrix: np.ndarray, first: np.ndarray, start: np.ndarray) -> np.ndarray:
    """State before each segment, chaining the transfer matrices (in, out, segment) of each text."""
    out = np.empty((2, matrix.shape[2]))
    m = matrix.transpose(2, 0, 1)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        v = start
        for k in range(lo, hi):
            out[:, k] = v
            if k + 1 < hi:
                v = v @ m[k]
                v = v / v.sum()
    return out


def marginals(score: np.ndarray, bounds: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag for every token."""
    p = np.zeros(len(score))
    if not len(score):
        return p
    at, mask, first = _layout(bounds)
    odds, a = np.exp(np.clip(score, -30, 30))[at], np.exp(trans)
    eye = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, at.shape[1]))
    one = np.full(2, 0.5)
    several = bool((np.diff(first) > 1).any())
    enter = _incoming(_sweep(odds, mask, a, eye, False), first, one) if several else np.full((2, at.shape[1]), 0.5)
    forward = _sweep(odds, mask, a, enter, True)
    # Backward messages are a forward pass over reversed segments: b = A (e * b_next).
    def back(state, keep):
        kept, s = [], state
        for e, m in zip(odds[::-1], mask[::-1], strict=True):
            if keep:
                kept.append(s)
            o, t = s[..., 0, :], s[..., 1, :] * e
            new = np.stack([a[0, 0] * o + a[0, 1] * t, a[1, 0] * o + a[1, 1] * t], axis=-2)
            new /= new.sum(axis=-2, keepdims=True) if keep else new.sum(axis=(0, 1), keepdims=True)
            s = np.where(m, new, s)
        return np.stack(kept[::-1]) if keep else s
    if several:
        m = back(eye, False).transpose(2, 0, 1)
        leave = np.empty((2, at.shape[1]))
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            v = one
            for k in range(hi - 1, lo - 1, -1):
                leave[:, k] = v
                if k > lo:
                    v = v @ m[k]
                    v = v / v.sum()
    else:
        leave = np.full((2, at.shape[1]), 0.5)
    backward = back(leave, True)
    both = forward * backward
    p[at[mask]] = (both[:, 1] / both.sum(axis=1))[mask]
    return p


def _doc_features(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: 1, log-odds of the largest marginal, log1p of their sum."""
    out = np.tile([1.0, -15.0, 0.0], (len(bounds) - 1, 1))
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        top = np.clip(np.maximum.reduceat(p, bounds[:-1][some]), 3e-7, 1 - 3e-7)
        out[some, 1] = np.log(top / (1 - top))
        out[some, 2] = np.log1p(np.add.reduceat(p, bounds[:-1][some]))
    return out


def _slices(texts: list[bytes]):
    """Bounds of runs of whole texts of about ``SLICE`` bytes."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= SLICE):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def _owners(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


class _Slices:
    """Features and token bounds of the slices of the fitting texts, kept up to HELD bytes and else taken anew."""

    def __init__(self, texts: list[bytes]):
        self.texts, self.ranges, self.kept, self.held = texts, list(_slices(texts)), {}, 0

    def __len__(self) -> int:
        return len(self.ranges)

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k in self.kept:
            return self.kept[k]
        i, j = self.ranges[k]
        feats, bounds, *_ = tokenize(self.texts[i:j])
        if self.held + feats.nbytes <= HELD:
            self.kept[k] = feats, bounds
            self.held += feats.nbytes
        return feats, bounds


def _token_labels(slices: _Slices, toxic: np.ndarray) -> list[np.ndarray]:
    """Whether a token of a toxic text holds a marker feature, slice by slice."""
    size = 1 << LOG_FEATURES
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    kinds = 1 + len(PREFIXES)
    one, zero = (np.zeros((kinds, size), np.int64) for _ in range(2))
    for s, (i, j) in enumerate(slices.ranges):
        feats, bounds = slices[s]
        bad = toxic[i:j]
        doc = _owners(bounds).astype(np.int64) << LOG_FEATURES
        for k, kind in enumerate(feats):
            pair = np.unique(doc | kind)
            f, is_toxic = pair & (size - 1), bad[pair >> LOG_FEATURES]
            one[k] += np.bincount(f[is_toxic], minlength=size)
            zero[k] += np.bincount(f[~is_toxic], minlength=size)
    marker = (one >= min(SUPPORT, max(1, n1 // 4))) & (one / n1 > LIFT * (zero + 0.5) / n0)
    out = []
    for s, (i, j) in enumerate(slices.ranges):
        feats, bounds = slices[s]
        out.append(np.any([m[kind] for m, kind in zip(marker, feats, strict=True)], axis=0) & toxic[i:j][_owners(bounds)])
    return out


def _sequences(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Training sequences are the segments: their cuts, and the left ones of neighbours inside a segment."""
    segs = np.concatenate([np.arange(lo, hi, SEGMENT_TOKENS) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)] + [[bounds[-1]]])
    cuts = segs.astype(np.int64)
    inner = np.ones(int(bounds[-1]), bool)
    inner[cuts[:-1]] = False
    return cuts, np.flatnonzero(inner) - 1


def fit_field(texts: list[bytes], toxic: np.ndarray, weight: np.ndarray) -> Field:
    """Fit on labelled texts; ``weight`` is how many labelled rows a row stands for."""
    toxic = toxic.astype(bool)
    prior = float((weight * toxic).sum() / weight.sum()) if len(toxic) else 0.0
    flat = Field(np.zeros(1 << LOG_FEATURES, np.float32), 0.0, np.zeros((2, 2)), np.array([_logit(prior), 0.0, 0.0]))
    if not len(toxic) or toxic.all() or not toxic.any():
        return flat
    slices = _Slices(texts)
    tags = _token_labels(slices, toxic)
    n = sum(map(len, tags))
    if not n:
        return flat
    seen = np.zeros((2, 2))
    for s, y in enumerate(tags):
        _, left = _sequences(slices[s][1])
        a, b = y[left], y[left + 1]
        seen += np.array([[(~a & ~b).sum(), (~a & b).sum()], [(a & ~b).sum(), (a & b).sum()]])
    marked = sum(int(y.sum()) for y in tags)
    w, b, trans = np.zeros(1 << LOG_FEATURES), math.log((marked + 1) / (n - marked + 1)), np.zeros((2, 2))
    gw2, gb2, gt2 = np.full(len(w), 1e-6), 1e-6, np.full((2, 2), 1e-6)
    for _ in range(STEPS):
        gw, gb, pair = np.zeros(len(w)), 0.0, np.zeros((2, 2))
        for s, y in enumerate(tags):
            if not len(y):
                continue
            feats, bounds = slices[s]
            cuts, left = _sequences(bounds)
            score = w[feats].sum(axis=0) + b
            p = marginals(score, cuts, trans)
            pair += _pairs(score, cuts, trans, p, left)
            diff = y - p
            gb += diff.sum()
            for kind in feats:
                gw += np.bincount(kind, diff, len(w))
        gw = gw / n * 100 - RIDGE * w
        gb, gt = gb / n * 100, (seen - pair) / n * 100
        gw2 += gw**2
        gb2 += gb**2
        gt2 += gt**2
        w += RATE * gw / np.sqrt(gw2) * (gw2 > 2e-6)
        b += RATE * gb / math.sqrt(gb2)
        trans += RATE * gt / np.sqrt(gt2)
        trans -= trans[0, 0]
    x = []
    for s in range(len(slices)):
        feats, bounds = slices[s]
        x.append(_doc_features(marginals(w[feats].sum(axis=0) + b, bounds, trans), bounds))
    return Field(w.astype(np.float32), float(b), trans, _logistic(np.concatenate(x), toxic.astype(float), weight * len(weight) / weight.sum()))


def _pairs(score, bounds, trans, p, left) -> np.ndarray:
    """Expected counts of neighbouring tags, from node marginals and the pair's conditional odds."""
    # P(y_t = j | y_{t-1} = i) is proportional to trans[i, j] * (p_t's backward-weighted odds); recover the
    # latter from the node marginals: p_t(1)/p_t(0) = r_t * (a01 q0 + a11 q1)/(a00 q0 + a10 q1), where q is the
    # filtered state before t, so one forward pass is enough.
    at, mask, _ = _layout(bounds)
    a = np.exp(trans)
    forward = _sweep(np.exp(np.clip(score, -30, 30))[at], mask, a, np.full((2, at.shape[1]), 0.5), True)
    q1 = np.zeros(len(score))
    q1[at[mask]] = forward[:, 1][mask]
    q1, p1 = q1[left], np.clip(p[left + 1], 1e-12, 1 - 1e-12)
    q0 = 1 - q1
    to1, to0 = a[0, 1] * q0 + a[1, 1] * q1, a[0, 0] * q0 + a[1, 0] * q1
    return np.array([[((1 - p1) * a[0, 0] * q0 / to0).sum(), (p1 * a[0, 1] * q0 / to1).sum()], [((1 - p1) * a[1, 0] * q1 / to0).sum(), (p1 * a[1, 1] * q1 / to1).sum()]])


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression by damped Newton steps; slopes are kept from turning negative."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (y - p)) - 0.1 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -2, 2)
        beta[1:] = np.maximum(beta[1:], 0.0)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, weight): the bounded fitting sample, held-out ids left out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold(F.col("doc_id")) != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    picks = [known.where(F.col("toxic") == k).orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(SAMPLE).withColumn("weight", F.lit(max(1.0, total.get(k, 0) / SAMPLE))) for k in (0, 1)]
    chosen = picks[0].unionByName(picks[1]).withColumnRenamed("doc_id", "_id")
    # At most 2 * SAMPLE ids are broadcast, so only their texts are shuffled; an id that repeats gives one row, its smallest text.
    rows = docs.where("_text IS NOT NULL").join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    return rows.groupBy("_doc", "toxic", "weight").agg(F.min("_text").alias("_text")).select("_doc", "_text", "toxic", "weight")


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit the field in one task on the bounded sample."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_doc", "ascending"), ("_text", "ascending")])
        field = fit_field(table["_text"].to_pylist(), table["toxic"].to_numpy(), table["weight"].to_numpy())
        return pa.table({"model": pa.array([pickle.dumps(field)], pa.binary())})

    rows = training_sample(docs, labels).withColumn("_one", F.lit(1)).groupBy("_one").applyInArrow(run, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else fit_field([], np.zeros(0), np.zeros(0))


def score_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with _score and _spans (start and end byte of the UTF-8 text, marginal); names that are taken get more underscores."""
    bound_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).cast("binary").alias("_text"))
    model = docs.sparkSession.sparkContext.broadcast(fit(base, labels))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])
    # The caller's columns travel by place, so no name of theirs can clash with the text's.
    own = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(F.col(text_col).cast("binary").alias("text"), *[field(c).alias(n) for c, n in zip(docs.columns, own)])

    def run(batches):
        field = model.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            others = batch.drop_columns(["text"])
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size < _BATCH):
                    size += len(texts[j] or b"")
                    j += 1
                feats, bounds, start, end, begins = tokenize([t or b"" for t in texts[i:j]])
                p = marginals(field.weight[feats].sum(axis=0, dtype=np.float64) + field.bias, bounds, field.trans)
                x = _doc_features(p, bounds)
                score = 1 / (1 + np.exp(-np.clip(x @ field.doc, -30, 30)))
                spans: list[list] = [[] for _ in range(i, j)]
                hit = np.flatnonzero(p >= SPAN_AT)
                owner = np.searchsorted(bounds, hit, side="right") - 1
                last = -2
                for d, k in zip(owner.tolist(), hit.tolist(), strict=True):
                    a, b, own_spans = int(start[k] - begins[d]), int(end[k] - begins[d]), spans[d]
                    if own_spans and last == k - 1:
                        own_spans[-1] |= {"end": b, "p": max(own_spans[-1]["p"], float(p[k]))}
                    else:
                        own_spans.append({"start": a, "end": b, "p": float(p[k])})
                    last = k
                part = others.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score, pa.float64()), pa.array(spans, pa.list_(span))], names=[*part.schema.names, "_score", "_spans"])
                i = j

    kinds = [T.StructField(n, f.dataType, f.nullable) for n, f in zip(own, docs.schema.fields)]
    schema = T.StructType([*kinds, T.StructField("_score", T.DoubleType()), T.StructField("_spans", T._parse_datatype_string("array<struct<start: long, end: long, p: double>>"))])
    score, spans = free_name(docs, "_score"), free_name(docs, "_spans")
    return rows.mapInArrow(run, schema).toDF(*docs.columns, score, spans)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score and spans."""
    scored = score_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), labels)
    return scored.select("doc_id", F.col("_score").alias("score"), F.col("_spans").alias("spans"))


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("spans").alias("n_spans"))
