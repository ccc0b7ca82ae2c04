"""Text quality by a sparse ensemble of rules over text statistics.

One pass over the texts counts statistics of each whole text (lengths, shares of character
classes, repetition of words and lines); everything after it reads that narrow table. A
random forest is grown on the labelled rows, every path from a root to a node becomes a
rule (a conjunction of bounds on statistics), and a logistic regression with a lasso
penalty keeps the few rules that matter. The kept rules are compiled into one Spark column,
so scoring is a projection.

Forest and regression are Spark's learners and run on all executors. The labelled rows
they read are bounded by ``SAMPLE`` per kind (ids chosen by hash, weighted back to the
label shares); with fewer, all are read. Rows whose crc32(id) leaves ``HELD_OUT`` modulo
``FOLDS`` are never read for fitting. Nothing but the text enters a score.

Edge cases: null, empty and word-free texts have statistics of zero and the score that the
rules give these; an id labelled more than once counts with its largest label, an id with
several texts with the one of the smallest statistics; repeated rows are scored alike;
without labels of both kinds every score is the share of label 1 (0 without labels). Long
texts are read in pieces cut at white space.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.words import _pieces
from ebbtide.session import bound_batches, scratch, settle, shuffle_width

SAMPLE = 100_000  # labelled ids of each kind that are read for fitting, as expected by their hash
FOLDS, HELD_OUT = 3, 1
TREES, DEPTH, LEAST = 24, 3, 5  # forest; LEAST labelled rows in a leaf
LASSO = 5e-4
SEED = 11

#: Bytes of each class; their counts are divided by the bytes of the text.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digits": b"0123456789", "stops": b".,;:", "cries": b"!?", "bars": b"|",
    "signs": b"#$%&*+=~^@_<>\\/", "brackets": b"()[]{}\"'`", "dashes": b"-", "spaces": b" \t\n\v\f\r", "beyond": bytes(range(128, 256)),
}
STATISTICS = ("words", "word_bytes", "longest_word", "different_words", "commonest_word", "repeated_next", "lines", "different_lines", "words_per_line", *CLASSES)
_CLASS = np.zeros((256, len(CLASSES)))
for _k, _bytes in enumerate(CLASSES.values()):
    _CLASS[list(_bytes), _k] = 1.0


def statistics(blob: bytes | None) -> list[float]:
    """STATISTICS of one text."""
    count: Counter[bytes] = Counter()
    n = same = letters = 0
    codes = np.zeros(256, np.int64)
    last = None
    for piece in _pieces(blob or b""):
        words = piece.split()
        codes += np.bincount(np.frombuffer(piece, np.uint8), minlength=256)
        if not words:
            continue
        count.update(words)
        n += len(words)
        letters += len(piece)
        same += sum(map(eq, words, words[1:])) + (words[0] == last)
        last = words[-1]
    if not n:
        return [0.0] * len(STATISTICS)
    lines = [x for x in blob.split(b"\n") if x]
    size = int(codes.sum())
    shape = [n, (size - codes[[9, 10, 11, 12, 13, 32]].sum()) / n, max(map(len, count)), len(count) / n, max(count.values()) / n, same / n, len(lines), len(set(lines)) / len(lines), n / len(lines)]
    return [float(x) for x in shape] + (codes @ _CLASS / size).tolist()


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, one column per statistic) of every row."""
    bound_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column("text")]
            values = np.array(rows, float).reshape(len(rows), len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(v) for v in values.T]], names=["doc_id", *STATISTICS])

    return base.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in STATISTICS))


@dataclass(frozen=True, order=True)
class Rule:
    """Bounds on statistics that all hold: (statistic, above, at most), None where open."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def column(self) -> Column:
        tests = [t for name, low, high in self.bounds for t in ((F.col(name) > low) if low is not None else None, (F.col(name) <= high) if high is not None else None) if t is not None]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    def __str__(self) -> str:
        return " and ".join(f"{'' if low is None else f'{low:g} < '}{name}{'' if high is None else f' <= {high:g}'}" for name, low, high in self.bounds)


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weights: dict[Rule, float]

    def margin(self) -> Column:
        out = F.lit(self.intercept)
        for rule, w in self.weights.items():
            out = out + F.when(rule.column(), w).otherwise(0.0)
        return out

    def column(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        return 1 / (1 + F.exp(-self.margin()))

    def matched(self) -> Column:
        """Texts of the rules that hold."""
        return F.array_compact(F.array(*[F.when(r.column(), F.lit(str(r))) for r in self.weights])) if self.weights else F.array().cast("array<string>")


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % FOLDS


def paths(nodes) -> list[Rule]:
    """Rules of all paths of trees, given as rows (tree, node, feature, threshold, left, right); of the two sides of a root only one."""
    trees: dict[int, dict[int, tuple]] = {}
    for tree, node, feature, threshold, left, right in nodes:
        trees.setdefault(tree, {})[node] = (feature, threshold, left, right)
    found = set()
    for tree in trees.values():
        stack: list[tuple[int, dict[int, tuple[float | None, float | None]]]] = [(0, {})]
        while stack:
            node, held = stack.pop()
            if held and not (len(held) == 1 and next(iter(held.values()))[1] is None):  # an open upper end is the complement of another rule
                found.add(Rule(tuple((STATISTICS[f], *held[f]) for f in sorted(held))))
            feature, threshold, left, right = tree[node]
            if left < 0:
                continue
            low, high = held.get(feature, (None, None))
            stack.append((left, {**held, feature: (low, threshold if high is None else min(high, threshold))}))
            stack.append((right, {**held, feature: (threshold if low is None else max(low, threshold), high)}))
    return sorted(found, key=lambda r: [(n, low is not None, low or 0.0, high is not None, high or 0.0) for n, low, high in r.bounds])


def training_rows(measured: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """(label, weight, statistics): one row per chosen labelled id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(F.max(label_col).cast("double").alias("label")).where(fold(F.col("doc_id")) != HELD_OUT)
    texts = measured.groupBy("doc_id").agg(F.min(F.struct(*STATISTICS)).alias("_s"))
    rows = settle(texts.join(known, "doc_id").select("doc_id", "label", "_s.*"))
    total = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    share = {y: min(1.0, SAMPLE / n) for y, n in total.items()}
    of = lambda pick: F.coalesce(*[F.when(F.col("label") == y, F.lit(pick(y))) for y in share], F.lit(0.0))
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    return rows.where(place < of(lambda y: share[y])).withColumn("weight", of(lambda y: 1 / share[y]))


def fit(measured: DataFrame, labels: DataFrame, label_col: str = "quality") -> RuleEnsemble:
    """Grow the forest, take its paths, and weigh them under the lasso."""
    rows = training_rows(measured, labels, label_col)
    total = {r["label"]: (r["n"], r["w"]) for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    if len(total) < 2:
        return RuleEnsemble(30.0 if 1.0 in total else -30.0, {})
    # Bags and sums follow the order of rows, so it is fixed; the rows are bounded by SAMPLE.
    data = rows.repartition(shuffle_width(rows.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    data = settle(data.select("label", "weight", array_to_vector(F.array(*STATISTICS)).alias("x"), *STATISTICS))
    least = max(1, min(LEAST, min(n for n, _ in total.values()) // 4))
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=least, featureSubsetStrategy="onethird", seed=SEED).fit(data)
    path = scratch(measured.sparkSession, "forest")
    forest.write().save(path)
    nodes = measured.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    nodes = nodes.select("treeID", "id", "split.featureIndex", F.get("split.leftCategoriesOrThreshold", F.lit(0)), "leftChild", "rightChild").collect()  # TREES * 2**DEPTH nodes at most
    rules = paths(map(tuple, nodes))
    if not rules:
        p = total[1.0][1] / (total[0.0][1] + total[1.0][1])
        return RuleEnsemble(float(np.log(p / (1 - p))), {})
    # Rows that the same rules match are one weighted row of the regression.
    held = data.select("label", "weight", F.array(*[r.column().cast("double") for r in rules]).alias("x"))
    held = settle(held.groupBy("label", "x").agg(F.sum("weight").alias("weight")).orderBy("label", "x").withColumn("x", array_to_vector("x")))
    lasso = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=200).fit(held)
    weights = {r: float(w) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w}
    return RuleEnsemble(float(lasso.intercept), weights)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, statistics, score, rules that hold) of every row."""
    measured = settle(measure(docs, id_col, text_col))
    model = fit(measured, labels, label_col)
    return measured.withColumn("score", model.column()).withColumn("rules", model.matched())


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
