"""Rule ensemble, presence-mask search and vector codes against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import presence_masks, rule_ensemble, vector_codes
from test_vectors import SCHEMA as VECTORS
from test_vectors import table

DOCS = "doc_id long, text string, score double, n long, tie string, term int, words string, label int, weight double, rules string, x int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 0.1, 1, "x", 1, "x", 1, 1.0, "x", 1) for i, t in rows], DOCS).repartition(4)


# ---- rule ensemble -------------------------------------------------------------------------------
def prose(rng):
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    return "\n".join(" ".join(word() for _ in range(rng.randint(4, 12))) + "." for _ in range(rng.randint(2, 9)))


def junk(rng):
    words = prose(rng).split()
    kind = rng.randrange(4)
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " ".join(w for w in words[:6] for _ in range(9))
    if kind == 2:
        return " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in words)
    return " | ".join(words)


def graded(spark, n=600):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.7)
        rows.append((i, prose(rng) if y else junk(rng)))
        labels.append((i, y, 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_quality_of_held_out_documents_and_edge_cases(spark):
    rows, labels = graded(spark)
    odd = [(9000, None), (9001, ""), (9002, " \n\t"), (None, "a b c"), (9003, "word " * 300_000), (3, rows[3][1]), (3, "another text of this id")]
    marks = labels + [(None, 1, 0), (5, None, 0), (7, 3, 0), (3, 0, 0), (100_000, 1, 1)]
    out = rule_ensemble.score_documents(docs(spark, rows + odd), spark.createDataFrame(marks, LABELS))
    digest = rule_ensemble.digest(out)
    assert digest.columns == ["doc_id", "held_out", "score", "predicted"] and dict(digest.dtypes)["held_out"] == "boolean"
    got = defaultdict(list)
    for r in digest.collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows) + len(odd) and len(got[3]) == 3
    truth = {i: y for i, y, _ in labels}
    held = [i for i in truth if i != 3 and got[i][0]["held_out"]]
    assert len(held) > 150 and sum(got[i][0]["predicted"] == truth[i] for i in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for rs in got.values() for r in rs)
    assert len({got[i][0]["score"] for i in (9000, 9001, 9002)}) == 1


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark):
    rows, labels = graded(spark, 300)
    score = lambda marks, texts: {r["doc_id"]: r["score"] for r in rule_ensemble.score_documents(texts, spark.createDataFrame(marks, LABELS)).collect()}
    held = {r["doc_id"] for r in docs(spark, rows).where(rule_ensemble.fold(F.col("doc_id")) == 1).collect()}
    flipped = [(i, 1 - y if i in held else y, 1) for i, y, _ in labels]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert score(labels, frame) == pytest.approx(score(flipped, frame), abs=1e-6)


@pytest.mark.parametrize("labels,want", [([], 0.0), ([(0, 1, 0), (2, 1, 0), (3, 1, 0)], 1.0), ([(0, 0, 0), (2, 0, 0), (3, 0, 0)], 0.0)])
def test_labels_of_one_kind_give_their_share(spark, labels, want):
    out = rule_ensemble.score_documents(docs(spark, [(i, "some text") for i in range(6)]), spark.createDataFrame(labels, LABELS))
    assert {round(r["score"], 6) for r in out.collect()} == {want}
    empty = rule_ensemble.score_documents(docs(spark, []), spark.createDataFrame(labels, LABELS))
    assert rule_ensemble.digest(empty).count() == 0


def plain_statistics(text):
    """The statistics by their definitions."""
    raw = (text or "").encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
    if not words:
        return [0.0] * len(rule_ensemble.STATISTICS)
    lines = [x for x in raw.split(b"\n") if x]
    count = Counter(words)
    out = [len(words), sum(map(len, words)) / len(words), max(map(len, words)), len(count) / len(words), max(count.values()) / len(words)]
    out += [sum(a == b for a, b in zip(words, words[1:])) / len(words), len(lines), len(set(lines)) / len(lines), len(words) / len(lines)]
    return out + [sum(b in c for b in raw) / len(raw) for c in rule_ensemble.CLASSES.values()]


@pytest.mark.parametrize("text", [None, "", "  \n ", "one", "One two two,\ntwo\n\nOne two two,", "ÉA è|x! 12-3 #$ (y)\t\x0bz", "ab cd " * 400_000 + "cd cd"])
def test_statistics_by_definition(text):
    assert rule_ensemble.statistics(None if text is None else text.encode()) == pytest.approx(plain_statistics(text))


def test_paths_and_compiled_rules_follow_the_trees(spark):
    # One tree: words <= 10 ? (lower <= 0.5 ? leaf : leaf) : (words <= 20 ? leaf : leaf)
    lower = rule_ensemble.STATISTICS.index("lower")
    nodes = [(0, 0, 0, 10.0, 1, 2), (0, 1, lower, 0.5, 3, 4), (0, 2, 0, 20.0, 5, 6), *[(0, k, -1, None, -1, -1) for k in (3, 4, 5, 6)], (1, 0, -1, None, -1, -1)]
    rules = rule_ensemble.paths(nodes)
    want = {"words <= 10", "words <= 10 and lower <= 0.5", "words <= 10 and 0.5 < lower", "10 < words <= 20"}  # what lies above 20 alone is their complement
    assert {str(r) for r in rules} == want
    model = rule_ensemble.RuleEnsemble(0.25, {r: 0.5 + k for k, r in enumerate(rules)})
    rows = [(float(w), x) for w in (0, 10, 11, 20, 21) for x in (0.2, 0.5, 0.7)]
    for r in spark.createDataFrame(rows, "words double, lower double").select("*", model.column().alias("p"), model.matched().alias("m")).collect():
        holds = [all((low is None or r[n] > low) and (high is None or r[n] <= high) for n, low, high in rule.bounds) for rule in rules]
        margin = 0.25 + sum(w for w, h in zip(model.weights.values(), holds) if h)
        assert r["p"] == pytest.approx(1 / (1 + math.exp(-margin))) and r["m"] == [str(x) for x, h in zip(rules, holds) if h]


# ---- presence masks ------------------------------------------------------------------------------
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERMS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_rank(rows, items, k=20):
    corpus = [(i, Counter(plain_terms(t))) for i, t in rows if plain_terms(t)]
    n_docs, words = len(corpus), sum(c.total() for _, c in corpus)
    df = Counter(t for _, c in corpus for t in c)
    out = {}
    for item, text in items:
        scored = []
        for doc, c in corpus:
            m = 100 - 25 + (25 * c.total() * n_docs) // words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in plain_terms(text) if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out[item] = [(r, None if gone else doc, -s) for r, (s, gone, doc) in enumerate(sorted(scored)[:k], 1)]
    return {i: r for i, r in out.items() if r}


def searched(spark, n=1500):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdeÉéß9Z") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    text = lambda a, b: "".join(rng.choice(vocabulary[: rng.choice([8, 40, 120])]) + rng.choice([" ", "-", ",\n", "\x00"]) for _ in range(rng.randint(a, b)))
    same = text(20, 20)
    rows = [(i, same if i % 3 == 0 else text(0, 60)) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " ,;"), (None, text(30, 30)), (7, rows[7][1]), (n + 3, text(9, 9) + "é" * 700_000 + " " + text(50, 50) + same)]
    items = [(i, text(1, 90)) for i in range(25)] + [(100, None), (101, "..."), (102, "nowhere unseen"), (103, same + " " + same), (104, " ".join(vocabulary))]
    return rows, items


ITEMS = "item_id long, text string, doc_id long, n int"


@pytest.mark.parametrize("asked,docs_in_block", [(1 << 18, 1 << 15), (60, 64)])
def test_ranked_search_is_exact(spark, monkeypatch, asked, docs_in_block):
    monkeypatch.setattr(presence_masks, "ASKED", asked)
    rows, items = searched(spark)
    monkeypatch.setattr(presence_masks, "DOCS", docs_in_block)
    asked_items = spark.createDataFrame([(i, t, 1, 1) for i, t in items] + [(103, "zzz later text", 1, 1)], ITEMS)
    got = defaultdict(list)
    for r in presence_masks.rank(docs(spark, rows), asked_items).orderBy("item_id", "rank").collect():
        got[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    want = plain_rank(rows, [(i, min(t, "zzz later text") if i == 103 else t) for i, t in items])
    assert got == want and 104 in got and 100 not in got


def test_masks_are_transposed_bitmaps_and_few_documents_are_scored():
    rng = np.random.default_rng(0)
    held = rng.random((130, 200)) < 0.3
    rows = presence_masks.masks([np.packbits(h, bitorder="little") for h in held], 200)
    assert rows.shape == (200, 3) and all(bool((int(rows[d, t // 64]) >> (t % 64)) & 1) == held[t, d] for t in range(130) for d in range(200))
    present, order, first = presence_masks._groups(rows, 130)
    assert sorted(order.tolist()) == list(range(200)) and (np.repeat(present, np.diff(first, append=200), axis=0) == held.T[order]).all()
    # A rare heavy term in 30 of 20,000 documents and a common light one: the masks without the rare term are never scored.
    n = 20_000
    lists = [[0, 1] if d % 600 == 0 else [1] for d in range(n)]
    ends, term = np.append(0, np.cumsum([len(x) for x in lists])), np.array([t for x in lists for t in x], np.int32)
    block = presence_masks.Block(np.full(n, 10), ends, term, np.ones(len(term), np.int32), n, 10 * n)
    best = presence_masks.Best(20)
    scored = presence_masks.search(block, np.array([0, 1], np.int32), np.array([6000, 1]), best, list(range(n)), np.zeros(n, np.int64))
    assert scored < 100 and sorted(d for _, d, _ in best.rows()) == [600 * k for k in range(20)]


def test_search_in_empty_tables(spark):
    none, some = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "abc")], "item_id long, text string")
    for texts in ([], [(1, None), (2, "...")], [(1, "abc")]):
        assert presence_masks.rank(docs(spark, texts), none).count() == 0
    assert presence_masks.rank(docs(spark, []), some).count() == 0
    assert presence_masks.rank(docs(spark, [(1, None)]), some).columns == ["item_id", "rank", "doc_id", "score"]


# ---- vector codes --------------------------------------------------------------------------------
def plain_codes(rows):
    """Codes, errors and codebooks of one vector length by loops over Python integers."""
    whole = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label, _ in rows]
    width = -(-len(whole[0][1]) // 8)
    cut = [[(v + [0] * (8 * width - len(v)))[p * width : (p + 1) * width] for p in range(8)] for _, v, _ in whole]
    first = {}
    for k, (i, v, _) in enumerate(whole):
        if i not in first or v < whole[first[i]][1]:
            first[i] = k
    seeds = sorted(first, key=lambda i: (i is None, i))[:16]
    books = [[list(cut[first[i]][p]) for i in seeds] for p in range(8)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(8)] for c in cut]

    for _ in range(6):
        for p in range(8):
            groups = defaultdict(list)
            for c, found in zip(cut, assign()):
                groups[found[p][1]].append(c[p])
            books[p] = [[sum(x) // len(x) for x in zip(*groups[k])] if groups[k] else e for k, e in enumerate(books[p])]
    found = assign()
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return [(i, label, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), digest) for (i, _, label), f in zip(whole, found)]


@pytest.mark.parametrize("dim", [16, 12])
def test_codes_match_plain_integers(spark, dim):
    _, rows = table(spark, n=150, dim=dim, seed=4)
    rows = [(i, v, [0, 1, None][j % 3], 1) for j, (i, v, *_) in enumerate(rows)]
    rows += [rows[3], (None, rows[4][1], 1, 1), (0, rows[9][1], 5, 1)]
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], VECTORS + ", code string, error long, _v int").repartition(3)
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    want = [row for n in {len(r[1]) for r in good} for row in (plain_codes([r for r in good if len(r[1]) == n]) if n else [(r[0], r[2], "00" * 8, 0, hashlib.sha256(b"").hexdigest()) for r in good if not r[1]])]
    label_error = Counter()
    for _, label, _, error, _ in want:
        label_error[label] += error
    key = lambda r: tuple((x is None, x) for x in r)
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vector_codes.digest(vector_codes.encode(df)).collect()]
    full = [(i, code, error, label_error[label], digest) for i, label, code, error, digest in want]
    assert sorted(got, key=key) == sorted(full, key=key)


@pytest.mark.parametrize("width", [0, 1, 3, 8, 13])
def test_nearest_entries_through_the_transform(width):
    rng = np.random.default_rng(width)
    for entries in (1, 5, 16):
        for spread in (2, 1 << 20):
            x, c = rng.integers(-spread, spread, (300, width)), rng.integers(-spread, spread, (entries, width))
            far = ((x[:, None] - c[None]) ** 2).sum(axis=2)
            index, error = vector_codes.nearest(x, c)
            assert (index == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()


def test_transform_is_the_hadamard_matrix_in_sequency_order():
    for n in (1, 2, 4, 8, 32):
        h = vector_codes.hadamard(n)
        assert [(np.diff(row) != 0).sum() for row in h] == list(range(n)) and (h @ h.T == n * np.eye(n)).all()
        x = np.random.default_rng(n).integers(-99, 99, (7, n))
        assert (vector_codes.transform(x) == x @ h.T).all()


def test_codes_of_empty_tables_and_large_components(spark):
    for rows in ([], [(1, None, 1, 1), (2, [math.nan], 1, 1), (3, [None, 1.0], 1, 1)]):
        assert vector_codes.encode(spark.createDataFrame(rows, VECTORS)).count() == 0
    with pytest.raises(ValueError, match="too large"):
        vector_codes.encode(spark.createDataFrame([(1, [40000.0] * 64, 1, 1)], VECTORS))
