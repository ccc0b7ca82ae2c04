"""Vector searches against brute force."""

import math

import numpy as np
import pytest

from ebbtide.llm import exact_topk, multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, score long"


def table(spark, n=900, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, dim)).astype(np.float32)
    x[5] = x[50]
    x[n // 2 : n // 2 + n // 3] = x[100]  # a third of all rows is one vector
    rows = [(i, v.tolist(), 0, 1) for i, v in enumerate(x)]
    odd = [(100000, None, 0, 1), (100100, [], 0, 1), (100200, [math.nan] * dim, 0, 1), (100300, [math.inf] * dim, 0, 1), (100400, [None] * dim, 0, 1), (100500, [0.0] * dim, 0, 1), (100600, [1.0, 2.0], 0, 1), (100601, [1.5, 2.0], 0, 1)]
    return spark.createDataFrame(rows + odd, SCHEMA).repartition(5), rows + odd


def usable(rows, zero):
    return [(i, np.array(v, float)) for i, v, *_ in rows if v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]


def test_inner_products_are_exact(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "CANDIDATES", 100)
    monkeypatch.setattr(exact_topk, "QUERIES", 4)
    df, rows = table(spark)
    got = {}
    for r in exact_topk.top_k(df).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    v = [(i, np.floor(256 * x).astype(int)) for i, x in usable(rows, True)]
    want = {}
    for i, q in v:
        if i % 50 == 0:
            best = sorted((-int(q @ x), j) for j, x in v if j != i and len(x) == len(q))[:5]
            if best:
                want[i] = {k: (j, -s) for k, (s, j) in enumerate(best, 1)}
    assert got == want and 100600 in got


@pytest.mark.parametrize("share,least", [(1.0, 1.0), (0.5, 0.85)])
def test_multi_index_recall(spark, monkeypatch, share, least):
    monkeypatch.setattr(multi_index, "ENTRIES", 64)
    monkeypatch.setattr(multi_index, "QUERIES", 3)
    monkeypatch.setattr(multi_index, "CENTROIDS", 8)
    monkeypatch.setattr(multi_index, "LEAST", 20)
    df, rows = table(spark)
    got = {}
    for r in multi_index.nearest(df, share=share).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    v = usable(rows, False)
    hits = total = 0
    for i, q in v:
        if i % 100:
            continue
        best = sorted((float(np.sqrt(((x - q) ** 2).sum())), j) for j, x in v if j != i and len(x) == len(q))[:10]
        own = sorted(got.get(i, []))
        assert [r for r, *_ in own] == list(range(1, len(own) + 1))
        assert [(s, j) for _, j, s in own] == sorted((s, j) for _, j, s in own)
        hits += len({j for _, j in best} & {j for _, j, _ in own})
        total += len(best)
    assert hits / total >= least and 100600 in got


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(0, None, 0, 1), (50, [], 0, 1)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert exact_topk.top_k(df).count() == 0 and multi_index.nearest(df).count() == 0


def test_large_scores_are_exact_or_an_error():
    """Products beyond 2**53 against Python's integers, and beyond 64 bits."""
    rng = np.random.default_rng(6)
    for size in (2**20, 2**28):
        x = rng.integers(-size, size, (200, 12))
        ids = np.arange(200)
        got = {q: (c.tolist(), s.tolist()) for q, c, s in exact_topk._search(np.ascontiguousarray(x.T), ids, x[:5], ids[:5], 4)}
        for q in range(5):
            scores = {c: sum(int(a) * int(b) for a, b in zip(x[q], x[c], strict=True)) for c in range(200) if c != q}
            best = sorted(scores, key=lambda c: (-scores[c], c))[:4]
            assert got[q] == (best, [scores[c] for c in best])
    big = np.full((3, 4), 2**32)
    with pytest.raises(OverflowError):
        list(exact_topk._search(big.T, np.arange(3), big[:1], np.arange(1), 2))


def shuffled_rows(df):
    """Rows written by the widest shuffle of the plan that ran."""
    df.collect()
    nodes, rows = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        kids = [node.finalPhysicalPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if node.nodeName() == "ShuffleQueryStage" else [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Exchange" and "REPARTITION" in node.simpleString(1000):
            rows.append(node.metrics().apply("shuffleRecordsWritten").value())
        nodes += kids
    return max(rows)


def test_rows_are_moved_once(spark, monkeypatch):
    """However many batches of queries pass, a row goes to one block, and a query once to each of its blocks."""
    monkeypatch.setattr(exact_topk, "CANDIDATES", 100)
    monkeypatch.setattr(multi_index, "ENTRIES", 100)
    monkeypatch.setattr(multi_index, "CENTROIDS", 8)
    df, rows = table(spark)
    n = len(usable(rows, True))
    queries = sum(i % 50 == 0 for i, _ in usable(rows, True))
    for size in (1, 512):
        monkeypatch.setattr(exact_topk, "QUERIES", size)
        monkeypatch.setattr(multi_index, "QUERIES", size)
        assert shuffled_rows(exact_topk.top_k(df)) == n + queries * 10
        assert n < shuffled_rows(multi_index.nearest(df, every=50)) < n + queries * 15


def test_rows_of_one_id_are_spread(spark, monkeypatch):
    """A third of all rows has one id: no block holds them all, and all of them are candidates."""
    monkeypatch.setattr(exact_topk, "CANDIDATES", 50)
    monkeypatch.setattr(multi_index, "ENTRIES", 50)
    monkeypatch.setattr(multi_index, "CENTROIDS", 4)
    rng = np.random.default_rng(8)
    rows = [(7 if i < 200 else i, rng.normal(0, 1, 8).tolist(), 0, 1) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    held, _, _ = exact_topk.placed(df, 50)
    assert held.where("id = 7").groupBy("_c").count().agg({"count": "max"}).first()[0] < 60
    x = [np.float32(v).astype(float) for _, v, *_ in rows]
    for found, every, score in (
        (exact_topk.top_k(df), 50, lambda a, b: int(np.floor(256 * a) @ np.floor(256 * b))),
        (multi_index.nearest(df, share=1.0), 100, lambda a, b: -float(np.sqrt(((a - b) ** 2).sum()))),
    ):
        got = {}
        for r in found.collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
        for i, *_ in rows[200:]:
            if i % every == 0:
                want = sorted((-score(x[i], v), j) for (j, *_), v in zip(rows, x, strict=True) if j != i)
                assert [j for _, j in sorted(got[i])] == [j for _, j in want[: len(got[i])]]
