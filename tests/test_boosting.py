"""Boosted trees, their search and Shapley values, and joint k-means against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import boosting, learning, metrics, trees
from ebbtide.session import scratch

P = {**boosting.DEFAULTS, "min_rows": 5, "subsample": 1.0, "feature_share": 1.0}


def rows(n=400, width=4, seed=0):
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 9, (n, width)).astype(np.uint8)
    codes[rng.random((n, width)) < 0.15] = boosting.NULL
    y = ((codes[:, 0] > 4) ^ (codes[:, 1] == boosting.NULL) ^ (rng.random(n) < 0.1)).astype(float)
    return boosting.Rows(np.arange(n), codes, y, rng.choice([1.0, 2.0], n), np.zeros(n), np.zeros(n, bool))


def plain_gain(r, g, h, feature, cut, null_left, p):
    c = r.codes[:, feature]
    left = np.where(c == boosting.NULL, null_left, c <= cut)
    if left.sum() < p["min_rows"] or (~left).sum() < p["min_rows"]:
        return 0.0

    def worth(at):
        s = g[at].sum()
        return max(abs(s) - p["reg_alpha"], 0) ** 2 / (h[at].sum() + p["reg_lambda"])

    return worth(left) + worth(~left) - worth(np.ones(len(c), bool))


@pytest.mark.parametrize("alpha,lam", [(0.0, 0.0), (3.0, 7.0)])
def test_best_splits_equal_brute_force(alpha, lam):
    for seed in range(5):
        r, p = rows(seed=seed), {**P, "reg_alpha": alpha, "reg_lambda": lam}
        g, h = boosting.slopes(r.margin, r.y, r.w)
        hist = boosting.histogram(r.codes, np.zeros(len(r.y), int), 1, g, h)
        use = np.array([True, True, seed % 2 == 0, True])
        gain, f, b, null_left, left, right = boosting.best_splits(hist, use, p)
        every = {(k, c, s): plain_gain(r, g, h, k, c, s, p) for k in range(4) if use[k] for c in range(boosting.NULL) for s in (False, True)}
        assert gain[0] == pytest.approx(max(every.values())) and every[f[0], b[0], bool(null_left[0])] == pytest.approx(gain[0])
        goes = np.where(r.codes[:, f[0]] == boosting.NULL, null_left[0], r.codes[:, f[0]] <= b[0])
        assert left[0] == pytest.approx([g[goes].sum(), h[goes].sum(), goes.sum()]) and right[0, 2] == (~goes).sum()


def test_trees_hold_their_budget_and_lower_the_loss():
    r = rows(2000, 5)
    state = boosting.grow_rounds(r, {**P, "leaves": 6, "max_depth": 4, "rounds": 20, "step_size": 0.3, "subsample": 0.7, "feature_share": 0.6}, boosting.State(), 50, False)
    assert len(state.trees) == 20 and state.ended and state.losses[-1] < 0.6 * math.log(2)
    assert all(sum(f < 0 for f in t.feature) <= 6 for t in state.trees)
    for t in state.trees:  # covers add up
        for n, f in enumerate(t.feature):
            assert f < 0 or t.cover[n] == pytest.approx(t.cover[t.left[n]] + t.cover[t.right[n]])


def test_only_the_smaller_child_is_counted_and_its_sibling_is_the_rest():
    r, p = rows(3000, 5), {**P, "max_depth": 4}
    codes = np.asfortranarray(r.codes)
    g, h = boosting.slopes(r.margin, r.y, r.w)
    grown, at = boosting.Growing(p, 5, 0), {0: np.arange(3000)}
    while not grown.done():
        mine = [at[n] for n in grown.counted]
        assert grown.depth == 0 or 2 * sum(map(len, mine)) <= sum(len(at[n]) for n in grown.open)
        node = np.repeat(np.arange(len(mine)), [len(x) for x in mine])
        own = np.concatenate(mine)
        sums = boosting.histogram(codes, node, len(mine), g[own], h[own], own, grown.which)
        for n, hist in zip(grown.open, grown._whole(sums), strict=True):
            plain = boosting.histogram(r.codes[at[n]], np.zeros(len(at[n]), int), 1, g[at[n]], h[at[n]])[0]
            assert np.allclose(hist, plain, atol=1e-9) and (hist[plain[..., 2] == 0] == 0).all()
        grown.split(sums)
        boosting.divide(grown.tree, codes, at)
    assert all((grown.tree.nodes(r.codes[rows_]) == n).all() for n, rows_ in at.items())


def test_equal_gains_go_to_the_first_feature_in_any_row_order():
    r = rows(1500, 2, seed=3)
    own = np.minimum(r.codes[:, 0], 8)
    codes = np.column_stack([own, 8 - own, own])  # three features that part the rows alike
    y = r.y * np.linspace(0.1, 1, 1500)
    for seed in range(30):
        order = np.random.default_rng(seed).permutation(1500)
        g, h = boosting.slopes(r.margin, y, r.w * 0.37)
        hist = boosting.histogram(codes[order], np.zeros(1500, int), 1, g[order], h[order])
        assert boosting.best_splits(hist, np.array([False, True, True]), P)[1][0] == 1
        assert boosting.best_splits(hist, np.ones(3, bool), P)[1][0] == 0


def draw(k):
    return F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(1 << 20)) / float(1 << 20)


def frame(spark, n=3000, parts=6):
    return spark.range(0, n, 1, parts).select(
        "id", draw(1).alias("a"), F.when(draw(2) > 0.3, draw(3)).alias("b"), (F.col("id") % 7).cast("double").alias("c"), (draw(4) < 0.3).alias("held"),
    ).withColumn("churned", ((F.col("a") + F.coalesce("b", F.lit(0.9)) + 0.3 * draw(5)) > 1.2).cast("int")).withColumn("w", F.lit(1.0) + F.col("churned")).drop("id")


def table(spark, parts=6):
    df = frame(spark, parts=parts)
    return boosting.binned(df, ["a", "b", "c"], boosting.cut_points(df, ["a", "b", "c"]), "churned", "w", "held")


def same(a, b):
    assert len(a.trees) == len(b.trees) and a.losses == pytest.approx(b.losses)
    for s, t in zip(a.trees, b.trees, strict=True):
        assert (s.feature, s.bin, s.null_left, s.left) == (t.feature, t.bin, t.null_left, t.left) and s.value == pytest.approx(t.value)


def test_one_task_and_many_grow_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(boosting, "EVERY", 4)
    p = {**boosting.DEFAULTS, "rounds": 10, "step_size": 0.4, "max_depth": 3, "min_rows": 20}
    data = table(spark)
    one, many = (boosting.boost(data, 3, p, True, spread=s) for s in (False, True))
    same(one, many)
    assert len(one.losses) == 10 and one.losses[-1] < one.losses[0]


def test_a_fit_that_was_cut_off_goes_on(spark, monkeypatch):
    monkeypatch.setattr(boosting, "EVERY", 3)
    p = {**boosting.DEFAULTS, "rounds": 9, "step_size": 0.4, "max_depth": 2, "min_rows": 20}
    whole = boosting.boost(table(spark), 3, p, True)
    for spread in (False, True):
        path, save, calls = scratch(spark, "run"), boosting.save_state, []

        def cut_off(*args):
            save(*args)
            calls.append(1)
            if len(calls) == 2:
                raise KeyboardInterrupt

        monkeypatch.setattr(boosting, "save_state", cut_off)
        with pytest.raises(KeyboardInterrupt):
            boosting.boost(table(spark), 3, p, True, path, spread)
        monkeypatch.setattr(boosting, "save_state", save)
        assert len(boosting.load_state(spark, path).trees) == 6
        same(whole, boosting.boost(table(spark, parts=3), 3, p, True, path, spread))


def test_the_best_round_is_a_prefix(spark):
    df = spark.range(600).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(3) > 0.5).cast("int").alias("churned"), (F.col("id") % 2).alias("part")).cache()
    train, val = df.where("part = 0").drop("part"), df.where("part = 1").drop("part")
    p = {"max_depth": 2, "step_size": 0.5, "min_rows": 5, "subsample": 1.0}
    early = learning.fit_boosted(train, val, {**p, "patience": 3}).model
    long = learning.fit_boosted(train, val, {**p, "patience": 99, "rounds": len(early.trees)}).model
    assert early.trees == long.trees[: len(early.trees)] and 1 <= len(early.trees) < 60


def test_search_runs_every_setting_and_goes_on(spark):
    data, path = table(spark), scratch(spark, "search")
    trials = [{**boosting.DEFAULTS, "rounds": 15, "patience": 4, "step_size": s, "max_depth": 2, "min_rows": 10} for s in (0.01, 0.3, 0.6)]
    boosting.search(data, trials[:2], path).collect()
    out = {r["trial"]: r for r in boosting.search(data, trials, path).collect()}
    assert sorted(out) == [0, 1, 2] and out[0]["rounds"] == 15 and all(0.5 < r["auc_pr"] <= 1 for r in out.values())
    r = boosting.together(boosting.unpack(__import__("pyarrow").RecordBatch.from_pylist([x.asDict() for x in data.collect()])))
    state = boosting.grow_rounds(r, trials[1], boosting.State(), 15, True)
    best = state.best(4, True)
    assert out[1]["rounds"] == best and out[1]["loss"] == pytest.approx(state.losses[best - 1])


def test_a_setting_that_fails_leaves_the_others_written(spark):
    """Every setting is a job of its own, not one of a group that ends or fails together."""
    data, path = table(spark), scratch(spark, "search")
    trials = [{**boosting.DEFAULTS, "rounds": 4, "step_size": s, "max_depth": 2, "min_rows": 10} for s in (0.1, 0.3, 0.6)]
    broken = {k: v for k, v in trials[2].items() if k != "reg_alpha"}
    with pytest.raises(Exception, match="reg_alpha"):
        boosting.search(data, [*trials[:2], broken], path)
    assert sorted(r["trial"] for r in spark.read.parquet(f"{path}/trials").select("trial").collect()) == [0, 1]
    assert sorted(r["trial"] for r in boosting.search(data, trials, path).collect()) == [0, 1, 2]


def watched_rows(n, seed):
    r = rows(n, 6, seed)
    rng = np.random.default_rng(seed + 50)
    r.codes[:, 2], r.codes[:, 3] = rng.integers(0, boosting.NULL, n), rng.integers(0, 2, n)
    return boosting.Rows(rng.integers(-(2**62), 2**62, n), r.codes, r.y, r.w, r.margin, rng.random(n) < 0.4)


@pytest.mark.parametrize("cells", [1, 300, 1 << 14])
def test_rows_in_files_give_the_trees_of_rows_in_memory(monkeypatch, cells):
    monkeypatch.setattr(boosting, "PART", 500)
    monkeypatch.setattr(boosting, "CELLS", cells)
    p = {**P, "rounds": 25, "patience": 4, "step_size": 0.3, "subsample": 0.7, "subsample_every": 2, "feature_share": 0.7, "leaves": 20, "reg_alpha": 0.5, "reg_lambda": 1.0}
    for seed in range(3):
        r = watched_rows(3000, seed)
        blocks = [boosting.Rows(*[getattr(r, c)[a : a + 700] for c in boosting._BLOCK]) for a in range(0, 3000, 700)]
        filed = boosting.filed(iter(blocks))
        assert [len(x.y) for x in filed[0].parts()[:-1]] == [500] * (int((~r.held).sum()) // 500) and filed[0].n + filed[1].n == 3000
        state, ap = boosting.grow_filed(*filed, p)
        want = boosting.grow_rounds(r, p, boosting.State(), 25, True)
        same(state, want)
        assert state.ended == want.ended
        margin = sum(t.margins(r.codes[r.held]) for t in want.trees[: want.best(4, True)])
        assert ap == pytest.approx(boosting.average_precision(r.y[r.held], margin), abs=1e-12)


def test_precision_of_parts_is_that_of_all_rows(monkeypatch):
    monkeypatch.setattr(boosting, "PART", 64)
    rng = np.random.default_rng(8)
    for digits in (1, 2, 9):
        y, score = (rng.random(1000) < 0.2).astype(float), rng.normal(size=1000).round(digits)
        parts = [[x[a : a + 64].copy() for a in range(0, 1000, 64)] for x in (y, score)]
        assert boosting.precision_of_parts(*parts) == pytest.approx(boosting.average_precision(y, score), abs=1e-12)
    assert boosting.precision_of_parts([np.zeros(3)], [np.ones(3)]) == boosting.precision_of_parts([], []) == 0.0


def test_a_search_over_a_large_table_gives_the_same(spark, monkeypatch):
    data = table(spark)
    trials = [{**boosting.DEFAULTS, "rounds": 12, "patience": 4, "step_size": s, "max_depth": 3, "min_rows": 10} for s in (0.1, 0.5)]
    want = {r["trial"]: r for r in boosting.search(data, trials, scratch(spark, "search")).collect()}
    monkeypatch.setattr(boosting, "TOGETHER", 1000)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *_: pytest.fail("all rows are sent to every task"))
    got = {r["trial"]: r for r in boosting.search(data, trials, scratch(spark, "search")).collect()}
    assert sorted(got) == [0, 1]
    for i, r in got.items():
        assert (r["rounds"], r["loss"], r["auc_pr"]) == pytest.approx((want[i]["rounds"], want[i]["loss"], want[i]["auc_pr"]))


def test_settings_are_compared_on_all_rows(spark, monkeypatch):
    seen = []

    def search(data, trials, path):
        seen.append({r["held"]: r["n"] for r in data.selectExpr("hex(held) LIKE '%01%' AS held", "length(held) AS n").groupBy("held").agg(F.sum("n").alias("n")).collect()})
        return data.sparkSession.createDataFrame([(0, 1, 0.5, 0.5)], "trial int, rounds int, loss double, auc_pr double")

    monkeypatch.setattr(learning.boosting, "search", search)
    df = spark.range(230_000).select(draw(1).alias("a"), draw(2).alias("b"), (F.col("id") % 5 == 0).cast("int").alias("churned"))
    learning.tune(df, df.limit(210_000), 1)
    assert sum(seen[0].values()) == 440_000


def test_average_precision_counts_ties_together(spark, skewed):
    df, plain = skewed
    y, p = np.array([y for _, y, _ in plain]), np.array([p for *_, p in plain])
    assert boosting.average_precision(y, p) == pytest.approx(metrics.average_precision(df).first()["auc_pr"])


def test_tuned_settings_have_all_parameters(spark):
    trials = learning.draw_trials(40)
    assert all(0 <= t["reg_alpha"] <= 10 and 0 <= t["reg_lambda"] <= 10 and 20 <= t["leaves"] <= 300 for t in trials)
    df = frame(spark, 900)
    best, out = learning.tune(df.where("not held").drop("held", "w"), df.where("held").drop("held", "w"), 3, fixed={"rounds": 5})
    got = out.collect()
    assert len(got) == 3 and best["step_size"] == max(got, key=lambda r: (r["auc_pr"], -r["trial"]))["step_size"] and best["rounds"] == 5


# ---- Shapley values ------------------------------------------------------------------------------
def expectation(tree, codes, known, n=0):
    """Value of a tree when only the features in ``known`` are known."""
    f = tree.feature[n]
    if f < 0:
        return tree.value[n]
    left, right = tree.left[n], tree.right[n]
    if f in known:
        goes = tree.null_left[n] if codes[f] == boosting.NULL else codes[f] <= tree.bin[n]
        return expectation(tree, codes, known, left if goes else right)
    return sum(tree.cover[c] / tree.cover[n] * expectation(tree, codes, known, c) for c in (left, right))


def test_shapley_values_equal_the_sum_over_all_subsets():
    r = rows(1500, 4, seed=3)
    state = boosting.grow_rounds(r, {**P, "max_depth": 4, "leaves": 16, "rounds": 5, "step_size": 0.5}, boosting.State(), 9, False)
    assert max(len(t.feature) for t in state.trees) > 20
    codes = r.codes[:15]
    for tree in state.trees:
        out, paths = np.zeros((len(codes), 4)), trees.leaf_paths(tree)
        trees.shapley(paths, codes, out)
        for row, got in zip(codes, out, strict=True):
            for i in range(4):
                want = 0.0
                others = [j for j in range(4) if j != i]
                for size in range(4):
                    for s in itertools.combinations(others, size):
                        w = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                        want += w * (expectation(tree, row, {*s, i}) - expectation(tree, row, set(s)))
                assert got[i] == pytest.approx(want, abs=1e-12)
        assert out.sum(axis=1) + paths.expected == pytest.approx(tree.margins(codes))


def test_parts_made_once_for_every_way_equal_those_made_row_by_row(monkeypatch):
    r = rows(3000, 12, seed=5)
    r.y = ((r.codes[:, :6] > 4).sum(axis=1) + np.random.default_rng(1).random(3000) > 3.5).astype(float)
    for deepest in (3, 7, 9):  # the last one has leaves with more path features than are made once
        state = boosting.grow_rounds(rows(3000, 12, seed=5) if deepest == 3 else r, {**P, "max_depth": deepest, "leaves": 200, "rounds": 2, "min_rows": 2}, boosting.State(), 2, False)
        for tree in state.trees:
            out = []
            for most in (7, 0):
                monkeypatch.setattr(trees, "MASKED", most)
                out.append(np.zeros((3000, 12)))
                trees.shapley(trees.leaf_paths(tree), r.codes, out[-1])
            assert np.abs(out[0]).sum() > 0 and np.allclose(*out, rtol=0, atol=1e-13)


# ---- clusters ------------------------------------------------------------------------------------
def test_joint_starts_equal_single_ones(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.4, (80, 3)) for c in (0, 3, 6)])
    points = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").repartition(5).cache()
    seeds = trees._seeds(points, 3, 7, 4)
    centres, cost = trees.joint_lloyd(points, seeds)
    for s in range(4):
        c = seeds[s].copy()
        for _ in range(trees.PASSES):
            near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            c = np.array([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(3)])
        assert cost[s] == pytest.approx(((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum(), rel=1e-4)
        alone, one = trees.joint_lloyd(points, seeds[s : s + 1])
        assert one[0] == pytest.approx(cost[s], rel=1e-6)


def test_clusters_are_the_nearest_centres(spark):
    rng = np.random.default_rng(2)
    rows_ = [(i, [("a", float(v[0]), 0.0), ("b", float(v[1]), 0.0)]) for i, v in enumerate(np.concatenate([rng.normal(c, 0.2, (50, 2)) for c in (0, 5)]))]
    df = spark.createDataFrame(rows_, "id long, contributions array<struct<feature: string, contribution: double, value: double>>")
    out = {r["id"]: r["cluster"] for r in trees.cluster_contributions(df, k=2).collect()}
    assert len({out[i] for i in range(50)}) == 1 and len({out[i] for i in range(50, 100)}) == 1 and out[0] != out[99]


def test_nearest_centres_are_exact_where_distances_are_close():
    x = np.random.default_rng(4).normal(size=(500, 7)) * 1e3
    centres = np.concatenate([x[:3], x[:1], x[3:4] + 1e-9])  # two equal ones, and one beside a point
    assert (trees.nearest(x, centres) == ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert trees.nearest(x[:1], centres)[0] == 0
