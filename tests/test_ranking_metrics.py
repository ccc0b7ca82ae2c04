import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import business, metrics
from ebbtide.operators.ranking import hash_sample, quantiles, running_totals, with_position


def test_position_is_the_global_order(skewed):
    df, rows = skewed
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}
    got = with_position(df, F.col("p").desc(), F.col("id").asc(), total="n", sums=["y"]).collect()
    assert {r["id"]: r["position"] for r in got} == want and {r["n"] for r in got} == {len(rows)}
    so_far = np.cumsum([r[1] for r in sorted(rows, key=lambda r: (-r[2], r[0]))])
    assert all(r["cum_y"] == so_far[r["position"]] for r in got)


def test_running_totals_by_group_with_null_group(spark):
    df = spark.createDataFrame([(g, v, v + 1) for g in ("a", None, "b") for v in range(50)], "g string, v int, n int")
    got = running_totals(df, "v", ["n"], ["g"], descending=False).collect()
    assert len(got) == 150
    assert all(r["cum_n"] == (r["v"] + 1) * (r["v"] + 2) // 2 and r["all_n"] == 1275 for r in got)


def test_quantiles_match_numpy(spark, skewed):
    df, rows = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["y"]: r for r in quantiles(df, "p", probs, ["y"], [f"q{i}" for i in range(7)]).collect()}
    for y in (0, 1):
        v = np.array([r[2] for r in rows if r[1] == y])
        assert got[y]["n"] == len(v)
        assert [got[y][f"q{i}"] for i in range(7)] == pytest.approx(np.quantile(v, probs).tolist())
    assert quantiles(df.where("p > 5"), "p", [0.5]).first()["q50"] is None


def brute(rows):
    y, p = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        up = p >= t
        ap += (y[up].sum() / y.sum() - last) * y[up].mean()
        last = y[up].sum() / y.sum()
    return ap, auc


def test_all_metrics(skewed):
    df, rows = skewed
    ap, auc = brute(rows)
    m = metrics.all_metrics(df).first().asDict()
    assert set(m) == set(metrics.METRICS) and len(m) == 10
    assert m["auc_pr"] == pytest.approx(ap) and m["auc_roc"] == pytest.approx(auc)
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert m["precision_at_5pct"] == pytest.approx(np.mean([r[1] for r in order[:100]]))


def test_separable_and_one_class(spark):
    df = spark.createDataFrame([(i, int(i >= 80), 0.1 if i < 80 else 0.9) for i in range(100)], "id long, y int, p double")
    m = metrics.all_metrics(df).first()
    assert m["auc_pr"] > 0.95 and m["auc_roc"] == 1.0 and m["f1"] == 1.0
    none = metrics.all_metrics(df.withColumn("y", F.lit(0))).first()
    assert none["auc_pr"] is None and none["auc_roc"] is None and none["f1"] == 0.0 and none["lift_at_10pct"] == 0.0


@pytest.mark.parametrize("n", [1, 2, 7, 10, 95, 1003])
def test_decile_invariants(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 17 / 17).alias("p"))
    rows = metrics.decile_table(df).orderBy("decile").collect()
    assert sum(r["n_customers"] for r in rows) == n
    assert rows[-1]["cumulative_capture_rate"] == 1.0
    if n >= 95:
        want = np.bincount(np.maximum(1, np.ceil(10 * np.arange(n) / (n - 1)).astype(int)))[1:]
        assert [r["n_customers"] for r in rows] == want.tolist()


def test_best_threshold_prefers_the_lowest_on_ties(spark):
    df = spark.createDataFrame([(0, 1, 0.9), (1, 0, 0.8), (2, 1, 0.7), (3, 0, 0.1)], "id long, y int, p double")
    assert metrics.best_f1(df).first()["threshold"] == 0.7


def test_score_of_one_is_in_the_top_priority_tier(spark):
    df = spark.createDataFrame([(0, 1, 1.0), (1, 0, 0.6), (2, 0, 0.05)], "id long, y int, p double")
    assert {r["tier"]: r["n"] for r in metrics.priority_tiers(df, 0.3).collect()} == {"Critical": 2, "Low Risk": 1}


def test_business_arms(skewed):
    df, rows = skewed
    out = business.business_impact(df).collect()
    assert len(out) == 10
    top = [r[1] for r in sorted(rows, key=lambda r: (-r[2], r[0]))[:400]]
    m = next(r for r in out if r["strategy"] == "Model-guided" and r["capacity_pct"] == 0.2)
    assert (m["customers_contacted"], m["true_positives"]) == (400, sum(top))
    assert m["net_value_gbp"] == pytest.approx(sum(top) * 0.25 * 360 - 400 * 8)
    assert business.business_impact(df).where("strategy = 'Random baseline'").collect() == [r for r in out if r["strategy"] == "Random baseline"]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000)
    a, b = hash_sample(df, "id", 300), hash_sample(df.repartition(7), "id", 300)
    assert a.count() == 300 and a.exceptAll(b).count() == 0
    assert hash_sample(df, "id", 9999).count() == 5000
