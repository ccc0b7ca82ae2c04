import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import attribution, drift, hazards, learning, survival, trees, uplift
from ebbtide.plans import training
from ebbtide.session import scratch


@pytest.fixture(scope="module")
def lifetimes(spark):
    rng = np.random.default_rng(5)
    n = 300
    x, z = rng.normal(size=n), rng.integers(0, 2, n)
    t = np.maximum(1, np.round(rng.exponential(30 / np.exp(0.8 * x - 0.5 * z)))).astype(int)
    e = (rng.random(n) < 0.7).astype(int)
    rows = [(i, int(a), int(b), float(c), int(g)) for i, (a, b, c, g) in enumerate(zip(t, e, x, z))]
    return spark.createDataFrame(rows, "id long, duration int, event int, x double, z int").cache(), t, e, np.column_stack([x, z.astype(float)])


def efron(t, e, x, beta):
    """Gradient of the Efron log-likelihood by its definition."""
    theta, grad, ll = np.exp(x @ beta), np.zeros(x.shape[1]), 0.0
    for day in np.unique(t[e == 1]):
        risk, dead = t >= day, (t == day) & (e == 1)
        d = dead.sum()
        ll += (x[dead] @ beta).sum()
        grad += x[dead].sum(axis=0)
        for k in range(d):
            w = theta * risk - k / d * theta * dead
            ll -= math.log(w.sum())
            grad -= (w[:, None] * x).sum(axis=0) / w.sum()
    return ll, grad


def test_cox_solves_the_penalised_efron_equations(lifetimes):
    df, t, e, x = lifetimes
    for pen in (0.0, 0.1):
        m = hazards.fit_cox(df, ["x", "z"], penalizer=pen)
        std = x.std(axis=0, ddof=1)
        s = (x - x.mean(axis=0)) / std
        beta = m.coef * std
        ll, grad = efron(t, e, s, beta)
        assert m.log_likelihood == pytest.approx(ll)
        assert np.abs(grad / len(t) - pen * beta).max() < 1e-6
    assert m.coef[0] > 0.2 and len(m.ph) == 2 and all(0 <= p <= 1 for _, _, p in m.ph)


def test_cox_predictions(spark, lifetimes):
    df, t, e, x = lifetimes
    m = hazards.fit_cox(df, ["x", "z"])
    rows = df.select("x", "z", m.churn_probability(20).alias("p"), m.median_lifetime().alias("med")).collect()
    h = m.baseline_h[np.searchsorted(m.baseline_t, 20, side="right") - 1]
    for r in rows[:20]:
        lp = (r["x"] - m.mean[0]) * m.coef[0] + (r["z"] - m.mean[1]) * m.coef[1]
        assert r["p"] == pytest.approx(1 - math.exp(-h * math.exp(lp)))
        over = m.baseline_t[np.exp(-m.baseline_h * math.exp(lp)) <= 0.5]
        assert r["med"] == (over[0] if len(over) else m.baseline_t[-1])


@pytest.mark.parametrize("risk,tied,d", [(10.0, 3.0, 1), (5000.0, 4999.0, 4000), (1e7, 3e5, 250000), (3e6, 2e6, hazards.TIE_CHUNK + 7)])
def test_tie_sums(risk, tied, d):
    w = np.arange(d) / d
    s = risk - tied * w
    want = (np.log(s).sum(), (1 / s).sum(), (w / s).sum(), (1 / s**2).sum(), (w / s**2).sum(), (w**2 / s**2).sum())
    assert hazards.tie_sums(risk, tied, d) == pytest.approx(want, rel=1e-10)


@pytest.mark.parametrize("pen,ratio", [(0.05, 0.5), (0.15, 1.0)])
def test_elastic_net_cox_meets_its_optimality_conditions(lifetimes, pen, ratio):
    df, t, e, x = lifetimes
    m = hazards.fit_cox(df, ["x", "z"], penalizer=pen, l1_ratio=ratio)
    std = x.std(axis=0, ddof=1)
    beta = m.coef * std
    _, grad = efron(t, e, (x - x.mean(axis=0)) / std, beta)
    left = grad / len(t) - pen * (1 - ratio) * beta
    for b, g in zip(beta, left, strict=True):
        assert abs(g) <= pen * ratio + 1e-6 if b == 0 else g == pytest.approx(math.copysign(pen * ratio, b), abs=1e-6)


@pytest.mark.parametrize("steps", [4, 1000])
def test_concordance_by_pairs(lifetimes, steps):
    df, t, e, x = lifetimes
    r = np.floor(x[:, 0] * steps)
    con = tie = pairs = 0
    for i in np.flatnonzero(e == 1):
        other = (t > t[i]) | ((t == t[i]) & (e == 0))
        pairs += other.sum()
        con += (other & (r < r[i])).sum()
        tie += (other & (r == r[i])).sum()
    got = hazards.concordance(df, F.floor(F.col("x") * steps)).first()
    assert (got["concordant"], got["tied"], got["pairs"]) == (con, tie, pairs)
    assert got["c_index"] == pytest.approx((con + tie / 2) / pairs)


def test_fractional_durations_are_whole_days(spark):
    df = spark.range(3000).select((F.col("id") / 1000).alias("duration"), (F.col("id") % 2).alias("event"), F.rand(1).alias("x"))
    model = hazards.fit_cox(df, ["x"])
    assert model.baseline_t.tolist() == [1.0, 2.0] and 0 <= model.concordance(df).first()["c_index"] <= 1


def test_kaplan_meier_by_hand(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (3, 1), (3, 1)], "duration int, event int")
    rows = survival.kaplan_meier(df).orderBy("t").collect()
    assert [(r["t"], r["at_risk"], r["d"]) for r in rows] == [(1.0, 5, 2), (2.0, 3, 0), (3.0, 2, 2)]
    assert [r["survival"] for r in rows] == pytest.approx([0.6, 0.6, 0.0])
    assert rows[0]["ci_lo"] < 0.6 < rows[0]["ci_hi"]
    assert survival.median_survival(survival.kaplan_meier(df)).first().asDict() == {"t": 3.0, "kind": "median"}
    p = survival.logrank_p(spark.createDataFrame([(i % 9 + 1, 1, i % 2) for i in range(60)], "duration int, event int, g int"), "g").first()
    assert 0 < p["p_value"] <= 1 and p["p_value"] == pytest.approx(math.erfc(math.sqrt(p["statistic"] / 2)))


@pytest.fixture(scope="module")
def boosted(spark):
    df = spark.range(1500).select(
        F.concat(F.lit("c"), "id").alias("unique_customer_identifier"), F.rand(1).alias("a"), F.when(F.rand(2) > 0.2, F.rand(3)).alias("b"), F.lit(F.col("id") % 5).cast("double").alias("c"),
    ).withColumn("churned", (F.col("a") + F.coalesce("b", F.lit(0.9)) > 1.1).cast("int")).cache()
    return df, learning.fit_boosted(df, params={"rounds": 6, "max_depth": 3, "step_size": 0.3, "min_rows": 10})


def test_tree_contributions_add_up_to_the_margin(boosted):
    df, model = boosted
    assert model.features == ["a", "b", "c"]  # NULL is a branch, not a column
    scored = model.score(df)
    assert not [c for c in scored.columns if c.startswith("_") or c.endswith("_is_null")]
    out = trees.tree_contributions(scored, model, ["unique_customer_identifier", "p"])
    total = F.aggregate("contributions", F.lit(0.0), lambda s, c: s + c["contribution"])
    for r in out.select("p", "margin", "bias", total.alias("s")).limit(200).collect():
        assert r["margin"] == pytest.approx(r["s"] + r["bias"])
        assert r["p"] == pytest.approx(1 / (1 + math.exp(-r["margin"])))
    assert learning.importance(model, df.sparkSession).orderBy("rank").first()["feature"] in ("a", "b")
    clusters = trees.cluster_contributions(out, k=3)
    assert clusters.select("cluster").distinct().count() <= 3
    profile = attribution.cluster_profile(clusters).collect()
    assert sum(r["share"] for r in profile) == pytest.approx(1.0)


def test_missing_feature_scores_as_zero(boosted):
    df, model = boosted
    a = model.score(df.drop("c")).agg(F.sum("p")).first()[0]
    assert a == pytest.approx(model.score(df.withColumn("c", F.lit(0.0))).agg(F.sum("p")).first()[0])


def test_best_round_and_patience():
    assert learning.best_round([5.0, 4.0, 3.0, 3.0, 3.5], 2) == (3, True)
    assert learning.best_round([5.0, 4.0, 3.0, 3.5], 2) == (3, False)


def test_boosting_stops_by_patience(spark):
    df = spark.range(400).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(3) > 0.5).cast("int").alias("churned"), (F.col("id") % 2).alias("part")).cache()
    train, val = df.where("part = 0").drop("part"), df.where("part = 1").drop("part")
    model = learning.fit_boosted(train, val, {"patience": 2, "max_depth": 2, "step_size": 0.5, "min_rows": 5})
    assert 1 <= model.model.getNumTrees <= 12 < learning.BOOSTING["rounds"]  # pure noise: 1,000 rounds never run


def test_a_loaded_run_scores_alike(boosted, tmp_path):
    df, model = boosted
    calibrator = learning.calibrate(model.score(df), y="churned")
    model.save(f"{tmp_path}/churn")
    calibrator.save(f"{tmp_path}/calibrator")
    again, mapped = training.load_run(df.sparkSession, str(tmp_path))
    a, b = (c.apply(m.score(df)).agg(F.sum("p"), F.sum("calibrated")).first() for m, c in ((model, calibrator), (again, mapped)))
    assert tuple(a) == pytest.approx(tuple(b)) and again.features == model.features


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_calibration_is_monotone_and_in_range(skewed, method):
    df, _ = skewed
    cal = learning.calibrate(df, method)
    rows = cal.apply(df).select("p", "calibrated").distinct().orderBy("p").collect()
    v = [r["calibrated"] for r in rows]
    assert all(0 <= x <= 1 for x in v) and all(b >= a - 1e-12 for a, b in zip(v, v[1:]))
    if method == "isotonic":
        mean = cal.apply(df).agg(F.avg("calibrated"), F.avg("y")).first()
        assert mean[0] == pytest.approx(mean[1], abs=1e-6)
    with pytest.raises(ValueError):
        learning.calibrate(df, "other")


def test_random_search_is_seeded_and_within_bounds():
    a, b = learning.draw_trials(30), learning.draw_trials(30)
    assert a == b
    assert all(0.005 <= t["step_size"] <= 0.3 and 20 <= t["min_rows"] <= 500 and 0.5 <= t["subsample"] <= 1 and 2 <= t["max_depth"] <= 10 for t in a)


def test_gates(spark):
    runs = spark.createDataFrame([("champion", 1, "auc_pr", 0.40), ("champion", 2, "auc_pr", 0.44), ("challenger", 1, "auc_pr", 0.435)], "role string, logged_at int, metric string, value double")
    assert learning.promote_gate(runs).first()["promote"]
    assert not learning.promote_gate(runs.withColumn("value", F.when(F.col("role") == "challenger", 0.42).otherwise(F.col("value")))).first()["promote"]
    assert learning.promote_gate(runs.where("role = 'challenger'")).first()["champion"] == 0.0
    ages = spark.sql("SELECT 'a' AS model, DATE'2024-01-01' AS tuned_at UNION ALL SELECT 'b', DATE'2024-01-02' UNION ALL SELECT 'c', NULL")
    assert {r["model"]: r["action"] for r in learning.retune_gate(ages, "2024-01-29").collect()} == {"a": "full_tune", "b": "quick_refit", "c": "full_tune"}


def test_psi_against_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=800), rng.normal(0.4, 1.2, size=500)
    edges = np.linspace(a.min(), a.max(), 11)
    edges[0], edges[-1] = -np.inf, np.inf
    r, c = (np.histogram(v, edges)[0] / len(v) + 1e-4 for v in (a, b))
    want = ((c - r) * np.log(c / r)).sum()
    ref = spark.createDataFrame([(float(v), 1.0) for v in a] + [(None, 1.0), (float("nan"), 1.0)], "v double, k double")
    cur = spark.createDataFrame([(float(v), 1.0) for v in b], "v double, k double")
    got = {x["feature"]: x["psi"] for x in drift.psi(ref, cur).collect()}
    assert got["v"] == pytest.approx(want) and got["k"] == pytest.approx(0.0)
    assert drift.psi(ref, ref, ["v"]).first()["psi"] == pytest.approx(0.0)
    assert drift.psi(ref, cur.where("v > 99"), ["v"]).first()["psi"] == 0.0
    grid = np.sort(np.concatenate([a, b]))
    d = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert drift.ks(ref, cur, ["v"]).first()["statistic"] == pytest.approx(d)


def test_severity_levels(spark):
    rows = [(False, 0.0, "", 0), (True, 0.25, "", 0), (False, 0.1, "a", 1), (True, 0.5, "a", 1), (False, 0.1, "a, b, c, d", 4)]
    df = spark.createDataFrame(rows, "drift_detected boolean, drift_share double, psi_alerts string, n_alerts int")
    out = drift.severity(df).collect()
    assert [r["severity"] for r in out] == ["info", "warning", "warning", "critical", "critical"]
    assert out[1]["message"].split("\n")[:2] == ["Drift detected: Yes", "Drifted feature share: 25.0%"]


def test_uplift_bands(spark):
    df = spark.createDataFrame([(0.06,), (0.05,), (-0.05,), (-0.06,)], "u double")
    assert [r[0] for r in df.select(uplift.uplift_segment(F.col("u"))).collect()] == ["Persuadable", "Neutral", "Neutral", "Do Not Disturb"]


@pytest.mark.parametrize("boosted_arms", [True, False])
def test_uplift_is_fitted_on_one_frame_and_scores_another(spark, boosted_arms):
    from pyspark.ml.classification import LogisticRegression

    df = spark.range(800).select("id", F.rand(1).alias("x"), (F.col("id") % 2).cast("int").alias("contacted")).withColumn("retained", (F.col("x") + 0.4 * F.col("contacted") > 0.7).cast("int")).cache()
    est = None if boosted_arms else LogisticRegression(maxIter=50)
    model = uplift.fit_uplift(df, ["x"], est, params={"rounds": 5, "max_depth": 2, "min_rows": 10, "step_size": 0.5})
    new = spark.createDataFrame([(1, 0.5), (2, 0.95)], "id long, x double")
    got = {r["id"]: r for r in model.score(new).collect()}
    assert got[1]["uplift_segment"] == "Persuadable" and got[1]["uplift_score"] > got[2]["uplift_score"]


def test_registered_search_is_whole(monkeypatch):
    """mdl_tune and mdl_train search with the library's own trials and rounds."""
    import inspect
    from types import SimpleNamespace

    from ebbtide.catalog import models
    from ebbtide.plans import training

    calls = {}

    def record(name, fn, result):
        def call(*args, **kwargs):
            bound = inspect.signature(fn).bind(*args, **kwargs)
            bound.apply_defaults()
            calls[name] = bound.arguments
            return result
        return call

    monkeypatch.setattr(models.learning, "tune", record("tune", models.learning.tune, ({}, None)))
    monkeypatch.setattr(models.training, "train", record("train", training.train, SimpleNamespace(metrics=None)))
    for name, value in (("parts", SimpleNamespace(train=None, val=None)), ("features", (None, None)), ("scratch", ""), ("rounded", None)):
        monkeypatch.setattr(models, name, lambda *_, value=value: value)
    d = SimpleNamespace(spark=None)
    models.mdl_tune(d)
    models.mdl_train(d)
    assert calls["tune"]["n_trials"] == calls["train"]["n_trials"] == 50
    assert not calls["tune"]["fixed"] and not calls["train"]["fixed"]


def test_weibull_solves_its_penalised_score_equations(spark):
    """Compared with the likelihood written out row by row; models come back as they were saved."""
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), max(1, int(math.exp(5 + 0.5 * a - 0.2 * b + 0.4 * math.log(-math.log(rng.uniform()))))), int(rng.uniform() < 0.7), 7.0) for a, b in rng.normal(size=(300, 2))]
    df = spark.createDataFrame(rows, "a double, b double, duration int, event int, same double")
    x = np.array([r[:2] for r in rows])
    t, e = (np.array([r[k] for r in rows], float) for k in (2, 3))

    def objective(intercept, a, b, scale, penalizer):
        z = (np.log(t) - intercept - x @ [a, b]) / scale
        return (e * (z - math.log(scale)) - np.exp(z)).mean() - penalizer / 2 * ((np.array([a, b]) * x.std(axis=0, ddof=1)) ** 2).sum()

    spread = []
    for penalizer in (0.0, 0.5):
        m = hazards.fit_weibull(df, ["a", "b", "same"], penalizer=penalizer)
        assert m.coef[2] == 0
        best = [m.intercept, *m.coef[:2], m.scale]
        for k in range(4):
            for h in (-1e-3, 1e-3):
                other = list(best)
                other[k] += h
                assert objective(*other, penalizer) < objective(*best, penalizer)
            up, down = ([v + (h if j == k else 0) for j, v in enumerate(best)] for h in (1e-5, -1e-5))
            assert abs(objective(*up, penalizer) - objective(*down, penalizer)) / 2e-5 < 1e-6
        spread.append(abs(m.coef[0]))
        path = scratch(spark, "weibull")
        m.save(spark, path)
        assert hazards.WeibullModel.load(spark, path) == m
    assert spread[1] < spread[0]
    got = df.select(m.median_lifetime().alias("d")).collect()
    assert np.allclose([r["d"] for r in got], np.exp(m.intercept + x @ m.coef[:2]) * math.log(2) ** m.scale)
    cox = hazards.fit_cox(df, ["a", "b"])
    path = scratch(spark, "cox")
    cox.save(spark, path)
    again = hazards.CoxModel.load(spark, path)
    pick = lambda model: [tuple(r) for r in df.select(model.churn_probability(90), model.median_lifetime()).collect()]
    assert pick(again) == pick(cox) and [tuple(r) for r in again.summary(spark).collect()] == [tuple(r) for r in cox.summary(spark).collect()]


def test_the_projection_builds_its_own_snapshot_only(spark, monkeypatch):
    from conftest import SMALL
    from ebbtide.catalog import QUERIES, models

    monkeypatch.setattr(models, "written_matrix", lambda d: pytest.fail("all snapshots were written"))
    out = QUERIES["mdl_pca"](spark, SMALL).collect()
    assert len(out) == 10 and {r["feature"] for r in out} <= set(models.PCA_COLUMNS)


def test_scoring_with_a_saved_run_builds_no_training_matrix(spark, monkeypatch):
    from conftest import SMALL
    from ebbtide.catalog import models
    from ebbtide.sources.starschema import StarSchema

    scratch(spark, "run")  # the shared folder has its name from here on
    first = models.scr_batch(StarSchema(spark, SMALL)).collect()

    def never(d):
        raise AssertionError("the training matrix is built again")

    monkeypatch.setattr(models, "written_matrix", never)
    again = models.scr_batch(StarSchema(spark, SMALL)).collect()
    assert sorted(first) == sorted(again)
