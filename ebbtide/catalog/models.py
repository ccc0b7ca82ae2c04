"""Models, hazards and streaming. Most results are iterative fits, which SQL cannot check."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from ebbtide.catalog.ctes import ID, S, h32, sql
from ebbtide.catalog.evaluation import WEIGHTS, ap_sql
from ebbtide.catalog.monitoring import contacted
from ebbtide.catalog.registry import query
from ebbtide.catalog.shared import assembled, rounded
from ebbtide.catalog.sources import written_matrix
from ebbtide.config import Settings
from ebbtide.functions.scalars import ID as KEY, portable_hash
from ebbtide.operators import attribution, boosting, encoding, hazards, learning, metrics, splitting, trees, uplift
from ebbtide.plans import features as feature_plans, scoring as score_plans, training
from ebbtide.session import scratch, settle, shared_dir
from ebbtide.sources import readers
from ebbtide.sources.starschema import SPLITS
from ebbtide.streaming import jobs

SETTINGS = Settings(splits=SPLITS)
RUN = 2  # raised when a saved run holds other folders


def once(fn):
    """Result kept on the query's own data binding, so one call of a query builds it once."""
    def get(d):
        if fn.__name__ not in d.built:
            d.built[fn.__name__] = fn(d)
        return d.built[fn.__name__]

    return get


@once
def features(d):
    """Written feature matrix of all three snapshots, with its encoder."""
    folder = written_matrix(d)
    return readers.read_snapshots(d.spark, folder + "/matrix"), encoding.FittedEncoder.load(d.spark, folder + "/encoder")


def parts(d):
    return splitting.temporal_split(training.with_row_key(features(d)[0]), splits=SPLITS)


def data_key(d) -> str:
    """Name of what a run depends on: its tables' paths, sizes and times, the settings, and how models are fitted."""
    files = d.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(d.folder)
    names = ("customer", "orders", "lineitem", "events", "nation")
    rows = files.select("path", "length", "modificationTime").where(F.col("path").rlike("/(" + "|".join(names) + r")\.parquet")).orderBy("path").collect()  # a listing
    listing = [(r["path"], r["length"], str(r["modificationTime"])) for r in rows]
    return hashlib.sha256(repr((listing, SETTINGS, learning.BOOSTING, boosting.FORMAT, RUN)).encode()).hexdigest()[:16]


@once
def run_folder(d) -> str:
    return f"{shared_dir(d.spark)}/runs/{data_key(d)}"


@once
def boosted(d):
    """Model and calibrator of the run saved for these data, by any session; without one it is trained, or goes on where it was cut off."""
    path = run_folder(d)
    try:
        return training.load_run(d.spark, path)
    except AnalysisException:  # nothing saved yet
        matrix, encoder = features(d)
        encoder.save(f"{path}/encoder")
        training.train(matrix, SETTINGS, n_trials=0, run_path=path)
        return training.load_run(d.spark, path)


def encoder_of_run(d):
    """Encoder saved with the run, so that scoring with a saved run builds no training matrix."""
    boosted(d)
    return encoding.FittedEncoder.load(d.spark, f"{run_folder(d)}/encoder")


@query("mdl_logreg")
def mdl_logreg(d):
    s = parts(d)
    return rounded(learning.fit_logistic(s.train).score(s.test).select("row_key", "churned", "p"))


@query("mdl_gbt")
def mdl_gbt(d):
    s = parts(d)
    model = learning.fit_boosted(s.train, s.val)
    return rounded(model.score(s.test).select("row_key", "churned", "p"))


@query("mdl_predict")
def mdl_predict(d):
    model, _ = boosted(d)
    return rounded(model.score(parts(d).test).select("row_key", "p", learning.predict_label(F.col("p")).alias("prediction")))


@query("mdl_balanced_weight", sql("assembled", "SELECT churned AS label, count(*) AS n, round((SELECT count(*) FROM assembled) / (2.0::DOUBLE * count(*)), 6) AS weight FROM assembled GROUP BY 1"))
def mdl_balanced_weight(d):
    return rounded(learning.class_weights(assembled(d)))


@query("mdl_calibrate_iso")
def mdl_calibrate_iso(d):
    s = d.scored()
    return rounded(learning.calibrate(s).apply(s))


@query("mdl_calibrate_sigmoid")
def mdl_calibrate_sigmoid(d):
    s = d.scored()
    return rounded(learning.calibrate(s, "sigmoid").apply(s))


@query("mdl_tune")
def mdl_tune(d):
    s = parts(d)
    return rounded(learning.tune(s.train, s.val)[1])


@query("mdl_train")
def mdl_train(d):
    run = training.train(features(d)[0], SETTINGS, run_path=scratch(d.spark, "run"), run_id="run-1")
    return rounded(run.metrics)


@query("mdl_importance")
def mdl_importance(d):
    return rounded(learning.importance(boosted(d)[0], d.spark))


def runs(d):
    """Logged average precision of two score columns as champion and challenger."""
    a = metrics.average_precision(d.scored()).select(F.lit("champion").alias("role"), F.col("auc_pr").alias("value"))
    other = d.scored().withColumn("p", (portable_hash("id") % 10000) / 10000.0)
    b = metrics.average_precision(other).select(F.lit("challenger").alias("role"), F.col("auc_pr").alias("value"))
    return a.unionByName(b).select("role", F.lit("2000-06-01").cast("date").alias("logged_at"), F.lit("auc_pr").alias("metric"), "value")


@query("mdl_promote_gate", sql("scored", f""", alt AS (SELECT id, y, {h32('id')} % 10000 / 10000.0::DOUBLE AS p FROM scored) SELECT round({ap_sql('alt')}, 6) AS challenger, round({ap_sql('scored')}, 6) AS champion, {ap_sql('alt')} >= {ap_sql('scored')} - 0.01 AS promote"""))
def mdl_promote_gate(d):
    return rounded(learning.promote_gate(runs(d)))


@query("mdl_retune_gate", """SELECT o_orderpriority AS model, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-28') AS INTEGER) AS age_days,
 CASE WHEN date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-28') >= 28 THEN 'full_tune' ELSE 'quick_refit' END AS action FROM orders GROUP BY 1""")
def mdl_retune_gate(d):
    tuned = d.table("orders").select(F.col("o_orderpriority").alias("model"), F.col("o_orderdate").cast("date").alias("tuned_at"))
    return learning.retune_gate(tuned, "2001-08-28")


PCA_COLUMNS = ["tenure_days", "ooc_days", "speed_gap", "dd_cancel_60_day", "contract_dd_cancels", "contract_status_risk", "tech_FTTC", "tech_FTTP", "tech_GFAST", "tech_MPF", "call_count_90d", "avg_download_30d"]


@query("mdl_pca")
def mdl_pca(d):
    matrix = feature_plans.assemble(d.panel(), d.calls(), d.usage(), d.cease(), SPLITS.train_end)  # no encoded column takes part
    out, loadings, share = learning.pca(settle(matrix.select(*PCA_COLUMNS)), PCA_COLUMNS)
    return rounded(learning.top_loadings(loadings).withColumn("explained_pc1", F.lit(share[0])).withColumn("explained_pc2", F.lit(share[1])))


# ---- hazards -----------------------------------------------------------------------------------
COVARIATES = ["price", "urgent", "dd_flag"]


def lifetimes(d):
    return d.lifetimes()


@once
def cox(d):
    return hazards.fit_cox(lifetimes(d), COVARIATES)


@query("surv_cox_fit")
def surv_cox_fit(d):
    return rounded(cox(d).summary(d.spark))


@query("surv_concordance", sql("lifetimes", """, a AS (SELECT duration, event, price, count(*)::BIGINT AS n FROM lifetimes GROUP BY ALL)
 SELECT concordant, tied, pairs, round((concordant + tied * 0.5::DOUBLE) / pairs, 6) AS c_index FROM (SELECT sum(CASE WHEN o.price < e.price THEN e.n * o.n ELSE 0 END)::BIGINT AS concordant, sum(CASE WHEN o.price = e.price THEN e.n * o.n ELSE 0 END)::BIGINT AS tied, sum(e.n * o.n)::BIGINT AS pairs
 FROM a e JOIN a o ON e.event = 1 AND (o.duration > e.duration OR (o.duration = e.duration AND o.event = 0)))"""))
def surv_concordance(d):
    return rounded(hazards.concordance(d.lifetimes(), "price"))


@query("surv_cox_predict")
def surv_cox_predict(d):
    m = cox(d)
    return rounded(lifetimes(d).select("id", m.churn_probability(90).alias("p_90d"), m.churn_probability(365).alias("p_365d"), m.median_lifetime().alias("median_days")))


@query("surv_weibull")
def surv_weibull(d):
    lt = lifetimes(d)
    model = hazards.fit_weibull(lt, COVARIATES)
    return lt.select("id", F.round(model.median_lifetime(), 4).alias("expected_days_to_churn"))


@query("surv_ph_test")
def surv_ph_test(d):
    return rounded(cox(d).ph_test(d.spark))


@query("surv_output_col")
def surv_output_col(d):
    m = cox(d)
    days = lifetimes(d).select("id", m.median_lifetime().alias("expected_days_to_churn"))
    return d.scored().join(days, "id", "left")


@query("surv_coef_flags")
def surv_coef_flags(d):
    from pyspark.sql import functions as fn

    spread = lifetimes(d).agg(*[fn.stddev_samp(c).alias(c) for c in COVARIATES]).first().asDict()
    return rounded(cox(d).flags(spread, d.spark).where("rank <= 15"))


@query("upl_tlearner")
def upl_tlearner(d):
    est = LogisticRegression(featuresCol="features", labelCol="label", maxIter=100, regParam=0.01)
    return rounded(uplift.two_model_uplift(contacted(d), list(WEIGHTS), est))


# ---- explanation and scoring -------------------------------------------------------------------
def explained_tree(d):
    model, _ = boosted(d)
    return trees.tree_contributions(parts(d).test, model, ["row_key", KEY])


@query("exp_contrib_tree")
def exp_contrib_tree(d):
    return rounded(attribution.long_form(explained_tree(d), "row_key"))


@query("exp_kmeans")
def exp_kmeans(d):
    out = trees.cluster_contributions(explained_tree(d))
    return out.select("row_key", "cluster", trees.segment_label().alias("segment"), attribution.driver_names(n=1)[0].alias("top_driver"))


@query("scr_batch")
def scr_batch(d):
    model, calibrator = boosted(d)
    return score_plans.score_active(d.panel(), d.calls(), d.usage(), d.cease(), model, calibrator, encoder_of_run(d), settings=SETTINGS)


def requests(d):
    """Request rows derived from the panel: two required fields and two optional ones."""
    return d.panel_keyed().select(F.col("o_orderkey").alias("request_id"), F.coalesce("ooc_days", F.lit(0.0)).alias("ooc_days"), "tenure_days", "dd_cancel_60_day", F.lit(None).cast("double").alias("call_count_30d"))


@query("scr_requests")
def scr_requests(d):
    model, calibrator = boosted(d)
    return score_plans.score_requests(requests(d), model, calibrator)


# ---- streaming -----------------------------------------------------------------------------------
@query("str_score", sql("scored", "SELECT id, round(p, 4) AS churn_probability, CASE WHEN p >= 0.70 THEN 'High' WHEN p >= 0.30 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM scored"))
def str_score(d):
    from ebbtide.operators import scoring

    path = scratch(d.spark, "requests")
    d.scored().select("id", "p").write.parquet(path)
    stream = jobs.read_parquet_stream(d.spark, path, d.spark.read.parquet(path).schema)
    out = jobs.score_stream(stream, lambda df: df.select("id", F.round("p", 4).alias("churn_probability"), scoring.risk_tier(F.col("p")).alias("risk_tier")))
    return jobs.run_to_table(out, "scored-stream")


@query("str_call_counts", sql("calls", f""", w AS (SELECT {ID}, call_type, CAST(event_date - CAST(i AS INTEGER) AS DATE) AS window_start FROM calls CROSS JOIN range(0, 7) t(i))
 SELECT {ID}, window_start, CAST(window_start + 7 AS DATE) AS window_end, count(*) AS n_calls, count(*) FILTER (WHERE call_type = 'Loyalty') AS n_loyalty FROM w GROUP BY 1, 2"""))
def str_call_counts(d):
    """All sliding windows that hold a call, as the stream emits them; a closing row ends the input."""
    calls = d.calls().select(KEY, "call_type", jobs.utc_midnight(F.col("event_date")).alias("event_time"))
    return jobs.replay(calls, jobs.call_counts, "call-counts")
