"""Ranking windows, metrics, curves, decision and business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.catalog.ctes import ID, h32, sql
from ebbtide.catalog.eda import base
from ebbtide.catalog.features import KEYED
from ebbtide.catalog.registry import query
from ebbtide.catalog.shared import rounded
from ebbtide.operators import attribution, business, contract, metrics, panel as panels, scoring, splitting, survival
from ebbtide.operators.ranking import top_rows, with_position
from ebbtide.session import scratch
from ebbtide.sources import sinks
from ebbtide.sources.starschema import SPLITS

T1, T2, T3 = (f"DATE '{x}'" for x in SPLITS.snapshots)
VAL_SQL = f"(SELECT id, y, p FROM scored_accounts WHERE datevalue > {T1} AND datevalue <= {T2})"
TEST_SQL = f"(SELECT id, y, p FROM scored_accounts WHERE datevalue > {T2} AND datevalue <= {T3})"


def halves(d):
    s = splitting.temporal_split(d.scored_accounts(), "datevalue", SPLITS)
    return s.val.select("id", "y", "p"), s.test.select("id", "y", "p")


def ap_sql(src: str) -> str:
    return f"""(SELECT sum(pos * tp / cn) / sum(pos) FROM (SELECT pos, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(n) OVER (ORDER BY p DESC) AS cn FROM (SELECT p, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM {src} GROUP BY p)))"""


def auc_sql(src: str) -> str:
    """Mann–Whitney form with average ranks, a different route than the curve sums."""
    return f"""(SELECT (sum(CASE WHEN y = 1 THEN ar END) - sum(y)::DOUBLE * (sum(y) + 1) / 2) / (sum(y)::DOUBLE * (count(*) - sum(y))) FROM
 (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS ar FROM {src}))"""


def f1_sql(src: str, t: str = "0.5") -> str:
    return f"""(SELECT coalesce(2.0::DOUBLE * count(*) FILTER (WHERE p >= {t} AND y = 1) / nullif(2 * count(*) FILTER (WHERE p >= {t} AND y = 1) + count(*) FILTER (WHERE p >= {t} AND y = 0) + count(*) FILTER (WHERE p < {t} AND y = 1), 0), 0) FROM {src})"""


def prec_sql(src: str, k: int) -> str:
    return f"(SELECT avg(y) FROM (SELECT y, row_number() OVER (ORDER BY p DESC, id) AS rn, greatest(1, floor(count(*) OVER () * {k} / 100)) AS k FROM {src}) WHERE rn <= k)"


def metric_exprs(src: str, t: str = "0.5") -> dict[str, str]:
    out = {"auc_pr": ap_sql(src), "auc_roc": auc_sql(src), "f1": f1_sql(src, t), "brier_score": f"(SELECT avg((p - y) * (p - y)) FROM {src})"}
    for k in (5, 10, 20):
        out[f"precision_at_{k}pct"] = prec_sql(src, k)
        out[f"lift_at_{k}pct"] = f"({prec_sql(src, k)} / (SELECT avg(y) FROM {src}))"
    return out


def long_metrics(src: str, t: str = "0.5") -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, {e} AS value" for m, e in metric_exprs(src, t).items())


def best_sql(src: str) -> str:
    return f"""(SELECT p AS threshold, 2 * pr * rc / (pr + rc + 1e-10::DOUBLE) AS f1 FROM (SELECT p, tp / cn AS pr, tp / (SELECT sum(y) FROM {src}) AS rc FROM (SELECT p, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(n) OVER (ORDER BY p DESC) AS cn
 FROM (SELECT p, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM {src} GROUP BY p))) ORDER BY f1 DESC, p LIMIT 1)"""


# ---- windows ---------------------------------------------------------------------------------
@query("win_priority_rank", sql("scored", "SELECT id, p, row_number() OVER (ORDER BY p DESC, id) AS priority_rank FROM scored"))
def win_priority_rank(d):
    return scoring.priority_rank(d.scored().select("id", "p"), "p", "id")


@query("win_decile", sql("scored", """, r AS (SELECT y, row_number() OVER (ORDER BY p DESC, id) - 1 AS r, count(*) OVER () AS n FROM scored), g AS (SELECT CAST(greatest(1, ceil(10.0::DOUBLE * r / (n - 1))) AS INTEGER) AS decile, count(*) AS n_customers, sum(y)::BIGINT AS n_churners FROM r GROUP BY 1)
 SELECT decile, n_customers, n_churners, round(n_churners / n_customers, 4) AS churn_rate, round((n_churners / n_customers) / (sum(n_churners) OVER () / sum(n_customers) OVER ()), 2) AS lift, round(sum(n_churners) OVER (ORDER BY decile) / sum(n_churners) OVER (), 4) AS cumulative_capture_rate FROM g"""))
def win_decile(d):
    return metrics.decile_table(d.scored())


@query("win_topk_pct", sql("scored", "SELECT " + ", ".join(f"round({e}, 6) AS {m}" for m, e in metric_exprs("scored").items() if "pct" in m)))
def win_topk_pct(d):
    return rounded(metrics.top_percent(metrics.ranked(d.scored())))


@query("win_gains_curve", sql("scored", """SELECT id, row_number() OVER w AS contacted, round(row_number() OVER w / count(*) OVER (), 6) AS contacted_share, round(sum(y) OVER (w ROWS UNBOUNDED PRECEDING) / sum(y) OVER (), 6) AS captured_share FROM scored WINDOW w AS (ORDER BY p DESC, id)"""))
def win_gains_curve(d):
    return rounded(metrics.gains_curve(d.scored()))


@query("win_gains_points", sql("scored", " UNION ALL ".join(f"SELECT {k} AS pct, count(*) FILTER (WHERE y = 1 AND rn <= floor(n * {k} / 100)) AS captured, round(count(*) FILTER (WHERE y = 1 AND rn <= floor(n * {k} / 100)) / count(*) FILTER (WHERE y = 1), 6) AS capture_rate FROM (SELECT y, row_number() OVER (ORDER BY p DESC, id) AS rn, count(*) OVER () AS n FROM scored)" for k in (10, 25, 50))))
def win_gains_points(d):
    return rounded(metrics.gains_points(d.scored()))


@query("win_topn_customers", sql("scored", "SELECT id, p, CAST(row_number() OVER (ORDER BY p DESC, id) AS INTEGER) AS rank FROM scored QUALIFY rank <= 25"))
def win_topn_customers(d):
    return top_rows(d.scored().select("id", "p"), "p", "id", 25)


WEIGHTS = {"ooc_days": 0.01, "tenure_days": -0.002, "speed": 0.004, "contract_dd_cancels": 0.5, "dd_cancel_60_day": 0.8}
CONTRIB_SQL = "(" + " UNION ALL ".join(f"SELECT id, {ID}, y, p, '{c}' AS feature, (coalesce({c}, 0) - (SELECT avg(coalesce({c}, 0)) FROM scored_accounts)) * {w}::DOUBLE AS contribution, coalesce({c}, 0) AS value FROM scored_accounts" for c, w in WEIGHTS.items()) + ")"


def explained(d):
    return attribution.linear_contributions(d.scored_accounts().select("id", ID, "y", "p", *WEIGHTS), WEIGHTS)


@query("win_topn_per_row", sql("scored_accounts", f"""SELECT id, max(feature) FILTER (WHERE r = 1) AS driver_1, max(feature) FILTER (WHERE r = 2) AS driver_2, max(feature) FILTER (WHERE r = 3) AS driver_3 FROM
 (SELECT id, feature, row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS r FROM {CONTRIB_SQL}) GROUP BY 1"""))
def win_topn_per_row(d):
    names = attribution.driver_names()
    return explained(d).select("id", *[F.get(names, i).alias(f"driver_{i + 1}") for i in range(3)])


@query("win_topn_features", sql("scored_accounts", f"SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs, CAST(row_number() OVER (ORDER BY avg(abs(contribution)) DESC, feature) AS INTEGER) AS rank FROM {CONTRIB_SQL} GROUP BY 1 QUALIFY rank <= 3"))
def win_topn_features(d):
    return rounded(attribution.top_features(explained(d), 3))


@query("win_first_per_key", sql("cease_keyed", f"SELECT * FROM cease_keyed QUALIFY row_number() OVER (PARTITION BY {ID} ORDER BY cease_placed_date, o_orderkey) = 1"))
def win_first_per_key(d):
    return panels.first_per_key(d.cease_keyed(), ID, ["cease_placed_date", KEYED])


TIER_SQL = "(SELECT *, CASE WHEN p >= q75 THEN 'Critical (Q4)' WHEN p >= q50 THEN 'High (Q3)' WHEN p >= q25 THEN 'Moderate (Q2)' ELSE 'Low (Q1)' END AS tier FROM scored CROSS JOIN (SELECT quantile_cont(p, 0.25) AS q25, quantile_cont(p, 0.5) AS q50, quantile_cont(p, 0.75) AS q75 FROM scored))"


@query("win_quartile_tier", sql("scored", f"SELECT id, p, tier FROM {TIER_SQL}"))
def win_quartile_tier(d):
    return survival.quartile_tier(d.scored(), "p").select("id", "p", "tier")


@query("win_monotone_check", sql("scored", f"""SELECT bool_and(coalesce(prev >= rate, true)) AS is_monotone, count(*) AS n_tiers FROM (SELECT rate, lag(rate) OVER (ORDER BY lo DESC) AS prev FROM (SELECT tier, avg(y) AS rate, min(p) AS lo FROM {TIER_SQL} GROUP BY 1))"""))
def win_monotone_check(d):
    return survival.monotone(survival.tier_summary(survival.quartile_tier(d.scored(), "p"), "p", "y"))


@query("surv_tier_summary", sql("scored", f"""SELECT tier, count(*) AS n_customers, sum(y)::BIGINT AS n_churners, round(avg(y), 6) AS churn_rate, round(avg(p), 6) AS avg_score, min(p) AS min_score, max(p) AS max_score, round(count(*) / (SELECT count(*) FROM scored), 6) AS share FROM {TIER_SQL} GROUP BY 1"""))
def surv_tier_summary(d):
    return rounded(survival.tier_summary(survival.quartile_tier(d.scored(), "p"), "p", "y"))


# ---- metrics ---------------------------------------------------------------------------------
@query("met_average_precision", sql("scored", f"SELECT round({ap_sql('scored')}, 6) AS auc_pr"))
def met_average_precision(d):
    return rounded(metrics.average_precision(d.scored()))


@query("met_roc_auc", sql("scored", f"SELECT round({auc_sql('scored')}, 6) AS auc_roc"))
def met_roc_auc(d):
    return rounded(metrics.roc_auc(d.scored()))


@query("met_f1_brier", sql("scored", f"SELECT round({f1_sql('scored')}, 6) AS f1, round((SELECT avg((p - y) * (p - y)) FROM scored), 6) AS brier_score"))
def met_f1_brier(d):
    return rounded(metrics.f1_brier(d.scored()))


@query("met_all", sql("scored", "SELECT " + ", ".join(f"round({e}, 6) AS {m}" for m, e in metric_exprs("scored").items())))
def met_all(d):
    return rounded(metrics.all_metrics(d.scored()))


CURVE_SQL = "(SELECT p, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(n) OVER (ORDER BY p DESC) AS cn, sum(pos) OVER () AS ap, sum(n) OVER () AS an FROM (SELECT p, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM scored GROUP BY p))"


@query("met_pr_curve", sql("scored", f"SELECT p AS threshold, round(tp / cn, 6) AS precision, round(tp / ap, 6) AS recall FROM {CURVE_SQL} UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE"))
def met_pr_curve(d):
    return rounded(metrics.pr_curve(d.scored()))


@query("met_roc_curve", sql("scored", f"SELECT p AS threshold, round((cn - tp) / (an - ap), 6) AS fpr, round(tp / ap, 6) AS tpr FROM {CURVE_SQL} UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE"))
def met_roc_curve(d):
    return rounded(metrics.roc_curve(d.scored()))


@query("met_best_f1", sql("scored_accounts", f"SELECT threshold, round(f1, 6) AS f1 FROM {best_sql(VAL_SQL)}"))
def met_best_f1(d):
    return rounded(metrics.best_f1(halves(d)[0]))


def best_threshold(d):
    return metrics.best_f1(halves(d)[0]).first()["threshold"]


@query("met_threshold_apply", sql("scored_accounts", f""", b AS (SELECT threshold AS t FROM {best_sql(VAL_SQL)}), x AS (SELECT count(*) FILTER (WHERE p >= t AND y = 1) AS tp, count(*) FILTER (WHERE p >= t) AS fl, sum(y) AS pos, count(*) AS n FROM {TEST_SQL} CROSS JOIN b)
 SELECT round(tp / fl, 6) AS precision, round(tp / pos, 6) AS recall, round(2 * tp / (fl + pos), 6) AS f1, fl AS flagged, round(fl / n, 6) AS flagged_share FROM x"""))
def met_threshold_apply(d):
    return rounded(metrics.threshold_report(halves(d)[1], best_threshold(d)))


@query("met_score_hist", sql("scored", "SELECT y, CAST(least(floor(p * 39), 38) AS INTEGER) AS bin, count(*) AS n FROM scored WHERE p BETWEEN 0 AND 1 GROUP BY 1, 2"))
def met_score_hist(d):
    from ebbtide.operators.profiling import histogram

    return histogram(d.scored(), "p", 39, ["y"], 0.0, 1.0)


SEGMENTS_SQL = """(SELECT 'Contract Status' AS segment, CASE WHEN ooc_days >= 0 THEN 'Out-of-contract' ELSE 'In-contract' END AS grp, id, y, p FROM scored_accounts
 UNION ALL SELECT 'Tenure Band', CASE WHEN tenure_days < 90 THEN '0-3m' WHEN tenure_days < 365 THEN '3m-1yr' WHEN tenure_days < 1095 THEN '1-3yr' ELSE '3yr+' END, id, y, p FROM scored_accounts
 UNION ALL SELECT 'Technology', coalesce(technology, 'Unknown'), id, y, p FROM scored_accounts UNION ALL SELECT 'Sales Channel', sales_channel, id, y, p FROM scored_accounts)"""


@query("met_segment", sql("scored_accounts", f""", s AS {SEGMENTS_SQL}, c AS (SELECT segment, grp, p, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM s GROUP BY ALL), k AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS cn FROM c WINDOW w AS (PARTITION BY segment, grp ORDER BY p DESC)),
 a AS (SELECT segment, grp, sum(pos * tp / cn) / sum(pos) AS auc_pr, sum(n)::BIGINT AS n, sum(pos)::BIGINT AS churners FROM k GROUP BY ALL),
 r AS (SELECT segment, grp, y, rank() OVER (PARTITION BY segment, grp ORDER BY p) + (count(*) OVER (PARTITION BY segment, grp, p) - 1) / 2.0::DOUBLE AS ar FROM s), u AS (SELECT segment, grp, (sum(CASE WHEN y = 1 THEN ar END) - sum(y)::DOUBLE * (sum(y) + 1) / 2) / (sum(y)::DOUBLE * (count(*) - sum(y))) AS auc_roc FROM r GROUP BY ALL)
 SELECT segment, grp AS "group", round(auc_pr, 6) AS auc_pr, round(auc_roc, 6) AS auc_roc, n, churners, round(churners / n, 6) AS churn_rate, round(auc_pr - {ap_sql('scored')}, 6) AS vs_aggregate FROM a JOIN u USING (segment, grp) WHERE n >= 50 AND churners > 0 AND churners < n"""))
def met_segment(d):
    segments = {
        "Contract Status": F.when(F.col("ooc_days") >= 0, "Out-of-contract").otherwise("In-contract"),
        "Tenure Band": contract.tenure_bucket(F.col("tenure_days")),
        "Technology": F.coalesce("technology", F.lit("Unknown")),
        "Sales Channel": F.col("sales_channel"),
    }
    return rounded(metrics.segment_quality(d.scored_accounts(), segments))


@query("met_stability", sql("scored_accounts", f""", v AS ({long_metrics(VAL_SQL)}), t AS ({long_metrics(TEST_SQL)}) SELECT metric, round(v.value, 6) AS validation, round(t.value, 6) AS test, round(t.value - v.value, 6) AS delta, round((t.value - v.value) / abs(v.value) * 100, 6) AS delta_pct,
 CASE WHEN v.value = 0 THEN '' WHEN (t.value - v.value) / abs(v.value) * 100 < -10 THEN 'DEGRADED' WHEN (t.value - v.value) / abs(v.value) * 100 > 10 THEN 'IMPROVED' ELSE 'Stable' END AS status FROM v JOIN t USING (metric)"""))
def met_stability(d):
    val, test = halves(d)
    return rounded(metrics.stability(metrics.metrics_long(val), metrics.metrics_long(test)))


TIERS_SQL = "CASE WHEN p >= 0.5 AND p <= 1.0 THEN 'Critical' WHEN p >= t AND p < 0.5 THEN 'High' WHEN p >= t * 0.5::DOUBLE AND p < t THEN 'Watch' WHEN p >= 0 AND p < t * 0.5::DOUBLE THEN 'Low Risk' END"


@query("met_priority_tiers", sql("scored_accounts", f"""SELECT tier, count(*) AS n, sum(y)::BIGINT AS churners, round(avg(y), 6) AS churn_rate, CASE tier WHEN 'Critical' THEN 'Immediate outbound call + bespoke offer' WHEN 'High' THEN 'Proactive retention call within 7 days'
 WHEN 'Watch' THEN 'Automated email + NPS survey' ELSE 'No immediate action — monitor next refresh' END AS action FROM (SELECT *, {TIERS_SQL} AS tier FROM {TEST_SQL} CROSS JOIN (SELECT threshold AS t FROM {best_sql(VAL_SQL)})) WHERE tier IS NOT NULL GROUP BY 1"""))
def met_priority_tiers(d):
    return rounded(metrics.priority_tiers(halves(d)[1], best_threshold(d)))


def impact_sql(src: str) -> str:
    arms = []
    for label, order in (("Model-guided", "p DESC, id"), ("Random baseline", f"{h32('id')}, id")):
        for cap in ("0.05", "0.1", "0.15", "0.2", "0.3"):
            arms.append(f"SELECT '{label}' AS strategy, {cap}::DOUBLE AS capacity_pct, max(k) AS k, count(*) FILTER (WHERE rn <= k AND y = 1) AS tp, count(*) FILTER (WHERE y = 1) AS pos FROM (SELECT y, row_number() OVER (ORDER BY {order}) AS rn, CAST(greatest(1, floor(count(*) OVER () * {cap}::DOUBLE)) AS BIGINT) AS k FROM {src})")
    return f"""(SELECT strategy, capacity_pct, k AS customers_contacted, tp AS true_positives, k - tp AS false_positives, round(tp / k, 4) AS precision, round(tp / pos, 4) AS capture_rate, round(tp * 0.25::DOUBLE, 1) AS estimated_retained,
 round(tp * 0.25::DOUBLE * 360.0::DOUBLE, 2) AS revenue_saved_gbp, round(k * 8.0::DOUBLE, 2) AS call_spend_gbp, round(tp * 0.25::DOUBLE * 360.0::DOUBLE - k * 8.0::DOUBLE, 2) AS net_value_gbp FROM ({' UNION ALL '.join(arms)}))"""


@query("met_business_impact", sql("scored", f"SELECT * FROM {impact_sql('scored')}"))
def met_business_impact(d):
    return business.business_impact(d.scored())


HEAD_SQL = "SELECT max(net_value_gbp) FILTER (WHERE strategy = 'Model-guided') AS model_net_value, max(net_value_gbp) FILTER (WHERE strategy = 'Random baseline') AS random_net_value, max(net_value_gbp) FILTER (WHERE strategy = 'Model-guided') - max(net_value_gbp) FILTER (WHERE strategy = 'Random baseline') AS uplift_vs_random FROM {} WHERE capacity_pct = 0.2"


@query("met_business_headline", sql("scored", HEAD_SQL.format(impact_sql("scored"))))
def met_business_headline(d):
    return business.headline(business.business_impact(d.scored()))


@query("met_reproduce", sql("scored", "SELECT metric, abs(value - value) < 1e-4 AS same FROM (" + long_metrics("scored") + ")"))
def met_reproduce(d):
    path = scratch(d.spark, "runs")
    sinks.log_metrics(metrics.metrics_long(d.scored()), path, "saved")
    saved = d.spark.read.parquet(path).select("metric", F.col("value").alias("saved"))
    again = metrics.metrics_long(d.scored())
    return again.join(saved, "metric").select("metric", (F.abs(F.col("value") - F.col("saved")) < 1e-4).alias("same"))


@query("met_exec_summary", sql("scored_accounts", f""", b AS (SELECT threshold AS t FROM {best_sql(VAL_SQL)}), v AS ({long_metrics(VAL_SQL, '(SELECT t FROM b)')}), t AS ({long_metrics(TEST_SQL, '(SELECT t FROM b)')}), h AS ({HEAD_SQL.format(impact_sql(TEST_SQL))}),
 x AS (SELECT *, {TIERS_SQL} AS tier FROM {TEST_SQL} CROSS JOIN b)
 SELECT round((SELECT value FROM t WHERE metric = 'auc_pr'), 6) AS auc_pr, round((SELECT value FROM t WHERE metric = 'auc_roc'), 6) AS auc_roc, round((SELECT value FROM t WHERE metric = 'brier_score'), 6) AS brier_score, round((SELECT value FROM t WHERE metric = 'lift_at_10pct'), 6) AS lift_at_10pct,
 (SELECT t FROM b) AS threshold, (SELECT model_net_value FROM h) AS net_value, (SELECT uplift_vs_random FROM h) AS uplift_vs_random, (SELECT count(*) FROM x WHERE tier = 'Critical') AS n_critical, (SELECT count(*) FROM x WHERE tier = 'High') AS n_high,
 (SELECT count(*) FROM x WHERE p < t AND y = 1) AS n_missed, CASE WHEN (SELECT count(*) FROM v JOIN t USING (metric) WHERE (t.value - v.value) / abs(v.value) * 100 < -10) > 0 THEN 'Some degradation detected' ELSE 'Stable across periods' END AS stability"""))
def met_exec_summary(d):
    from ebbtide.plans.evaluation import executive_summary

    val, test = halves(d)
    return rounded(executive_summary(val, test))


@query("mdl_compare", sql("scored_accounts", f""", alt AS (SELECT id, y, {h32('id')} % 10000 / 10000.0::DOUBLE AS p, datevalue FROM scored_accounts) """ + " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{s}' AS split, metric, round(value, 6) AS value FROM ({long_metrics(src)})" for m, s, src in (("primary", "val", VAL_SQL), ("primary", "test", TEST_SQL),
    ("baseline", "val", f"(SELECT * FROM alt WHERE datevalue > {T1} AND datevalue <= {T2})"), ("baseline", "test", f"(SELECT * FROM alt WHERE datevalue > {T2} AND datevalue <= {T3})")))))
def mdl_compare(d):
    from ebbtide.functions.scalars import portable_hash
    from ebbtide.plans.evaluation import compare_models

    s = splitting.temporal_split(d.scored_accounts().withColumn("p2", (portable_hash("id") % 10000) / 10000.0), "datevalue", SPLITS)
    return rounded(compare_models({"val": s.val, "test": s.test}, {"primary": "p", "baseline": "p2"}))


@query("mdl_reliability", sql("scored", "SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, round(avg(p), 6) AS mean_predicted, round(avg(y), 6) AS observed_rate, count(*) AS n FROM scored GROUP BY 1"))
def mdl_reliability(d):
    return rounded(metrics.reliability(d.scored()))


@query("mdl_hosmer_lemeshow", sql("scored", """SELECT round(sum(pow(o - e, 2) / (e * (1 - e / n))), 6) AS statistic, count(*) - 2 AS dof FROM (SELECT floor((rn - 1) * 10 / t) AS g, count(*) AS n, sum(y) AS o, sum(p) AS e FROM
 (SELECT y, p, row_number() OVER (ORDER BY p DESC, id) AS rn, count(*) OVER () AS t FROM scored) GROUP BY 1)"""))
def mdl_hosmer_lemeshow(d):
    return rounded(metrics.hosmer_lemeshow(d.scored()))
