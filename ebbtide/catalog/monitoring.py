"""Drift, survival, uplift, explanation and scoring queries that SQL can check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.catalog.ctes import ID, S, sql
from ebbtide.catalog.evaluation import CONTRIB_SQL, T1, T2, T3, TEST_SQL, WEIGHTS, explained
from ebbtide.catalog.registry import query
from ebbtide.catalog.shared import CALL_COLS, CONTRACT_COLS, USAGE_COLS, assembled, rounded
from ebbtide.config import DEFAULT_ACTION, DRIVER_ACTIONS
from ebbtide.functions.scalars import ID as KEY
from ebbtide.operators import attribution, drift, scoring, splitting, survival, uplift
from ebbtide.session import scratch
from ebbtide.sources import readers, sinks
from ebbtide.sources.starschema import SPLITS

# ---- drift -----------------------------------------------------------------------------------


def psi_sql(long: str) -> str:
    """(feature, psi) from a relation (side, feature, value)."""
    return f"""(SELECT feature, coalesce(sum((cp - rp) * ln(cp / rp)), 0.0::DOUBLE) AS psi FROM (
 SELECT g.feature, g.bin, coalesce(r, 0) / nr + 1e-4::DOUBLE AS rp, coalesce(c, 0) / nc + 1e-4::DOUBLE AS cp FROM
  (SELECT f.feature, b.bin, f.nr, f.nc FROM (SELECT feature, count(*) FILTER (WHERE side = 'ref') AS nr, count(*) FILTER (WHERE side = 'cur') AS nc FROM {long} GROUP BY 1) f CROSS JOIN (SELECT unnest(range(10)) AS bin) b) g
  LEFT JOIN (SELECT l.feature, (SELECT count(*) FROM range(1, 10) t(i) WHERE l.value >= m.lo + (m.hi - m.lo) / 10 * i) AS bin, count(*) FILTER (WHERE side = 'ref') AS r, count(*) FILTER (WHERE side = 'cur') AS c
   FROM {long} l JOIN (SELECT feature, min(value) AS lo, max(value) AS hi FROM {long} WHERE side = 'ref' GROUP BY 1) m USING (feature) GROUP BY 1, 2) x USING (feature, bin)) GROUP BY 1)"""


def ks_sql(long: str) -> str:
    return f"""(SELECT feature, max(abs(cr / tr - cc / tc)) AS statistic, max(tr) AS nr, max(tc) AS nc FROM (SELECT feature, value, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY feature) AS tr, sum(c) OVER (PARTITION BY feature) AS tc FROM
 (SELECT feature, value, count(*) FILTER (WHERE side = 'ref')::DOUBLE AS r, count(*) FILTER (WHERE side = 'cur')::DOUBLE AS c FROM {long} GROUP BY 1, 2) WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY 1)"""


PSI = psi_sql("drift_long")
KS = ks_sql("drift_long")
# 1.358099 is where the asymptotic two-sided p-value crosses 0.05.
DRIFTED = "sqrt(nr * nc / (nr + nc)) * statistic > 1.3580986"


@query("drf_psi", sql("drift_long", f"SELECT feature, round(psi, 6) AS psi FROM {PSI} WHERE feature = 'l_discount'"))
def drf_psi(d):
    ref, cur = d.drift_pair()
    return rounded(drift.psi(ref, cur, ["l_discount"]))


@query("drf_psi_all", sql("drift_long", f"SELECT feature, round(psi, 4) AS psi, psi >= 0.2 AS warned FROM {PSI}"))
def drf_psi_all(d):
    return drift.psi_all(*d.drift_pair())


ALERTS = f"(SELECT coalesce(string_agg(feature, ', ' ORDER BY feature), '') AS psi_alerts, CAST(count(*) AS INTEGER) AS n_alerts FROM {PSI} WHERE round(psi, 4) > 0.2)"


@query("drf_alert_list", sql("drift_long", f"SELECT * FROM {ALERTS}"))
def drf_alert_list(d):
    return drift.alert_list(drift.psi_all(*d.drift_pair()))


@query("drf_dataset", sql("drift_long", f"SELECT feature, round(statistic, 6) AS statistic, {DRIFTED} AS drifted FROM {KS}"))
def drf_dataset(d):
    return rounded(drift.ks(*d.drift_pair()).select("feature", "statistic", "drifted"))


@query("drf_prediction", sql("scored_accounts", f""", l AS (SELECT 'ref' AS side, 'p' AS feature, p AS value FROM scored_accounts WHERE datevalue <= {T1} UNION ALL SELECT 'cur', 'p', p FROM {TEST_SQL})
 SELECT round(a, 6) AS ref_mean, round(b, 6) AS cur_mean, round(psi, 6) AS score_psi, abs(b - a) > 0.05 AS mean_alert, psi > 0.2 AS psi_alert FROM {psi_sql('l')} CROSS JOIN (SELECT avg(value) FILTER (WHERE side = 'ref') AS a, avg(value) FILTER (WHERE side = 'cur') AS b FROM l)"""))
def drf_prediction(d):
    s = splitting.temporal_split(d.scored_accounts(), "datevalue", SPLITS)
    return rounded(drift.prediction_drift(s.train, s.test))


FULL = f"(SELECT round(avg(CAST({DRIFTED} AS INTEGER)), 6) AS drift_share, avg(CAST({DRIFTED} AS INTEGER)) > 0.2 AS drift_detected FROM {KS})"


@query("drf_full", sql("drift_long", f"SELECT * FROM {FULL} CROSS JOIN {ALERTS}"))
def drf_full(d):
    return rounded(drift.full_monitoring(*d.drift_pair()))


@query("sink_json_report", sql("drift_long", f"SELECT '19980601_000000' AS reported_at, drift_share, drift_detected, psi_alerts, CAST(n_alerts AS BIGINT) AS n_alerts FROM {FULL} CROSS JOIN {ALERTS}"))
def sink_json_report(d):
    path = scratch(d.spark, "reports")
    sinks.append_report(drift.full_monitoring(*d.drift_pair()), path, "19980601_000000")
    return rounded(d.spark.read.json(path))


@query("drf_severity", sql("drift_long", f"""SELECT CASE WHEN NOT drift_detected AND n_alerts = 0 THEN 'No Drift Detected' ELSE 'Churn Model Drift Alert' END AS title,
 CASE WHEN NOT drift_detected AND n_alerts = 0 THEN 'All features stable.' ELSE 'Drift detected: ' || CASE WHEN drift_detected THEN 'Yes' ELSE 'No' END || chr(10) || 'Drifted feature share: ' || printf('%.1f', drift_share * 100) || '%' || CASE WHEN n_alerts > 0 THEN chr(10) || 'Features with PSI > 0.2: ' || psi_alerts ELSE '' END
  || chr(10) || '→ **Recommended action**: trigger retraining pipeline' END AS message,
 CASE WHEN NOT drift_detected AND n_alerts = 0 THEN 'info' WHEN drift_share > 0.3 OR n_alerts > 3 THEN 'critical' ELSE 'warning' END AS severity FROM {FULL} CROSS JOIN {ALERTS}"""))
def drf_severity(d):
    return drift.severity(drift.full_monitoring(*d.drift_pair()))


NUMERIC = [c for c in [*CONTRACT_COLS, *CALL_COLS, *USAGE_COLS] if c not in ("tenure_bucket", "sales_channel", "crm_package_name")]
UNPIVOT = " UNION ALL ".join(f"SELECT CASE WHEN snapshot_date = {T1} THEN 'ref' ELSE 'cur' END AS side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM assembled_all WHERE snapshot_date IN ({T1}, {T3}) AND {c} IS NOT NULL" for c in NUMERIC)


@query("drf_oldest_newest", sql("assembled_all", f""", l AS ({UNPIVOT}) SELECT f.feature, CASE WHEN nr > 0 AND nc > 0 THEN round(psi, 4) ELSE 0.0::DOUBLE END AS psi, nr > 0 AND nc > 0 AND psi >= 0.2 AS warned FROM {psi_sql('l')} p
 JOIN (SELECT feature, count(*) FILTER (WHERE side = 'ref') AS nr, count(*) FILTER (WHERE side = 'cur') AS nc FROM l GROUP BY 1) f USING (feature)"""))
def drf_oldest_newest(d):
    folder = scratch(d.spark, "snapshots")
    sinks.write_features(assembled(d, SPLITS.snapshots), folder)
    return drift.psi_all(*drift.oldest_newest(readers.read_snapshots(d.spark, folder)))


# ---- survival --------------------------------------------------------------------------------


def km_sql(by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    g = f"{by}, " if by else ""
    return f"""(SELECT {g} t, at_risk, d, CASE WHEN dead = 1 THEN 0.0::DOUBLE ELSE exp(lg) END AS survival,
 CASE WHEN dead = 1 THEN 0.0::DOUBLE WHEN lg = 0 THEN 1.0::DOUBLE ELSE exp(lg * exp(1.959963984540054::DOUBLE * sqrt(v) / -lg)) END AS ci_lo, CASE WHEN dead = 1 THEN 0.0::DOUBLE WHEN lg = 0 THEN 1.0::DOUBLE ELSE exp(lg * exp(-1.959963984540054::DOUBLE * sqrt(v) / -lg)) END AS ci_hi
 FROM (SELECT *, max(CAST(d = at_risk AS INTEGER)) OVER w AS dead, sum(CASE WHEN d < at_risk THEN ln(1 - d / at_risk) ELSE 0 END) OVER w AS lg, sum(CASE WHEN d < at_risk THEN d / (at_risk * (at_risk - d)::DOUBLE) ELSE 0 END) OVER w AS v
  FROM (SELECT {g} t, d, CAST(sum(n) OVER ({part} ORDER BY t DESC) AS BIGINT) AS at_risk FROM (SELECT {g} CAST(duration AS DOUBLE) AS t, sum(event)::BIGINT AS d, count(*) AS n FROM lifetimes GROUP BY ALL)) WINDOW w AS ({part} ORDER BY t)))"""


KM_OUT = "t, at_risk, d, round(survival, 6) AS survival, round(ci_lo, 6) AS ci_lo, round(ci_hi, 6) AS ci_hi"


@query("surv_km", sql("lifetimes", f"SELECT {KM_OUT} FROM {km_sql()}"))
def surv_km(d):
    return rounded(survival.kaplan_meier(d.lifetimes()))


@query("surv_km_strata", sql("lifetimes", f"SELECT segment, {KM_OUT} FROM {km_sql('segment')}"))
def surv_km_strata(d):
    return rounded(survival.kaplan_meier(d.lifetimes(), by=["segment"]))


MEDIAN = "coalesce(min(t) FILTER (WHERE survival <= 0.5 + 1e-12), min(t) FILTER (WHERE survival <= 0.75 + 1e-12), max(t)) AS t, CASE WHEN min(survival) <= 0.5 + 1e-12 THEN 'median' WHEN min(survival) <= 0.75 + 1e-12 THEN 'quartile' ELSE 'last' END AS kind"


@query("surv_median", sql("lifetimes", f"SELECT segment, {MEDIAN} FROM {km_sql('segment')} GROUP BY 1 UNION ALL SELECT 'all', {MEDIAN} FROM {km_sql()}"))
def surv_median(d):
    lt = d.lifetimes()
    each = survival.median_survival(survival.kaplan_meier(lt, by=["segment"]), ["segment"])
    whole = survival.median_survival(survival.kaplan_meier(lt)).select(F.lit("all").alias("segment"), "t", "kind")
    return each.unionByName(whole)


def logrank_sql(group: str) -> str:
    return f"""SELECT '{group}' AS grouping, observed, round(expected, 6) AS expected, round(pow(observed - expected, 2) / variance, 6) AS statistic, pow(observed - expected, 2) / variance > 3.841458820694124 AS significant FROM (
 SELECT sum(d1)::BIGINT AS observed, sum(d * r1 / r) AS expected, sum(CASE WHEN r > 1 THEN d * (r1 / r) * (1 - r1 / r) * (r - d) / (r - 1) ELSE 0 END) AS variance FROM (
 SELECT d, d1, sum(n) OVER w AS r, sum(n1) OVER w AS r1 FROM (SELECT duration, sum(event)::DOUBLE AS d, count(*)::DOUBLE AS n, sum(event * {group})::DOUBLE AS d1, sum({group})::DOUBLE AS n1 FROM lifetimes GROUP BY 1) WINDOW w AS (ORDER BY duration DESC)))"""


@query("surv_logrank", sql("lifetimes", logrank_sql("urgent") + " UNION ALL " + logrank_sql("dd_flag")))
def surv_logrank(d):
    lt = d.lifetimes()
    parts = [survival.logrank(lt, g).select(F.lit(g).alias("grouping"), "observed", "expected", "statistic", "significant") for g in ("urgent", "dd_flag")]
    return rounded(parts[0].unionByName(parts[1]))


@query("surv_conditional", sql("lifetimes", f"""SELECT segment, round(a, 6) AS s_now, round(b, 6) AS s_later, round((a - b) / a, 6) AS p_churn FROM (SELECT segment, coalesce(arg_max(survival, t) FILTER (WHERE t <= 200), 1.0) AS a, coalesce(arg_max(survival, t) FILTER (WHERE t <= 565), 1.0) AS b FROM {km_sql('segment')} GROUP BY 1)"""))
def surv_conditional(d):
    return rounded(survival.conditional_churn(survival.kaplan_meier(d.lifetimes(), by=["segment"]), 200, 365, ["segment"]))


# ---- uplift ----------------------------------------------------------------------------------
GROUP_SQL = """(SELECT o_orderpriority, count(*) FILTER (WHERE t = 1) AS n_treated, count(*) FILTER (WHERE t = 0) AS n_control, avg(1 - y) FILTER (WHERE t = 1) AS p_treated, avg(1 - y) FILTER (WHERE t = 0) AS p_control
 FROM (SELECT s.y, o.o_orderpriority, o.o_custkey % 2 AS t FROM scored s JOIN orders o ON o.o_orderkey = s.id) GROUP BY 1)"""


def contacted(d):
    a = d.scored_accounts()
    return a.withColumn("contacted", F.col(KEY).cast("bigint") % 2).withColumn("retained", 1 - F.col("y"))


@query("upl_group_rate", sql("scored", f"SELECT o_orderpriority, n_treated, n_control, round(p_treated, 6) AS p_treated, round(p_control, 6) AS p_control, round(p_treated - p_control, 6) AS uplift FROM {GROUP_SQL}"))
def upl_group_rate(d):
    return rounded(uplift.group_uplift(contacted(d), ["o_orderpriority"])).drop("segment")


@query("upl_segments", sql("scored", """SELECT id, CASE WHEN p - 0.5::DOUBLE > 0.05 THEN 'Persuadable' WHEN p - 0.5::DOUBLE < -0.05 THEN 'Do Not Disturb' ELSE 'Neutral' END AS uplift_segment FROM scored"""))
def upl_segments(d):
    return d.scored().select("id", uplift.uplift_segment(F.col("p") - 0.5).alias("uplift_segment"))


# ---- explanation -----------------------------------------------------------------------------
@query("exp_contrib_linear", sql("scored_accounts", f"SELECT id, feature, round(contribution, 6) AS contribution, round(value, 6) AS value FROM {CONTRIB_SQL}"))
def exp_contrib_linear(d):
    return rounded(attribution.long_form(explained(d), "id"))


RANKED = f"(SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS r FROM {CONTRIB_SQL})"


@query("exp_top_drivers", sql("scored_accounts", f"SELECT id, CAST(r - 1 AS INTEGER) AS pos, feature, round(contribution, 4) AS contribution, round(value, 6) AS value, CASE WHEN contribution > 0 THEN '↑ Increases churn' ELSE '↓ Decreases churn' END AS direction FROM {RANKED} WHERE r <= 3"))
def exp_top_drivers(d):
    rows = explained(d).select("id", F.posexplode(attribution.top_drivers()).alias("pos", "c")).select("id", "pos", "c.*")
    return rows.select("id", "pos", "feature", "contribution", F.round("value", 6).alias("value"), attribution.direction(F.col("contribution")).alias("direction"))


@query("exp_global", sql("scored_accounts", f"SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs, CAST(row_number() OVER (ORDER BY avg(abs(contribution)) DESC, feature) AS INTEGER) AS rank FROM {CONTRIB_SQL} GROUP BY 1"))
def exp_global(d):
    return rounded(attribution.global_importance(explained(d)))


@query("exp_top_customers", sql("scored_accounts", f"""SELECT CAST(t.rank AS INTEGER) AS rank, t.id, t.p AS churn_probability, r.feature, round(r.contribution, 4) AS contribution FROM (SELECT id, p, row_number() OVER (ORDER BY p DESC, id) AS rank FROM scored_accounts QUALIFY rank <= 5) t JOIN {RANKED} r ON r.id = t.id AND r.r <= 3"""))
def exp_top_customers(d):
    from ebbtide.operators.ranking import top_rows

    best = top_rows(explained(d), "p", "id", 5)
    rows = best.select("rank", "id", F.round("p", 4).alias("churn_probability"), F.explode(attribution.top_drivers()).alias("c"))
    return rows.select("rank", "id", "churn_probability", "c.feature", "c.contribution")


TOP3 = f"(SELECT feature FROM {CONTRIB_SQL} GROUP BY 1 ORDER BY avg(abs(contribution)) DESC, feature LIMIT 3)"


@query("exp_dependence", sql("scored_accounts", f"SELECT id, feature, round(value, 6) AS value, round(contribution, 6) AS contribution FROM {CONTRIB_SQL} WHERE feature IN {TOP3}"))
def exp_dependence(d):
    return rounded(attribution.dependence(explained(d), "id", 3))


def clustered(d):
    return explained(d).withColumn("cluster", (F.col("id") % 4).cast("int"))


@query("exp_cluster_profile", sql("scored_accounts", f"""SELECT cluster, max(size) AS size, max(feature) FILTER (WHERE r = 1) AS top_driver, max(feature) FILTER (WHERE r = 2) AS second_driver, max(CASE WHEN m > 0 THEN 'high' ELSE 'low' END) FILTER (WHERE r = 1) AS direction,
 round(max(size) / (SELECT count(*) FROM scored_accounts), 6) AS share FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY s DESC, feature) AS r FROM (SELECT CAST(id % 4 AS INTEGER) AS cluster, feature, count(*) AS size, avg(abs(contribution)) AS s, avg(contribution) AS m FROM {CONTRIB_SQL} GROUP BY 1, 2)) GROUP BY 1"""))
def exp_cluster_profile(d):
    return rounded(attribution.cluster_profile(clustered(d)))


@query("exp_cluster_heat", sql("scored_accounts", f"SELECT CAST(id % 4 AS INTEGER) AS cluster, feature, round(avg(contribution), 6) AS mean_contribution FROM {CONTRIB_SQL} GROUP BY 1, 2"))
def exp_cluster_heat(d):
    wide = attribution.cluster_heat(clustered(d))
    return rounded(wide.unpivot(["cluster"], wide.columns[1:], "feature", "mean_contribution"))


def _text(s: str) -> str:
    return s.replace("'", "''")


ACTIONS = " ".join(f"WHEN '{k}' THEN '{_text(v)}'" for k, v in DRIVER_ACTIONS.items())


@query("exp_action_map", sql("scored_accounts", f"SELECT id, feature AS top_driver, CASE feature {ACTIONS} ELSE '{_text(DEFAULT_ACTION)}' END AS action FROM {RANKED} WHERE r = 1"))
def exp_action_map(d):
    top = attribution.driver_names(n=1)[0]
    return explained(d).select("id", top.alias("top_driver"), attribution.action_for(top).alias("action"))


# ---- scoring ---------------------------------------------------------------------------------
@query("scr_snapshot_default", sql("panel", "SELECT max(datevalue) AS snapshot_date, count(*) AS n_rows FROM panel WHERE datevalue = (SELECT max(datevalue) FROM panel)"))
def scr_snapshot_default(d):
    day = scoring.default_snapshot(d.panel())
    rows = d.panel().where(F.col("datevalue") == F.lit(day).cast("date"))
    return rows.agg(F.lit(day).cast("date").alias("snapshot_date"), F.count("*").alias("n_rows"))


DRIVERS_SQL = f"(SELECT id, {', '.join(f'max(feature) FILTER (WHERE r = {i}) AS driver_{i}' for i in (1, 2, 3))} FROM {RANKED} GROUP BY 1)"


def format_sql(score: str, tiers: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY round({score}, 4) DESC, a.id) AS priority_rank, a.{ID}, a.id, round({score}, 4) AS churn_probability, {tiers} AS risk_tier, v.driver_1, v.driver_2, v.driver_3, a.ooc_days, a.tenure_days
 FROM scored_accounts a JOIN {DRIVERS_SQL} v ON v.id = a.id"""


def score_rows(d, p):
    e = explained(d).withColumn("p", p).withColumn("drivers", attribution.driver_names())
    return e.select("id", KEY, "p", "drivers", "ooc_days", "tenure_days")


@query("scr_format", sql("scored_accounts", format_sql("a.p", "CASE WHEN a.p >= 0.70 THEN 'High' WHEN a.p >= 0.30 THEN 'Medium' ELSE 'Low' END")))
def scr_format(d):
    return scoring.format_scored(score_rows(d, F.col("p")), tie="id")


@query("scr_fallback_tiers", sql("scored_accounts", f"""SELECT priority_rank, {ID}, id, churn_probability, CASE WHEN priority_rank <= ceil((SELECT count(*) FROM orders) * 0.05::DOUBLE) THEN 'High' WHEN priority_rank <= ceil((SELECT count(*) FROM orders) * 0.20::DOUBLE) THEN 'Medium' ELSE 'Low' END AS risk_tier,
 driver_1, driver_2, driver_3, ooc_days, tenure_days FROM ({format_sql('a.p / 7', "''")})"""))
def scr_fallback_tiers(d):
    return scoring.format_scored(score_rows(d, F.col("p") / 7), tie="id")


@query("scr_tier_counts", sql("scored_accounts", "SELECT CASE WHEN p >= 0.70 THEN 'High' WHEN p >= 0.30 THEN 'Medium' ELSE 'Low' END AS risk_tier, count(*) AS n FROM scored_accounts GROUP BY 1"))
def scr_tier_counts(d):
    return scoring.tier_counts(d.scored().select(scoring.risk_tier(F.col("p")).alias("risk_tier")))
