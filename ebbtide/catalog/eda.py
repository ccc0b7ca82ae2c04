"""Exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.catalog.ctes import ID, S, num, sql
from ebbtide.catalog.features import KEYED, RICH_SQL
from ebbtide.catalog.registry import query
from ebbtide.catalog.shared import CALL_COLS, CONTRACT_COLS, USAGE_COLS, assembled, rounded
from ebbtide.operators import activity, association, metrics, panel as panels, profiling as pf
from ebbtide.operators.ranking import quantiles
from ebbtide.sources.schemas import CALLS, CEASE, USAGE
from ebbtide.sources.starschema import StarSchema

BEST = 0.4  # decision threshold used by the error-analysis queries


def base(d):
    return panels.analytical_base(d.panel_keyed(), d.cease(), KEYED)


def rich(d):
    return pf.rich_base(base(d), d.calls(), d.usage())


def first_events(d):
    return panels.first_per_key(d.cease_keyed(), ID, ["cease_placed_date", KEYED])


FIRST_SQL = f"(SELECT * FROM cease_keyed QUALIFY row_number() OVER (PARTITION BY {ID} ORDER BY cease_placed_date, o_orderkey) = 1)"


@query("agg_first_cease", sql("first_cease", f"SELECT {ID}, first_cease FROM first_cease"))
def agg_first_cease(d):
    return panels.first_cease(d.cease())


@query("agg_churn_rate", sql("panel cease", f"""SELECT (SELECT count(DISTINCT {ID}) FROM panel) AS customers, count(DISTINCT {ID}) AS churners, count(*) - count(DISTINCT {ID}) AS duplicate_rows,
 round(count(DISTINCT {ID}) / (SELECT count(DISTINCT {ID}) FROM panel), 6) AS churn_rate FROM cease"""))
def agg_churn_rate(d):
    return rounded(pf.churn_rate(d.panel(), d.cease()))


@query("agg_monthly_volume", sql("cease", """SELECT m.month, count(c.cease_placed_date) AS n FROM
 (SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(cease_placed_date)) FROM cease), (SELECT date_trunc('month', max(cease_placed_date)) FROM cease), INTERVAL 1 MONTH)) AS DATE) AS month) m
 LEFT JOIN cease c ON CAST(date_trunc('month', c.cease_placed_date) AS DATE) = m.month GROUP BY 1"""))
def agg_monthly_volume(d):
    return pf.monthly_volume(d.cease(), "cease_placed_date")


@query("agg_dow_counts", sql("cease", """SELECT CAST(isodow(cease_placed_date) AS INTEGER) AS day_no, dayname(cease_placed_date) AS weekday, count(*) AS n FROM cease GROUP BY 1, 2"""))
def agg_dow_counts(d):
    return pf.weekday_counts(d.cease(), "cease_placed_date")


@query("agg_reason_first", sql("cease_keyed", f"""SELECT reason_description_insight, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM {FIRST_SQL} GROUP BY 1"""))
def agg_reason_first(d):
    return rounded(pf.reason_breakdown(first_events(d)))


@query("agg_topk_trend", sql("cease_keyed", f""", counted AS (SELECT CAST(date_trunc('month', cease_placed_date) AS DATE) AS month, reason_description_insight AS r, count(*) AS n FROM cease_keyed WHERE r IN
 (SELECT reason_description_insight FROM cease_keyed GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5) GROUP BY 1, 2),
 grid AS (SELECT m.month, t.r FROM (SELECT DISTINCT month FROM counted) m, (SELECT DISTINCT r FROM counted) t) SELECT month, r AS reason, coalesce(n, 0) AS n FROM grid LEFT JOIN counted USING (month, r)"""))
def agg_topk_trend(d):
    wide = pf.reason_trend(d.cease(), 5)
    return wide.unpivot(["month"], wide.columns[1:], "reason", "n")


@query("agg_value_counts", sql("accounts calls", """SELECT 'contract_status' AS field, contract_status AS value, count(*) AS n FROM accounts GROUP BY 2 UNION ALL SELECT 'technology', technology, count(*) FROM accounts GROUP BY 2
 UNION ALL SELECT 'call_type', call_type, count(*) FROM calls GROUP BY 2
 UNION ALL SELECT * FROM (SELECT 'channel_top5', sales_channel, count(*) AS c FROM accounts GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5)
 UNION ALL SELECT * FROM (SELECT 'dd', CAST(CAST(contract_dd_cancels AS INTEGER) AS VARCHAR), count(*) FROM accounts GROUP BY contract_dd_cancels ORDER BY contract_dd_cancels NULLS LAST LIMIT 10)"""))
def agg_value_counts(d):
    p, c = d.panel(), d.calls()
    dd = p.select(F.col("contract_dd_cancels").cast("int").alias("dd"))
    parts = [
        (p, "contract_status", pf.value_counts(p, "contract_status")), (p, "technology", pf.value_counts(p, "technology")), (c, "call_type", pf.value_counts(c, "call_type")),
        (p, "channel_top5", pf.value_counts(p, "sales_channel", 5, by_count=True)), (dd, "dd", pf.value_counts(dd, "dd", 10)),
    ]
    out = None
    for _, name, df in parts:
        one = df.select(F.lit(name).alias("field"), F.col(df.columns[0]).cast("string").alias("value"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("agg_rate_by_group", sql("base", """SELECT 'contract_status' AS field, contract_status AS a, CAST(NULL AS VARCHAR) AS b, round(avg(churned), 6) AS churn_rate, count(*) AS n FROM base GROUP BY 2
 UNION ALL SELECT 'technology', technology, NULL, round(avg(churned), 6), count(*) FROM base GROUP BY 2
 UNION ALL SELECT 'tech_dd', technology, CAST(CAST(dd_cancel_60_day AS INTEGER) AS VARCHAR), round(avg(churned), 6), count(*) FROM base GROUP BY technology, dd_cancel_60_day"""))
def agg_rate_by_group(d):
    b = base(d).withColumn("dd", F.col("dd_cancel_60_day").cast("int").cast("string"))
    out = None
    for field, keys in (("contract_status", ["contract_status"]), ("technology", ["technology"]), ("tech_dd", ["technology", "dd"])):
        df = pf.rate_by(b, keys)
        second = F.col(keys[1]) if len(keys) > 1 else F.lit(None).cast("string")
        one = df.select(F.lit(field).alias("field"), F.col(keys[0]).alias("a"), second.alias("b"), "churn_rate", "n")
        out = one if out is None else out.unionByName(one)
    return rounded(out)


@query("agg_pivot_rate", sql("base", """SELECT contract_status, round(avg(churned) FILTER (WHERE technology = 'FTTC'), 6) AS "FTTC", round(avg(churned) FILTER (WHERE technology = 'FTTP'), 6) AS "FTTP",
 round(avg(churned) FILTER (WHERE technology = 'GFAST'), 6) AS "GFAST", round(avg(churned) FILTER (WHERE technology = 'MPF'), 6) AS "MPF" FROM base GROUP BY 1"""))
def agg_pivot_rate(d):
    return rounded(pf.rate_pivot(base(d), "contract_status", "technology", ["FTTC", "FTTP", "GFAST", "MPF"]))


@query("agg_two_way_median", sql("base", """SELECT technology, churned, round(avg(tenure_days), 6) AS mean, count(*) AS n, round(quantile_cont(tenure_days, 0.5), 6) AS median FROM base GROUP BY 1, 2"""))
def agg_two_way_median(d):
    return rounded(pf.group_median(base(d), "tenure_days", ["technology", "churned"]))


@query("agg_gap_summary", sql("base", """SELECT churned, round(avg(g), 1) AS mean_gap, round(quantile_cont(g, 0.5), 1) AS median_gap, count(*) AS n FROM
 (SELECT churned, CASE WHEN speed <> 0 THEN (speed - line_speed) / speed * 100 END AS g FROM base WHERE line_speed > 0) GROUP BY 1"""))
def agg_gap_summary(d):
    out = pf.group_median(pf.measured_gap(base(d)), "speed_gap_pct", ["churned"])
    return out.select("churned", F.round("mean", 1).alias("mean_gap"), F.round("median", 1).alias("median_gap"), "n")


@query("agg_call_per_customer", sql("calls", f"""SELECT {ID}, count(*) AS total_calls, count(*) FILTER (WHERE call_type = 'Loyalty') AS loyalty_calls, round(count(*) FILTER (WHERE call_type = 'Loyalty') * 100.0::DOUBLE / count(*), 6) AS pct_loyalty,
 round(avg(talk_time_seconds), 6) AS avg_talk_time, round(avg(hold_time_seconds), 6) AS avg_hold_time, max(talk_time_seconds) AS max_talk_time FROM calls GROUP BY 1"""))
def agg_call_per_customer(d):
    return rounded(activity.calls_all_time(d.calls()))


@query("agg_calls_histogram", sql("calls", f"SELECT n_calls, count(*) AS n_customers FROM (SELECT {ID}, count(*) AS n_calls FROM calls GROUP BY 1) GROUP BY 1"))
def agg_calls_histogram(d):
    return pf.calls_histogram(d.calls())


@query("agg_histogram", sql("base", """SELECT churned, CAST(least(floor((tenure_days - lo) * 40 / (hi - lo)), 39) AS INTEGER) AS bin, count(*) AS n, round(count(*) / max(t) / 50.0::DOUBLE, 6) AS density FROM
 (SELECT *, min(tenure_days) OVER () AS lo, max(tenure_days) OVER () AS hi, count(*) OVER (PARTITION BY churned) AS t FROM base) GROUP BY 1, 2"""))
def agg_histogram(d):
    counts = pf.histogram(base(d), "tenure_days", 40, ["churned"])
    return rounded(pf.density(counts, ["churned"], 50.0))


@query("agg_daily_mean", sql("usage_num", "SELECT calendar_date, round(avg(dl), 6) AS avg_dl FROM usage_num GROUP BY 1"))
def agg_daily_mean(d):
    return rounded(pf.daily_mean(d.usage()))


@query("agg_zero_pct_having", sql("usage_num", f"""SELECT {ID}, round(sum(CASE WHEN dl = 0 OR usage_download_mbs IS NULL THEN 1.0::DOUBLE ELSE 0 END) / count(*), 6) AS zero_pct, count(*) AS n_days FROM usage_num GROUP BY 1 HAVING count(*) > 10"""))
def agg_zero_pct_having(d):
    return rounded(pf.zero_share(d.usage()))


@query("agg_percentile_cont", sql("usage_num accounts", """SELECT 'download' AS measure, count(*) AS n, round(quantile_cont(dl, 0.25), 6) AS q25, round(quantile_cont(dl, 0.5), 6) AS q50, round(quantile_cont(dl, 0.75), 6) AS q75, round(quantile_cont(dl, 0.95), 6) AS q95,
  round(quantile_cont(dl, 0.99), 6) AS q99 FROM usage_num WHERE dl > 0
 UNION ALL SELECT 'tenure', count(*), round(quantile_cont(tenure_days, 0.25), 6), round(quantile_cont(tenure_days, 0.5), 6), round(quantile_cont(tenure_days, 0.75), 6), round(quantile_cont(tenure_days, 0.95), 6), round(quantile_cont(tenure_days, 0.99), 6) FROM accounts"""))
def agg_percentile_cont(d):
    dl = activity.parsed_usage(d.usage()).where("dl > 0").select(F.lit("download").alias("measure"), F.col("dl").alias("v"))
    both = dl.unionByName(d.panel().select(F.lit("tenure").alias("measure"), F.col("tenure_days").alias("v")))
    return rounded(quantiles(both, "v", [0.25, 0.5, 0.75, 0.95, 0.99], ["measure"]))


@query("agg_usage_all_time", sql("usage_num", f"SELECT {ID}, round(avg(dl), 6) AS avg_download_mbs, round(avg(ul), 6) AS avg_upload_mbs FROM usage_num GROUP BY 1"))
def agg_usage_all_time(d):
    return rounded(activity.usage_all_time(d.usage()))


@query("agg_profile")
def agg_profile(d):
    return rounded(pf.column_profile(d.raw_tables()))


DESCRIBED = ["tenure_days", "ooc_days", "speed", "line_speed", "contract_dd_cancels"]


@query("agg_describe", sql("accounts", " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
 round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM accounts""" for c in DESCRIBED)))
def agg_describe(d):
    return rounded(pf.describe(d.panel(), DESCRIBED))


CORR = ["churned", "tenure_days", "ooc_days", "speed", "line_speed", "speed_gap_pct", "contract_dd_cancels", "dd_cancel_60_day", "total_calls", "loyalty_calls", "avg_download_mbs", "avg_upload_mbs"]


def corr_cell(a: str, b: str) -> str:
    return f"round(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END, 6)"


@query("agg_corr_matrix", sql("base calls usage_num", f", rich AS ({RICH_SQL})\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {'1.0::DOUBLE' if a == b else corr_cell(*sorted((a, b), key=CORR.index))} AS r FROM rich" for a in CORR for b in CORR if a != b)
    + " UNION ALL SELECT unnest([" + ", ".join(f"'{c}'" for c in CORR) + "]), unnest([" + ", ".join(f"'{c}'" for c in CORR) + "]), 1.0::DOUBLE"))
def agg_corr_matrix(d):
    return rounded(association.pearson_matrix(rich(d), CORR))


@query("agg_corr_target", sql("base calls usage_num", f", rich AS ({RICH_SQL}), c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {corr_cell(c, 'churned')} AS r FROM rich" for c in CORR[1:]) + """)
 SELECT feature, r, abs(r) AS abs_r, CASE WHEN r > 0 THEN '⬆ Higher → More Churn' ELSE '⬇ Higher → Less Churn' END AS direction,
 CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS INTEGER) AS rank FROM c"""))
def agg_corr_target(d):
    return rounded(association.target_correlation(rich(d), CORR[1:], "churned"))


NUMERIC_MATRIX = [c for c in [*CONTRACT_COLS, *CALL_COLS, *USAGE_COLS] if c not in ("tenure_bucket", "sales_channel", "crm_package_name")]


@query("agg_multicollinear", sql("assembled", "SELECT a, b, round(r, 6) AS r FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM assembled" for i, a in enumerate(NUMERIC_MATRIX) for b in NUMERIC_MATRIX[i + 1:]) + ") WHERE NOT isnan(r) AND abs(r) > 0.85"))
def agg_multicollinear(d):
    return rounded(association.multicollinear(assembled(d), NUMERIC_MATRIX))


CATS = ["contract_status", "technology", "sales_channel", "dd_cancel_60_day", "churned"]


def cramers_sql(a: str, b: str) -> str:
    ta, tb = (f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in (a, b))
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN least(nr, nc) < 2 THEN 0 ELSE sqrt(chi2 / (n * (least(nr, nc) - 1))) END, 6) AS v FROM (
 SELECT max(nr) AS nr, max(nc) AS nc, max(n) AS n, sum(CASE WHEN nr = 2 AND nc = 2 THEN pow(greatest(abs(o - e) - 0.5::DOUBLE, 0), 2) / e ELSE pow(o - e, 2) / e END) AS chi2 FROM (
  SELECT rr.k AS x, cc.k AS y, coalesce(o.n, 0) AS o, rr.n * cc.n / t.n AS e, t.n, (SELECT count(DISTINCT {ta}) FROM base) AS nr, (SELECT count(DISTINCT {tb}) FROM base) AS nc
  FROM (SELECT {ta} AS k, count(*)::DOUBLE AS n FROM base GROUP BY 1) rr CROSS JOIN (SELECT {tb} AS k, count(*)::DOUBLE AS n FROM base GROUP BY 1) cc CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM base) t
  LEFT JOIN (SELECT {ta} AS x, {tb} AS y, count(*)::DOUBLE AS n FROM base GROUP BY 1, 2) o ON o.x = rr.k AND o.y = cc.k))"""


@query("agg_cramers_v", sql("base", " UNION ALL ".join(cramers_sql(a, b) for i, a in enumerate(CATS) for b in CATS[i + 1:])))
def agg_cramers_v(d):
    return rounded(association.cramers_v(base(d), CATS))


NULLABLE = {t: (view, list(columns)) for t, view, columns in (
    ("customer_info", "panel", StarSchema.PANEL_COLUMNS), ("cease", "cease", [c for c in CEASE.fieldNames() if c != "reason_description"]),  # the mapping has no long reason
    ("calls", "calls", CALLS.fieldNames()), ("usage", "usage", USAGE.fieldNames()),
)}
NULL_SQL = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", round(avg(CAST({c} IS NULL AS INTEGER)), 6) AS null_pct FROM {s}" for t, (s, cols) in NULLABLE.items() for c in cols)


@query("agg_null_rates", sql("panel cease calls usage", NULL_SQL))
def agg_null_rates(d):
    t = d.raw_tables()
    return rounded(pf.null_rates(t))


@query("agg_null_group", sql("assembled", """SELECT 'calls' AS feature_group, count(*) FILTER (WHERE call_count_30d IS NULL AND avg_talk_time_30d IS NULL AND days_since_last_call IS NULL) AS n_missing, round(avg(CAST(call_count_30d IS NULL AS INTEGER)), 6) AS share FROM assembled
 UNION ALL SELECT 'usage', count(*) FILTER (WHERE zero_usage_days_30d IS NULL), round(avg(CAST(zero_usage_days_30d IS NULL AS INTEGER)), 6) FROM assembled"""))
def agg_null_group(d):
    m = assembled(d)
    return rounded(pf.null_group(m, CALL_COLS, "calls").unionByName(pf.null_group(m, USAGE_COLS, "usage")))


@query("agg_processing_time", sql("cease", """, took AS (SELECT CAST(date_diff('day', cease_placed_date, TRY_CAST(cease_completed_date AS DATE)) AS INTEGER) AS days FROM cease)
 SELECT days, count(*) AS n, (SELECT quantile_cont(days, 0.5) FROM took WHERE days BETWEEN 0 AND 120) AS median FROM took WHERE days BETWEEN 0 AND 120 GROUP BY 1"""))
def agg_processing_time(d):
    days = pf.processing_days(d.cease())
    return pf.value_counts(days, "days").withColumn("median", quantiles(days, "days", [0.5]).select("q50").scalar())


@query("agg_loyalty_rate", sql("base calls", f"""SELECT CAST(coalesce(l, 0) > 0 AS INTEGER) AS had_loyalty, CAST(coalesce(t, 0) > 0 AS INTEGER) AS has_calls, round(avg(churned), 6) AS churn_rate, count(*) AS n FROM base LEFT JOIN
 (SELECT {ID}, count(*) AS t, count(*) FILTER (WHERE call_type = 'Loyalty') AS l FROM calls GROUP BY 1) USING ({ID}) GROUP BY 1, 2"""))
def agg_loyalty_rate(d):
    return rounded(pf.loyalty_rate(rich(d)))


@query("agg_loyalty_after_cease", sql("calls first_cease", f"""SELECT count(*) AS loyalty_calls, count(*) FILTER (WHERE event_date >= first_cease) AS after_cease, round(count(*) FILTER (WHERE event_date >= first_cease) / count(*), 6) AS share
 FROM calls LEFT JOIN first_cease USING ({ID}) WHERE call_type = 'Loyalty'"""))
def agg_loyalty_after_cease(d):
    return rounded(pf.loyalty_after_cease(d.calls(), panels.first_cease(d.cease())))


@query("agg_reason_addressable", sql("cease_keyed", f"""SELECT CASE WHEN reason_description_insight IN ('CompetitorDeals','TechnicalIssue','Mis-sold') THEN 'addressable' WHEN reason_description_insight IN ('Bereavement','HomeMove') THEN 'non-addressable'
 WHEN reason_description_insight = 'BadDebtDisconnect' THEN 'involuntary' ELSE 'unclassified' END AS reason_group, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {FIRST_SQL} GROUP BY 1"""))
def agg_reason_addressable(d):
    return rounded(pf.reason_groups(first_events(d)))


@query("agg_cease_reversal", sql("cease", "SELECT count(*) AS n, count(*) FILTER (WHERE cease_completed_date IS NULL) AS never_completed, round(avg(CAST(cease_completed_date IS NULL AS INTEGER)), 6) AS share FROM cease"))
def agg_cease_reversal(d):
    gone = F.col("cease_completed_date").isNull()
    return rounded(d.cease().agg(F.count("*").alias("n"), F.count_if(gone).alias("never_completed"), F.avg(gone.cast("double")).alias("share")))


OUTCOME_SQL = f"CASE WHEN p >= {BEST} AND y = 1 THEN 'TP' WHEN p >= {BEST} THEN 'FP' WHEN y = 1 THEN 'FN' ELSE 'TN' END"


@query("agg_confusion", sql("scored", f"SELECT {OUTCOME_SQL} AS outcome, count(*) AS n FROM scored GROUP BY 1"))
def agg_confusion(d):
    return metrics.confusion(d.scored(), BEST)


@query("agg_error_medians", sql("scored_accounts", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, outcome, count({f}) AS n, round(quantile_cont({f}, 0.5), 6) AS median FROM (SELECT *, {OUTCOME_SQL} AS outcome FROM scored_accounts) WHERE outcome IN ('FN', 'TP') AND {f} IS NOT NULL GROUP BY outcome"
    for f in ("tenure_days", "ooc_days", "contract_dd_cancels"))))
def agg_error_medians(d):
    rows = d.scored_accounts().withColumn("outcome", metrics.outcome(BEST)).where(F.col("outcome").isin("FN", "TP"))
    long = pf.long_values(rows, ["tenure_days", "ooc_days", "contract_dd_cancels"], "outcome")
    return rounded(quantiles(long, "value", [0.5], ["feature", "outcome"], ["median"]))


@query("agg_error_share", sql("scored_accounts", f"""SELECT grp AS contract_status, round(count(*) FILTER (WHERE outcome = 'TP') / count(*), 6) AS "TP", round(count(*) FILTER (WHERE outcome = 'FP') / count(*), 6) AS "FP",
 round(count(*) FILTER (WHERE outcome = 'FN') / count(*), 6) AS "FN", round(count(*) FILTER (WHERE outcome = 'TN') / count(*), 6) AS "TN" FROM
 (SELECT CASE WHEN ooc_days >= 0 THEN 'Out-of-contract' ELSE 'In-contract' END AS grp, {OUTCOME_SQL} AS outcome FROM scored_accounts) GROUP BY 1"""))
def agg_error_share(d):
    grp = F.when(F.col("ooc_days") >= 0, "Out-of-contract").otherwise("In-contract")
    rows = d.scored_accounts().select(grp.alias("contract_status"), metrics.outcome(BEST).alias("outcome"))
    kinds = ["TP", "FP", "FN", "TN"]
    wide = rows.groupBy("contract_status").pivot("outcome", kinds).count().fillna(0)
    total = sum((F.col(k) for k in kinds[1:]), F.col(kinds[0]))
    return rounded(wide.select("contract_status", *[(F.col(k) / total).alias(k) for k in kinds]))
