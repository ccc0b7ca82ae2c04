"""Projections, filters, joins, feature blocks, labels, splits and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.catalog.ctes import ID, S, num, sql
from ebbtide.catalog.registry import query
from ebbtide.catalog.shared import (
    CALL_COLS, CONTRACT_COLS, FOLD_SQL, MATRIX_COLS, USAGE_COLS, assembled, contract_sql, matrix, out_cols, rounded,
)
from ebbtide.functions import scalars as fx
from ebbtide.operators import activity, contract, encoding, labels, panel as panels, splitting
from ebbtide.plans import features as plans
from ebbtide.sources.starschema import SNAPSHOT, SPLITS

KEYED = "o_orderkey"


@query("prj_contract", sql("panel", f"SELECT {ID}, {out_cols(CONTRACT_COLS)} FROM ({contract_sql('panel')})"))
def prj_contract(d):
    return rounded(contract.contract_features(d.panel()))


@query("prj_status_ordinal", sql("accounts", """SELECT o_orderkey, contract_status, CASE lower(trim(contract_status)) WHEN '02 in contract' THEN 1
 WHEN '03 soon to be ooc' THEN 2 WHEN '05 newly ooc' THEN 4 WHEN '06 ooc' THEN 5 ELSE 1 END AS risk FROM accounts"""))
def prj_status_ordinal(d):
    return d.panel_keyed().select(KEYED, "contract_status", contract.status_risk().alias("risk"))


@query("prj_ooc", sql("accounts", """SELECT o_orderkey, CASE WHEN ooc_days >= 0 THEN 1 ELSE 0 END AS is_out_of_contract,
 CASE WHEN ooc_days IS NULL THEN NULL WHEN ooc_days < 0 THEN 0 - ooc_days ELSE 0.0::DOUBLE END AS days_to_ooc FROM accounts"""))
def prj_ooc(d):
    f = contract.contract_features(d.panel_keyed(), keep=[KEYED])
    return f.select(KEYED, "is_out_of_contract", "days_to_ooc")


@query("prj_speed_gap", sql("accounts", """SELECT o_orderkey, round(g, 6) AS speed_gap, round(CASE WHEN speed > 0 AND g IS NOT NULL THEN g / speed ELSE 0.0::DOUBLE END, 6) AS speed_gap_pct
 FROM (SELECT *, CASE WHEN line_speed IS NOT NULL THEN greatest(speed - line_speed, 0.0::DOUBLE) END AS g FROM accounts)"""))
def prj_speed_gap(d):
    f = contract.contract_features(d.panel_keyed(), keep=[KEYED])
    return rounded(f.select(KEYED, "speed_gap", "speed_gap_pct"))


@query("prj_dd", sql("accounts", """SELECT o_orderkey, dd_cancel_60_day, CASE WHEN dd_cancel_60_day > 0 THEN 1 ELSE 0 END AS has_dd_cancel,
 round(ln(1 + dd_cancel_60_day), 6) AS dd_cancel_log, ifnull(contract_dd_cancels, 0.0::DOUBLE) AS contract_dd_cancels FROM accounts"""))
def prj_dd(d):
    f = contract.contract_features(d.panel_keyed(), keep=[KEYED])
    return rounded(f.select(KEYED, "dd_cancel_60_day", "has_dd_cancel", "dd_cancel_log", "contract_dd_cancels"))


@query("prj_tenure", sql("accounts", """SELECT o_orderkey, tenure_days, round(ln(1 + tenure_days), 6) AS tenure_log,
 CASE WHEN tenure_days < 90 THEN '0-3m' WHEN tenure_days < 365 THEN '3m-1yr' WHEN tenure_days < 1095 THEN '1-3yr' ELSE '3yr+' END AS tenure_bucket FROM accounts"""))
def prj_tenure(d):
    f = contract.contract_features(d.panel_keyed(), keep=[KEYED])
    return rounded(f.select(KEYED, "tenure_days", "tenure_log", "tenure_bucket"))


@query("prj_one_hot", sql("accounts", """SELECT o_orderkey, CASE WHEN technology = 'FTTC' THEN 1 ELSE 0 END AS "tech_FTTC", CASE WHEN technology = 'FTTP' THEN 1 ELSE 0 END AS "tech_FTTP",
 CASE WHEN technology = 'GFAST' THEN 1 ELSE 0 END AS "tech_GFAST", CASE WHEN technology = 'MPF' THEN 1 ELSE 0 END AS "tech_MPF" FROM accounts"""))
def prj_one_hot(d):
    p = d.panel_keyed()
    return p.select(KEYED, *contract.one_hot(F.col("technology"), contract.vocabulary(p, "technology"), "tech_"))


@query("prj_safe_num", sql("usage", f"""SELECT usage_download_mbs AS raw, {num('usage_download_mbs')} AS parsed, count(*) AS n
 FROM usage GROUP BY 1, 2"""))
def prj_safe_num(d):
    return d.usage().groupBy(F.col("usage_download_mbs").alias("raw")).agg(F.count("*").alias("n")).withColumn("parsed", fx.safe_double("raw"))


@query("prj_bucket_right", sql("accounts", """SELECT o_orderkey,
 CASE WHEN t > 0 AND t <= 180 THEN '0–6 months' WHEN t > 180 AND t <= 365 THEN '6–12 months' WHEN t > 365 AND t <= 730 THEN '1–2 years'
  WHEN t > 730 AND t <= 1095 THEN '2–3 years' WHEN t > 1095 AND t <= 1460 THEN '3–4 years' WHEN t > 1460 THEN '4+ years' END AS tenure_band,
 CASE WHEN o <= -180 THEN '≤−180d' WHEN o <= -30 THEN '−180→−30d' WHEN o <= 0 THEN '−30→0d' WHEN o <= 30 THEN '0→30d' WHEN o <= 180 THEN '30→180d' ELSE '>180d' END AS ooc_band,
 CASE WHEN speed <= 0 THEN NULL WHEN speed <= 40 THEN '≤40 Mbps' WHEN speed <= 80 THEN '41–80' WHEN speed <= 200 THEN '81–200' ELSE '201+' END AS speed_tier
 FROM (SELECT *, tenure_days AS t, coalesce(ooc_days, 0) AS o FROM accounts)"""))
def prj_bucket_right(d):
    from ebbtide.operators.profiling import ooc_band, speed_tier, tenure_band

    return d.panel_keyed().select(KEYED, tenure_band().alias("tenure_band"), ooc_band().alias("ooc_band"), speed_tier().alias("speed_tier"))


@query("prj_clip", sql("accounts", """SELECT o_orderkey, CASE WHEN ooc_days < -50 THEN -50.0::DOUBLE WHEN ooc_days > 100 THEN 100.0::DOUBLE ELSE ooc_days END AS clipped,
 CASE WHEN contract_dd_cancels > 1 THEN 1.0::DOUBLE ELSE contract_dd_cancels END AS capped FROM accounts"""))
def prj_clip(d):
    return d.panel_keyed().select(KEYED, fx.clip(F.col("ooc_days"), -50, 100).alias("clipped"), fx.at_most(F.col("contract_dd_cancels"), 1).alias("capped"))


@query("prj_cond_mask", sql("accounts", """SELECT o_orderkey, round(CASE WHEN line_speed > 0 AND speed <> 0 THEN (speed - line_speed) / speed * 100 END, 6) AS speed_gap_pct FROM accounts"""))
def prj_cond_mask(d):
    s, l = F.col("speed"), F.col("line_speed")
    return rounded(d.panel_keyed().select(KEYED, fx.keep_if(l > 0, F.try_divide(s - l, s) * 100).alias("speed_gap_pct")))


@query("prj_date_parts", sql("cease_keyed", """SELECT o_orderkey, strftime(cease_placed_date, '%Y-%m') AS month_period, dayname(cease_placed_date) AS weekday,
 CAST(date_trunc('month', cease_placed_date) AS DATE) AS month_start, CAST(date_diff('day', cease_placed_date, TRY_CAST(cease_completed_date AS DATE)) AS INTEGER) AS days_to_complete FROM cease_keyed"""))
def prj_date_parts(d):
    placed = F.col("cease_placed_date")
    return d.cease_keyed().select(
        KEYED, F.date_format(placed, "yyyy-MM").alias("month_period"), F.date_format(placed, "EEEE").alias("weekday"),
        fx.month_of(placed).alias("month_start"), F.datediff(fx.safe_date("cease_completed_date"), placed).alias("days_to_complete"),
    )


@query("prj_date_coerce", sql("cease_keyed", """SELECT o_orderkey, TRY_CAST(raw AS DATE) AS parsed FROM (SELECT o_orderkey, CASE WHEN reason_description_insight = 'INVALID' THEN 'not a date' ELSE cease_completed_date END AS raw FROM cease_keyed)"""))
def prj_date_coerce(d):
    raw = F.when(F.col("reason_description_insight") == "INVALID", "not a date").otherwise(F.col("cease_completed_date"))
    return d.cease_keyed().select(KEYED, fx.safe_date(raw).alias("parsed"))


@query("prj_ordinal_rank", sql("accounts", """SELECT o_orderkey, contract_status, CAST(r AS INTEGER) AS contract_status_ord FROM accounts LEFT JOIN
 (SELECT contract_status AS cs, row_number() OVER (ORDER BY contract_status) - 1 AS r FROM (SELECT DISTINCT contract_status FROM accounts WHERE contract_status IS NOT NULL)) ON cs = contract_status"""))
def prj_ordinal_rank(d):
    from ebbtide.operators.profiling import ordinal_rank

    return ordinal_rank(d.panel_keyed().select(KEYED, "contract_status"), "contract_status", "contract_status_ord")


@query("prj_dummies_drop_first", sql("accounts", """SELECT o_orderkey, CAST(coalesce(technology, 'Unknown') = 'FTTP' AS INTEGER) AS "tech_FTTP", CAST(coalesce(technology, 'Unknown') = 'GFAST' AS INTEGER) AS "tech_GFAST",
 CAST(coalesce(technology, 'Unknown') = 'MPF' AS INTEGER) AS "tech_MPF", CAST(coalesce(technology, 'Unknown') = 'Unknown' AS INTEGER) AS "tech_Unknown" FROM accounts"""))
def prj_dummies_drop_first(d):
    from ebbtide.operators.profiling import dummies_drop_first

    p = d.panel_keyed()
    return p.select(KEYED, *dummies_drop_first(p, "technology", "tech_"))


@query("prj_undummy", sql("accounts", "SELECT o_orderkey, coalesce(technology, 'Unknown') AS technology FROM accounts"))
def prj_undummy(d):
    from ebbtide.operators.profiling import undummy

    f = contract.contract_features(d.panel_keyed(), keep=[KEYED])
    return f.select(KEYED, undummy(f, "tech_").alias("technology"))


@query("prj_fillna", sql("assembled", f"""SELECT {ID}, tenure_days, is_out_of_contract, round(ifnull(avg_talk_time_30d, 0), 6) AS avg_talk_time_30d,
 ifnull(call_count_30d, 0) AS call_count_30d, round(ifnull(avg_download_30d, 0), 6) AS avg_download_30d, ifnull(ooc_days, 0) AS ooc_days FROM assembled"""))
def prj_fillna(d):
    cols = ["tenure_days", "is_out_of_contract", "avg_talk_time_30d", "call_count_30d", "avg_download_30d", "ooc_days"]
    return rounded(assembled(d).select(ID, *cols).fillna(0))


@query("prj_align_features", sql("assembled", f"""SELECT {ID}, 0.0::DOUBLE AS sales_channel_encoded, round(tenure_days, 6) AS tenure_days, CAST(is_out_of_contract AS DOUBLE) AS is_out_of_contract,
 0.0::DOUBLE AS "tech_CABLE", CAST(call_count_90d AS DOUBLE) AS call_count_90d FROM assembled"""))
def prj_align_features(d):
    from ebbtide.operators.learning import align_features

    wanted = ["sales_channel_encoded", "tenure_days", "is_out_of_contract", "tech_CABLE", "call_count_90d"]
    return rounded(align_features(assembled(d), wanted, keep=[ID]))


NUMERIC_COLS = [c for c in [*CONTRACT_COLS, *CALL_COLS, *USAGE_COLS] if c not in ("tenure_bucket", "sales_channel", "crm_package_name")]


@query("prj_drop_const", sql("assembled", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(stddev_samp(coalesce({c}, 0)), 6) AS std, coalesce(stddev_samp(coalesce({c}, 0)), 0) < 1e-6 AS dropped FROM assembled" for c in [*NUMERIC_COLS, "churned"])))
def prj_drop_const(d):
    """What drop_constant decides about every numeric column, after filling."""
    from ebbtide.operators.profiling import column_spread

    return rounded(column_spread(assembled(d).fillna(0), keep=[ID, "snapshot_date"]))



@query("prj_numeric_only", sql("assembled", f"SELECT {ID}, {out_cols([*NUMERIC_COLS, 'churned'])} FROM assembled"))
def prj_numeric_only(d):
    from ebbtide.operators.profiling import numeric_columns

    m = assembled(d)
    return rounded(m.select(ID, *numeric_columns(m)))


@query("flt_as_of", sql("panel calls usage", f"""SELECT 'calls' AS source, count(*) AS n FROM calls WHERE event_date < {S} UNION ALL SELECT 'usage', count(*) FROM usage WHERE calendar_date < {S}
 UNION ALL SELECT 'customer_info', count(*) FROM panel WHERE datevalue <= {S}"""))
def flt_as_of(d):
    parts = [("calls", d.calls(), "event_date", False), ("usage", d.usage(), "calendar_date", False), ("customer_info", d.panel(), "datevalue", True)]
    frames = [activity.stamp(df, c, SNAPSHOT, inc).agg(F.lit(name).alias("source"), F.count("*").alias("n")) for name, df, c, inc in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("flt_isin_topk", sql("cease_keyed", """SELECT o_orderkey, reason_description_insight FROM cease_keyed WHERE reason_description_insight IN
 (SELECT reason_description_insight FROM cease_keyed GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)"""))
def flt_isin_topk(d):
    from ebbtide.operators.profiling import keep_top_categories

    return keep_top_categories(d.cease_keyed(), "reason_description_insight", 5).select(KEYED, "reason_description_insight")


@query("flt_range", sql("cease_keyed accounts", """SELECT 'processing' AS rule, count(*) AS n FROM cease_keyed WHERE date_diff('day', cease_placed_date, TRY_CAST(cease_completed_date AS DATE)) BETWEEN 0 AND 120
 UNION ALL SELECT 'measured_line', count(*) FROM accounts WHERE line_speed > 0"""))
def flt_range(d):
    took = F.datediff(fx.safe_date("cease_completed_date"), F.col("cease_placed_date"))
    a = d.cease().where(took.between(0, 120)).agg(F.lit("processing").alias("rule"), F.count("*").alias("n"))
    return a.unionByName(d.panel().where("line_speed > 0").agg(F.lit("measured_line").alias("rule"), F.count("*").alias("n")))


# ---- joins -----------------------------------------------------------------------------------
@query("join_asof_latest", sql("accounts", f"""SELECT * EXCLUDE (rk) FROM (SELECT o_orderkey, {ID}, datevalue, contract_status, sales_channel,
 rank() OVER (PARTITION BY {ID} ORDER BY datevalue DESC) AS rk FROM accounts WHERE datevalue <= {S}) WHERE rk = 1"""))
def join_asof_latest(d):
    return panels.latest_asof(d.panel_keyed(), SNAPSHOT).select(KEYED, ID, "datevalue", "contract_status", "sales_channel")


@query("join_asof_anchor", sql("anchored", f"SELECT o_orderkey, {ID}, datevalue, technology, churned FROM anchored"))
def join_asof_anchor(d):
    return panels.retrospective_anchor(d.panel_keyed(), d.cease()).select(KEYED, ID, "datevalue", "technology", "churned")


@query("join_dedup_first", sql("base", f"SELECT o_orderkey, {ID}, datevalue, technology, churned FROM base"))
def join_dedup_first(d):
    return panels.analytical_base(d.panel_keyed(), d.cease(), KEYED).select(KEYED, ID, "datevalue", "technology", "churned")


@query("join_left_features", sql("assembled", f"SELECT {out_cols(MATRIX_COLS)} FROM assembled"))
def join_left_features(d):
    return rounded(assembled(d))


@query("join_left_label_zero", sql("panel leavers", f"""SELECT p.{ID}, DATE '1998-06-01' AS snapshot_date, CASE WHEN l.{ID} IS NULL THEN 0 ELSE 1 END AS churned
 FROM (SELECT DISTINCT {ID} FROM panel) p LEFT JOIN leavers l ON l.{ID} = p.{ID}"""))
def join_left_label_zero(d):
    return labels.churn_label(d.panel(), d.cease(), SNAPSHOT)


@query("join_anti_active", sql("panel cease", f"SELECT DISTINCT {ID} FROM panel WHERE {ID} NOT IN (SELECT {ID} FROM cease)"))
def join_anti_active(d):
    return panels.active_customers(d.panel(), d.cease())


@query("join_inner_overlap", sql("panel calls usage cease", f"""SELECT 'customer_info' AS source, count(DISTINCT {ID}) AS n FROM panel WHERE {ID} IN (SELECT {ID} FROM cease)
 UNION ALL SELECT 'calls', count(DISTINCT {ID}) FROM calls WHERE {ID} IN (SELECT {ID} FROM cease)
 UNION ALL SELECT 'usage', count(DISTINCT {ID}) FROM usage WHERE {ID} IN (SELECT {ID} FROM cease)"""))
def join_inner_overlap(d):
    from ebbtide.operators.quality import key_overlaps

    tables = d.raw_tables()
    return key_overlaps({k: tables[k] for k in ("customer_info", "calls", "usage")}, tables["cease"], ID)


@query("join_nonequi_cover", sql("panel first_cease", f"""SELECT count(DISTINCT f.{ID}) AS covered, (SELECT count(*) FROM first_cease) - count(DISTINCT f.{ID}) AS uncovered
 FROM first_cease f JOIN panel p ON p.{ID} = f.{ID} AND p.datevalue <= f.first_cease"""))
def join_nonequi_cover(d):
    from ebbtide.operators.quality import pre_event_coverage

    return pre_event_coverage(d.panel(), d.cease())


@query("join_inner_range_leak", sql("panel first_cease", f"""SELECT count(*) AS n_leaked FROM (SELECT {ID}, max(datevalue) AS newest FROM panel GROUP BY 1) JOIN first_cease USING ({ID}) WHERE newest > first_cease"""))
def join_inner_range_leak(d):
    from ebbtide.operators.quality import late_snapshots

    return late_snapshots(d.panel(), d.cease())


@query("join_left_monthly", sql("panel cease", f"""SELECT b.month, b.base, ifnull(c.churners, 0) AS churners, round(ifnull(c.churners, 0) / b.base * 100.0::DOUBLE, 6) AS churn_pct FROM
 (SELECT datevalue AS month, count(DISTINCT {ID}) AS base FROM panel GROUP BY 1) b LEFT JOIN
 (SELECT CAST(date_trunc('month', cease_placed_date) AS DATE) AS month, count(DISTINCT {ID}) AS churners FROM cease GROUP BY 1) c USING (month)"""))
def join_left_monthly(d):
    from ebbtide.operators.profiling import monthly_churn_rate

    return rounded(monthly_churn_rate(d.panel(), d.cease()))


RICH_SQL = f"""SELECT b.*, ifnull(c.total_calls, 0) AS total_calls, ifnull(c.loyalty_calls, 0) AS loyalty_calls, c.pct_loyalty, c.avg_talk_time, c.avg_hold_time, c.max_talk_time,
 u.avg_download_mbs, u.avg_upload_mbs, CASE WHEN b.line_speed > 0 AND b.speed <> 0 THEN (b.speed - b.line_speed) / b.speed * 100 END AS speed_gap_pct
 FROM base b LEFT JOIN (SELECT {ID}, count(*) AS total_calls, count(*) FILTER (WHERE call_type = 'Loyalty') AS loyalty_calls,
   count(*) FILTER (WHERE call_type = 'Loyalty') * 100.0::DOUBLE / count(*) AS pct_loyalty, avg(talk_time_seconds) AS avg_talk_time, avg(hold_time_seconds) AS avg_hold_time,
   max(talk_time_seconds) AS max_talk_time FROM calls GROUP BY 1) c USING ({ID})
 LEFT JOIN (SELECT {ID}, avg(dl) AS avg_download_mbs, avg(ul) AS avg_upload_mbs FROM usage_num GROUP BY 1) u USING ({ID})"""


@query("join_left_rich", sql("base calls usage_num", f"""SELECT {ID}, churned, total_calls, loyalty_calls, round(pct_loyalty, 6) AS pct_loyalty, round(avg_talk_time, 6) AS avg_talk_time,
 round(avg_download_mbs, 6) AS avg_download_mbs, round(avg_upload_mbs, 6) AS avg_upload_mbs, round(speed_gap_pct, 6) AS speed_gap_pct FROM ({RICH_SQL})"""))
def join_left_rich(d):
    from ebbtide.operators.profiling import rich_base

    rich = rich_base(panels.analytical_base(d.panel_keyed(), d.cease(), KEYED), d.calls(), d.usage())
    return rounded(rich.select(ID, "churned", "total_calls", "loyalty_calls", "pct_loyalty", "avg_talk_time", "avg_download_mbs", "avg_upload_mbs", "speed_gap_pct"))


@query("join_category_map", sql("assembled", f"""SELECT a.{ID}, a.sales_channel, a.tenure_days, round(coalesce(m.enc, g.mu), 6) AS sales_channel_encoded, round(coalesce(k.enc, g.mu), 6) AS crm_package_name_encoded
 FROM assembled a CROSS JOIN (SELECT avg(churned) AS mu FROM assembled) g
 LEFT JOIN (SELECT sales_channel, (sum(churned) + (SELECT avg(churned) FROM assembled)) / (count(*) + 1.0::DOUBLE) AS enc FROM assembled GROUP BY 1) m USING (sales_channel)
 LEFT JOIN (SELECT crm_package_name, (sum(churned) + (SELECT avg(churned) FROM assembled)) / (count(*) + 1.0::DOUBLE) AS enc FROM assembled GROUP BY 1) k USING (crm_package_name)"""))
def join_category_map(d):
    df = assembled(d)
    return rounded(encoding.fit(df).apply(df).select(ID, "sales_channel", "tenure_days", "sales_channel_encoded", "crm_package_name_encoded"))


# ---- feature aggregates ----------------------------------------------------------------------
@query("agg_call_features", sql("callf", f"SELECT {ID}, {S} AS snapshot_date, {out_cols(CALL_COLS)} FROM callf"))
def agg_call_features(d):
    return rounded(activity.call_features(d.calls(), SNAPSHOT))


@query("agg_usage_features", sql("usagef", f"SELECT {ID}, {S} AS snapshot_date, {out_cols(USAGE_COLS)} FROM usagef"))
def agg_usage_features(d):
    return rounded(activity.usage_features(d.usage(), SNAPSHOT))


@query("agg_window_param", sql("calls", f"""SELECT {ID}, {S} AS snapshot_date, count(*) FILTER (WHERE event_date >= {S} - 10) AS call_count_10d, count(*) FILTER (WHERE event_date >= {S} - 45) AS call_count_45d,
 count(*) FILTER (WHERE event_date >= {S} - 180) AS call_count_180d FROM calls WHERE event_date < {S} GROUP BY 1"""))
def agg_window_param(d):
    return activity.call_counts(d.calls(), SNAPSHOT, (10, 45, 180))


@query("agg_label", sql("newest cease", f"""SELECT a.{ID}, {S} AS snapshot_date, CAST(max(CASE WHEN c.{ID} IS NOT NULL THEN 1 ELSE 0 END) AS INTEGER) AS churned FROM newest a
 LEFT JOIN cease c ON c.{ID} = a.{ID} AND c.cease_placed_date >= {S} AND c.cease_placed_date < {S} + 90 AND c.cease_completed_date IS NOT NULL GROUP BY 1"""))
def agg_label(d):
    from ebbtide.config import Label

    return labels.churn_label(panels.latest_asof(d.panel(), SNAPSHOT), d.cease(), SNAPSHOT, Label(include_pending=False))


# ---- splits, encoding, matrix ----------------------------------------------------------------
T1, T2, T3 = (f"DATE '{x}'" for x in SPLITS.snapshots)
SPLIT_SQL = f"CASE WHEN datevalue <= {T1} THEN 'train' WHEN datevalue <= {T2} THEN 'val' WHEN datevalue <= {T3} THEN 'test' END"


@query("ml_temporal_split", sql("accounts", f"""SELECT o_orderkey, 'train' AS split FROM accounts WHERE datevalue <= {T1} UNION ALL SELECT o_orderkey, 'val' FROM accounts WHERE datevalue > {T1} AND datevalue <= {T2}
 UNION ALL SELECT o_orderkey, 'test' FROM accounts WHERE datevalue > {T2} AND datevalue <= {T3}"""))
def ml_temporal_split(d):
    s = splitting.temporal_split(d.panel_keyed(), "datevalue", SPLITS)
    parts = [df.select(KEYED, F.lit(name).alias("split")) for name, df in (("train", s.train), ("val", s.val), ("test", s.test))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ml_split_sizes", sql("scored_accounts", f"SELECT {SPLIT_SQL} AS split, count(*) AS n_rows, round(avg(y), 6) AS churn_rate FROM scored_accounts WHERE datevalue <= {T3} GROUP BY 1"))
def ml_split_sizes(d):
    return rounded(splitting.split_sizes(d.scored_accounts(), "datevalue", "y", SPLITS))


@query("ml_leak_dates", sql("accounts", f"SELECT max(datevalue) FILTER (WHERE datevalue <= {T1}) AS max_train, min(datevalue) FILTER (WHERE datevalue > {T2} AND datevalue <= {T3}) AS min_test, max(datevalue) FILTER (WHERE datevalue <= {T1}) < min(datevalue) FILTER (WHERE datevalue > {T2} AND datevalue <= {T3}) AS ok FROM accounts"))
def ml_leak_dates(d):
    return splitting.leak_dates(d.panel_keyed(), "datevalue", SPLITS)


@query("ml_leak_snapshot", sql("assembled", "SELECT count(DISTINCT snapshot_date) AS n_snapshots, count(DISTINCT snapshot_date) = 1 AS ok FROM assembled"))
def ml_leak_snapshot(d):
    return splitting.single_snapshot(assembled(d))


@query("ml_target_encode_fit", sql("matrix", f"SELECT {ID}, ooc_days, churned, round(crm_package_name_encoded, 6) AS crm_package_name_encoded, round(sales_channel_encoded, 6) AS sales_channel_encoded FROM matrix"))
def ml_target_encode_fit(d):
    return rounded(encoding.out_of_fold(assembled(d)).select(ID, "ooc_days", "churned", "crm_package_name_encoded", "sales_channel_encoded"))


@query("ml_target_encode_apply", sql("assembled assembled_v", f"""SELECT v.{ID}, v.sales_channel, v.crm_package_name, v.ooc_days, round(coalesce(s.enc, g.mu), 6) AS sales_channel_encoded, round(coalesce(k.enc, g.mu), 6) AS crm_package_name_encoded
 FROM assembled_v v CROSS JOIN (SELECT avg(churned) AS mu FROM assembled) g
 LEFT JOIN (SELECT sales_channel, (sum(churned) + (SELECT avg(churned) FROM assembled)) / (count(*) + 1.0::DOUBLE) AS enc FROM assembled GROUP BY 1) s USING (sales_channel)
 LEFT JOIN (SELECT crm_package_name, (sum(churned) + (SELECT avg(churned) FROM assembled)) / (count(*) + 1.0::DOUBLE) AS enc FROM assembled GROUP BY 1) k USING (crm_package_name)"""))
def ml_target_encode_apply(d):
    enc = encoding.fit(assembled(d))
    return rounded(enc.apply(assembled(d, SPLITS.val_end)).select(ID, "sales_channel", "crm_package_name", "ooc_days", "sales_channel_encoded", "crm_package_name_encoded"))


@query("ml_kfold", sql("panel", f"SELECT DISTINCT {ID}, {FOLD_SQL} AS fold FROM panel"))
def ml_kfold(d):
    return d.panel().select(ID, encoding.fold_of().alias("fold")).distinct()


@query("ml_feature_matrix", sql("matrix", f"SELECT {out_cols([*MATRIX_COLS, 'crm_package_name_encoded', 'sales_channel_encoded'])} FROM matrix"))
def ml_feature_matrix(d):
    return rounded(matrix(d))
