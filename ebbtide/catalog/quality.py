"""Validation and quality gate, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.catalog.ctes import ID, num, sql
from ebbtide.catalog.eda import NULL_SQL
from ebbtide.catalog.registry import query
from ebbtide.catalog.shared import MATRIX_COLS, assembled, out_cols, rounded
from ebbtide.operators import profiling as pf, quality as dq, splitting
from ebbtide.session import settle
from ebbtide.sources.starschema import SPLITS

DATA_END = "2000-01-01"
T1, T2, T3 = (f"DATE '{x}'" for x in SPLITS.snapshots)

RULES = {
    "customer_info": ("panel", [(ID, "not_nullable", f"{ID} IS NULL"), (ID, "type_string", "false"), ("datevalue", "not_nullable", "datevalue IS NULL"), ("datevalue", "type_date", "false"),
        ("contract_status", "isin", "contract_status NOT IN ('01 Early Contract','02 In Contract','03 Soon to be OOC','04 Coming OOC','05 Newly OOC','06 OOC')"),
        ("technology", "isin", "technology NOT IN ('FTTC','FTTP','GFAST','MPF')"),
        *[x for c in ("contract_dd_cancels", "dd_cancel_60_day", "speed", "line_speed", "tenure_days") for x in ((c, "type_double", "false"), (c, "ge_0", f"{c} < 0"))], ("ooc_days", "type_double", "false")]),
    "cease": ("cease", [(ID, "not_nullable", f"{ID} IS NULL"), (ID, "type_string", "false"), ("cease_placed_date", "not_nullable", "cease_placed_date IS NULL"), ("cease_placed_date", "type_date", "false"),
        ("reason_description_insight", "isin", "reason_description_insight NOT IN ('CompetitorDeals','VagueReason','HomeMove','Bereavement','Other','BadDebtDisconnect','CustomerServices','Installation&Provisioning','Mis-sold','TV','TechnicalIssue')"),
        ("cease_completed_date", "date_order", "cease_completed_date <> '' AND NOT coalesce(TRY_CAST(cease_completed_date AS DATE) >= cease_placed_date, false)")]),
    "calls": ("calls", [(ID, "not_nullable", f"{ID} IS NULL"), (ID, "type_string", "false"), ("event_date", "not_nullable", "event_date IS NULL"), ("event_date", "type_date", "false"),
        ("talk_time_seconds", "ge_0", "talk_time_seconds < 0"), ("hold_time_seconds", "ge_0", "hold_time_seconds < 0")]),
    "usage": ("usage", [(ID, "not_nullable", f"{ID} IS NULL"), (ID, "type_string", "false"), ("calendar_date", "not_nullable", "calendar_date IS NULL"), ("calendar_date", "type_date", "false")]),
}


def rules_sql(keep) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{k}' AS \"check\", count(*) FILTER (WHERE {p}) AS n_fail FROM {s}" for t, (s, rs) in RULES.items() for c, k, p in rs if keep(k))


ALL = "panel cease calls usage"


@query("dq_schema", sql(ALL, rules_sql(lambda k: k.startswith(("type", "not")))))
def dq_schema(d):
    return dq.full_report(d.raw_tables()).where(F.col("check").rlike("^(type|not)"))


@query("dq_isin", sql(ALL, rules_sql(lambda k: k == "isin")))
def dq_isin(d):
    return dq.full_report(d.raw_tables()).where("check = 'isin'")


@query("dq_ge", sql(ALL, rules_sql(lambda k: k == "ge_0")))
def dq_ge(d):
    return dq.full_report(d.raw_tables()).where("check = 'ge_0'")


@query("dq_date_order", sql(ALL, rules_sql(lambda k: k == "date_order")))
def dq_date_order(d):
    cease = d.cease()
    return dq.rule_counts(cease, [dq.date_order("cease_completed_date", "cease_placed_date")], "cease")


@query("dq_lazy_report", sql(ALL, rules_sql(lambda k: True)))
def dq_lazy_report(d):
    return dq.full_report(d.raw_tables())


@query("dq_strict", sql("assembled", f"SELECT {out_cols(MATRIX_COLS)} FROM assembled"))
def dq_strict(d):
    return dq.validate(rounded(assembled(d)), "matrix")


@query("dq_date_issue_split", sql("cease", """SELECT count(*) FILTER (WHERE TRY_CAST(cease_completed_date AS DATE) < cease_placed_date) AS inverted,
 count(*) FILTER (WHERE cease_placed_date IS NULL AND cease_completed_date IS NOT NULL) AS completed_without_placed FROM cease"""))
def dq_date_issue_split(d):
    return dq.date_issues(d.cease())


@query("dq_nulls_gate", sql(ALL, f"SELECT *, 'WARN' AS status FROM ({NULL_SQL}) WHERE null_pct > 0.30"))
def dq_nulls_gate(d):
    t = d.raw_tables()
    return rounded(dq.nulls_gate(pf.null_rates(t)))


@query("dq_dup_profile", sql("cease", f"""SELECT {ID}, count(*) AS n_events, count(DISTINCT cease_placed_date) AS n_dates, count(DISTINCT reason_description_insight) AS n_reasons,
 CAST(date_diff('day', min(cease_placed_date), max(cease_placed_date)) AS INTEGER) AS span_days, CASE WHEN min(cease_placed_date) = max(cease_placed_date) THEN 'same-day' ELSE 'multi-date' END AS kind
 FROM cease GROUP BY 1 HAVING count(*) > 1"""))
def dq_dup_profile(d):
    return dq.duplicate_profile(d.cease())


@query("dq_dup_counts", sql(ALL, f"""SELECT 'cease' AS "table", count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {ID} FROM cease)) AS extra_rows FROM cease
 UNION ALL SELECT 'customer_info', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT {ID}, datevalue FROM panel)) FROM panel
 UNION ALL SELECT 'calls', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM calls)) FROM calls
 UNION ALL SELECT 'usage', count(*), count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM usage)) FROM usage"""))
def dq_dup_counts(d):
    return dq.duplicate_counts(d.raw_tables())


COVERAGE_SQL = f"""SELECT (SELECT count(DISTINCT {ID}) FROM cease) AS n_cease, (SELECT count(DISTINCT {ID}) FROM panel) AS n_customer_info, (SELECT count(DISTINCT {ID}) FROM calls) AS n_calls, (SELECT count(DISTINCT {ID}) FROM usage) AS n_usage,
 (SELECT count(DISTINCT {ID}) FROM cease WHERE {ID} IN (SELECT {ID} FROM panel)) AS cease_in_customer_info, (SELECT count(DISTINCT {ID}) FROM cease WHERE {ID} IN (SELECT {ID} FROM calls)) AS cease_in_calls,
 (SELECT count(DISTINCT {ID}) FROM cease WHERE {ID} IN (SELECT {ID} FROM usage)) AS cease_in_usage, (SELECT count(DISTINCT {ID}) FROM cease WHERE {ID} NOT IN (SELECT {ID} FROM panel)) AS cease_only,
 (SELECT count(DISTINCT {ID}) FROM panel WHERE {ID} NOT IN (SELECT {ID} FROM cease)) AS info_only,
 (SELECT count(*) FROM first_cease f WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.{ID} = f.{ID} AND p.datevalue <= f.first_cease)) AS no_pre_cease"""


@query("dq_coverage", sql(ALL + " first_cease", f"SELECT *, round(cease_in_customer_info / n_cease, 6) AS coverage_pct, CASE WHEN cease_in_customer_info / n_cease > 0.95 THEN 'PASS' ELSE 'WARN' END AS status FROM ({COVERAGE_SQL})"))
def dq_coverage(d):
    return rounded(dq.coverage(d.raw_tables()))


TEMPORAL_SQL = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", min({c}) AS min_date, max({c}) AS max_date, count(DISTINCT {c}) AS n_dates, count(*) FILTER (WHERE {c} > DATE '{DATA_END}') AS n_future FROM {s}"
    for t, c, s in (("cease", "cease_placed_date", "cease"), ("customer_info", "datevalue", "panel"), ("calls", "event_date", "calls"), ("usage", "calendar_date", "usage")))


@query("dq_temporal", sql(ALL, TEMPORAL_SQL))
def dq_temporal(d):
    return dq.temporal_coverage(d.raw_tables(), DATA_END)


@query("dq_horizon", sql(ALL, f"""SELECT data_min, data_max, CAST({T3} + 90 AS DATE) AS test_label_end, CAST(floor(date_diff('day', data_min, data_max) / 30) AS INTEGER) AS months_of_data,
 CAST(floor(greatest(date_diff('day', CAST({T3} + 90 AS DATE), data_max), 0) / 30) AS INTEGER) AS unused_months FROM (SELECT min(min_date) AS data_min, max(max_date) AS data_max FROM ({TEMPORAL_SQL}))"""))
def dq_horizon(d):
    return dq.unused_horizon(dq.temporal_coverage(d.raw_tables(), DATA_END), SPLITS.test_end, 90)


@query("dq_outliers", sql("panel", " UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) AS n_rows, count(DISTINCT {ID}) AS n_customers FROM panel WHERE {p}" for k, p in (
    ("negative_tenure", "tenure_days < 0"), ("speed_zero_line_positive", "speed = 0 AND line_speed > 0"), ("line_above_speed", "line_speed > speed AND speed > 0"), ("ooc_below_3650", "ooc_days < -3650")))))
def dq_outliers(d):
    return dq.outliers(d.panel())


@query("dq_unparseable", sql("usage", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NOT NULL AND ({num(c)}) IS NULL) AS n_bad, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM usage" for c in ("usage_download_mbs", "usage_upload_mbs"))))
def dq_unparseable(d):
    return dq.unparseable(d.usage(), ["usage_download_mbs", "usage_upload_mbs"])


@query("dq_cardinality", sql("panel calls", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(DISTINCT {c}) AS actual, {m} AS expected_max, count(DISTINCT {c}) <= {m} AS ok FROM {s}" for t, s, c, m in (
    ("customer_info", "panel", "contract_status", 6), ("customer_info", "panel", "technology", 4), ("customer_info", "panel", "sales_channel", 20), ("customer_info", "panel", "crm_package_name", 50), ("calls", "calls", "call_type", 20)))))
def dq_cardinality(d):
    return dq.cardinality(d.panel(), d.calls())


@query("dq_leak_cols", sql("assembled", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n_values, false AS leaky FROM assembled" for c in MATRIX_COLS)))
def dq_leak_cols(d):
    """Columns of the built matrix with their leak flag, counted over the matrix rows."""
    m = assembled(d)
    bad = set(splitting.leaky_columns(m))
    cells = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n_values"), F.lit(c in bad).alias("leaky")) for c in m.columns]
    return m.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")


@query("dq_panel_overlap", sql("scored_accounts", f""", s AS (SELECT {ID} AS cid, CASE WHEN datevalue <= {T1} THEN 'train' WHEN datevalue <= {T2} THEN 'val' WHEN datevalue <= {T3} THEN 'test' END AS split, y FROM scored_accounts)
 SELECT (SELECT count(*) FROM (SELECT cid FROM s WHERE split = 'train' INTERSECT SELECT cid FROM s WHERE split = 'test')) AS in_both,
 (SELECT count(*) FROM (SELECT cid FROM s WHERE split = 'train' GROUP BY 1 HAVING count(*) > 1)) AS dup_train, (SELECT count(*) FROM (SELECT cid FROM s WHERE split = 'test' GROUP BY 1 HAVING count(*) > 1)) AS dup_test,
 (SELECT count(*) FROM (SELECT cid FROM s WHERE split = 'train' AND y = 1 INTERSECT SELECT cid FROM s WHERE split = 'test' AND y = 1)) AS churned_both"""))
def dq_panel_overlap(d):
    return splitting.panel_overlap(d.scored_accounts(), "datevalue", "y", SPLITS)


@query("dq_gate", sql(ALL + " first_cease", f""", r AS ({rules_sql(lambda k: True)}), g AS (
 SELECT 'Schema validation' AS "check", CASE WHEN sum(n_fail) = 0 THEN 'PASS' WHEN sum(n_fail) = sum(n_fail) FILTER (WHERE "table" = 'cease' AND "check" = 'date_order') THEN 'WARN' ELSE 'FAIL' END AS status FROM r
 UNION ALL SELECT 'Completeness', CASE WHEN count(*) FILTER (WHERE null_pct > 0.30) = 0 THEN 'PASS' ELSE 'WARN' END FROM ({NULL_SQL})
 UNION ALL SELECT 'Duplicates', CASE WHEN count(*) - count(DISTINCT {ID}) < count(*) * 0.15 THEN 'PASS' ELSE 'WARN' END FROM cease
 UNION ALL SELECT 'Join integrity', CASE WHEN cease_in_customer_info / n_cease > 0.95 THEN 'PASS' ELSE 'WARN' END FROM ({COVERAGE_SQL})
 UNION ALL SELECT 'Temporal coverage', CASE WHEN sum(n_future) = 0 THEN 'PASS' ELSE 'WARN' END FROM ({TEMPORAL_SQL})
 UNION ALL SELECT 'Outliers & cardinality', CASE WHEN (SELECT count(*) FROM panel WHERE tenure_days < 0 OR (speed = 0 AND line_speed > 0) OR ooc_days < -3650) + (SELECT count(*) FROM usage WHERE usage_download_mbs = 'n/a') = 0 THEN 'PASS' ELSE 'WARN' END
 UNION ALL SELECT 'Leakage risk', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END FROM (SELECT unnest({list(MATRIX_COLS)}) AS c) WHERE lower(c) IN ('cease_placed_date', 'cease_completed_date', 'reason_description', 'reason_description_insight'))
 SELECT "check", status FROM g UNION ALL SELECT 'VERDICT', CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'BLOCKED' WHEN count(*) FILTER (WHERE status = 'WARN') > 0 THEN 'PROCEED WITH CAUTION' ELSE 'ALL CLEAR' END FROM g"""))
def dq_gate(d):
    rows = settle(dq.gate(d.raw_tables(), DATA_END, assembled(d).columns))  # a handful of rows, used for the verdict as well
    return rows.unionByName(dq.verdict(rows).select(F.lit("VERDICT").alias("check"), F.col("verdict").alias("status")))


# ---- set operations --------------------------------------------------------------------------
@query("set_union_all", sql("panel calls", f"SELECT {ID}, datevalue AS day, 'panel' AS source FROM panel UNION ALL SELECT {ID}, event_date, 'calls' FROM calls"))
def set_union_all(d):
    a = d.panel().select(ID, F.col("datevalue").alias("day"), F.lit("panel").alias("source"))
    return a.unionByName(d.calls().select(F.lit("calls").alias("source"), F.col("event_date").alias("day"), ID))


@query("set_distinct", sql("panel calls", f"""SELECT 'panel' AS source, count(*) AS n_tuples FROM (SELECT DISTINCT {ID}, datevalue FROM panel) UNION ALL SELECT 'calls', count(*) FROM (SELECT DISTINCT * FROM calls)"""))
def set_distinct(d):
    a = d.panel().select(ID, "datevalue").distinct().agg(F.lit("panel").alias("source"), F.count("*").alias("n_tuples"))
    return a.unionByName(d.calls().distinct().agg(F.lit("calls").alias("source"), F.count("*").alias("n_tuples")))


@query("set_key_diff", sql("panel cease", f"""SELECT (SELECT count(*) FROM (SELECT {ID} FROM panel EXCEPT SELECT {ID} FROM cease)) AS only_a, (SELECT count(*) FROM (SELECT {ID} FROM cease EXCEPT SELECT {ID} FROM panel)) AS only_b,
 (SELECT count(*) FROM (SELECT {ID} FROM cease INTERSECT SELECT {ID} FROM panel)) AS both"""))
def set_key_diff(d):
    return dq.key_diff(d.panel(), d.cease())
