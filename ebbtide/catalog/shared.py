"""Small helpers of the catalogue modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.catalog.ctes import cte, num  # noqa: F401
from ebbtide.config import TECHNOLOGIES
from ebbtide.plans import features as plans
from ebbtide.sources.starschema import SNAPSHOT, SPLITS, StarSchema


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, so that summation order cannot show in a comparison."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


def assembled(d: StarSchema, snapshots=SNAPSHOT) -> DataFrame:
    return plans.assemble(d.panel(), d.calls(), d.usage(), d.cease(), snapshots)


def matrix(d: StarSchema, snapshots=SNAPSHOT) -> DataFrame:
    return plans.feature_matrix(d.panel(), d.calls(), d.usage(), d.cease(), snapshots)


# ---- SQL for the feature blocks -----------------------------------------------------------------
STATUS_SQL = """CASE lower(trim(contract_status)) WHEN '01 early contract' THEN 0 WHEN '02 in contract' THEN 1
 WHEN '03 soon to be ooc' THEN 2 WHEN '04 coming ooc' THEN 3 WHEN '05 newly ooc' THEN 4 WHEN '06 ooc' THEN 5 ELSE 1 END"""
GAP_SQL = "CASE WHEN speed - line_speed > 0 THEN speed - line_speed WHEN speed - line_speed <= 0 THEN 0.0::DOUBLE END"
BUCKET_SQL = """CASE WHEN t >= 0 AND t < 90 THEN '0-3m' WHEN t >= 90 AND t < 365 THEN '3m-1yr'
 WHEN t >= 365 AND t < 1095 THEN '1-3yr' WHEN t >= 1095 THEN '3yr+' ELSE 'nan' END"""


def contract_sql(source: str, keep: str = "") -> str:
    hot = ",\n ".join(f"CAST(coalesce(technology = '{t}', false) AS INTEGER) AS tech_{t}" for t in TECHNOLOGIES)
    return f"""SELECT unique_customer_identifier, {keep} ooc_days,
 CAST(coalesce(ooc_days >= 0, false) AS INTEGER) AS is_out_of_contract,
 CASE WHEN ooc_days < 0 THEN 0 - ooc_days WHEN ooc_days >= 0 THEN 0.0::DOUBLE END AS days_to_ooc,
 {STATUS_SQL} AS contract_status_risk, {GAP_SQL} AS speed_gap,
 coalesce(({GAP_SQL}) / nullif(speed, 0), 0.0::DOUBLE) AS speed_gap_pct,
 coalesce(dd_cancel_60_day, 0.0::DOUBLE) AS dd_cancel_60_day,
 CAST(coalesce(dd_cancel_60_day, 0) > 0 AS INTEGER) AS has_dd_cancel, ln(1 + coalesce(dd_cancel_60_day, 0.0::DOUBLE)) AS dd_cancel_log,
 coalesce(contract_dd_cancels, 0.0::DOUBLE) AS contract_dd_cancels, t AS tenure_days, ln(1 + t) AS tenure_log,
 {BUCKET_SQL} AS tenure_bucket, sales_channel, crm_package_name, {hot}
FROM (SELECT *, coalesce(tenure_days, 0.0::DOUBLE) AS t FROM {source})"""


def calls_sql(snap: str) -> str:
    def n(days: int, extra: str = "") -> str:
        return f"count(*) FILTER (WHERE event_date >= {snap} - {days}{extra})"

    loyal = " AND call_type = 'Loyalty'"
    return f"""SELECT unique_customer_identifier, {', '.join(f'{n(w)} AS call_count_{w}d' for w in (7, 14, 30, 90))},
 CAST(({n(30, loyal)}) > 0 AS INTEGER) AS loyalty_call_flag_30d, {n(90, loyal)} AS loyalty_call_count_90d,
 coalesce({n(90, loyal)} / nullif({n(90)}, 0), 0.0::DOUBLE) AS pct_loyalty_calls_90d,
 avg(talk_time_seconds) FILTER (WHERE event_date >= {snap} - 30) AS avg_talk_time_30d,
 avg(hold_time_seconds) FILTER (WHERE event_date >= {snap} - 30) AS avg_hold_time_30d,
 CAST(date_diff('day', max(event_date), {snap}) AS INTEGER) AS days_since_last_call,
 coalesce({n(30)} / nullif({n(90)} / 3.0::DOUBLE, 0), 1.0::DOUBLE) AS call_frequency_trend
FROM calls WHERE event_date < {snap} GROUP BY unique_customer_identifier"""


def usage_sql(snap: str) -> str:
    def a(x: str, lo: int, hi: int = 0) -> str:
        return f"avg({x}) FILTER (WHERE calendar_date >= {snap} - {lo} AND calendar_date < {snap} - {hi})"

    a30, prior = a("dl", 30), a("dl", 60, 30)
    return f"""SELECT unique_customer_identifier, {a30} AS avg_download_30d, {a('ul', 30)} AS avg_upload_30d, {a('dl', 7)} AS avg_download_7d,
 coalesce({a('dl', 7)} / nullif({a30}, 0), 1.0::DOUBLE) AS download_trend_7_30,
 coalesce(({a30} - {prior}) / nullif({prior}, 0), 0.0::DOUBLE) AS download_pct_change_30_60d,
 count(*) FILTER (WHERE calendar_date >= {snap} - 30 AND (dl IS NULL OR dl = 0)) AS zero_usage_days_30d,
 stddev_samp(dl) FILTER (WHERE calendar_date >= {snap} - 30) AS usage_volatility_30d,
 {a('coalesce(dl, 0) + coalesce(ul, 0)', 30)} AS avg_daily_total_mb_30d
FROM usage_num WHERE calendar_date < {snap} GROUP BY unique_customer_identifier"""


def asof_sql(snap: str) -> str:
    return f"""SELECT p.* FROM panel p JOIN (SELECT unique_customer_identifier AS cid, max(datevalue) AS newest FROM panel
 WHERE datevalue <= {snap} GROUP BY 1) m ON m.cid = p.unique_customer_identifier AND m.newest = p.datevalue"""


CONTRACT_COLS = ["ooc_days", "is_out_of_contract", "days_to_ooc", "contract_status_risk", "speed_gap", "speed_gap_pct", "dd_cancel_60_day",
                 "has_dd_cancel", "dd_cancel_log", "contract_dd_cancels", "tenure_days", "tenure_log", "tenure_bucket", "sales_channel",
                 "crm_package_name", *[f"tech_{t}" for t in TECHNOLOGIES]]
CALL_COLS = ["call_count_7d", "call_count_14d", "call_count_30d", "call_count_90d", "loyalty_call_flag_30d", "loyalty_call_count_90d",
             "pct_loyalty_calls_90d", "avg_talk_time_30d", "avg_hold_time_30d", "days_since_last_call", "call_frequency_trend"]
USAGE_COLS = ["avg_download_30d", "avg_upload_30d", "avg_download_7d", "download_trend_7_30", "download_pct_change_30_60d",
              "zero_usage_days_30d", "usage_volatility_30d", "avg_daily_total_mb_30d"]
DOUBLES = {"ooc_days", "days_to_ooc", "speed_gap", "speed_gap_pct", "dd_cancel_60_day", "dd_cancel_log", "contract_dd_cancels", "tenure_days",
           "tenure_log", "pct_loyalty_calls_90d", "avg_talk_time_30d", "avg_hold_time_30d", "call_frequency_trend", *USAGE_COLS} - {"zero_usage_days_30d"}


def out_cols(cols, alias: str = "") -> str:
    """Select list with doubles rounded to six digits."""
    return ", ".join(f"round({alias}{c}, 6) AS {c}" if c in DOUBLES or c.endswith("_encoded") else f"{alias}{c}" for c in cols)


SNAP_SQL = "DATE '1998-06-01'"
MATRIX_COLS = ["unique_customer_identifier", "snapshot_date", *CONTRACT_COLS, *CALL_COLS, *USAGE_COLS, "churned"]

for _tag, _snap in (("", SNAP_SQL), ("_v", f"DATE '{SPLITS.val_end}'"), ("_t", f"DATE '{SPLITS.test_end}'")):
    cte(f"newest{_tag}", asof_sql(_snap), "panel")
    cte(f"contract{_tag}", contract_sql(f"newest{_tag}"), f"newest{_tag}")
    cte(f"callf{_tag}", calls_sql(_snap), "calls")
    cte(f"usagef{_tag}", usage_sql(_snap), "usage_num")
    cte(f"leavers{_tag}", f"SELECT DISTINCT unique_customer_identifier FROM cease WHERE cease_placed_date >= {_snap} AND cease_placed_date < {_snap} + 90", "cease")
    cte(f"assembled{_tag}", f"""
SELECT c.*, {_snap} AS snapshot_date, {', '.join('a.' + c for c in CALL_COLS)}, {', '.join('u.' + c for c in USAGE_COLS)},
 CAST(l.unique_customer_identifier IS NOT NULL AS INTEGER) AS churned
FROM contract{_tag} c LEFT JOIN callf{_tag} a USING (unique_customer_identifier) LEFT JOIN usagef{_tag} u USING (unique_customer_identifier)
LEFT JOIN leavers{_tag} l USING (unique_customer_identifier)""", f"contract{_tag}", f"callf{_tag}", f"usagef{_tag}", f"leavers{_tag}")
cte("assembled_all", "SELECT * FROM assembled UNION ALL BY NAME SELECT * FROM assembled_v UNION ALL BY NAME SELECT * FROM assembled_t",
    "assembled", "assembled_v", "assembled_t")

H32 = "CAST('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8) AS BIGINT)"
FOLD_SQL = f"CAST({H32.format('unique_customer_identifier')} % 5 AS INTEGER)"


def oof_sql(source: str, column: str) -> str:
    """Out-of-fold value by its definition: rows of the same category in the other folds."""
    return f"""(SELECT a.fold, a.{column}, (coalesce(sum(b.pos), 0) + m.mu) / (coalesce(sum(b.n), 0) + 1.0::DOUBLE) AS enc
 FROM (SELECT DISTINCT {FOLD_SQL} AS fold, {column} FROM {source}) a
 LEFT JOIN (SELECT {FOLD_SQL} AS fold, {column}, sum(churned) AS pos, count(*) AS n FROM {source} GROUP BY 1, 2) b
   ON b.{column} = a.{column} AND b.fold <> a.fold
 CROSS JOIN (SELECT avg(churned) AS mu FROM {source}) m GROUP BY a.fold, a.{column}, m.mu)"""


cte("matrix", f"""
SELECT x.*, coalesce(p.enc, m.mu) AS crm_package_name_encoded, coalesce(s.enc, m.mu) AS sales_channel_encoded
FROM (SELECT *, {FOLD_SQL} AS fold FROM assembled) x CROSS JOIN (SELECT avg(churned) AS mu FROM assembled) m
LEFT JOIN {oof_sql('assembled', 'crm_package_name')} p ON p.fold = x.fold AND p.crm_package_name = x.crm_package_name
LEFT JOIN {oof_sql('assembled', 'sales_channel')} s ON s.fold = x.fold AND s.sales_channel = x.sales_channel""", "assembled")

# One row per customer: newest row before the first cancellation, smallest order key on ties.
cte("anchored", """
SELECT a.*, CAST(f.first_cease IS NOT NULL AS INTEGER) AS churned, f.first_cease
FROM accounts a LEFT JOIN first_cease f USING (unique_customer_identifier)
JOIN (SELECT p.unique_customer_identifier AS cid, max(p.datevalue) AS anchor FROM panel p LEFT JOIN first_cease f USING (unique_customer_identifier)
      WHERE f.first_cease IS NULL OR p.datevalue <= f.first_cease GROUP BY 1) m ON m.cid = a.unique_customer_identifier AND m.anchor = a.datevalue""",
    "accounts", "panel", "first_cease")
cte("base", """
SELECT * FROM anchored QUALIFY row_number() OVER (PARTITION BY unique_customer_identifier ORDER BY o_orderkey) = 1""", "anchored")
