import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ebbtide.config import Label
from ebbtide.operators import activity, contract, encoding, labels, panel as panels
from ebbtide.functions import scalars as fx
from ebbtide.session import scratch

D = dt.date
PANEL = "unique_customer_identifier string, datevalue date, contract_status string, ooc_days double, contract_dd_cancels double, dd_cancel_60_day double, technology string, speed double, line_speed double, sales_channel string, crm_package_name string, tenure_days double"


def panel(spark, *rows):
    base = dict(unique_customer_identifier="a", datevalue=D(2023, 5, 1), contract_status=None, ooc_days=None, contract_dd_cancels=None, dd_cancel_60_day=None,
                technology=None, speed=None, line_speed=None, sales_channel="s", crm_package_name="c", tenure_days=None)
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], PANEL)


def test_all_null_account(spark):
    r = contract.contract_features(panel(spark, {})).first()
    assert r["contract_status_risk"] == 1 and r["is_out_of_contract"] == 0
    assert r["ooc_days"] is None and r["days_to_ooc"] is None and r["speed_gap"] is None
    assert r["speed_gap_pct"] == 0 and r["dd_cancel_60_day"] == 0 and r["has_dd_cancel"] == 0 and r["contract_dd_cancels"] == 0
    assert r["tenure_days"] == 0 and r["tenure_bucket"] == "0-3m" and r["tech_FTTC"] == 0


@pytest.mark.parametrize("days,label", [(-1, "nan"), (0, "0-3m"), (89, "0-3m"), (90, "3m-1yr"), (364, "3m-1yr"), (365, "1-3yr"), (1094, "1-3yr"), (1095, "3yr+")])
def test_tenure_bucket_edges(spark, days, label):
    assert contract.contract_features(panel(spark, {"tenure_days": float(days)})).first()["tenure_bucket"] == label


def test_account_values(spark):
    r = contract.contract_features(panel(spark, {"contract_status": " 06 OOC ", "ooc_days": -12.0, "speed": 80.0, "line_speed": 60.0, "dd_cancel_60_day": 2.0, "technology": "MPF"})).first()
    assert (r["contract_status_risk"], r["days_to_ooc"], r["is_out_of_contract"]) == (5, 12.0, 0)
    assert (r["speed_gap"], r["speed_gap_pct"], r["has_dd_cancel"], r["tech_MPF"]) == (20.0, 0.25, 1, 1)
    assert r["dd_cancel_log"] == pytest.approx(math.log(3))
    z = contract.contract_features(panel(spark, {"ooc_days": 0.0, "speed": 0.0, "line_speed": 5.0})).first()
    assert (z["is_out_of_contract"], z["days_to_ooc"], z["speed_gap"], z["speed_gap_pct"]) == (1, 0.0, 0.0, 0.0)


def test_technology_column_in_capitals_or_absent(spark):
    p = panel(spark, {"technology": "G.Fast"})
    assert contract.contract_features(p.withColumnRenamed("technology", "Technology"), technologies=None).first()["tech_G.Fast"] == 1
    assert contract.contract_features(p.drop("technology"), technologies=None).first()["tech_unknown"] == 1


@pytest.mark.parametrize("text,value", [("12", 12.0), (" 1.5 ", 1.5), ("-.5", -0.5), ("1e3", 1000.0), ("12d", None), ("1_000", None), ("NaN", None), ("inf", None), ("", None), ("n/a", None), (None, None)])
def test_safe_double(spark, text, value):
    assert spark.createDataFrame([(text,)], "v string").select(fx.safe_double("v")).first()[0] == value


def test_calls_window_bounds(spark):
    snap = "2023-06-01"
    day = lambda n: D(2023, 6, 1) - dt.timedelta(days=n)
    rows = [("a", day(n), t, 60.0, None) for n, t in ((0, "Loyalty"), (7, "Loyalty"), (8, "Tech"), (30, "Tech"), (90, "Loyalty"), (91, "Tech"))] + [("b", day(200), "Tech", 5.0, 1.0)]
    calls = spark.createDataFrame(rows, "unique_customer_identifier string, event_date date, call_type string, talk_time_seconds double, hold_time_seconds double")
    got = {r[0]: r for r in activity.call_features(calls, snap).collect()}
    a, b = got["a"], got["b"]
    assert (a["call_count_7d"], a["call_count_14d"], a["call_count_30d"], a["call_count_90d"]) == (1, 2, 3, 4)  # the snapshot day itself is excluded
    assert (a["loyalty_call_flag_30d"], a["loyalty_call_count_90d"], a["pct_loyalty_calls_90d"], a["days_since_last_call"]) == (1, 2, 0.5, 7)
    assert a["call_frequency_trend"] == pytest.approx(3 / (4 / 3)) and a["avg_hold_time_30d"] is None
    assert (b["call_count_90d"], b["pct_loyalty_calls_90d"], b["call_frequency_trend"], b["avg_talk_time_30d"], b["days_since_last_call"]) == (0, 0.0, 1.0, None, 200)
    both = activity.call_features(calls, [snap, "2023-06-02"])
    assert both.where(F.col("snapshot_date") == snap).exceptAll(activity.call_features(calls, snap)).count() == 0
    assert both.where((F.col("snapshot_date") == "2023-06-02") & (F.col("unique_customer_identifier") == "a")).first()["call_count_7d"] == 1


def test_usage_defaults(spark):
    rows = [("a", D(2023, 5, 20), "n/a", "1"), ("a", D(2023, 5, 25), None, None), ("a", D(2023, 5, 30), "0", "2"), ("old", D(2022, 1, 1), "5", "5")]
    usage = spark.createDataFrame(rows, "unique_customer_identifier string, calendar_date date, usage_download_mbs string, usage_upload_mbs string")
    got = {r[0]: r for r in activity.usage_features(usage, "2023-06-01").collect()}
    assert (got["a"]["zero_usage_days_30d"], got["a"]["avg_download_30d"], got["a"]["avg_daily_total_mb_30d"]) == (3, 0.0, 1.0)
    assert got["a"]["usage_volatility_30d"] is None and got["a"]["download_trend_7_30"] == 1.0
    assert (got["old"]["avg_download_30d"], got["old"]["download_trend_7_30"], got["old"]["download_pct_change_30_60d"], got["old"]["zero_usage_days_30d"]) == (None, 1.0, 0.0, 0)


def test_label_window_and_completed_only(spark):
    ids = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("d",)], "unique_customer_identifier string")
    cease = spark.createDataFrame([("a", D(2023, 6, 1), None), ("b", D(2023, 8, 30), "2023-09-01"), ("c", D(2023, 5, 31), "2023-06-02")], "unique_customer_identifier string, cease_placed_date date, cease_completed_date string")
    get = lambda label: {r[0]: r["churned"] for r in labels.churn_label(ids, cease, "2023-06-01", label).collect()}
    assert get(Label()) == {"a": 1, "b": 0, "c": 0, "d": 0}
    assert get(Label(window_days=91)) == {"a": 1, "b": 1, "c": 0, "d": 0}
    assert get(Label(window_days=91, include_pending=False)) == {"a": 0, "b": 1, "c": 0, "d": 0}


def test_asof_keeps_ties_and_anchor_drops_late_history(spark):
    p = panel(spark, {"datevalue": D(2023, 4, 1)}, {"datevalue": D(2023, 5, 1), "speed": 1.0}, {"datevalue": D(2023, 5, 1), "speed": 2.0}, {"datevalue": D(2023, 7, 1)}, {"unique_customer_identifier": "late", "datevalue": D(2023, 7, 1)})
    assert sorted(r["speed"] for r in panels.latest_asof(p, "2023-06-01").collect()) == [1.0, 2.0]
    cease = spark.createDataFrame([("a", D(2023, 4, 20)), ("late", D(2023, 6, 1))], "unique_customer_identifier string, cease_placed_date date")
    rows = panels.retrospective_anchor(p, cease).collect()
    assert [(r[0], r["datevalue"], r["churned"]) for r in rows] == [("a", D(2023, 4, 1), 1)]


def test_out_of_fold_against_a_loop(spark):
    import hashlib
    import random

    rng = random.Random(3)
    rows = [(f"c{i}", "hot" if rng.random() < 0.4 else rng.choice(["x", "y", None]), f"k{rng.randint(0, 4)}", int(rng.random() < 0.3)) for i in range(400)]
    df = spark.createDataFrame(rows, "unique_customer_identifier string, crm_package_name string, sales_channel string, churned int")
    fold = lambda i: int(hashlib.md5(i.encode()).hexdigest()[:8], 16) % 5
    mean = sum(r[3] for r in rows) / len(rows)
    got = {r[0]: r for r in encoding.out_of_fold(df).select("unique_customer_identifier", "crm_package_name_encoded", "sales_channel_encoded").collect()}
    for i, pack, chan, _ in rows:
        for c, pos, name in ((pack, 1, "crm_package_name_encoded"), (chan, 2, "sales_channel_encoded")):
            other = [r[3] for r in rows if r[pos] == c and fold(r[0]) != fold(i)] if c is not None else []
            want = (sum(other) + mean) / (len(other) + 1)
            assert got[i][name] == pytest.approx(want)
    enc = encoding.fit(df)
    new = spark.createDataFrame([("z", "never", None)], "unique_customer_identifier string, crm_package_name string, sales_channel string")
    r = enc.apply(new).first()
    assert r["crm_package_name_encoded"] == pytest.approx(mean) and r["sales_channel_encoded"] == pytest.approx(mean)


def test_call_features_read_the_log_once_and_equal_those_of_single_dates(spark):
    """Last call and windows share one pass, whether windows of two dates overlap or not."""
    days = [(c, f"2023-{m:02d}-{d:02d}", k, float(m * d), None if d % 3 else float(d)) for c in range(6) for m in range(1, 7) for d in range(1 + c % 4, 28, 4 + c) for k in ("Loyalty", "Tech")]
    path = scratch(spark, "calls")
    spark.createDataFrame(days, "c int, d string, call_type string, talk_time_seconds double, hold_time_seconds double").select(
        F.col("c").cast("string").alias("unique_customer_identifier"), F.col("d").cast("date").alias("event_date"), "call_type", "talk_time_seconds", "hold_time_seconds",
    ).write.parquet(path)
    calls = spark.read.parquet(path)
    for dates in (["2023-02-10", "2023-02-20", "2023-06-30"], ["2022-12-01", "2023-02-01", "2023-06-01", "2023-12-01"]):
        out = activity.call_features(calls, dates)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
        want = sorted(tuple(r) for d in dates for r in activity.call_features(calls, d).collect())
        got = sorted(tuple(r) for r in out.collect())
        assert len(got) == len(want) > 6 and [g[:2] for g in got] == [w[:2] for w in want]
        assert all(a == b or a == pytest.approx(b) for g, w in zip(got, want, strict=True) for a, b in zip(g, w, strict=True))
