"""Non-parametric survival: Kaplan–Meier, medians, log-rank.

Rows are reduced to one line per (stratum, day) first. The windows that follow
run over days, a domain bounded by the length of the observation period.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.scalars import ratio, whole_days

Z95 = 1.959963984540054  # 97.5 % point of the standard normal
CHI2_1_95 = 3.841458820694124  # 95 % point of chi-square with one degree of freedom


def life_table(df: DataFrame, duration: str = "duration", event: str = "event", by: Sequence[str] = ()) -> DataFrame:
    """(by…, t, d, n): events and rows leaving at each distinct day; durations are whole days, at least 1."""
    t = whole_days(duration).alias("t")
    return df.groupBy(*by, t).agg(F.sum(F.col(event).cast("bigint")).alias("d"), F.count("*").alias("n"))


def kaplan_meier(df: DataFrame, duration: str = "duration", event: str = "event", by: Sequence[str] = ()) -> DataFrame:
    """(by…, t, at_risk, d, survival, ci_lo, ci_hi) with the log-log 95 % band."""
    later = Window.partitionBy(*by).orderBy("t").rowsBetween(0, Window.unboundedFollowing)
    sofar = Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    table = life_table(df, duration, event, by).withColumn("at_risk", F.sum("n").over(later))
    d, r = F.col("d").cast("double"), F.col("at_risk").cast("double")
    alive = F.when(d < r, F.ln(1 - d / r))
    table = table.select(
        *by, "t", "at_risk", "d",
        F.max((F.col("d") == F.col("at_risk")).cast("int")).over(sofar).alias("_ended"),
        F.sum(F.coalesce(alive, F.lit(0.0))).over(sofar).alias("_log"),
        F.sum(F.when(d < r, d / (r * (r - d))).otherwise(0.0)).over(sofar).alias("_var"),
    )
    s = F.when(F.col("_ended") == 1, 0.0).otherwise(F.exp("_log"))
    half = F.lit(Z95) * F.sqrt("_var") / -F.col("_log")
    edge = (F.col("_ended") == 1) | (F.col("_log") == 0)
    return table.select(
        *by, "t", "at_risk", "d", s.alias("survival"),
        F.when(edge, s).otherwise(F.exp(F.col("_log") * F.exp(half))).alias("ci_lo"),
        F.when(edge, s).otherwise(F.exp(F.col("_log") * F.exp(-half))).alias("ci_hi"),
    )


def median_survival(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First day with survival ≤ 0.5, else ≤ 0.75, else the last day; ``kind`` says which."""
    s, t = F.col("survival"), F.col("t")
    # A cut-off hit exactly must not depend on the last bits of a product.
    at50, at75 = (F.min(F.when(s <= q + 1e-12, t)) for q in (0.5, 0.75))
    kind = F.when(at50.isNotNull(), "median").when(at75.isNotNull(), "quartile").otherwise("last")
    return curve.groupBy(*by).agg(F.coalesce(at50, at75, F.max("t")).alias("t"), kind.alias("kind"))


def conditional_churn(curve: DataFrame, age: float, horizon: float, by: Sequence[str] = ()) -> DataFrame:
    """P(leaving within ``horizon`` days | still here at ``age``) = (S(a) − S(a+h)) / S(a)."""
    def at(x: float):
        return F.coalesce(F.min(F.when(F.col("t") <= x, F.col("survival"))), F.lit(1.0))

    now, then = at(age), at(age + horizon)
    return curve.groupBy(*by).agg(now.alias("s_now"), then.alias("s_later"), ratio(now - then, now).alias("p_churn"))


@F.pandas_udf(T.DoubleType())
def chi2_sf1(x: pd.Series) -> pd.Series:
    """Upper tail of chi-square with one degree of freedom; used on report rows only."""
    return x.map(lambda v: math.erfc(math.sqrt(max(v, 0.0) / 2)) if pd.notna(v) else None).astype(float)


def logrank(df: DataFrame, group: str, duration: str = "duration", event: str = "event") -> DataFrame:
    """Two-group log-rank test of ``group`` in {0, 1}: statistic and significance at 5 %."""
    rows = df.where(F.col(group).isin(0, 1))
    t = whole_days(duration).alias("t")
    g, e = F.col(group) == 1, F.col(event) == 1
    per = rows.groupBy(t).agg(F.count_if(e).alias("d"), F.count("*").alias("n"), F.count_if(e & g).alias("d1"), F.count_if(g).alias("n1"))
    later = Window.orderBy("t").rowsBetween(0, Window.unboundedFollowing)  # distinct days
    risk = per.select("d", "d1", F.sum("n").over(later).alias("r"), F.sum("n1").over(later).alias("r1"))
    d, r, r1 = (F.col(c).cast("double") for c in ("d", "r", "r1"))
    share = r1 / r
    var = F.when(r > 1, d * share * (1 - share) * (r - d) / (r - 1)).otherwise(0.0)
    sums = risk.agg(F.sum("d1").alias("observed"), F.sum(d * share).alias("expected"), F.sum(var).alias("variance"))
    stat = F.try_divide(F.pow(F.col("observed") - F.col("expected"), 2), F.col("variance"))
    return sums.select("observed", "expected", stat.alias("statistic"), (stat > CHI2_1_95).alias("significant"))


def logrank_p(df: DataFrame, group: str, duration: str = "duration", event: str = "event") -> DataFrame:
    return logrank(df, group, duration, event).withColumn("p_value", chi2_sf1("statistic"))


# --- fixed values: tier names of the quartile stratification, riskiest first ------------------
QUARTILE_TIERS = ("Critical (Q4)", "High (Q3)", "Moderate (Q2)", "Low (Q1)")


def quartile_tier(df: DataFrame, score: str) -> DataFrame:
    """Tier of every row by the exact quartiles of ``score``."""
    from ebbtide.operators.ranking import quantiles

    q = quantiles(df, score, [0.25, 0.5, 0.75]).first()
    if q is None:
        return df.withColumn("tier", F.lit(None).cast("string"))
    s = F.col(score)
    top, high, moderate, low = QUARTILE_TIERS
    return df.withColumn("tier", F.when(s >= q["q75"], top).when(s >= q["q50"], high).when(s >= q["q25"], moderate).when(s < q["q25"], low))


def tier_summary(tiers: DataFrame, score: str, y: str) -> DataFrame:
    total = tiers.select(F.count("*")).scalar()
    per = tiers.groupBy("tier").agg(
        F.count("*").alias("n_customers"), F.sum(F.col(y).cast("bigint")).alias("n_churners"), F.avg(F.col(y).cast("double")).alias("churn_rate"),
        F.avg(score).alias("avg_score"), F.min(score).alias("min_score"), F.max(score).alias("max_score"),
    )
    return per.withColumn("share", F.col("n_customers") / total)


def monotone(summary: DataFrame) -> DataFrame:
    """Do churn rates fall (or stay) from the riskiest tier to the safest?"""
    order = F.array_position(F.array(*[F.lit(t) for t in QUARTILE_TIERS]), F.col("tier"))
    w = Window.orderBy("_o")  # one row per tier
    steps = summary.withColumn("_o", order).select((F.lag("churn_rate").over(w) >= F.col("churn_rate")).alias("fine"))
    return steps.agg(F.bool_and(F.coalesce("fine", F.lit(True))).alias("is_monotone"), F.count("*").alias("n_tiers"))
