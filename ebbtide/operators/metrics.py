"""Ranking metrics, curves and decision tables from a frame of (id, label, score).

Curves work on distinct scores: rows are counted per score first, so a score
shared by a third of all rows is one row afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import one_row, ratio
from ebbtide.operators.ranking import running_totals, with_position
from ebbtide.session import settle

TOP_PERCENTS = (5, 10, 20)
METRICS = (
    "auc_pr", "auc_roc", "f1", "brier_score",
    *[f"{m}_at_{k}pct" for k in TOP_PERCENTS for m in ("precision", "lift")],
)


def score_curve(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score (descending): n, pos, their running and overall sums."""
    counted = df.groupBy(*by, p).agg(F.count("*").alias("n"), F.sum(F.col(y).cast("bigint")).alias("pos"))
    return running_totals(counted, p, ["n", "pos"], by)


def _ap() -> Column:
    return F.try_divide(F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n")), F.max("all_pos").cast("double"))


def _auc() -> Column:
    neg, above = F.col("n") - F.col("pos"), F.col("cum_pos") - F.col("pos")
    won = F.sum(neg.cast("double") * (above + F.col("pos") / 2))
    pairs = F.max("all_pos").cast("double") * (F.max("all_n") - F.max("all_pos"))
    return F.try_divide(won, pairs)


def curve_quality(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return curve.groupBy(*by).agg(_ap().alias("auc_pr"), _auc().alias("auc_roc"), F.max("all_n").alias("n"), F.max("all_pos").alias("churners"))


def average_precision(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return curve_quality(score_curve(df, y, p)).select("auc_pr")


def roc_auc(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return curve_quality(score_curve(df, y, p)).select("auc_roc")


def _hits(y: str, p: str, threshold: float | Column) -> dict[str, Column]:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    up, one = F.col(p) >= t, F.col(y) == 1
    return {"tp": F.count_if(up & one), "fp": F.count_if(up & ~one), "fn": F.count_if(~up & one), "tn": F.count_if(~up & ~one)}


def _f1(h: dict[str, Column]) -> Column:
    return ratio(h["tp"] * 2, h["tp"] * 2 + h["fp"] + h["fn"], 0.0)


def f1_brier(df: DataFrame, y: str = "y", p: str = "p", threshold: float | Column = 0.5) -> DataFrame:
    err = F.col(p).cast("double") - F.col(y)
    return df.agg(_f1(_hits(y, p, threshold)).alias("f1"), F.avg(err * err).alias("brier_score"))


def ranked(df: DataFrame, id_col: str = "id", y: str = "y", p: str = "p") -> DataFrame:
    """(id, y, p, position, n_all): rows in score order, ids deciding ties."""
    return with_position(df.select(id_col, y, p), F.col(p).desc(), F.col(id_col).asc(), total="n_all")


def _capacity(share: float) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("n_all") * F.lit(float(share))))


def _percent_cut(k: int) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("n_all") * k / 100))


def top_percent(positions: DataFrame, y: str = "y", percents: Sequence[int] = TOP_PERCENTS) -> DataFrame:
    """precision_at_k / lift_at_k columns for each percentage."""
    base = F.avg(F.col(y).cast("double"))
    cols = []
    for k in percents:
        cut = _percent_cut(k)
        hit = F.avg(F.when(F.col("position") < cut, F.col(y).cast("double")))
        cols += [hit.alias(f"precision_at_{k}pct"), ratio(hit, base, 0.0).alias(f"lift_at_{k}pct")]
    return positions.agg(*cols)


def all_metrics(df: DataFrame, id_col: str = "id", y: str = "y", p: str = "p", threshold: float | Column = 0.5) -> DataFrame:
    """One row with the ten headline metrics."""
    quality = curve_quality(score_curve(df, y, p)).select("auc_pr", "auc_roc")
    row = one_row(quality, f1_brier(df, y, p, threshold), top_percent(ranked(df, id_col, y, p), y))
    return row.select(*METRICS)


def metrics_long(df: DataFrame, **kw) -> DataFrame:
    wide = all_metrics(df, **kw)
    return wide.unpivot([], list(METRICS), "metric", "value")


# ---- curves ----------------------------------------------------------------------------------
def pr_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Precision and recall when everything at or above each score is flagged, plus the (1, 0) end point."""
    c = score_curve(df, y, p).select(
        F.col(p).cast("double").alias("threshold"), (F.col("cum_pos") / F.col("cum_n")).alias("precision"), ratio(F.col("cum_pos"), F.col("all_pos")).alias("recall")
    )
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return c.unionByName(end)


def roc_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """False and true positive rate at each score, plus the origin."""
    c = score_curve(df, y, p).select(
        F.col(p).cast("double").alias("threshold"),
        ratio(F.col("cum_n") - F.col("cum_pos"), F.col("all_n") - F.col("all_pos")).alias("fpr"),
        ratio(F.col("cum_pos"), F.col("all_pos")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return c.unionByName(start)


def best_f1(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, f1) of the score with the highest F1; the lowest score wins ties."""
    c = pr_curve(df, y, p).where(F.col("threshold").isNotNull())
    f1 = F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-10))
    best = c.withColumn("f1", f1).agg(F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("neg"))).alias("b"))
    return best.select((-F.col("b.neg")).alias("threshold"), F.col("b.f1").alias("f1"))


def threshold_report(df: DataFrame, threshold: float | Column, y: str = "y", p: str = "p") -> DataFrame:
    h = _hits(y, p, threshold)
    return df.agg(
        ratio(h["tp"], h["tp"] + h["fp"], 0.0).alias("precision"), ratio(h["tp"], h["tp"] + h["fn"], 0.0).alias("recall"), _f1(h).alias("f1"),
        (h["tp"] + h["fp"]).alias("flagged"), ratio(h["tp"] + h["fp"], F.count("*")).alias("flagged_share"),
    )


def outcome(threshold: float | Column, y: str = "y", p: str = "p") -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    up, one = F.col(p) >= t, F.col(y) == 1
    return F.when(up & one, "TP").when(up, "FP").when(one, "FN").otherwise("TN")


def confusion(df: DataFrame, threshold: float | Column, y: str = "y", p: str = "p") -> DataFrame:
    """Rows per outcome; outcomes that do not occur are missing."""
    return df.groupBy(outcome(threshold, y, p).alias("outcome")).agg(F.count("*").alias("n"))


def reliability(df: DataFrame, bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    """Mean predicted and observed rate per uniform score bin; empty bins are absent."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.avg(p).alias("mean_predicted"), F.avg(F.col(y).cast("double")).alias("observed_rate"), F.count("*").alias("n"))


def hosmer_lemeshow(df: DataFrame, groups: int = 10, id_col: str = "id", y: str = "y", p: str = "p") -> DataFrame:
    """Chi-square statistic of observed against expected counts over score groups of equal size."""
    pos = ranked(df, id_col, y, p)
    g = F.floor(F.col("position") * groups / F.col("n_all"))
    per = pos.groupBy(g.alias("g")).agg(F.count("*").alias("n"), F.sum(y).alias("o"), F.sum(p).alias("e"))
    term = F.try_divide(F.pow(F.col("o") - F.col("e"), 2), F.col("e") * (1 - F.col("e") / F.col("n")))
    return per.agg(F.sum(term).alias("statistic"), (F.count("*") - 2).alias("dof"))


# ---- tables ----------------------------------------------------------------------------------
def decile_of(position: Column, n: Column, parts: int = 10) -> Column:
    """Part 1..parts by quantiles of the position, right-closed (not ``ntile``)."""
    return F.coalesce(F.greatest(F.lit(1), F.ceil(F.try_divide(position.cast("double") * parts, (n - 1).cast("double")))), F.lit(1)).cast("int")


def decile_table(df: DataFrame, id_col: str = "id", y: str = "y", p: str = "p") -> DataFrame:
    from pyspark.sql import Window

    pos = ranked(df, id_col, y, p)
    per = pos.groupBy(decile_of(F.col("position"), F.col("n_all")).alias("decile")).agg(F.count("*").alias("n_customers"), F.sum(F.col(y).cast("bigint")).alias("n_churners"))
    whole = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # ten rows
    so_far = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    rate = F.col("n_churners") / F.col("n_customers")
    base = F.sum("n_churners").over(whole) / F.sum("n_customers").over(whole)
    return per.select(
        "decile", "n_customers", "n_churners", F.round(rate, 4).alias("churn_rate"), F.round(ratio(rate, base, 0.0), 2).alias("lift"),
        F.round(ratio(F.sum("n_churners").over(so_far), F.sum("n_churners").over(whole), 0.0), 4).alias("cumulative_capture_rate"),
    )


def gains_curve(df: DataFrame, id_col: str = "id", y: str = "y", p: str = "p") -> DataFrame:
    """Share of churners reached after contacting each customer in score order."""
    rows = df.select(id_col, p, F.col(y).cast("bigint").alias("hit"))
    c = with_position(rows, F.col(p).desc(), F.col(id_col).asc(), total="n_all", sums=["hit"])
    contacted = F.col("position") + 1
    return c.select(id_col, contacted.alias("contacted"), (contacted / F.col("n_all")).alias("contacted_share"), ratio(F.col("cum_hit"), F.col("all_hit")).alias("captured_share"))


def gains_points(df: DataFrame, percents: Sequence[int] = (10, 25, 50), id_col: str = "id", y: str = "y", p: str = "p") -> DataFrame:
    pos = ranked(df, id_col, y, p)
    cells = []
    for k in percents:
        hit = F.count_if((F.col("position") < F.floor(F.col("n_all") * k / 100)) & (F.col(y) == 1))
        cells.append(F.struct(F.lit(k).alias("pct"), hit.alias("captured"), ratio(hit, F.count_if(F.col(y) == 1)).alias("capture_rate")))
    return pos.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def segment_quality(df: DataFrame, segments: dict[str, Column], minimum: int = 50, y: str = "y", p: str = "p") -> DataFrame:
    """Ranking quality per segment value; small or one-class groups are left out.

    All segmentations, and the aggregate they are compared with, share one
    shuffle: counts per (segment, group, score).
    """
    named = [F.struct(F.lit(name).alias("segment"), c.cast("string").alias("group")) for name, c in segments.items()]
    everyone = F.struct(F.lit("").alias("segment"), F.lit("").alias("group"))
    long = df.select(F.explode(F.array(everyone, *named)).alias("s"), y, p).select("s.segment", "s.group", y, p).where(F.col("group").isNotNull())
    by = ["segment", "group"]
    per = settle(curve_quality(score_curve(long, y, p, by), by))  # one row per group, read twice
    overall = per.where("segment = ''").first()
    kept = per.where((F.col("segment") != "") & (F.col("n") >= minimum) & (F.col("churners") > 0) & (F.col("churners") < F.col("n")))
    return kept.withColumn("churn_rate", F.col("churners") / F.col("n")).withColumn("vs_aggregate", F.col("auc_pr") - F.lit(overall["auc_pr"] if overall else None).cast("double"))


def stability(before: DataFrame, after: DataFrame) -> DataFrame:
    """Compare two long metric frames: delta, relative delta and a verdict at ±10 %."""
    j = before.select("metric", F.col("value").alias("validation")).join(after.select("metric", F.col("value").alias("test")), "metric")
    j = j.withColumn("delta", F.col("test") - F.col("validation")).withColumn("delta_pct", F.try_divide(F.col("delta"), F.abs("validation")) * 100)
    status = F.when(F.col("delta_pct").isNull(), "").when(F.col("delta_pct") < -10, "DEGRADED").when(F.col("delta_pct") > 10, "IMPROVED").otherwise("Stable")
    return j.withColumn("status", status)


# --- fixed values: operational priority tiers and what to do with each -------------------------
TIER_ACTIONS = {
    "Critical": "Immediate outbound call + bespoke offer",
    "High": "Proactive retention call within 7 days",
    "Watch": "Automated email + NPS survey",
    "Low Risk": "No immediate action — monitor next refresh",
}


def priority_tier(threshold: Column, p: str = "p") -> Column:
    """Tier of a score; the bands are closed below and open above, the top one closed at 1.0 as well."""
    s = F.col(p)
    return (
        F.when((s >= 0.5) & (s <= 1.0), "Critical").when((s >= threshold) & (s < 0.5), "High")
        .when((s >= threshold * 0.5) & (s < threshold), "Watch").when((s >= 0) & (s < threshold * 0.5), "Low Risk")
    )


def priority_tiers(df: DataFrame, threshold: float | Column, y: str = "y", p: str = "p") -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    tier = priority_tier(t, p)
    pairs = [F.lit(x) for kv in TIER_ACTIONS.items() for x in kv]
    per = df.groupBy(tier.alias("tier")).agg(F.count("*").alias("n"), F.sum(F.col(y).cast("bigint")).alias("churners")).where(F.col("tier").isNotNull())
    return per.withColumn("churn_rate", F.col("churners") / F.col("n")).withColumn("action", F.try_element_at(F.create_map(*pairs), F.col("tier")))
