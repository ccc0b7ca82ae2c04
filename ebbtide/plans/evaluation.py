"""Evaluation reports built from several operators."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import one_row
from ebbtide.operators import business, metrics


# --- fixed values: verdict texts ----------------------------------------------------------------
DEGRADED, STABLE = "Some degradation detected", "Stable across periods"


def compare_models(splits: Mapping[str, DataFrame], models: Mapping[str, str], y: str = "y", id_col: str = "id") -> DataFrame:
    """(model, split, metric, value) for every score column on every split."""
    parts = [
        metrics.metrics_long(df, id_col=id_col, y=y, p=p).select(F.lit(model).alias("model"), F.lit(split).alias("split"), "metric", "value")
        for model, p in models.items() for split, df in splits.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def executive_summary(val: DataFrame, test: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row of headline numbers; the threshold comes from ``val``, everything else from ``test``."""
    t = metrics.best_f1(val, y, p).first()["threshold"]
    now = metrics.all_metrics(test, y=y, p=p, threshold=t)
    before = metrics.metrics_long(val, y=y, p=p, threshold=t)
    after = now.unpivot([], list(metrics.METRICS), "metric", "value")
    worse = metrics.stability(before, after).agg(F.count_if(F.col("status") == "DEGRADED").alias("n"))
    money = business.headline(business.business_impact(test, y=y, p=p))
    tier = metrics.priority_tier(F.lit(t), p)
    counts = test.agg(
        F.count_if(tier == "Critical").alias("n_critical"), F.count_if(tier == "High").alias("n_high"),
        F.count_if((F.col(p) < t) & (F.col(y) == 1)).alias("n_missed"),
    )
    return one_row(
        now.select("auc_pr", "auc_roc", "brier_score", "lift_at_10pct", F.lit(t).alias("threshold")),
        money.select(F.col("model_net_value").alias("net_value"), "uplift_vs_random"),
        counts,
        worse.select(F.when(F.col("n") > 0, DEGRADED).otherwise(STABLE).alias("stability")),
    )
