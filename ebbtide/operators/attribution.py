"""Working with per-row feature contributions.

A row's contributions are an ``array<struct<feature, contribution, value>>``;
top drivers come from sorting that array in place, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import DEFAULT_ACTION, DRIVER_ACTIONS
from ebbtide.functions.scalars import lookup


def linear_contributions(df: DataFrame, weights: Mapping[str, float], name: str = "contributions") -> DataFrame:
    """β(x − mean x) per feature; NULL inputs count as 0."""
    x = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in weights}
    means = df.agg(*[F.avg(v).alias(c) for c, v in x.items()]).first()
    cells = [
        F.struct(F.lit(c).alias("feature"), ((x[c] - float(means[c] or 0.0)) * float(w)).alias("contribution"), x[c].alias("value"))
        for c, w in weights.items()
    ]
    return df.withColumn(name, F.array(*cells))


def top_drivers(contributions: Column | str = "contributions", n: int = 3) -> Column:
    """The ``n`` entries with the largest absolute contribution, names deciding ties."""
    c = F.col(contributions) if isinstance(contributions, str) else contributions
    keyed = F.transform(c, lambda e: F.struct((-F.abs(e["contribution"])).alias("k"), e["feature"].alias("feature"), e["contribution"].alias("contribution"), e["value"].alias("value")))
    best = F.slice(F.sort_array(keyed), 1, n)
    return F.transform(best, lambda e: F.struct(e["feature"].alias("feature"), F.round(e["contribution"], 4).alias("contribution"), e["value"].alias("value")))


def driver_names(contributions: Column | str = "contributions", n: int = 3) -> Column:
    return F.transform(top_drivers(contributions, n), lambda e: e["feature"])


# --- fixed values: direction texts --------------------------------------------------------------
UP, DOWN = "↑ Increases churn", "↓ Decreases churn"


def direction(c: Column) -> Column:
    return F.when(c > 0, UP).otherwise(DOWN)


def long_form(df: DataFrame, *keep: str, contributions: str = "contributions") -> DataFrame:
    return df.select(*keep, F.inline(contributions))


def global_importance(df: DataFrame, contributions: str = "contributions") -> DataFrame:
    """(feature, mean_abs, rank)."""
    per = long_form(df, contributions=contributions).groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))
    return per.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs"), "feature")))  # one row per feature


def top_features(df: DataFrame, k: int, contributions: str = "contributions") -> DataFrame:
    return global_importance(df, contributions).where(F.col("rank") <= k)


def dependence(df: DataFrame, id_col: str, k: int = 3, contributions: str = "contributions") -> DataFrame:
    """(id, feature, value, contribution) for the ``k`` most important features."""
    best = top_features(df, k, contributions).select("feature")
    return long_form(df, id_col, contributions=contributions).join(F.broadcast(best), "feature", "left_semi").select(id_col, "feature", "value", "contribution")


def cluster_profile(df: DataFrame, cluster: str = "cluster", contributions: str = "contributions") -> DataFrame:
    """Size, share, dominant and second driver and the direction of the dominant one per cluster."""
    per = long_form(df, cluster, contributions=contributions).groupBy(cluster, "feature").agg(
        F.count("*").alias("size"), F.avg(F.abs("contribution")).alias("strength"), F.avg("contribution").alias("mean")
    )
    order = Window.partitionBy(cluster).orderBy(F.desc("strength"), "feature")  # one row per feature
    ranked = per.withColumn("r", F.row_number().over(order))
    total = df.select(F.count("*")).scalar()
    first, second = F.col("r") == 1, F.col("r") == 2
    out = ranked.groupBy(cluster).agg(
        F.max("size").alias("size"),
        F.max(F.when(first, F.col("feature"))).alias("top_driver"),
        F.max(F.when(second, F.col("feature"))).alias("second_driver"),
        F.max(F.when(first, F.when(F.col("mean") > 0, "high").otherwise("low"))).alias("direction"),
    )
    return out.withColumn("share", F.col("size") / total)


def cluster_heat(df: DataFrame, k: int = 8, cluster: str = "cluster", contributions: str = "contributions") -> DataFrame:
    """Mean contribution per cluster, one column for each of the ``k`` most important features."""
    names = [r["feature"] for r in top_features(df, k, contributions).orderBy("rank").collect()]
    rows = long_form(df, cluster, contributions=contributions).where(F.col("feature").isin(names))
    return rows.groupBy(cluster).pivot("feature", names).agg(F.avg("contribution"))


def action_for(feature: Column) -> Column:
    return lookup(feature, DRIVER_ACTIONS, DEFAULT_ACTION)
