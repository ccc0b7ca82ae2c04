"""Operations-ready scored list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import CONTEXT_COLUMNS, DEFAULTS, REQUEST_DEFAULTS, REQUEST_REQUIRED, Tiers
from ebbtide.functions.scalars import ID
from ebbtide.operators.ranking import with_position
from ebbtide.session import settle


def default_snapshot(panel: DataFrame) -> str:
    day = panel.agg(F.max("datevalue").cast("string")).first()[0]
    if day is None:
        raise ValueError("the panel is empty: no snapshot date to score")
    return day


def risk_tier(p: Column, tiers: Tiers = DEFAULTS.tiers) -> Column:
    return F.when(p >= tiers.high, "High").when(p >= tiers.medium, "Medium").otherwise("Low")


def priority_rank(df: DataFrame, score: str, tie: str = ID) -> DataFrame:
    """1-based global rank by score, ids deciding ties."""
    out = with_position(df, F.col(score).desc(), F.col(tie).asc())
    return out.withColumn("priority_rank", F.col("position") + 1).drop("position")


def format_scored(df: DataFrame, p: str = "p", drivers: str = "drivers", tie: str = ID, tiers: Tiers = DEFAULTS.tiers) -> DataFrame:
    """priority_rank, id, churn_probability, risk_tier, driver_1..n and known context columns.

    Tiers use the unrounded score, the order uses the rounded one. When no row
    reaches Medium, the best rows are promoted by rank instead.
    """
    context = [c for c in CONTEXT_COLUMNS if c in df.columns]
    names = [F.coalesce(F.get(F.col(drivers), i), F.lit("")).alias(f"driver_{i + 1}") for i in range(tiers.top_drivers)]
    keys = [ID] if tie == ID else [ID, tie]
    flat = df.select(*keys, F.round(F.col(p), 4).alias("churn_probability"), risk_tier(F.col(p), tiers).alias("risk_tier"), *names, *context)
    # Ranking samples its input before it sorts it; written once, rows are scored and explained only once.
    flat = settle(flat)
    ordered = with_position(flat, F.col("churn_probability").desc(), F.col(tie).asc(), total="_n")
    any_higher = flat.select(F.coalesce(F.max(F.col("risk_tier") != "Low"), F.lit(False))).scalar()
    high_n = F.greatest(F.lit(1), F.ceil(F.col("_n") * tiers.fallback_high_share))
    medium_n = F.greatest(high_n + 1, F.ceil(F.col("_n") * tiers.fallback_medium_share))
    fallback = F.when(F.col("position") < high_n, "High").when(F.col("position") < medium_n, "Medium").otherwise("Low")
    tier = F.when(any_higher, F.col("risk_tier")).otherwise(fallback)
    cols = [c for c in flat.columns if c != "risk_tier"]
    out = ordered.select((F.col("position") + 1).alias("priority_rank"), *cols, tier.alias("risk_tier"))
    return out.select("priority_rank", *keys, "churn_probability", "risk_tier", *[f"driver_{i + 1}" for i in range(tiers.top_drivers)], *context)


def tier_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_tier").agg(F.count("*").alias("n"))


def complete_requests(requests: DataFrame) -> DataFrame:
    """Fill absent optional request fields with their defaults; required fields must be present."""
    missing = [c for c in REQUEST_REQUIRED if c not in requests.columns]
    if missing:
        raise ValueError(f"request columns missing: {missing}")
    fields = [F.col(c).cast("double").alias(c) for c in REQUEST_REQUIRED]
    for c, default in REQUEST_DEFAULTS.items():
        value = F.coalesce(F.col(c).cast("double"), F.lit(default)) if c in requests.columns else F.lit(default)
        fields.append(value.alias(c))
    others = [c for c in requests.columns if c not in REQUEST_REQUIRED and c not in REQUEST_DEFAULTS]
    return requests.select(*others, *fields)
