"""Money: what contacting the top of the list is worth against contacting at random."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Economics
from ebbtide.functions.scalars import portable_hash, ratio
from ebbtide.operators.metrics import _capacity, ranked
from ebbtide.operators.ranking import with_position


def _arm(positions: DataFrame, strategy: str, y: str, e: Economics) -> DataFrame:
    cells = []
    for share in e.capacities:
        k = _capacity(share)
        cells.append(F.struct(F.lit(share).alias("capacity_pct"), F.max(k).alias("k"), F.count_if((F.col("position") < k) & (F.col(y) == 1)).alias("tp")))
    row = positions.agg(F.array(*cells).alias("c"), F.count_if(F.col(y) == 1).alias("all_pos"))
    d = row.select(F.explode("c").alias("c"), "all_pos").select("c.*", "all_pos")
    saved, spend = F.col("tp") * e.success_rate * e.annual_revenue, F.col("k") * e.call_cost
    return d.select(
        F.lit(strategy).alias("strategy"),
        "capacity_pct",
        F.col("k").alias("customers_contacted"),
        F.col("tp").alias("true_positives"),
        (F.col("k") - F.col("tp")).alias("false_positives"),
        F.round(ratio(F.col("tp"), F.col("k")), 4).alias("precision"),
        F.round(ratio(F.col("tp"), F.col("all_pos"), 0.0), 4).alias("capture_rate"),
        F.round(F.col("tp") * F.lit(e.success_rate), 1).alias("estimated_retained"),
        F.round(saved, 2).alias("revenue_saved_gbp"),
        F.round(spend, 2).alias("call_spend_gbp"),
        F.round(saved - spend, 2).alias("net_value_gbp"),
    )


def business_impact(df: DataFrame, id_col: str = "id", y: str = "y", p: str = "p", economics: Economics = DEFAULTS.economics) -> DataFrame:
    """Both strategies at every capacity. The random arm is a fixed shuffle by id hash."""
    shuffled = df.select(id_col, y).withColumn("_h", portable_hash(id_col))
    random_order = with_position(shuffled, F.col("_h").asc(), F.col(id_col).asc(), total="n_all")
    return _arm(ranked(df, id_col, y, p), "Model-guided", y, economics).unionByName(_arm(random_order, "Random baseline", y, economics))


def headline(impact: DataFrame, economics: Economics = DEFAULTS.economics) -> DataFrame:
    """Net value of both strategies and their difference at the headline capacity."""
    at = impact.where(F.col("capacity_pct") == F.lit(economics.headline_capacity))
    model = F.max(F.when(F.col("strategy") == "Model-guided", F.col("net_value_gbp")))
    chance = F.max(F.when(F.col("strategy") == "Random baseline", F.col("net_value_gbp")))
    return at.agg(model.alias("model_net_value"), chance.alias("random_net_value"), (model - chance).alias("uplift_vs_random"))
