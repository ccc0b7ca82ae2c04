"""Uplift of contacting a customer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def uplift_segment(u: Column, band: float = 0.05) -> Column:
    return F.when(u > band, "Persuadable").when(u < -band, "Do Not Disturb").otherwise("Neutral")


def group_uplift(df: DataFrame, keys: Sequence[str], treatment: str = "contacted", outcome: str = "retained") -> DataFrame:
    """Retained rate of treated minus control per group, with its label."""
    t, y = F.col(treatment), F.col(outcome).cast("double")
    treated, control = F.avg(F.when(t == 1, y)), F.avg(F.when(t == 0, y))
    per = df.groupBy(*keys).agg(F.count_if(t == 1).alias("n_treated"), F.count_if(t == 0).alias("n_control"), treated.alias("p_treated"), control.alias("p_control"), (treated - control).alias("uplift"))
    return per.withColumn("segment", uplift_segment(F.col("uplift")))


@dataclass
class UpliftModel:
    """One fitted classifier per arm (0 control, 1 treated); scores any rows with the features."""

    arms: dict[int, object]
    features: list[str]

    def score(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        """(id, uplift_score, uplift_segment): probability if treated minus probability if not."""
        from ebbtide.operators.learning import ChurnModel, assemble_features, probability

        scored = df if all(isinstance(m, ChurnModel) for m in self.arms.values()) else assemble_features(df, self.features)
        for a, model in self.arms.items():
            if isinstance(model, ChurnModel):
                scored = model.score(scored, f"p{a}")
            else:
                scored = model.transform(scored).withColumn(f"p{a}", probability()).drop("rawPrediction", "probability", "prediction")
        u = F.col("p1") - F.col("p0")
        return scored.select(id_col, u.alias("uplift_score"), uplift_segment(u).alias("uplift_segment"))


def fit_uplift(df: DataFrame, features: Sequence[str], estimator=None, treatment: str = "contacted", outcome: str = "retained", params: Mapping[str, float] | None = None) -> UpliftModel:
    """Fit one model per arm: boosted trees, or any unfitted Spark ML classifier reading ``features`` and ``label``."""
    from ebbtide.operators.learning import assemble_features, fit_boosted

    arms = {}
    for a in (0, 1):
        rows = df.where(F.col(treatment) == a)
        if estimator is None:
            arms[a] = fit_boosted(rows, params={"rounds": 100, **(params or {})}, features=features, target=outcome)
        else:
            arms[a] = estimator.fit(assemble_features(rows, features).withColumn("label", F.col(outcome).cast("double")))
    return UpliftModel(arms, list(features))


def two_model_uplift(df: DataFrame, features: Sequence[str], estimator=None, treatment: str = "contacted", outcome: str = "retained", id_col: str = "id") -> DataFrame:
    """Fit both arms and score the same rows."""
    return fit_uplift(df, features, estimator, treatment, outcome).score(df, id_col)
