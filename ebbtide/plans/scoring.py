"""Batch scoring of active customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.scalars import ID
from ebbtide.operators import attribution, encoding, learning, panel as panels, scoring, trees
from ebbtide.plans import features as plans
from ebbtide.plans.training import with_row_key


def score_active(
    panel: DataFrame, calls: DataFrame, usage: DataFrame, cease: DataFrame,
    model: learning.ChurnModel, calibrator: learning.Calibrator, encoder: encoding.FittedEncoder | None,
    snapshot: str | None = None, settings: Settings = DEFAULTS,
) -> DataFrame:
    """Features → probability → drivers → ranked list for customers without a cancellation.

    Customers who left are filtered from the panel and both logs before any feature is
    built. Panel rows that tie on the newest date are cut to one per customer: the one
    with the smallest row key, a hash of the row's own values.
    """
    day = snapshot or scoring.default_snapshot(panel)
    active = panels.active_customers(panel, cease)
    panel, calls, usage = (df.join(active, ID, "left_semi") for df in (panel, calls, usage))
    matrix = plans.feature_matrix(panel, calls, usage, cease, day, encoder, settings) if encoder else plans.assemble(panel, calls, usage, cease, day, settings)
    rows = panels.first_per_key(with_row_key(matrix), ID, ["row_key"])
    scored = calibrator.apply(model.score(rows))
    context = [c for c in scored.columns if c in scoring.CONTEXT_COLUMNS]
    explained = trees.tree_contributions(scored, model, [ID, "row_key", "calibrated", *context])
    listed = explained.withColumn("drivers", attribution.driver_names(n=settings.tiers.top_drivers))
    return scoring.format_scored(listed, p="calibrated", tie="row_key", tiers=settings.tiers)


def score_requests(requests: DataFrame, model: learning.ChurnModel, calibrator: learning.Calibrator | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Probability (4 digits) and tier for request rows with optional fields; works on streams too."""
    full = scoring.complete_requests(requests)
    scored = model.score(full)
    p = "p"
    if calibrator is not None:
        scored, p = calibrator.apply(scored), "calibrated"
    keep = [c for c in requests.columns if c not in scoring.REQUEST_DEFAULTS and c not in scoring.REQUEST_REQUIRED]
    return scored.select(*keep, F.round(p, 4).alias("churn_probability"), scoring.risk_tier(F.col(p), settings.tiers).alias("risk_tier"))
