"""Train, calibrate and evaluate in one run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Settings
from ebbtide.functions.scalars import ID
from ebbtide.operators import learning, metrics, quality, splitting
from ebbtide.session import settle
from ebbtide.sources import sinks


@dataclass
class TrainingRun:
    model: learning.ChurnModel
    calibrator: learning.Calibrator
    params: dict
    metrics: DataFrame
    sizes: DataFrame


def load_run(spark: SparkSession, run_path: str) -> tuple[learning.ChurnModel, learning.Calibrator]:
    """Model, with its feature list, and calibrator of a logged run."""
    return learning.ChurnModel.load(spark, f"{run_path}/churn"), learning.Calibrator.load(f"{run_path}/calibrator")


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Unique tie-break for rows that may repeat a customer: id first, then the row's own values."""
    numbers = [c for c in df.columns if c != ID]
    return df.withColumn(name, F.concat_ws("|", F.col(ID), F.lower(F.hex(F.xxhash64(*numbers)))))


def train(matrix: DataFrame, settings: Settings = DEFAULTS, n_trials: int = 50, fixed: dict | None = None, run_path: str | None = None, run_id: str = "run") -> TrainingRun:
    """Split by time, check leakage, search ``n_trials`` settings (0: none), fit with early stop on val,
    calibrate on val, evaluate calibrated scores on test, and log the run.

    Trials and rounds are written to ``run_path`` as they end; a run that was cut off and
    starts again there goes on from them.
    """
    quality.validate(matrix, "matrix")
    bad = splitting.leaky_columns(matrix)
    if bad:
        raise ValueError(f"columns that must not be features: {bad}")
    split = splitting.temporal_split(matrix, splits=settings.splits)
    split.check()
    fixed = dict(fixed or {})
    params, _ = learning.tune(split.train, split.val, n_trials, fixed=fixed, run_path=run_path and f"{run_path}/search") if n_trials else ({}, None)
    model = learning.fit_boosted(split.train, split.val, {**params, **fixed}, run_path=run_path and f"{run_path}/fit")
    calibrator = learning.calibrate(model.score(split.val), y="churned")
    # The metrics read the scores several times; written once, each test row is scored once.
    scored = settle(calibrator.apply(model.score(with_row_key(split.test))).select("row_key", "churned", "calibrated"))
    result = metrics.metrics_long(scored, id_col="row_key", y="churned", p="calibrated")
    sizes = splitting.split_sizes(matrix, splits=settings.splits)
    if run_path:
        sinks.log_metrics(result, f"{run_path}/metrics", run_id)
        sinks.log_params(matrix.sparkSession, {**params, **fixed, "window_days": settings.label.window_days}, f"{run_path}/params", run_id)
        model.save(f"{run_path}/churn")
        calibrator.save(f"{run_path}/calibrator")
    return TrainingRun(model, calibrator, {**params, **fixed}, result, sizes)
