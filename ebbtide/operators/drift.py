"""Drift between a reference and a current frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Drift
from ebbtide.functions.scalars import one_row
from ebbtide.operators.profiling import long_values, numeric_columns
from ebbtide.operators.ranking import running_totals

NOT_FEATURES = ("churned", "snapshot_date", "unique_customer_identifier")


def shared_numeric(ref: DataFrame, cur: DataFrame) -> list[str]:
    return [c for c in numeric_columns(ref, NOT_FEATURES) if c in cur.columns]


def _both(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, is_ref) without NULL and NaN."""
    a = long_values(ref, columns).withColumn("is_ref", F.lit(True))
    b = long_values(cur, columns).withColumn("is_ref", F.lit(False))
    return a.unionByName(b).where(~F.isnan("value"))


def psi(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None, settings: Drift = DEFAULTS.drift) -> DataFrame:
    """(feature, psi) unrounded, for all features in one shuffle.

    Bins are equal-width on the reference range with open outer bins; a feature
    that is empty on one side scores 0.
    """
    columns = list(columns or shared_numeric(ref, cur))
    both = _both(ref, cur, columns)
    # One row per column of the frame, so the broadcast is bounded by the schema.
    span = long_values(ref, columns).where(~F.isnan("value")).groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / settings.bins
    edges = [F.col("lo") + step * i for i in range(1, settings.bins)]
    at = reduce(lambda a, b: a + b, [(F.col("value") >= e).cast("int") for e in edges])
    binned = both.join(F.broadcast(span), "feature").groupBy("feature", at.alias("bin")).agg(F.count_if("is_ref").alias("r"), F.count_if(~F.col("is_ref")).alias("c"))
    totals = binned.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    share = binned.join(F.broadcast(totals), "feature")
    eps = F.lit(settings.epsilon)
    rp, cp = F.try_divide(F.col("r"), F.col("nr")) + eps, F.try_divide(F.col("c"), F.col("nc")) + eps
    score = share.groupBy("feature").agg(F.sum((cp - rp) * F.ln(cp / rp)).alias("psi"), F.min(F.least("nr", "nc")).alias("side"))
    named = ref.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    out = named.join(score, "feature", "left")
    return out.select("feature", F.when(F.col("side") > 0, F.col("psi")).otherwise(0.0).alias("psi"))


def psi_all(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None, settings: Drift = DEFAULTS.drift) -> DataFrame:
    """Rounded PSI per feature and whether the unrounded value reaches the warning level."""
    return psi(ref, cur, columns, settings).select("feature", F.round("psi", 4).alias("psi"), (F.col("psi") >= settings.psi_alert).alias("warned"))


def alert_list(psi_rows: DataFrame, settings: Drift = DEFAULTS.drift) -> DataFrame:
    """One row: sorted names of features whose rounded PSI exceeds the alert level."""
    hit = F.collect_list(F.when(F.col("psi") > settings.psi_alert, F.col("feature")))
    return psi_rows.agg(F.sort_array(hit).alias("alerts")).select(F.array_join("alerts", ", ").alias("psi_alerts"), F.size("alerts").alias("n_alerts"))


def ks(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None, settings: Drift = DEFAULTS.drift) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov statistic, asymptotic p-value and drift flag per feature."""
    columns = list(columns or shared_numeric(ref, cur))
    counted = _both(ref, cur, columns).groupBy("feature", "value").agg(F.count_if("is_ref").alias("r"), F.count_if(~F.col("is_ref")).alias("c"))
    curve = running_totals(counted, "value", ["r", "c"], ["feature"], descending=False)
    gap = F.abs(F.try_divide(F.col("cum_r"), F.col("all_r")) - F.try_divide(F.col("cum_c"), F.col("all_c")))
    per = curve.groupBy("feature").agg(F.max(gap).alias("statistic"), F.max("all_r").alias("nr"), F.max("all_c").alias("nc"))
    lam = F.sqrt(F.col("nr") / (F.col("nr") + F.col("nc")) * F.col("nc")) * F.col("statistic")
    series = reduce(lambda a, b: a + b, [F.exp(lam * lam * (-2.0 * j * j)) * (2.0 if j % 2 else -2.0) for j in range(1, 31)])
    p = F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))
    return per.select("feature", "statistic", p.alias("p_value"), (p < settings.feature_p_value).alias("drifted"))


def dataset_drift(ks_rows: DataFrame, settings: Drift = DEFAULTS.drift) -> DataFrame:
    share = F.avg(F.coalesce(F.col("drifted"), F.lit(False)).cast("double"))
    return ks_rows.agg(share.alias("drift_share"), (share > settings.dataset_share).alias("drift_detected"))


def prediction_drift(ref: DataFrame, cur: DataFrame, p: str = "p", settings: Drift = DEFAULTS.drift) -> DataFrame:
    """Shift of the mean score and PSI of the scores, each with its alert."""
    score = psi(ref, cur, [p], settings).select(F.col("psi").alias("score_psi"))
    row = one_row(ref.agg(F.avg(p).alias("ref_mean")), cur.agg(F.avg(p).alias("cur_mean")), score)
    return row.withColumn("mean_alert", F.abs(F.col("cur_mean") - F.col("ref_mean")) > settings.mean_shift).withColumn("psi_alert", F.col("score_psi") > settings.psi_alert)


def full_monitoring(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None, settings: Drift = DEFAULTS.drift) -> DataFrame:
    """One row: drift flag, share of drifted features and the PSI alerts."""
    columns = list(columns or shared_numeric(ref, cur))
    return one_row(dataset_drift(ks(ref, cur, columns, settings), settings), alert_list(psi_all(ref, cur, columns, settings), settings))


# --- fixed values: alert texts ------------------------------------------------------------------
QUIET_TITLE, ALERT_TITLE, QUIET_MESSAGE = "No Drift Detected", "Churn Model Drift Alert", "All features stable."
DRIFT_LINE, SHARE_LINE, PSI_LINE = "Drift detected: ", "Drifted feature share: %.1f%%", "Features with PSI > 0.2: "
ACTION_LINE = "→ **Recommended action**: trigger retraining pipeline"


def severity(result: DataFrame, settings: Drift = DEFAULTS.drift) -> DataFrame:
    """Title, message and severity of a monitoring row."""
    quiet = ~F.col("drift_detected") & (F.col("n_alerts") == 0)
    level = F.when(quiet, "info").when((F.col("drift_share") > settings.critical_share) | (F.col("n_alerts") > settings.critical_alerts), "critical").otherwise("warning")
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit(DRIFT_LINE), F.when(F.col("drift_detected"), "Yes").otherwise("No")),
        F.format_string(SHARE_LINE, F.col("drift_share") * 100),
        F.when(F.col("n_alerts") > 0, F.concat(F.lit(PSI_LINE), F.col("psi_alerts"))),
        F.lit(ACTION_LINE),
    )
    return result.select(
        F.when(quiet, QUIET_TITLE).otherwise(ALERT_TITLE).alias("title"),
        F.when(quiet, QUIET_MESSAGE).otherwise(lines).alias("message"),
        level.alias("severity"),
    )


def oldest_newest(matrix: DataFrame, date_col: str = "snapshot_date") -> tuple[DataFrame, DataFrame]:
    """Rows of the first and of the last snapshot (one pruned partition each when partitioned by date)."""
    ends = matrix.select(date_col).agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    return matrix.where(F.col(date_col) == F.lit(ends["lo"])), matrix.where(F.col(date_col) == F.lit(ends["hi"]))
