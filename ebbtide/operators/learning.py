"""Model training, calibration, tuning and gates on Spark ML."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, NON_FEATURES
from ebbtide.operators import boosting
from ebbtide.operators.boosting import best_round  # noqa: F401 - part of this module's interface
from ebbtide.operators.profiling import numeric_columns
from ebbtide.session import scratch, settle


# ---- columns ---------------------------------------------------------------------------------
def feature_columns(df: DataFrame, also_exclude: Sequence[str] = ()) -> list[str]:
    """Numeric model inputs: no identifiers, dates, labels or raw categories."""
    return numeric_columns(df, (*NON_FEATURES, *also_exclude))


def align_features(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the wanted features in order as doubles; absent ones become 0.0."""
    have = set(df.columns)
    return df.select(*keep, *[(F.col(c).cast("double") if c in have else F.lit(0.0)).alias(c) for c in wanted])


def assemble_features(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Feature vector with NULL as 0; features absent from ``df`` are 0 as well."""
    have = set(df.columns)
    filled = {f"_x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0) for c in features}
    out = VectorAssembler(inputCols=list(filled), outputCol=output).transform(df.withColumns(filled))
    return out.drop(*filled)


def probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def class_weights(df: DataFrame, target: str = "churned") -> DataFrame:
    """(label, n, weight) with weight n_all / (2 · n_class)."""
    total = df.select(F.count("*")).scalar()
    per = df.groupBy(F.col(target).alias("label")).agg(F.count("*").alias("n"))
    return per.withColumn("weight", total / (F.col("n") * 2.0))


def with_weight(df: DataFrame, target: str = "churned", like: DataFrame | None = None) -> DataFrame:
    """Add each row's class weight, as found in ``like`` (or in ``df`` itself)."""
    w = {r["label"]: r["weight"] for r in class_weights(df if like is None else like, target).collect()}  # two rows
    return df.withColumn("weight", F.when(F.col(target) == 1, float(w.get(1, 1.0))).otherwise(float(w.get(0, 1.0))))


# ---- models ----------------------------------------------------------------------------------
@dataclass
class ChurnModel:
    """A fitted classifier together with the feature list it was trained on."""

    model: object
    features: list[str]
    kind: str

    def score(self, df: DataFrame, name: str = "p") -> DataFrame:
        """Add the leaving probability; missing features count as 0."""
        if self.kind == "boosted":
            return df.withColumn(name, 1 / (1 + F.exp(-self.margin(df))))
        x = assemble_features(df, self.features, "_features")
        out = self.model.transform(x).withColumn(name, probability("_probability"))
        return out.drop("_features", "_scaled", "_raw", "_probability", "_prediction")

    def margin(self, df: DataFrame) -> Column:
        """Sum of the trees' values; NULL takes each split's own branch, absent columns are 0."""
        model = self.model

        @F.pandas_udf("double")
        def margins(x: pd.DataFrame) -> pd.Series:
            return pd.Series(model.margins(x.to_numpy(float)))

        return margins(F.struct(*inputs(df, self.features)))

    def save(self, path: str) -> None:
        """Model, feature list and kind, so that ``load`` scores alike."""
        spark = SparkSession.active()
        if self.kind == "boosted":
            self.model.save(spark, f"{path}/model")
        else:
            self.model.write().overwrite().save(f"{path}/model")
        spark.createDataFrame([(self.kind, list(self.features))], "kind string, features array<string>").coalesce(1).write.mode("overwrite").json(f"{path}/features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ChurnModel:
        row = spark.read.schema("kind string, features array<string>").json(f"{path}/features").first()
        model = boosting.BoostedTrees.load(spark, f"{path}/model") if row["kind"] == "boosted" else PipelineModel.load(f"{path}/model")
        return ChurnModel(model, list(row["features"]), row["kind"])


def inputs(df: DataFrame, features: Sequence[str]) -> list[Column]:
    """Features as doubles named by their place; absent ones are 0."""
    have = set(df.columns)
    return [(F.col(c).cast("double") if c in have else F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features)]


def predict_label(p: Column, threshold: float = 0.5) -> Column:
    return (p >= threshold).cast("int")


def _named(estimator, features: str = "_features"):
    """Private column names, so that a model never collides with columns of the scored frame."""
    for setter, value in (("Features", features), ("RawPrediction", "_raw"), ("Probability", "_probability"), ("Prediction", "_prediction"), ("Label", "_label")):
        getattr(estimator, f"set{setter}Col")(value)
    return estimator.setWeightCol("weight")


def fit_logistic(train: DataFrame, features: Sequence[str] | None = None, target: str = "churned", max_iter: int = 100, reg: float = 0.0) -> ChurnModel:
    """Standardised, class-balanced logistic regression."""
    features = list(features or feature_columns(train))
    data = assemble_features(with_weight(train, target), features, "_features").withColumn("_label", F.col(target).cast("double"))
    scaler = StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True).fit(data)
    lr = _named(LogisticRegression(maxIter=max_iter, regParam=reg, standardization=False), "_scaled").fit(scaler.transform(data))
    return ChurnModel(PipelineModel([scaler, lr]), features, "logistic")


BOOSTING = boosting.DEFAULTS


def _watched(train: DataFrame, val: DataFrame | None, features: Sequence[str], target: str) -> DataFrame:
    """Rows to fit on, class-balanced, and rows to watch the loss on, with the same weights."""
    own = [*features, target, "weight"]
    rows = with_weight(train, target).select(*own, F.lit(False).alias("_held"))
    return rows if val is None else rows.unionByName(with_weight(val, target, train).select(*own, F.lit(True).alias("_held")))


def fit_boosted(
    train: DataFrame, val: DataFrame | None = None, params: Mapping[str, float] | None = None, features: Sequence[str] | None = None,
    target: str = "churned", seed: int = 42, run_path: str | None = None,
) -> ChurnModel:
    """Class-balanced gradient-boosted trees, stopping early on ``val`` when given.

    Boosting stops when the loss on ``val`` has not fallen for ``patience`` rounds and
    keeps the rounds up to its lowest value. NULL has a branch of its own in every split.
    With ``run_path`` a fit that was cut off goes on from its last written round.
    """
    p = {**BOOSTING, "seed": seed, **(params or {})}
    features = list(features or feature_columns(train))
    watched = val is not None and val.limit(1).count() > 0
    cuts = boosting.cut_points(train, features)
    table = boosting.binned(_watched(train, val if watched else None, features, target), features, cuts, target, "weight", "_held")
    state = boosting.boost(table, len(features), p, watched, run_path)
    best = state.best(int(p["patience"]), watched)
    return ChurnModel(boosting.BoostedTrees(cuts, state.trees[:best], state.losses[:best]), features, "boosted")


def node_table(model: ChurnModel, spark) -> DataFrame:
    """(tree, node, feature, threshold, null_left, left, right, value, gain, cover) of a boosted model; bounded by rounds and leaves."""
    rows = []
    for i, t in enumerate(model.model.trees):
        for n, f in enumerate(t.feature):
            cut = model.model.cuts[f] if f >= 0 else []
            threshold = None if f < 0 else float(cut[t.bin[n]]) if t.bin[n] < len(cut) else math.inf  # beyond the last cut all values go left
            rows.append((i, n, int(f), threshold, bool(t.null_left[n]), int(t.left[n]), int(t.right[n]), float(t.value[n]), float(t.gain[n]), float(t.cover[n])))
    return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, null_left boolean, left int, right int, value double, gain double, cover double")


def importance(model: ChurnModel, spark) -> DataFrame:
    """(feature, gain, splits, rank): share of all gains and number of splits."""
    gain, splits = np.zeros(len(model.features)), np.zeros(len(model.features), int)
    for t in model.model.trees:
        for f, g in zip(t.feature, t.gain, strict=True):
            if f >= 0:
                gain[f] += g
                splits[f] += 1
    rows = [(f, float(g), int(n)) for f, g, n in zip(model.features, gain / max(gain.sum(), 1e-12), splits, strict=True)]
    out = spark.createDataFrame(rows, "feature string, gain double, splits bigint")
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("gain"), "feature")))  # one row per feature


# ---- calibration -----------------------------------------------------------------------------
@dataclass
class Calibrator:
    method: str
    model: object

    def apply(self, df: DataFrame, p: str = "p", name: str = "calibrated") -> DataFrame:
        if self.method == "isotonic":
            if isinstance(self.model, IsotonicRegressionModel):
                out = self.model.setFeaturesCol(p).setPredictionCol("_iso").transform(df)
                return out.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("_iso")))).drop("_iso")
            raise TypeError("isotonic calibrator needs an isotonic model")
        slope, intercept = float(self.model.coefficients[0]), float(self.model.intercept)
        return df.withColumn(name, 1 / (1 + F.exp(-(F.col(p) * slope + intercept))))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/{self.method}")

    @staticmethod
    def load(path: str, method: str = "isotonic") -> Calibrator:
        reader = {"isotonic": IsotonicRegressionModel, "sigmoid": LogisticRegressionModel}[method]
        return Calibrator(method, reader.load(f"{path}/{method}"))


def calibrate(scored: DataFrame, method: str = "isotonic", y: str = "y", p: str = "p") -> Calibrator:
    """Map raw scores to observed rates: isotonic steps or a logistic curve (L2 strength 1).

    Scores are counted per distinct value first, so ties cost one weighted row each.
    """
    counted = scored.groupBy(F.col(p).alias("_p")).agg(F.avg(F.col(y).cast("double")).alias("_rate"), F.count("*").cast("double").alias("_w"), F.sum(F.col(y).cast("double")).alias("_pos"))
    if method == "isotonic":
        return Calibrator(method, IsotonicRegression(featuresCol="_p", labelCol="_rate", weightCol="_w", predictionCol="_iso").fit(counted))
    if method == "sigmoid":
        sides = F.array(F.struct(F.lit(1.0).alias("label"), F.col("_pos").alias("w")), F.struct(F.lit(0.0).alias("label"), (F.col("_w") - F.col("_pos")).alias("w")))
        rows = counted.select("_p", F.explode(sides).alias("s")).select("_p", "s.label", "s.w").where("w > 0")
        data = VectorAssembler(inputCols=["_p"], outputCol="features").transform(rows)
        n = rows.agg(F.sum("w")).first()[0] or 1.0
        return Calibrator(method, LogisticRegression(regParam=1.0 / n, standardization=False, weightCol="w").fit(data))
    raise ValueError(f"unknown calibration method {method!r}: use isotonic or sigmoid")


# ---- tuning ----------------------------------------------------------------------------------
# --- fixed values: search bounds ---------------------------------------------------------------
LEAVES, LEARNING_RATE, MIN_ROWS, SHARE, PENALTY = (20, 300), (0.005, 0.3), (20, 500), (0.5, 1.0), (0.0, 10.0)
BAGGING_EVERY = 5  # rounds that share their rows


def draw_trials(n: int, seed: int = 42) -> list[dict[str, float]]:
    """Seeded random draws within the bounds; trees grow by level, to a depth that can hold the leaves."""
    rng = random.Random(seed)
    trials = []
    for _ in range(n):
        leaves = rng.randint(*LEAVES)
        trials.append({
            "leaves": leaves,
            "max_depth": min(10, max(2, math.ceil(math.log2(leaves)) + 1)),
            "step_size": math.exp(rng.uniform(*map(math.log, LEARNING_RATE))),
            "min_rows": rng.randint(*MIN_ROWS),
            "feature_share": rng.uniform(*SHARE),
            "subsample": rng.uniform(*SHARE),
            "reg_alpha": rng.uniform(*PENALTY),
            "reg_lambda": rng.uniform(*PENALTY),
        })
    return trials


def tune(
    train: DataFrame, val: DataFrame, n_trials: int = 50, seed: int = 42, fixed: Mapping[str, float] | None = None, target: str = "churned", run_path: str | None = None,
) -> tuple[dict[str, float], DataFrame]:
    """Random search for the highest average precision on the temporal validation split.

    Returns the best parameters and the trial table. Every setting runs full rounds with
    patience on all rows of ``train`` and is judged by all rows of ``val``. With ``run_path``
    a search that was cut off runs what is missing.
    """
    spark, features = train.sparkSession, feature_columns(train)
    table = boosting.binned(_watched(train, val, features, target), features, boosting.cut_points(train, features), target, "weight", "_held")
    trials = [{**t, "subsample_every": BAGGING_EVERY, **(fixed or {})} for t in draw_trials(n_trials, seed)]
    found = boosting.search(table, [{**BOOSTING, "seed": seed, **t} for t in trials], run_path or scratch(spark, "search"))
    rows = [(i, *[float(v) for v in t.values()]) for i, t in enumerate(trials)]
    settings = spark.createDataFrame(rows, "trial int, " + ", ".join(f"{k} double" for k in trials[0]))
    out = settings.join(found, "trial")
    best = out.orderBy(F.desc("auc_pr"), "trial").first()
    return dict(trials[best["trial"]]), out


# ---- gates over run tables ---------------------------------------------------------------------
def promote_gate(runs: DataFrame, tolerance: float = DEFAULTS.promote_tolerance, metric: str = "auc_pr") -> DataFrame:
    """Compare the latest challenger with the latest champion (0 when there is none).

    ``runs`` has (role, logged_at, metric, value).
    """
    def latest(role: str) -> Column:
        return F.max_by(F.when(F.col("role") == role, F.col("value")), F.when(F.col("role") == role, F.col("logged_at")))

    row = runs.where(F.col("metric") == metric).agg(F.coalesce(latest("challenger"), F.lit(0.0)).alias("challenger"), F.coalesce(latest("champion"), F.lit(0.0)).alias("champion"))
    return row.withColumn("promote", F.col("challenger") >= F.col("champion") - tolerance)


def retune_gate(runs: DataFrame, now: str, after_days: int = DEFAULTS.retune_after_days) -> DataFrame:
    """(model, age_days, action) from (model, tuned_at): search again when never tuned or too old."""
    per = runs.groupBy("model").agg(F.max("tuned_at").alias("tuned_at"))
    age = F.datediff(F.lit(now).cast("date"), F.col("tuned_at"))
    stale = F.col("tuned_at").isNull() | (age >= after_days)
    return per.select("model", age.alias("age_days"), F.when(stale, "full_tune").otherwise("quick_refit").alias("action"))


# ---- projection ------------------------------------------------------------------------------
def pca(df: DataFrame, columns: Sequence[str], k: int = 2):
    """Standardise, project on ``k`` components; returns (scored frame, loadings, explained shares)."""
    data = assemble_features(df, columns, "_features")
    scaled = StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True).fit(data).transform(data)
    model = PCA(k=k, inputCol="_scaled", outputCol="_pc").fit(scaled)
    out = model.transform(scaled).withColumn("_pc", vector_to_array("_pc"))
    out = out.withColumns({f"pc{i + 1}": F.col("_pc")[i] for i in range(k)}).drop("_features", "_scaled", "_pc")
    m = model.pc.toArray()
    rows = [(c, *[float(m[j, i]) for i in range(k)]) for j, c in enumerate(columns)]
    loadings = df.sparkSession.createDataFrame(rows, "feature string, " + ", ".join(f"pc{i + 1} double" for i in range(k)))
    return out, loadings, [float(v) for v in model.explainedVariance]


def top_loadings(loadings: DataFrame, n: int = 10) -> DataFrame:
    parts = [F.abs(F.col(c)) for c in loadings.columns if c != "feature"]
    return loadings.withColumn("strength", F.greatest(*parts)).orderBy(F.desc("strength"), "feature").limit(n)
