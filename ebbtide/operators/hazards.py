"""Cox proportional hazards at scale.

A Newton step needs, for every distinct day, the risk-set sums of θ, θx and θxxᵀ
(θ = exp βx) and the same over that day's events. Tasks reduce their rows to
one line per day, Spark adds the lines up, and only the per-day table (bounded
by the length of the observation period, not by the number of customers) is
read by the driver, which solves a p × p system.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.scalars import one_row, whole_days
from ebbtide.operators.survival import Z95
from ebbtide.session import settle, share_package, shuffle_width

TIE_CHUNK = 1 << 20  # events of one day summed at a time; bounds memory, not the sum


# ---- tie sums --------------------------------------------------------------------------------
def tie_sums(risk: float, tied: float, d: int) -> tuple[float, ...]:
    """Efron sums over s_l = risk − w_l·tied with w_l = l/d, l = 0..d−1.

    Returns Σ log s, Σ 1/s, Σ w/s, Σ 1/s², Σ w/s² and Σ w²/s².
    """
    out = np.zeros(6)
    for lo in range(0, d, TIE_CHUNK):
        w = np.arange(lo, min(d, lo + TIE_CHUNK)) / d
        s = risk - tied * w
        r = 1 / s
        out += [np.log(s).sum(), r.sum(), (w * r).sum(), (r * r).sum(), (w * r * r).sum(), (w * w * r * r).sum()]
    return tuple(float(x) for x in out)


# ---- per-day moments --------------------------------------------------------------------------
def _width(p: int) -> int:
    return 1 + p + p * (p + 1) // 2


def _moments(data: DataFrame, beta: np.ndarray) -> dict[str, np.ndarray]:
    """Day table at ``beta``: arrays over ascending distinct days."""
    p = len(beta)
    iu = np.triu_indices(p)

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[float, np.ndarray] = {}
        for pdf in batches:
            x = np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, p))
            t, e = pdf["t"].to_numpy(float), pdf["e"].to_numpy(float)
            theta = np.exp(x @ beta)
            outer = (x[:, iu[0]] * x[:, iu[1]]) * theta[:, None]
            body = np.concatenate([theta[:, None], x * theta[:, None], outer], axis=1)
            line = np.concatenate([body, body * e[:, None], e[:, None], x * e[:, None]], axis=1)
            order = np.argsort(t, kind="stable")
            days, start = np.unique(t[order], return_index=True)
            if len(days):
                for day, row in zip(days, np.add.reduceat(line[order], start, axis=0)):
                    sums[day] = sums[day] + row if day in sums else row
        if sums:
            yield pd.DataFrame({"t": list(sums), "m": list(sums.values())})

    lines = data.mapInPandas(reduce_rows, "t double, m array<double>")
    table = lines.groupBy("t").agg(vector_to_array(Summarizer.sum(array_to_vector("m"))).alias("m")).toPandas().sort_values("t")
    m = np.vstack(table["m"].to_numpy())
    w = _width(p)
    return {"t": table["t"].to_numpy(float), "own": m[:, :w], "tied": m[:, w : 2 * w], "d": m[:, 2 * w], "sx": m[:, 2 * w + 1 :]}


def _square(tri: np.ndarray, p: int) -> np.ndarray:
    out = np.zeros((p, p))
    out[np.triu_indices(p)] = tri
    return out + out.T - np.diag(out.diagonal())


def _newton_terms(m: dict[str, np.ndarray], beta: np.ndarray):
    """Log-likelihood, gradient, information and the per-day score residuals."""
    p = len(beta)
    risk = np.cumsum(m["own"][::-1], axis=0)[::-1]
    ll, grad, info = 0.0, np.zeros(p), np.zeros((p, p))
    residual = np.zeros((len(m["t"]), p))
    for i in np.flatnonzero(m["d"] > 0):
        d = int(round(m["d"][i]))
        r0, r1, r2 = risk[i, 0], risk[i, 1 : 1 + p], risk[i, 1 + p :]
        k0, k1, k2 = m["tied"][i, 0], m["tied"][i, 1 : 1 + p], m["tied"][i, 1 + p :]
        logs, a, b, c, e, f = tie_sums(r0, k0, d)
        residual[i] = m["sx"][i] - (r1 * a - k1 * b)
        ll += float(beta @ m["sx"][i]) - logs
        grad += residual[i]
        cross = np.outer(r1, k1)
        info += _square(r2 * a - k2 * b, p) - (np.outer(r1, r1) * c - (cross + cross.T) * e + np.outer(k1, k1) * f)
    return ll, grad, info, residual


# ---- model -----------------------------------------------------------------------------------
@dataclass
class CoxModel:
    covariates: list[str]
    coef: np.ndarray
    se: np.ndarray
    mean: np.ndarray
    log_likelihood: float
    n: int
    n_events: int
    baseline_t: np.ndarray
    baseline_h: np.ndarray
    ph: list[tuple[str, float, float]] = field(default_factory=list)

    def save(self, spark, path: str) -> None:
        _write_model(spark, path, self)

    @classmethod
    def load(cls, spark, path: str) -> "CoxModel":
        held = _read_model(spark, path)
        arrays = {k: np.array(held[k]) for k in ("coef", "se", "mean", "baseline_t", "baseline_h")}
        return cls(**held | arrays | {"ph": [tuple(x) for x in held["ph"]]})

    def summary(self, spark) -> DataFrame:
        """coef, hazard ratio, standard error, z, p and 95 % interval per covariate."""
        rows = []
        for c, b, s in zip(self.covariates, self.coef, self.se):
            z = b / s if s > 0 else 0.0
            rows.append((c, float(b), float(math.exp(b)), float(s), float(z), math.erfc(abs(z) / math.sqrt(2)), float(b - Z95 * s), float(b + Z95 * s)))
        return spark.createDataFrame(rows, "covariate string, coef double, hazard_ratio double, se double, z double, p double, ci_lo double, ci_hi double")

    def ph_test(self, spark) -> DataFrame:
        """Score-residual test of proportional hazards against ranked time, worst first."""
        rows = [(c, float(s), float(p), bool(p < 0.05)) for c, s, p in self.ph]
        return spark.createDataFrame(rows, "covariate string, statistic double, p double, violated boolean").orderBy("p")

    def partial(self) -> Column:
        """(x − mean)·β as a column expression; NULL covariates count as 0."""
        out = F.lit(0.0)
        for c, b, mu in zip(self.covariates, self.coef, self.mean):
            out = out + (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - float(mu)) * float(b)
        return out

    def concordance(self, df: DataFrame, duration: str = "duration", event: str = "event") -> DataFrame:
        """C-index of the fitted risk on any rows, those of the fit or others."""
        return concordance(df, self.partial(), duration, event)

    def churn_probability(self, at_days: float) -> Column:
        """1 − S(at | x)."""
        i = int(np.searchsorted(self.baseline_t, at_days, side="right"))
        h = float(self.baseline_h[i - 1]) if i else 0.0
        return 1 - F.exp(F.exp(self.partial()) * -h)

    def median_lifetime(self) -> Column:
        """First day with S(t | x) ≤ 0.5, else the last day seen."""
        days, cumulative = self.baseline_t, self.baseline_h

        @F.pandas_udf(T.DoubleType())
        def first_day(lp: pd.Series) -> pd.Series:
            at = np.searchsorted(cumulative, math.log(2) / np.exp(lp.to_numpy(float)), side="left")
            return pd.Series(days[np.minimum(at, len(days) - 1)])

        return first_day(self.partial())

    def flags(self, spread: dict[str, float], spark) -> DataFrame:
        """Low-variance and possibly separated covariates, and the rank by |coef|."""
        rows = [(c, float(b), float(spread.get(c) or 0.0)) for c, b in zip(self.covariates, self.coef)]
        df = spark.createDataFrame(rows, "covariate string, coef double, std double")
        order = Window.orderBy(F.abs("coef").desc(), "covariate")  # one row per covariate
        return df.select("covariate", "coef", "std", (F.col("std") < 0.01).alias("low_variance"), (F.abs("coef") > 5).alias("unstable"), F.row_number().over(order).alias("rank"))


def _penalised_step(beta: np.ndarray, grad: np.ndarray, hessian: np.ndarray, penalizer: float, l1_ratio: float) -> np.ndarray:
    """Step to the minimum of the local quadratic plus the penalty, by coordinate descent."""
    ridge, lasso = penalizer * (1 - l1_ratio), penalizer * l1_ratio
    if not lasso:
        return np.linalg.solve(hessian + ridge * np.eye(len(beta)), grad - ridge * beta)
    b = beta.copy()
    for _ in range(10000):
        before = b.copy()
        for j in range(len(b)):
            pull = grad[j] - hessian[j] @ (b - beta) + hessian[j, j] * b[j]
            b[j] = math.copysign(max(abs(pull) - lasso, 0.0), pull) / (hessian[j, j] + ridge)
        if np.abs(b - before).max() < 1e-12:
            break
    return b - beta


def fit_cox(df: DataFrame, covariates: Sequence[str], duration: str = "duration", event: str = "event", penalizer: float = 0.1, max_iter: int = 25, tolerance: float = 1e-8, l1_ratio: float = 0.0) -> CoxModel:
    """Efron ties, elastic-net penalty on standardised covariates per observation; constant covariates are left out.

    The penalty is ``penalizer`` · (l1_ratio·|β| + (1 − l1_ratio)/2·β²); steps are proximal Newton steps.
    """
    filled = df.select(
        whole_days(duration).alias("t"), F.col(event).cast("double").alias("e"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_c{i}") for i, c in enumerate(covariates)]
    )
    stats = filled.agg(F.count("*").alias("n"), F.sum("e").alias("events"), *[f(f"_c{i}").alias(f"{k}{i}") for i in range(len(covariates)) for k, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    use = [i for i in range(len(covariates)) if (stats[f"s{i}"] or 0.0) > 1e-9]
    if not use or not stats["events"]:
        raise ValueError("need at least one varying covariate and one event")
    mean, std = np.array([stats[f"m{i}"] for i in use]), np.array([stats[f"s{i}"] for i in use])
    x = F.array(*[(F.col(f"_c{i}") - float(mu)) / float(sd) for i, mu, sd in zip(use, mean, std)])
    # Rows near in time share a task, so each task emits few day lines; the key is wide enough to split a hot day.
    spread = filled.select("t", "e", x.alias("x")).repartitionByRange(shuffle_width(df.sparkSession), F.col("t"), F.xxhash64("x"))
    data = settle(spread)
    n, p = int(stats["n"]), len(use)
    beta, previous = np.zeros(p), -math.inf
    step = np.zeros(p)
    for _ in range(max_iter):
        m = _moments(data, beta)
        ll, grad, info, residual = _newton_terms(m, beta)
        objective = ll / n - penalizer * ((1 - l1_ratio) / 2 * float(beta @ beta) + l1_ratio * float(np.abs(beta).sum()))
        if objective < previous - 1e-12 and np.abs(step).max() > tolerance:  # overshoot: go half way back
            step = step / 2
            beta = beta - step
            continue
        step = _penalised_step(beta, grad / n, info / n, penalizer, l1_ratio)
        if np.abs(step).max() < tolerance:
            break
        previous, beta = objective, beta + step
    else:
        raise ValueError(f"the Cox fit has not converged in {max_iter} steps; raise max_iter or the penalizer")
    variance = np.linalg.inv(info + n * penalizer * (1 - l1_ratio) * np.eye(p))
    risk = np.cumsum(m["own"][::-1, 0])[::-1]
    model = CoxModel(
        [covariates[i] for i in use], beta / std, np.sqrt(np.diag(variance)) / std, mean, ll, n, int(stats["events"]), m["t"], np.cumsum(m["d"] / risk)
    )
    model.ph = _ph_rows(model.covariates, m, residual, variance)
    return model


def _ph_rows(names: Sequence[str], m: dict[str, np.ndarray], residual: np.ndarray, variance: np.ndarray) -> list[tuple[str, float, float]]:
    """Correlate scaled residuals with the average rank of the event day."""
    d = m["d"]
    events = d.sum()
    rank = np.cumsum(d) - (d - 1) / 2
    centred = np.where(d > 0, rank - (rank * d).sum() / events, 0.0)
    scaled = events * residual @ variance
    spread = (d * centred**2).sum()
    out = []
    for j, c in enumerate(names):
        stat = float((centred @ scaled[:, j]) ** 2 / (events * variance[j, j] * spread)) if spread > 0 else 0.0
        out.append((c, stat, math.erfc(math.sqrt(stat / 2))))
    return out


# ---- concordance -----------------------------------------------------------------------------
def _inside(table: pd.DataFrame) -> tuple[float, float]:
    """Concordant and tied pairs among the cells (t, r, n, d) of one range of risk, by a tree of prefix sums."""
    rank = np.unique(table["r"].to_numpy(float), return_inverse=True)[1] + 1
    size = int(rank.max()) + 1
    tree = [0] * size

    def add(i: int, x: int) -> None:
        while i < size:
            tree[i] += x
            i += i & -i

    def upto(i: int) -> int:
        total = 0
        while i:
            total += tree[i]
            i -= i & -i
        return total

    concordant = tied = 0
    cells = table.assign(k=rank)[["t", "k", "n", "d"]].sort_values("t", ascending=False)
    for _, day in cells.groupby("t", sort=False):
        rows = list(zip(day["k"].tolist(), day["n"].tolist(), day["d"].tolist(), strict=True))
        for k, n, d in rows:  # those censored on a day outlive its events
            if n > d:
                add(k, n - d)
        for k, _, d in rows:
            if d:
                below = upto(k - 1)
                concordant += d * below
                tied += d * (upto(k) - below)
        for k, _, d in rows:
            if d:
                add(k, d)
    return concordant, tied


def concordance(df: DataFrame, risk: Column | str, duration: str = "duration", event: str = "event") -> DataFrame:
    """Exact C-index: of every leaver and everybody who outlived them, who had the higher risk; ties count half.

    Equal days and risks are one cell, and cells are dealt to ranges of risk. Pairs between
    ranges follow from the day × range table, whose size is bounded by the observation
    period and the number of tasks; pairs inside a range are counted in its own task.
    """
    spark, r = df.sparkSession, (F.col(risk) if isinstance(risk, str) else risk).cast("double")
    cells = df.select(whole_days(duration).alias("t"), r.alias("r"), F.col(event).cast("bigint").alias("e")).where("r IS NOT NULL")
    share_package(spark)
    last = shuffle_width(spark) - 1
    cells = cells.groupBy("t", "r").agg(F.count("*").alias("n"), F.sum("e").alias("d"))
    cells = settle(cells.repartitionByRange(last + 1, "r").withColumn("b", F.spark_partition_id()))

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        concordant, tied = _inside(pdf)
        return pd.DataFrame({"concordant": [concordant], "tied": [tied]})

    own = cells.groupBy("b").applyInPandas(inside, "concordant long, tied long").agg(F.coalesce(F.sum("concordant"), F.lit(0)).alias("c_in"), F.coalesce(F.sum("tied"), F.lit(0)).alias("tied"))
    days = cells.groupBy("t", "b").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    grid = days.select("t").distinct().withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(last))))  # days × ranges
    full = grid.join(days, ["t", "b"], "left").fillna(0, ["n", "d"])
    longer = Window.partitionBy("b").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, -1)
    outlived = F.coalesce(F.sum("n").over(longer), F.lit(0)) + F.col("n") - F.col("d")
    day = Window.partitionBy("t")
    table = full.select("t", "b", "d", outlived.alias("o"))
    table = table.select("d", F.coalesce(F.sum("o").over(day.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"), F.sum("o").over(day).alias("all"))
    across = table.agg(F.sum(F.col("d") * F.col("below")).alias("c_out"), F.sum(F.col("d") * F.col("all")).alias("pairs"))
    sums = one_row(across, own).select((F.col("c_out") + F.col("c_in")).alias("concordant"), "tied", "pairs")
    return sums.withColumn("c_index", F.try_divide(F.col("concordant") + F.col("tied") * 0.5, F.col("pairs").cast("double")))


# ---- parametric ------------------------------------------------------------------------------
def _weibull_sums(data: DataFrame, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of (intercept, coefficients, log scale) with its gradient and Hessian, summed per task, then by Spark."""
    p = len(theta) - 1  # with the intercept
    iu = np.triu_indices(p + 1)

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 + p + 1 + len(iu[0]))
        for pdf in batches:
            if len(pdf):
                x = np.column_stack([np.ones(len(pdf)), np.array(pdf["x"].tolist(), float).reshape(len(pdf), p - 1)])
                e, scale = pdf["e"].to_numpy(float), math.exp(theta[-1])
                z = (np.log(pdf["t"].to_numpy(float)) - x @ theta[:-1]) / scale
                w = np.exp(np.minimum(z, 500.0))
                second = np.zeros((p + 1, p + 1))
                second[:p, :p] = -(x.T * (w / scale**2)) @ x
                second[:p, p] = second[p, :p] = -((w * z + w - e) / scale) @ x
                second[p, p] = -(w * z * z + (w - e) * z).sum()
                first = np.append((w - e) / scale @ x, ((w - e) * z - e).sum())
                total += np.concatenate([[(e * (z - theta[-1]) - w).sum()], first, second[iu]])
        yield pd.DataFrame({"i": np.arange(len(total)), "v": total})

    rows = data.mapInPandas(reduce_rows, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # (p + 2)² / 2 sums
    out = np.zeros(1 + p + 1 + len(iu[0]))
    for r in rows:
        out[r["i"]] = r["v"]
    second = np.zeros((p + 1, p + 1))
    second[iu] = out[p + 2:]
    return out[0], out[1:p + 2], second + np.triu(second, 1).T


@dataclass
class WeibullModel:
    """log T = intercept + x·coef + scale·ε for the smallest extreme value ε."""

    covariates: list[str]
    intercept: float
    coef: list[float]
    scale: float
    log_likelihood: float  # without the constant −Σ e·log t

    def location(self) -> Column:
        """Linear predictor; NULL covariates count as 0."""
        out = F.lit(self.intercept)
        for c, b in zip(self.covariates, self.coef, strict=True):
            out = out + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(b)
        return out

    def median_lifetime(self) -> Column:
        return F.exp(self.location() + F.lit(self.scale * math.log(math.log(2))))

    def save(self, spark, path: str) -> None:
        _write_model(spark, path, self)

    @classmethod
    def load(cls, spark, path: str) -> "WeibullModel":
        return cls(**_read_model(spark, path))


def _write_model(spark, path: str, model) -> None:
    plain = {k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in vars(model).items()}
    spark.createDataFrame([(json.dumps(plain),)], "model string").write.mode("overwrite").parquet(path)


def _read_model(spark, path: str) -> dict:
    return json.loads(spark.read.parquet(path).first()["model"])


def fit_weibull(df: DataFrame, covariates: Sequence[str], duration: str = "duration", event: str = "event", penalizer: float = 0.0, max_iter: int = 100, tolerance: float = 1e-9) -> WeibullModel:
    """Weibull accelerated-failure-time model by damped Newton steps.

    The mean log-likelihood is lowered by ``penalizer`` / 2 times the sum of squared
    coefficients of the standardised covariates; intercept and scale are free. Constant
    covariates get the coefficient 0. Only sums of the width of the model reach the driver.
    """
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in covariates]
    rows = df.select(whole_days(duration).alias("t"), F.col(event).cast("double").alias("e"), *[x.alias(f"x{i}") for i, x in enumerate(filled)]).where("t IS NOT NULL AND e IS NOT NULL")
    stats = rows.agg(F.count("*").alias("n"), F.sum("e").alias("d"), F.sum("t").alias("t"), *[f(f"x{i}").alias(f"{k}{i}") for i in range(len(filled)) for k, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    if not stats["d"]:
        raise ValueError("the Weibull fit needs at least one event")
    mean, std = (np.array([stats[f"{k}{i}"] or 0.0 for i in range(len(filled))]) for k in "ms")
    use = np.flatnonzero(std > 0)
    scaled = [(F.col(f"x{i}") - float(mean[i])) / float(std[i]) for i in use]
    data = settle(rows.select("t", "e", F.array(*scaled).cast("array<double>").alias("x")))
    n, p = stats["n"], len(use)
    ridge = np.array([0.0] + [penalizer] * p + [0.0])
    theta = np.zeros(p + 2)
    theta[0] = math.log(stats["t"] / stats["d"])

    def at(theta: np.ndarray):
        ll, first, second = _weibull_sums(data, theta)
        return ll / n - float(ridge @ theta**2) / 2, first / n - ridge * theta, second / n - np.diag(ridge), ll

    value, first, second, ll = at(theta)
    step = None
    for _ in range(max_iter):
        if step is None:
            lowest = np.linalg.eigvalsh(-second)[0]  # away from the optimum the curvature can be negative
            step = np.linalg.solve(-second + max(0.0, 1e-6 - lowest) * np.eye(p + 2), first)
            if np.abs(step).max() < tolerance:
                break
            step = step / max(1.0, np.abs(step).max())
        tried = at(theta + step)
        if tried[0] >= value - 1e-13:
            theta, step = theta + step, None
            value, first, second, ll = tried
        else:  # overshoot
            step = step / 2
    else:
        raise ValueError(f"the Weibull fit has not converged in {max_iter} steps; raise max_iter or the penalizer")
    coef = np.zeros(len(filled))
    coef[use] = theta[1:-1] / std[use]
    return WeibullModel(list(covariates), float(theta[0] - coef @ mean), coef.tolist(), math.exp(theta[-1]), float(ll))
