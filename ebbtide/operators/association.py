"""Pairwise association: Pearson with pairwise-complete rows, and Cramér's V."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import ratio


def _pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, mx, my, vx, vy, cxy) per task and pair: moments of its complete rows around their own means."""
    ia, ib = np.triu_indices(len(cols), 1)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            seen = ~np.isnan(x)
            rows = []
            for i, j in zip(ia.tolist(), ib.tolist(), strict=True):
                both = seen[:, i] & seen[:, j]
                n = int(both.sum())
                if not n:
                    continue
                a, b = x[both, i], x[both, j]
                # Taken from the first value, so that a constant deviates by exactly nothing.
                da, db = a - a[0], b - b[0]
                ma, mb = da.mean(), db.mean()
                da, db = da - ma, db - mb
                rows.append((i, j, float(n), a[0] + ma, b[0] + mb, da @ da, db @ db, da @ db))
            yield pd.DataFrame(rows, columns=["i", "j", "n", "mx", "my", "vx", "vy", "cxy"])

    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return doubles.mapInPandas(moments, "i int, j int, n double, mx double, my double, vx double, vy double, cxy double")


def pearson_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, r) for every unordered pair over its complete rows; NULL r where a column does not vary.

    The input is read once. Each batch gives one line per pair; lines are merged by
    the parallel variance formula, with means taken relative to one of them.
    """
    cols = list(cols)
    pair = Window.partitionBy("i", "j")
    lines = _pair_moments(df, cols).withColumns({"_x": F.col("mx") - F.min("mx").over(pair), "_y": F.col("my") - F.min("my").over(pair)})
    share = F.col("n") / F.sum("n").over(pair)
    lines = lines.withColumns({"_gx": F.col("_x") - F.sum(F.col("_x") * share).over(pair), "_gy": F.col("_y") - F.sum(F.col("_y") * share).over(pair)})
    n, gx, gy = F.col("n"), F.col("_gx"), F.col("_gy")
    sums = lines.groupBy("i", "j").agg(F.sum(F.col("vx") + n * gx * gx).alias("vx"), F.sum(F.col("vy") + n * gy * gy).alias("vy"), F.sum(F.col("cxy") + n * gx * gy).alias("cxy"))
    names = F.array(*[F.lit(c) for c in cols])
    index = df.sparkSession.createDataFrame(list(combinations(range(len(cols)), 2)), "i int, j int")
    found = index.join(sums, ["i", "j"], "left")
    return found.select(names[F.col("i")].alias("a"), names[F.col("j")].alias("b"), F.try_divide("cxy", F.sqrt("vx") * F.sqrt("vy")).alias("r"))


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full symmetric matrix in long form, diagonal 1."""
    pairs = pearson_pairs(df, cols)
    cells = F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    both = pairs.select(F.explode(cells).alias("c")).select("c.*")
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "a string, b string, r double")
    return both.unionByName(diagonal)


# --- fixed values: direction texts --------------------------------------------------------------
HIGHER, LOWER = "⬆ Higher → More Churn", "⬇ Higher → Less Churn"


def target_correlation(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with the target and which way it points."""
    t = F.col(target).cast("double")
    cells = []
    for c in cols:
        x = F.col(c).cast("double")
        r = F.try_divide(F.covar_pop(x, t), F.stddev_pop(F.when(t.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), t)))
        cells.append(F.struct(F.lit(c).alias("feature"), r.alias("r")))
    long = df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")
    direction = F.when(F.col("r") > 0, HIGHER).otherwise(LOWER)
    order = Window.orderBy(F.abs("r").desc_nulls_last(), "feature")  # one row per feature
    return long.select("feature", "r", F.abs("r").alias("abs_r"), direction.alias("direction"), F.row_number().over(order).alias("rank"))


def multicollinear(df: DataFrame, cols: Sequence[str], threshold: float = 0.85) -> DataFrame:
    return pearson_pairs(df, cols).where(F.abs("r") > threshold)


def cramers_v(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, v) for every pair of categoricals; NULL is a category.

    All crosstabs are counted in one shuffle. 2×2 tables get the continuity
    correction, tables with a single row or column give 0.
    """
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cols}
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), text[a].alias("x"), text[b].alias("y")) for a, b in combinations(cols, 2)]
    cells = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").groupBy("a", "b", "x", "y").agg(F.count("*").alias("o"))
    rows = cells.groupBy("a", "b", "x").agg(F.sum("o").alias("rx"))
    columns = cells.groupBy("a", "b", "y").agg(F.sum("o").alias("cy"))
    shape_r = rows.groupBy("a", "b").agg(F.count("*").alias("nr"), F.sum("rx").alias("n"), F.sum(1 / F.col("rx")).alias("inv_r"))
    shape_c = columns.groupBy("a", "b").agg(F.count("*").alias("nc"), F.sum(1 / F.col("cy")).alias("inv_c"))
    o, rx, cy = (F.col(c).cast("double") for c in ("o", "rx", "cy"))
    full = cells.join(rows, ["a", "b", "x"]).join(columns, ["a", "b", "y"])
    sums = full.groupBy("a", "b").agg(F.sum(o * o / (rx * cy)).alias("phi"), F.max_by(F.struct("o", "rx", "cy"), "o").alias("top"))
    out = sums.join(shape_r, ["a", "b"]).join(shape_c, ["a", "b"])
    n = F.col("n").cast("double")
    gap = F.abs(F.col("top.o") - F.col("top.rx") * F.col("top.cy") / n)
    plain = n * (F.col("phi") - 1)
    yates = F.pow(F.greatest(gap - 0.5, F.lit(0.0)), 2) * n * F.col("inv_r") * F.col("inv_c")
    chi2 = F.when((F.col("nr") == 2) & (F.col("nc") == 2), yates).otherwise(F.greatest(plain, F.lit(0.0)))
    dim = F.least("nr", "nc") - 1
    return out.select("a", "b", F.sqrt(ratio(chi2, n * dim, 0.0)).alias("v"))
