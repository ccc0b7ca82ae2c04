"""Smoothed target encoding with leave-fold-out training values.

Sums per (category, fold) are aggregated once; the out-of-fold value of a fold
is the category total minus the fold's own share, so no pass per fold is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Encoding
from ebbtide.functions.scalars import ID, portable_hash
from ebbtide.session import settle


def fold_of(key: Column | str = ID, folds: int = DEFAULTS.encoding.folds) -> Column:
    return (portable_hash(key) % folds).cast("int")


def category_stats(df: DataFrame, columns: Sequence[str], target: str, fold: Column) -> DataFrame:
    """(column, category, fold, n, pos) for all encoded columns in one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in columns])
    long = df.select(F.explode(pairs).alias("pair"), fold.alias("fold"), F.col(target).cast("double").alias("y"))
    long = long.select("pair.column", "pair.category", "fold", "y")
    return long.groupBy("column", "category", "fold").agg(F.count("*").alias("n"), F.sum("y").alias("pos"))


@dataclass
class FittedEncoder:
    """Category maps as a frame (column, category, n, encoded) and the fallback mean."""

    maps: DataFrame
    prior: float
    columns: tuple[str, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        """Attach ``<column>_encoded``; unseen and NULL categories get the fallback."""
        for c in self.columns:
            lookup = self.maps.where(F.col("column") == c).select(F.col("category").alias(c), F.col("encoded").alias(f"{c}_encoded"))
            df = _attach(df, lookup, c, [], ID if ID in df.columns else F.monotonically_increasing_id()).withColumn(f"{c}_encoded", F.coalesce(f"{c}_encoded", F.lit(self.prior)))
        return df

    def save(self, path: str) -> None:
        self.maps.withColumn("prior", F.lit(self.prior)).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "FittedEncoder":
        maps = spark.read.parquet(path)
        names = [r[0] for r in maps.select("column").distinct().collect()]
        return cls(maps.drop("prior"), maps.select("prior").first()[0], tuple(sorted(names)))


NULL_KEYS = 1024  # join keys over which rows with a NULL category are spread


def _spread(column: str, key: Column | str) -> Column:
    """-1 for categories; rows with a NULL one, which find no partner, get keys of their own instead of sharing one task."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(F.col(column).isNull(), F.pmod(F.xxhash64(key), F.lit(NULL_KEYS))).otherwise(F.lit(-1).cast("long"))


def _attach(df: DataFrame, lookup: DataFrame, column: str, on: Sequence[str], key: Column | str) -> DataFrame:
    """Left join of a category lookup that does not gather NULL categories."""
    held = F.coalesce(F.col(column).cast("string"), F.lit(""))
    left = df.withColumn("_category", held).withColumn("_spread", _spread(column, key))
    right = lookup.withColumn("_category", held).drop(column).withColumn("_spread", F.lit(-1).cast("long"))
    return left.join(right, ["_category", "_spread", *on], "left").select(*df.columns, f"{column}_encoded")


def _smoothed(pos: Column, n: Column, prior: Column, strength: float) -> Column:
    return (pos + prior * strength) / (n + F.lit(strength))


def _prior(stats: DataFrame) -> float:
    """Overall target mean, read off the category counts of one column."""
    one = stats.agg(F.min("column").alias("c")).first()["c"]
    row = stats.where(F.col("column") == one).agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")).first()
    return float(row["pos"]) / row["n"] if row["n"] else 0.0


def out_of_fold(df: DataFrame, settings: Encoding = DEFAULTS.encoding, target: str = "churned", key: Column | str = ID, counts_from: DataFrame | None = None) -> DataFrame:
    """Training matrix with leave-fold-out ``<column>_encoded`` columns.

    The counts are taken in a first pass, written once and joined in a second.
    ``counts_from`` may name a cheaper frame with the same rows that has only
    the encoded columns, the key and the target.
    """
    fold = fold_of(key, settings.folds)
    stats = settle(category_stats(df if counts_from is None else counts_from, settings.columns, target, fold))
    prior = F.lit(_prior(stats))
    whole = Window.partitionBy("column", "category")  # at most `folds` rows per category
    n_out = F.sum("n").over(whole) - F.col("n")
    pos_out = F.sum("pos").over(whole) - F.col("pos")
    values = stats.where(F.col("category").isNotNull()).select(
        "column", "category", "fold", _smoothed(pos_out, n_out, prior, settings.smoothing).alias("encoded")
    )
    out = df.withColumn("_fold", fold)
    for c in settings.columns:
        lookup = values.where(F.col("column") == c).select(F.col("category").alias(c), F.col("fold").alias("_fold"), F.col("encoded").alias(f"{c}_encoded"))
        out = _attach(out, lookup, c, ["_fold"], key).withColumn(f"{c}_encoded", F.coalesce(f"{c}_encoded", prior))
    return out.drop("_fold")


def fit(df: DataFrame, settings: Encoding = DEFAULTS.encoding, target: str = "churned") -> FittedEncoder:
    """Full-data category means for later snapshots and scoring."""
    stats = settle(category_stats(df, settings.columns, target, F.lit(0)))
    prior = _prior(stats)
    maps = stats.where(F.col("category").isNotNull()).select("column", "category", "n", _smoothed(F.col("pos"), F.col("n"), F.lit(prior), settings.smoothing).alias("encoded"))
    return FittedEncoder(maps, prior, tuple(settings.columns))
