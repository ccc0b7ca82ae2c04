"""Temporal split and leakage guards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, LEAKY_COLUMNS, Splits
from ebbtide.functions.scalars import ID


def split_name(date: Column, splits: Splits = DEFAULTS.splits) -> Column:
    """train / val / test by date; NULL after the test end."""
    d = date.cast("date")
    ends = {k: F.lit(v).cast("date") for k, v in (("train", splits.train_end), ("val", splits.val_end), ("test", splits.test_end))}
    return F.when(d <= ends["train"], "train").when(d <= ends["val"], "val").when(d <= ends["test"], "test")


@dataclass
class TemporalSplit:
    train: DataFrame
    val: DataFrame
    test: DataFrame
    splits: Splits

    def check(self, date_col: str = "snapshot_date") -> None:
        assert_no_leakage(self.train, self.test, date_col)


def temporal_split(df: DataFrame, date_col: str = "snapshot_date", splits: Splits = DEFAULTS.splits) -> TemporalSplit:
    """Three lazy range filters, which reach the scan; rows after the test end belong to none."""
    d = F.col(date_col) if dict(df.dtypes)[date_col] == "date" else F.col(date_col).cast("date")
    train, val, test = (F.lit(x).cast("date") for x in (splits.train_end, splits.val_end, splits.test_end))
    return TemporalSplit(df.where(d <= train), df.where((d > train) & (d <= val)), df.where((d > val) & (d <= test)), splits=splits)


def split_sizes(df: DataFrame, date_col: str = "snapshot_date", target: str = "churned", splits: Splits = DEFAULTS.splits) -> DataFrame:
    part = df.withColumn("split", split_name(F.col(date_col), splits)).where(F.col("split").isNotNull())
    return part.groupBy("split").agg(F.count("*").alias("n_rows"), F.avg(F.col(target).cast("double")).alias("churn_rate"))


def leak_dates(df: DataFrame, date_col: str = "snapshot_date", splits: Splits = DEFAULTS.splits) -> DataFrame:
    """One row: newest training date, oldest test date, and whether they are in order."""
    d, part = F.col(date_col).cast("date"), split_name(F.col(date_col), splits)
    row = df.agg(F.max(F.when(part == "train", d)).alias("max_train"), F.min(F.when(part == "test", d)).alias("min_test"))
    return row.withColumn("ok", F.col("max_train") < F.col("min_test"))


def assert_no_leakage(train: DataFrame, test: DataFrame, date_col: str = "snapshot_date") -> None:
    newest = train.agg(F.max(F.col(date_col).cast("date"))).first()[0]
    oldest = test.agg(F.min(F.col(date_col).cast("date"))).first()[0]
    if newest is not None and oldest is not None and newest >= oldest:
        raise AssertionError(f"DATA LEAKAGE DETECTED: newest training date {newest} is not before oldest test date {oldest}")


def single_snapshot(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    return df.agg(F.countDistinct(date_col).alias("n_snapshots"), (F.countDistinct(date_col) == 1).alias("ok"))


def leaky_columns(df: DataFrame) -> list[str]:
    """Columns that must never reach a feature matrix but did."""
    return [c for c in df.columns if c.lower() in LEAKY_COLUMNS]


def panel_overlap(df: DataFrame, date_col: str, target: str, splits: Splits = DEFAULTS.splits) -> DataFrame:
    """Customers present in both train and test, repeated within a split, and leaving in both."""
    part = df.select(ID, split_name(F.col(date_col), splits).alias("split"), F.col(target).alias("y"))
    per = part.groupBy(ID).agg(
        F.count_if(F.col("split") == "train").alias("tr"),
        F.count_if(F.col("split") == "test").alias("te"),
        F.max(F.when((F.col("split") == "train"), F.col("y"))).alias("ytr"),
        F.max(F.when((F.col("split") == "test"), F.col("y"))).alias("yte"),
    )
    return per.agg(
        F.count_if((F.col("tr") > 0) & (F.col("te") > 0)).alias("in_both"),
        F.count_if(F.col("tr") > 1).alias("dup_train"),
        F.count_if(F.col("te") > 1).alias("dup_test"),
        F.count_if((F.col("ytr") == 1) & (F.col("yte") == 1)).alias("churned_both"),
    )
