"""Writing snapshots, scored lists, reports and run metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_features(matrix: DataFrame, folder: str) -> None:
    """One partition per snapshot date; only the dates in ``matrix`` are replaced."""
    matrix.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(folder)


def verify_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """(snapshot_date, n_rows, n_columns) of what was written."""
    df = spark.read.parquet(folder)
    return df.groupBy("snapshot_date").agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def write_scored_csv(scored: DataFrame, path: str) -> None:
    """Ranked list with a header, rows in rank order across the part files."""
    scored.repartitionByRange(F.col("priority_rank")).sortWithinPartitions("priority_rank").write.mode("overwrite").option("header", True).csv(path)


def append_report(result: DataFrame, path: str, stamp: str) -> None:
    """Append a time-stamped JSON document; only JSON-safe columns are kept."""
    safe = [c for c, t in result.dtypes if t in ("string", "int", "bigint", "double", "float", "boolean", "date") or t.startswith("array<")]
    result.select(F.lit(stamp).alias("reported_at"), *safe).write.mode("append").json(path)


def log_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Append (run_id, metric, value) rows, values rounded to six digits."""
    metrics.select(F.lit(run_id).alias("run_id"), "metric", F.round(F.col("value").cast("double"), 6).alias("value")).write.mode("append").parquet(path)


def log_params(spark: SparkSession, params: Mapping[str, object], path: str, run_id: str) -> None:
    rows = [(run_id, k, str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, "run_id string, param string, value string").write.mode("append").parquet(path)
