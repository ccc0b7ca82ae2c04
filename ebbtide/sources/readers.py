"""Reading raw tables, snapshots and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.sources.schemas import RAW


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; the schema is matched to the header by name."""
    header = spark.read.option("header", True).csv(path).columns
    by_name = {f.name: f for f in schema.fields}
    typed = T.StructType([by_name.get(c, T.StructField(c, T.StringType())) for c in header])
    return spark.read.schema(typed).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_raw(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One raw table by file kind: CSV with its declared schema, or Parquet."""
    return read_csv(spark, path, RAW[name]) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)


def ingest(tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Create or replace every raw table as Parquet; running it again gives the same state."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def load_all(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(p) for name, p in paths.items()}


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n_rows, n_columns)."""
    parts = [df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """SQL over the given frames, passed as named arguments of the statement."""
    return spark.sql(text, **tables)


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """All feature snapshots below ``folder``; an error when there are none."""
    try:
        return spark.read.option("mergeSchema", True).parquet(folder)
    except AnalysisException as e:
        raise FileNotFoundError(f"no feature snapshots in {folder}; write features first") from e


def concat_snapshots(*frames: DataFrame) -> DataFrame:
    """Union by name; columns absent on one side become NULL."""
    if not frames:
        raise FileNotFoundError("no feature snapshots given")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
