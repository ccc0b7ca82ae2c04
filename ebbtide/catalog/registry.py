"""Registry of runnable queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ebbtide.sources.starschema import StarSchema


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[StarSchema], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(StarSchema(spark, folder))


QUERIES: dict[str, Query] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn(StarSchema) -> DataFrame`` under ``key``."""

    def wrap(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = Query(key, fn, oracle)
        return fn

    return wrap
