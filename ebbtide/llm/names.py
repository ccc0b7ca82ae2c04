"""Names that do not clash with those of the caller's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col(f"`{name.replace('`', '``')}`").alias(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name
