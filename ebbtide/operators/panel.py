"""Choosing the right panel row per customer.

Both as-of choices reduce the panel to one date per customer first (partial
aggregation absorbs heavy customers) and then join on customer *and* date, so
one customer's history is spread over many hash partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import ID, flag
from ebbtide.operators.activity import dates_of, last_seen


def latest_asof(panel: DataFrame, snapshots: str | Sequence[str]) -> DataFrame:
    """Newest panel rows on or before each snapshot; rows tied on the newest date all stay."""
    past = panel.where(F.col("datevalue") <= F.lit(dates_of(snapshots)[-1]).cast("date"))
    newest = last_seen(past, "datevalue", snapshots, inclusive=True).withColumnRenamed("_last", "datevalue")
    return past.join(newest, [ID, "datevalue"])


def first_cease(cease: DataFrame) -> DataFrame:
    return cease.groupBy(ID).agg(F.min(F.col("cease_placed_date").cast("date")).alias("first_cease"))


def retrospective_anchor(panel: DataFrame, cease: DataFrame) -> DataFrame:
    """Newest row before the first cancellation for leavers, newest row overall for the rest.

    Leavers whose whole history lies after their first cancellation drop out.
    """
    # One row per customer and month, so the join below sees bounded groups.
    months = panel.select(ID, "datevalue").distinct()
    dated = months.join(first_cease(cease), ID, "left").where(
        F.col("first_cease").isNull() | (F.col("datevalue") <= F.col("first_cease"))
    )
    anchor = dated.groupBy(ID).agg(F.max("datevalue").alias("datevalue"), flag(F.max("first_cease").isNotNull()).alias("churned"))
    return panel.join(anchor, [ID, "datevalue"])


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the smallest by ``order``, which must decide ties.

    ``min_by`` over a struct runs as a sort aggregate: every task sorts its rows by key,
    then combines them, so a key holding a third of all rows still ends as one small
    partial row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    payload = [c for c in df.columns if c not in keys]
    rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), rank).alias("row"))
    return best.select(*keys, "row.*")


def analytical_base(panel_keyed: DataFrame, cease: DataFrame, tie_break: str) -> DataFrame:
    """Retrospective anchor reduced to one row per customer."""
    return first_per_key(retrospective_anchor(panel_keyed, cease), ID, [tie_break])


def active_customers(panel: DataFrame, cease: DataFrame) -> DataFrame:
    """Customers that never placed a cancellation."""
    return panel.select(ID).distinct().join(cease.select(ID).distinct(), ID, "left_anti")
