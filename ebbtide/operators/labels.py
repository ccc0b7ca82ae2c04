"""Forward-looking label: does the customer place a cancellation in the window after the snapshot?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS, Label
from ebbtide.functions.scalars import ID
from ebbtide.operators.activity import SNAP, dates_of


def leavers(cease: DataFrame, snapshots: str | Sequence[str], label: Label = DEFAULTS.label) -> DataFrame:
    """Distinct (customer, snapshot) pairs with a cancellation in [snapshot, snapshot + window)."""
    days = dates_of(snapshots)
    d = F.col("cease_placed_date").cast("date")
    low, high = F.lit(days[0]).cast("date"), F.date_add(F.lit(days[-1]).cast("date"), label.window_days)
    rows = cease.where((d >= low) & (d < high))
    if not label.include_pending:
        rows = rows.where(F.col("cease_completed_date").isNotNull())
    if len(days) == 1:
        return rows.select(ID).distinct().withColumn(SNAP, low)
    rows = rows.withColumn(SNAP, F.explode(F.array(*[F.lit(x).cast("date") for x in days])))
    return rows.where((d >= F.col(SNAP)) & (d < F.date_add(F.col(SNAP), label.window_days))).select(ID, SNAP).distinct()


def churn_label(customers: DataFrame, cease: DataFrame, snapshots: str | Sequence[str], label: Label = DEFAULTS.label) -> DataFrame:
    """One row per distinct customer and snapshot with ``churned`` in {0, 1}.

    ``customers`` may carry its own snapshot column; otherwise every snapshot applies to all.
    """
    if SNAP in customers.columns:
        base = customers.select(ID, SNAP).distinct()
    else:
        days = F.array(*[F.lit(x).cast("date") for x in dates_of(snapshots)])
        base = customers.select(ID).distinct().withColumn(SNAP, F.explode(days))
    hit = leavers(cease, snapshots, label).withColumn("churned", F.lit(1))
    return base.join(hit, [ID, SNAP], "left").withColumn("churned", F.coalesce("churned", F.lit(0)))
