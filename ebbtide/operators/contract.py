"""Contract and account features: one projection, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import CONTRACT_STATUSES, TECHNOLOGIES
from ebbtide.functions.scalars import ID, at_least, bucket_left, code_of, flag, ratio

STATUS_CODES = {text.lower(): code for code, text in enumerate(CONTRACT_STATUSES)}
UNKNOWN_STATUS_CODE = 1

# --- fixed values: tenure bands in days, left-closed ------------------------------------------
TENURE_EDGES = (0, 90, 365, 1095, None)
TENURE_LABELS = ("0-3m", "3m-1yr", "1-3yr", "3yr+")
TENURE_OUTSIDE = "nan"


def status_risk(c: Column | str = "contract_status") -> Column:
    return code_of(F.col(c) if isinstance(c, str) else c, STATUS_CODES, UNKNOWN_STATUS_CODE)


def tenure_bucket(days: Column) -> Column:
    return bucket_left(days, TENURE_EDGES, TENURE_LABELS, TENURE_OUTSIDE)


def one_hot(c: Column, values: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per value of a fixed vocabulary; NULL gives all zeros."""
    return [flag(c == v).alias(f"{prefix}{v}") for v in values]


def vocabulary(df: DataFrame, column: str, limit: int = 1000) -> list[str]:
    """Sorted distinct values, for one-hot without a fixed vocabulary.

    The list becomes columns, so it must be small; more than ``limit`` values is an error.
    """
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values; encode it instead")
    return sorted(r[0] for r in rows)


def contract_features(panel: DataFrame, technologies: Sequence[str] | None = TECHNOLOGIES, keep: Sequence[str] = ()) -> DataFrame:
    """Fixed account features plus one-hot technology columns for every panel row.

    Pass ``technologies=None`` to discover the vocabulary from the data.
    """
    names = {c.lower(): c for c in panel.columns}
    tech = F.col(names["technology"]) if "technology" in names else F.lit("unknown")
    if technologies is None:
        technologies = vocabulary(panel.select(tech.alias("technology")), "technology")
    number = {c: F.col(c).try_cast("double") for c in ("ooc_days", "speed", "line_speed", "dd_cancel_60_day", "contract_dd_cancels", "tenure_days")}
    gap = at_least(number["speed"] - number["line_speed"], 0)
    dd = F.coalesce(number["dd_cancel_60_day"], F.lit(0.0))
    tenure = F.coalesce(number["tenure_days"], F.lit(0.0))
    return panel.select(
        ID,
        *keep,
        number["ooc_days"].alias("ooc_days"),
        flag(number["ooc_days"] >= 0).alias("is_out_of_contract"),
        at_least(F.lit(0.0) - number["ooc_days"], 0).alias("days_to_ooc"),
        status_risk().alias("contract_status_risk"),
        gap.alias("speed_gap"),
        ratio(gap, number["speed"], 0.0).alias("speed_gap_pct"),
        dd.alias("dd_cancel_60_day"),
        flag(dd > 0).alias("has_dd_cancel"),
        F.log1p(dd).alias("dd_cancel_log"),
        F.coalesce(number["contract_dd_cancels"], F.lit(0.0)).alias("contract_dd_cancels"),
        tenure.alias("tenure_days"),
        F.log1p(tenure).alias("tenure_log"),
        tenure_bucket(tenure).alias("tenure_bucket"),
        "sales_channel",
        "crm_package_name",
        *one_hot(tech, technologies, "tech_"),
    )
