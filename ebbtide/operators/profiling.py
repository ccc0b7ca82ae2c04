"""Exploratory aggregates over the customer base and the event logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.config import REASON_GROUPS
from ebbtide.functions.scalars import ID, bucket_right, col, flag, month_of, one_row, ratio, safe_date, safe_double
from ebbtide.operators import activity
from ebbtide.operators.contract import vocabulary
from ebbtide.operators.ranking import quantiles

# --- fixed values: right-closed report bands --------------------------------------------------
TENURE_BAND_EDGES = (0, 180, 365, 730, 1095, 1460)
TENURE_BAND_LABELS = ("0–6 months", "6–12 months", "1–2 years", "2–3 years", "3–4 years", "4+ years")
OOC_BAND_EDGES = (-9999, -180, -30, 0, 30, 180, 9999)
OOC_BAND_LABELS = ("≤−180d", "−180→−30d", "−30→0d", "0→30d", "30→180d", ">180d")
SPEED_TIER_EDGES = (0, 40, 80, 200, 1000)
SPEED_TIER_LABELS = ("≤40 Mbps", "41–80", "81–200", "201+")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def tenure_band(c: str = "tenure_days") -> Column:
    return bucket_right(F.col(c), [*TENURE_BAND_EDGES, F.lit(float("inf"))], TENURE_BAND_LABELS)


def ooc_band(c: str = "ooc_days") -> Column:
    return bucket_right(F.coalesce(F.col(c), F.lit(0.0)), OOC_BAND_EDGES, OOC_BAND_LABELS)


def speed_tier(c: str = "speed") -> Column:
    return bucket_right(F.col(c), SPEED_TIER_EDGES, SPEED_TIER_LABELS)


# ---- column shaping --------------------------------------------------------------------------
def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def ordinal_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """0..k code of each sorted distinct value, as a literal map (no join)."""
    pairs = [F.lit(x) for i, v in enumerate(vocabulary(df, column)) for x in (v, i)]
    return df.withColumn(name, F.try_element_at(F.create_map(*pairs), F.col(column)))


def dummies_drop_first(df: DataFrame, column: str, prefix: str, missing: str = "Unknown") -> list[Column]:
    """One-hot columns without the first level; NULL is a level of its own."""
    filled = F.coalesce(F.col(column), F.lit(missing))
    levels = vocabulary(df.select(filled.alias(column)), column)
    return [(filled == v).cast("int").alias(f"{prefix}{v}") for v in levels[1:]]


def undummy(df: DataFrame, prefix: str, default: str = "Unknown") -> Column:
    hits = [F.when(F.col(c) == 1, c[len(prefix):]) for c in df.columns if c.startswith(prefix)]
    return F.coalesce(*hits, F.lit(default))


def column_spread(df: DataFrame, keep: Sequence[str] = (), tolerance: float = 1e-6) -> DataFrame:
    """(column, std, dropped) of every numeric column that isn't kept; one aggregate."""
    cells = [F.struct(F.lit(c).alias("column"), F.stddev_samp(c).alias("std")) for c in numeric_columns(df, keep)]
    long = df.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    return long.withColumn("dropped", F.coalesce("std", F.lit(0.0)) < tolerance)


def drop_constant(df: DataFrame, keep: Sequence[str] = (), tolerance: float = 1e-6) -> DataFrame:
    """Drop numeric columns whose standard deviation is below ``tolerance``."""
    return df.drop(*[r["column"] for r in column_spread(df, keep, tolerance).where("dropped").collect()])  # one row per column


def keep_top_categories(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose category is among the ``k`` most frequent (ties: alphabetical)."""
    top = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k).select(column)
    return df.join(F.broadcast(top), column, "left_semi")  # k rows


# ---- leaving events --------------------------------------------------------------------------
def churn_rate(panel: DataFrame, cease: DataFrame) -> DataFrame:
    row = one_row(
        panel.agg(F.countDistinct(ID).alias("customers")),
        cease.agg(F.countDistinct(ID).alias("churners"), (F.count("*") - F.countDistinct(ID)).alias("duplicate_rows")),
    )
    return row.withColumn("churn_rate", ratio(F.col("churners"), F.col("customers")))


def monthly_churn_rate(panel: DataFrame, cease: DataFrame) -> DataFrame:
    base = panel.groupBy(F.col("datevalue").alias("month")).agg(F.countDistinct(ID).alias("base"))
    gone = cease.groupBy(month_of("cease_placed_date").alias("month")).agg(F.countDistinct(ID).alias("churners"))
    out = base.join(gone, "month", "left").withColumn("churners", F.coalesce("churners", F.lit(0).cast("bigint")))
    return out.withColumn("churn_pct", F.col("churners") / F.col("base") * 100)


def monthly_volume(events: DataFrame, date_col: str) -> DataFrame:
    """Events per month with empty months shown as 0."""
    per = events.groupBy(month_of(date_col).alias("month")).agg(F.count("*").alias("n"))
    span = per.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    months = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    return months.join(per, "month", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def weekday_counts(events: DataFrame, date_col: str) -> DataFrame:
    """Events per weekday in calendar order; a weekday without events has NULL."""
    per = events.groupBy(F.date_format(date_col, "EEEE").alias("weekday")).agg(F.count("*").alias("n"))
    spark = events.sparkSession
    week = spark.createDataFrame(list(enumerate(WEEKDAYS, 1)), "day_no int, weekday string")
    return week.join(per, "weekday", "left").select("day_no", "weekday", "n")


def reason_breakdown(first: DataFrame, column: str = "reason_description_insight") -> DataFrame:
    """Counts and shares over one row per customer."""
    total = first.where(F.col(column).isNotNull()).select(F.count("*")).scalar()
    per = first.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return per.withColumn("pct", F.col("n") / total * 100)


def reason_trend(cease: DataFrame, k: int = 5, column: str = "reason_description_insight") -> DataFrame:
    """Monthly counts of the ``k`` most frequent reasons, one column each."""
    top = [r[0] for r in cease.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k).collect()]
    rows = cease.where(F.col(column).isin(top))
    return rows.groupBy(month_of("cease_placed_date").alias("month")).pivot(column, top).count().fillna(0)


def reason_groups(first: DataFrame, column: str = "reason_description_insight") -> DataFrame:
    pairs = [F.lit(x) for kv in REASON_GROUPS.items() for x in kv]
    group = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit("unclassified"))
    total = first.select(F.count("*")).scalar()
    per = first.groupBy(group.alias("reason_group")).agg(F.count("*").alias("n"))
    return per.withColumn("share", F.col("n") / total)


def processing_days(cease: DataFrame, low: int = 0, high: int = 120) -> DataFrame:
    took = F.datediff(safe_date("cease_completed_date"), F.col("cease_placed_date"))
    return cease.select(took.alias("days")).where(F.col("days").between(low, high))


# ---- counts and rates ------------------------------------------------------------------------
def value_counts(df: DataFrame, column: str, limit: int | None = None, by_count: bool = False) -> DataFrame:
    per = df.groupBy(column).agg(F.count("*").alias("n"))
    if limit is None:
        return per
    order = [F.desc("n"), F.asc_nulls_last(column)] if by_count else [F.asc_nulls_last(column)]
    return per.orderBy(*order).limit(limit)


def rate_by(df: DataFrame, keys: Sequence[str], target: str = "churned") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.col(target).cast("double")).alias("churn_rate"), F.count("*").alias("n"))


def rate_pivot(df: DataFrame, rows: str, columns: str, values: Sequence[str] | None = None, target: str = "churned") -> DataFrame:
    values = list(values) if values is not None else vocabulary(df, columns)
    return df.groupBy(rows).pivot(columns, values).agg(F.avg(F.col(target).cast("double")))


def calls_histogram(calls: DataFrame) -> DataFrame:
    """How many customers made how many calls."""
    return calls.groupBy(ID).agg(F.count("*").alias("n_calls")).groupBy("n_calls").agg(F.count("*").alias("n_customers"))


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = (), lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width counts; bin 0..bins-1, the last bin is closed on the right."""
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull())
    if lo is None or hi is None:
        span = rows.select(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
        low, high = span["lo"], span["hi"]
    else:
        low, high = F.lit(float(lo)), F.lit(float(hi))
        rows = rows.where((v >= low) & (v <= high))
    at = F.floor(F.coalesce(F.try_divide((v - low) * bins, high - low), F.lit(0.0))).cast("int")
    return rows.groupBy(*by, F.least(at, F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"))


def density(counts: DataFrame, by: Sequence[str], width: float) -> DataFrame:
    """Histogram counts turned into a density per group."""
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_all"))
    joined = counts.join(totals, list(by)) if by else counts.withColumn("_all", counts.select(F.sum("n")).scalar())
    return joined.withColumn("density", F.col("n") / F.col("_all") / F.lit(width)).drop("_all")


def daily_mean(usage: DataFrame) -> DataFrame:
    return activity.parsed_usage(usage).groupBy("calendar_date").agg(F.avg("dl").alias("avg_dl"))


def zero_share(usage: DataFrame, more_than: int = 10) -> DataFrame:
    """Share of zero or missing usage per customer with more than ``more_than`` rows.

    Text that does not parse is neither zero nor missing here.
    """
    zero = flag((safe_double("usage_download_mbs") == 0) | F.col("usage_download_mbs").isNull())
    per = usage.groupBy(ID).agg(F.avg(zero.cast("double")).alias("zero_pct"), F.count("*").alias("n_days"))
    return per.where(F.col("n_days") > more_than)


# ---- joined base -----------------------------------------------------------------------------
def rich_base(base: DataFrame, calls: DataFrame, usage: DataFrame) -> DataFrame:
    out = base.join(activity.calls_all_time(calls), ID, "left").join(activity.usage_all_time(usage), ID, "left")
    for c in ("total_calls", "loyalty_calls"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0).cast("bigint")))
    gap = F.try_divide(F.col("speed") - F.col("line_speed"), F.col("speed")) * 100
    return out.withColumn("speed_gap_pct", F.when(F.col("line_speed") > 0, gap))


def measured_gap(base: DataFrame) -> DataFrame:
    """Rows with a measured line and their gap in percent of the sold speed."""
    gap = F.try_divide(F.col("speed") - F.col("line_speed"), F.col("speed")) * 100
    return base.where(F.col("line_speed") > 0).withColumn("speed_gap_pct", gap)


def loyalty_rate(rich: DataFrame) -> DataFrame:
    flags = rich.withColumn("had_loyalty", flag(F.col("loyalty_calls") > 0)).withColumn("has_calls", flag(F.col("total_calls") > 0))
    return rate_by(flags, ["had_loyalty", "has_calls"])


def loyalty_after_cease(calls: DataFrame, first_cease: DataFrame) -> DataFrame:
    """Share of loyalty calls made on or after the customer's first cancellation."""
    daily = calls.where("call_type = 'Loyalty'").groupBy(ID, "event_date").agg(F.count("*").alias("n"))
    joined = daily.join(first_cease, ID, "left")
    late = F.coalesce(F.sum(F.when(F.col("event_date") >= F.col("first_cease"), F.col("n"))), F.lit(0).cast("bigint"))
    return joined.agg(F.sum("n").alias("loyalty_calls"), late.alias("after_cease"), ratio(late, F.sum("n")).alias("share"))


# ---- column profiles -------------------------------------------------------------------------
def _stack(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.unpivot([], df.columns, name, value)


def null_rates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column, null_pct), one aggregate per table."""
    parts = []
    for table, df in tables.items():
        rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
        parts.append(_stack(rates, "column", "null_pct").select(F.lit(table).alias("table"), "column", "null_pct"))
    return reduce(DataFrame.unionByName, parts)


def null_matrix(rates: DataFrame, tables: Sequence[str]) -> DataFrame:
    return rates.groupBy("column").pivot("table", list(tables)).agg(F.first("null_pct"))


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null share and approximate distinct count of every column."""
    parts = []
    for table, df in tables.items():
        cells = [
            F.struct(
                F.lit(c).alias("column"),
                F.avg(F.col(c).isNull().cast("double")).alias("null_pct"),
                F.approx_count_distinct(c).alias("approx_distinct"),
            )
            for c in df.columns
        ]
        parts.append(df.agg(F.array(*cells).alias("cells")).select(F.lit(table).alias("table"), F.explode("cells").alias("c")).select("table", "c.*"))
    return reduce(DataFrame.unionByName, parts)


def null_group(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Rows in which a whole feature group is missing."""
    gone = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])
    return df.agg(F.lit(name).alias("feature_group"), F.count_if(gone).alias("n_missing"), F.avg(gone.cast("double")).alias("share"))


def long_values(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """(keep…, feature, value) with one row per non-null cell."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.explode(cells).alias("cell")).select(*keep, "cell.feature", "cell.value").where(F.col("value").isNotNull())


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of every column, quartiles exact."""
    long = long_values(df, columns)
    basic = long.groupBy("feature").agg(F.count("*").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    return basic.join(quantiles(long, "value", [0.25, 0.5, 0.75], ["feature"]).drop("n"), "feature")


def group_median(df: DataFrame, value: str, by: Sequence[str], name: str = "median") -> DataFrame:
    """Exact median and mean per group; groups without values are kept with NULL."""
    mid = quantiles(df, value, [0.5], by, [name]).drop("n")
    stats = df.groupBy(*by).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))
    cond = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}")) for k in by])
    return stats.alias("s").join(mid.alias("m"), cond, "left").select("s.*", f"m.{name}")
