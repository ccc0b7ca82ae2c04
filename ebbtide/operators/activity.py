"""Point-in-time aggregates over the call and usage logs.

Each log is reduced to one row per customer and snapshot in a single pass:
map-side partial aggregation absorbs heavy customers before the shuffle.
Several snapshots share the same scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import DEFAULTS
from ebbtide.functions.scalars import ID, ratio, safe_double

SNAP = "snapshot_date"


def dates_of(snapshots: str | Sequence[str]) -> list[str]:
    return [snapshots] if isinstance(snapshots, str) else sorted(snapshots)


def stamp(events: DataFrame, date_col: str, snapshots: str | Sequence[str], inclusive: bool = False) -> DataFrame:
    """Attach every snapshot an event is visible from (strictly before it unless ``inclusive``)."""
    days = dates_of(snapshots)
    d = F.col(date_col)

    def visible(bound: Column) -> Column:
        return d <= bound if inclusive else d < bound

    if len(days) == 1:
        bound = F.lit(days[0]).cast("date")
        return events.where(visible(bound)).withColumn(SNAP, bound)
    events = events.where(visible(F.lit(days[-1]).cast("date")))
    all_days = F.array(*[F.lit(x).cast("date") for x in days])
    return events.withColumn(SNAP, F.explode(all_days)).where(visible(F.col(SNAP)))


def grain(snapshots: str | Sequence[str]) -> tuple[list[str], Column]:
    """Grouping keys and the snapshot as a column.

    A single snapshot is a literal and stays out of the keys, so that the
    aggregate is already partitioned by customer for the joins that follow.
    """
    days = dates_of(snapshots)
    return ([ID], F.lit(days[0]).cast("date")) if len(days) == 1 else ([ID, SNAP], F.col(SNAP))


def stamped(df: DataFrame, snapshots: str | Sequence[str]) -> DataFrame:
    """Aggregated frame with its snapshot column in second place."""
    _, snap = grain(snapshots)
    return df.select(ID, snap.alias(SNAP), *[c for c in df.columns if c not in (ID, SNAP)])


def _last(date_col: str, snap: Column, days: int) -> Column:
    return F.col(date_col) >= F.date_sub(snap, days)


def _next(d: Column, dates: Sequence[str]) -> Column:
    """First of the ascending ``dates`` after ``d``, NULL after the last one."""
    out = None
    for x in dates:
        day = F.lit(x).cast("date")
        out = F.when(d < day, day) if out is None else out.when(d < day, day)
    return out


def _apart(dates: Sequence[str], days: int) -> bool:
    """Whether no window of ``days`` days before a date reaches back beyond the date before."""
    at = [date.fromisoformat(str(x)[:10]).toordinal() for x in dates]
    return all(b - a >= days for a, b in zip(at, at[1:], strict=False))


def recent(events: DataFrame, date_col: str, snapshots: str | Sequence[str], days: int) -> DataFrame:
    """Events of the last ``days`` days before each snapshot, once per such snapshot.

    The outer bounds are plain comparisons, so they reach the scan; an event is
    copied only to snapshots whose window holds it.
    """
    dates = dates_of(snapshots)
    d = F.col(date_col)
    first, last = (F.lit(x).cast("date") for x in (dates[0], dates[-1]))
    near = events.where((d >= F.date_sub(first, days)) & (d < last))
    if len(dates) == 1:
        return near.withColumn(SNAP, last)
    if _apart(dates, days):
        return near.withColumn(SNAP, _next(d, dates)).where(d >= F.date_sub(F.col(SNAP), days))
    every = F.array(*[F.lit(x).cast("date") for x in dates])
    return near.withColumn(SNAP, F.explode(F.filter(every, lambda s: (s > d) & (s <= F.date_add(d, days)))))


def seen(events: DataFrame, date_col: str, snapshots: str | Sequence[str], days: int) -> DataFrame:
    """All events before the last snapshot, each at the first snapshot after it and at later ones whose window of ``days`` days holds it."""
    dates = dates_of(snapshots)
    d = F.col(date_col)
    last = F.lit(dates[-1]).cast("date")
    past = events.where(d < last)
    if len(dates) == 1:
        return past.withColumn(SNAP, last)
    if _apart(dates, days):
        return past.withColumn(SNAP, _next(d, dates))
    every = F.array(*[F.lit(x).cast("date") for x in dates])
    return past.withColumn(SNAP, F.explode(F.filter(every, lambda s: (s == _next(d, dates)) | ((s > d) & (s <= F.date_add(d, days))))))


def carried(per: DataFrame, snapshots: str | Sequence[str]) -> DataFrame:
    """Rows by customer and snapshot, of ``seen`` events, with ``_last`` carried on to every later snapshot; other columns stay where they are."""
    dates = dates_of(snapshots)
    if len(dates) == 1:
        return per
    every = F.array(*[F.lit(x).cast("date") for x in dates])
    spread = per.withColumn("_at", F.explode(F.filter(every, lambda s: s >= F.col(SNAP))))
    own = F.col("_at") == F.col(SNAP)
    kept = [c for c in per.columns if c not in (ID, SNAP, "_last")]
    out = spread.groupBy(ID, "_at").agg(F.max("_last").alias("_last"), *[F.max(F.when(own, F.col(c))).alias(c) for c in kept])
    return out.withColumnRenamed("_at", SNAP)


def last_seen(events: DataFrame, date_col: str, snapshots: str | Sequence[str], inclusive: bool = False) -> DataFrame:
    """(id, snapshot, _last): newest event before (``inclusive``: or on) each snapshot, for everybody with one.

    Events are reduced to one date per customer and gap between snapshots first; only
    those few rows are copied to the later snapshots.
    """
    dates = dates_of(snapshots)
    d = F.col(date_col)
    end = F.lit(dates[-1]).cast("date")
    past = events.where(d <= end if inclusive else d < end).select(ID, date_col)
    if len(dates) == 1:
        return past.groupBy(ID).agg(F.max(date_col).alias("_last")).select(ID, F.lit(dates[0]).cast("date").alias(SNAP), "_last")
    every = F.array(*[F.lit(x).cast("date") for x in dates])
    per_gap = past.withColumn("_next", F.element_at(F.filter(every, lambda s: s >= d if inclusive else s > d), 1)).groupBy(ID, "_next").agg(F.max(date_col).alias("_last"))
    spread = per_gap.withColumn(SNAP, F.explode(F.filter(every, lambda s: s >= F.col("_next"))))
    return spread.groupBy(ID, SNAP).agg(F.max("_last").alias("_last"))


def _filled(count: str) -> Column:
    return F.coalesce(F.col(count), F.lit(0).cast("bigint")).alias(count)


def call_counts(calls: DataFrame, snapshots: str | Sequence[str], windows: Sequence[int] = DEFAULTS.call_windows) -> DataFrame:
    """Calls per customer in each trailing window."""
    snap = F.col(SNAP)
    names = [f"call_count_{w}d" for w in windows]
    counts = recent(calls.select(ID, "event_date"), "event_date", snapshots, max(windows)).groupBy(ID, SNAP).agg(
        *[F.count_if(_last("event_date", snap, w)).alias(n) for n, w in zip(names, windows, strict=True)])
    return last_seen(calls, "event_date", snapshots).join(counts, [ID, SNAP], "left").select(ID, SNAP, *map(_filled, names))


def call_features(calls: DataFrame, snapshots: str | Sequence[str], windows: Sequence[int] = DEFAULTS.call_windows) -> DataFrame:
    snap = F.col(SNAP)
    in30, in90 = _last("event_date", snap, 30), _last("event_date", snap, 90)
    loyal = F.col("call_type") == "Loyalty"
    names = [f"call_count_{w}d" for w in windows]
    # One pass: the log's rows may come from a large join, which "last call" and windows share.
    past = seen(calls.select(ID, "event_date", "call_type", "talk_time_seconds", "hold_time_seconds"), "event_date", snapshots, max(90, *windows))
    per = past.groupBy(ID, SNAP).agg(
        F.max("event_date").alias("_last"),
        *[F.count_if(_last("event_date", snap, w)).alias(n) for n, w in zip(names, windows, strict=True)],
        F.max(F.when(loyal & in30, 1).otherwise(0)).alias("loyalty_call_flag_30d"),
        F.count_if(loyal & in90).alias("loyalty_call_count_90d"),
        F.count_if(in30).alias("_n30"), F.count_if(in90).alias("_n90"),
        F.avg(F.when(in30, F.col("talk_time_seconds"))).alias("avg_talk_time_30d"),
        F.avg(F.when(in30, F.col("hold_time_seconds"))).alias("avg_hold_time_30d"),
    )
    out = carried(per, snapshots)
    loyal90, n30, n90 = (F.coalesce(F.col(c), F.lit(0)) for c in ("loyalty_call_count_90d", "_n30", "_n90"))
    return out.select(
        ID, SNAP, *map(_filled, names), F.coalesce("loyalty_call_flag_30d", F.lit(0)).alias("loyalty_call_flag_30d"), _filled("loyalty_call_count_90d"),
        ratio(loyal90, n90, 0.0).alias("pct_loyalty_calls_90d"), "avg_talk_time_30d", "avg_hold_time_30d",
        F.datediff(snap, F.col("_last")).alias("days_since_last_call"),
        ratio(n30, n90 / F.lit(3.0), 1.0).alias("call_frequency_trend"),
    )


def parsed_usage(usage: DataFrame, *keep: str) -> DataFrame:
    return usage.select(ID, "calendar_date", *keep, safe_double("usage_download_mbs").alias("dl"), safe_double("usage_upload_mbs").alias("ul"))


def usage_features(usage: DataFrame, snapshots: str | Sequence[str]) -> DataFrame:
    """Values are read and parsed for the last 60 days only; older rows count by id and date."""
    snap = F.col(SNAP)
    in7, in30, in60 = (_last("calendar_date", snap, w) for w in (7, 30, 60))
    dl, ul = F.col("dl"), F.col("ul")
    total = F.coalesce(dl, F.lit(0.0)) + F.coalesce(ul, F.lit(0.0))
    per = recent(parsed_usage(usage), "calendar_date", snapshots, 60).groupBy(ID, SNAP).agg(
        F.avg(F.when(in30, dl)).alias("avg_download_30d"),
        F.avg(F.when(in30, ul)).alias("avg_upload_30d"),
        F.avg(F.when(in7, dl)).alias("avg_download_7d"),
        F.avg(F.when(in60 & ~in30, dl)).alias("_prior"),
        F.count_if(in30 & (dl.isNull() | (dl == 0))).alias("zero_usage_days_30d"),
        F.stddev_samp(F.when(in30, dl)).alias("usage_volatility_30d"),
        F.avg(F.when(in30, total)).alias("avg_daily_total_mb_30d"),
    )
    avg7, avg30, prior = (F.col(c) for c in ("avg_download_7d", "avg_download_30d", "_prior"))
    return last_seen(usage, "calendar_date", snapshots).join(per, [ID, SNAP], "left").select(
        ID, SNAP, "avg_download_30d", "avg_upload_30d", "avg_download_7d",
        ratio(avg7, avg30, 1.0).alias("download_trend_7_30"), ratio(avg30 - prior, prior, 0.0).alias("download_pct_change_30_60d"),
        _filled("zero_usage_days_30d"), "usage_volatility_30d", "avg_daily_total_mb_30d",
    )


def calls_all_time(calls: DataFrame) -> DataFrame:
    loyal = F.count_if(F.col("call_type") == "Loyalty")
    return calls.groupBy(ID).agg(
        F.count("*").alias("total_calls"),
        loyal.alias("loyalty_calls"),
        (loyal * F.lit(100.0) / F.count("*")).alias("pct_loyalty"),
        F.avg("talk_time_seconds").alias("avg_talk_time"),
        F.avg("hold_time_seconds").alias("avg_hold_time"),
        F.max("talk_time_seconds").alias("max_talk_time"),
    )


def usage_all_time(usage: DataFrame) -> DataFrame:
    return parsed_usage(usage).groupBy(ID).agg(F.avg("dl").alias("avg_download_mbs"), F.avg("ul").alias("avg_upload_mbs"))
