"""Global order at scale: positions, running totals, exact quantiles.

A window without a partition would pull everything into one task. Here rows are
range-partitioned on the full sort key (ties broken by an id, so no value can
overload one range), written once so the ranges stay fixed, and numbered inside
each range; the only thing combined globally is one total per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import portable_hash
from ebbtide.session import settle, shuffle_width

_BLOCK_BITS = 33  # layout of monotonically_increasing_id: partition in the upper bits, row below


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sorted, settled ranges; ``_block`` is the range, ``_at`` the row inside it."""
    width = shuffle_width(df.sparkSession)
    out = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    out = settle(out.withColumn("_slot", F.monotonically_increasing_id()))
    block = F.shiftright("_slot", _BLOCK_BITS)
    return out.withColumn("_block", block).withColumn("_at", F.col("_slot") - F.shiftleft(block, _BLOCK_BITS)).drop("_slot")


def with_position(df: DataFrame, *order: Column, name: str = "position", total: str | None = None, sums: Sequence[str] = ()) -> DataFrame:
    """Add the 0-based global position under ``order`` (and the row count as ``total``).

    ``order`` must end in a unique key. Every column in ``sums`` also gets its
    inclusive running sum ``cum_<s>`` and overall sum ``all_<s>``.
    """
    ranged = _ranged(df, order)
    if sums:
        inside = Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        ranged = ranged.select("*", *[F.sum(s).over(inside).alias(f"_c_{s}") for s in sums])
    sizes = ranged.groupBy("_block").agg(F.count("*").alias("_n"), *[F.sum(s).alias(f"_b_{s}") for s in sums])
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    whole = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        "_block",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(whole).alias("_total"),
        *[F.coalesce(F.sum(f"_b_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_b_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    # At most shuffle-width rows, so the broadcast has a fixed bound.
    out = ranged.join(F.broadcast(starts), "_block").withColumn(name, F.col("_start") + F.col("_at"))
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.col(f"_c_{s}") + F.col(f"_o_{s}")).drop(f"_c_{s}", f"_o_{s}")
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_block", "_at", "_start", "_total")


def running_totals(df: DataFrame, value: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Running and overall sums over distinct ``value`` within each ``by`` group.

    ``df`` must hold one row per (by, value). Adds ``cum_<s>`` (inclusive) and
    ``all_<s>`` for every column in ``sums``.
    """
    by = list(by)
    v = F.col(value).desc() if descending else F.col(value).asc()
    ranged = _ranged(df, [*[F.col(b) for b in by], v])
    blocks = ranged.groupBy(*by, "_block").agg(*[F.sum(s).alias(f"_b_{s}") for s in sums])
    # Ranges plus group boundaries: at most shuffle-width + number of groups rows.
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = blocks.select(
        *by,
        "_block",
        *[F.coalesce(F.sum(f"_b_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_b_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    inside = Window.partitionBy("_block", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    part = ranged.select("*", *[F.sum(s).over(inside).alias(f"_c_{s}") for s in sums])
    if not by:
        offsets = F.broadcast(offsets)  # at most shuffle-width rows
    out = _null_safe_join(part, offsets, [*by, "_block"])
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.col(f"_c_{s}") + F.col(f"_o_{s}"))
    return out.drop("_block", "_at", *[f"_c_{s}" for s in sums], *[f"_o_{s}" for s in sums])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which NULL keys match each other."""
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond).drop(*[f"_k_{k}" for k in keys])


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles per group, whatever the size of a group.

    One row per group (one row in all without ``by``) with ``n`` and one column per probability.
    """
    by = list(by)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    curve = running_totals(counted, value, ["n"], by, descending=False)
    total = F.col("all_n")

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("cum_n") > rank, F.col(value).cast("double")))

    picks = []
    for p, name in zip(probs, names):
        exact = F.lit(float(p)) * (total - 1)
        picks += [at(F.floor(exact)).alias(f"_lo_{name}"), at(F.ceil(exact)).alias(f"_hi_{name}"), F.max(exact - F.floor(exact)).alias(f"_f_{name}")]
    row = curve.groupBy(*by).agg(F.max("all_n").alias("n"), *picks)
    interp = [(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n) for n in names]
    return row.select(*by, "n", *interp)


def median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return quantiles(df, value, [0.5], by, [name])


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """Fixed-size pseudo-random sample: the ``n`` rows with the smallest key hash.

    Rows that cannot be among them are dropped by a bound on the hash first, so
    the final top-n sees little more than n rows however large the input is.
    """
    order = [F.md5(F.col(key).cast("string")), F.col(key)]
    total = df.count()
    share = (n + 10 * n**0.5 + 100) / max(total, 1)
    if share < 1:
        near = df.where(portable_hash(key) <= F.lit(int(share * 2**32)))
        if near.count() >= n:
            df = near
    return df.orderBy(*order).limit(n)


def capped_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """All rows when there are at most ``n``, else a sample of ``n``."""
    return hash_sample(df, key, n)


def top_rows(df: DataFrame, score: str, tie: str, n: int, rank: str = "rank") -> DataFrame:
    """The ``n`` best rows with their rank; ``n`` is a report size, so one window over n rows."""
    best = df.orderBy(F.col(score).desc(), F.col(tie).asc()).limit(n)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(F.col(score).desc(), F.col(tie).asc())))
