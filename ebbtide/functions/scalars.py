"""Null-safe column expressions shared by all operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ID = "unique_customer_identifier"

# Text that counts as a number: optional sign, digits, optional fraction and exponent.
NUMBER_TEXT = r"^[ ]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ ]*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: Column | str) -> Column:
    """Text to double; anything that is not plainly a number becomes NULL."""
    c = col(c)
    return F.when(c.rlike(NUMBER_TEXT), F.trim(c).try_cast("double"))


def safe_date(c: Column | str) -> Column:
    """ISO text to date; anything else becomes NULL."""
    return col(c).try_cast("date")


def ratio(num: Column, den: Column, default: float | None = None) -> Column:
    """``num / den``; a zero or NULL operand gives ``default``."""
    out = F.try_divide(num.cast("double"), den.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def whole_days(column: str) -> Column:
    """Duration in whole days, at least 1; fractions are cut, so distinct values are bounded by the period."""
    return at_least(F.floor(F.col(column).cast("double")).cast("double"), 1)


def at_least(c: Column, floor: float) -> Column:
    """Lower clip that keeps NULL (``greatest`` alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(float(floor))))


def at_most(c: Column, cap: float) -> Column:
    """Upper clip that keeps NULL."""
    return F.when(c.isNotNull(), F.least(c, F.lit(float(cap))))


def clip(c: Column, lo: float, hi: float) -> Column:
    return at_most(at_least(c, lo), hi)


def keep_if(predicate: Column, value: Column) -> Column:
    """``value`` where ``predicate`` holds, else NULL."""
    return F.when(predicate, value)


def flag(predicate: Column) -> Column:
    """1 where the predicate is true, 0 where it is false or NULL."""
    return F.coalesce(predicate, F.lit(False)).cast("int")


def _chain(cases: Sequence[tuple[Column, object]], default: object = None) -> Column:
    first, *rest = cases
    expr = reduce(lambda e, cv: e.when(cv[0], F.lit(cv[1])), rest, F.when(first[0], F.lit(first[1])))
    return expr if default is None else expr.otherwise(F.lit(default))


def bucket_left(c: Column, edges: Sequence[float | None], labels: Sequence[str], outside: str | None = None) -> Column:
    """Label of the left-closed interval ``[lo, hi)`` holding ``c``; a None edge is open."""
    cases = [
        (reduce(lambda a, b: a & b, [t for t in ((c >= lo) if lo is not None else None, (c < hi) if hi is not None else None) if t is not None]), lab)
        for lo, hi, lab in zip(edges, edges[1:], labels)
    ]
    return _chain(cases, outside)


def bucket_right(c: Column, edges: Sequence[float | Column], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval ``(lo, hi]``; NULL outside all of them."""
    return _chain([((c > lo) & (c <= hi), lab) for lo, hi, lab in zip(edges, edges[1:], labels)])


def code_of(c: Column, codes: dict[str, int], default: int) -> Column:
    """Integer code of a text after lower/trim, with a default for unknown and NULL."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(F.trim(c))), F.lit(default))


def lookup(c: Column, texts: dict[str, str], default: str) -> Column:
    pairs = [F.lit(x) for kv in texts.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(default))


def portable_hash(c: Column | str) -> Column:
    """First 32 bits of md5 as a long: the same number in any engine that has md5."""
    return F.conv(F.substring(F.md5(col(c).cast("string")), 1, 8), 16, 10).cast("bigint")


def month_of(c: Column | str) -> Column:
    return F.trunc(col(c), "month")


def r6(c: Column | str) -> Column:
    return F.round(col(c), 6)


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


def one_row(*frames):
    """Put several one-row frames side by side without a cross join."""
    from pyspark.sql import DataFrame

    stacked: DataFrame = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in stacked.columns])
