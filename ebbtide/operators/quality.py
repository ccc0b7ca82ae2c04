"""Validation rules, data-quality checks and the quality gate.

Rules are compiled into one aggregate per table, however many there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.config import CONTRACT_STATUSES, LEAVING_REASONS, TECHNOLOGIES
from ebbtide.functions.scalars import ID, one_row, ratio, safe_date, safe_double
from ebbtide.operators.panel import first_cease
from ebbtide.operators.splitting import leaky_columns


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a row that breaks the rule."""

    column: str
    check: str
    fails: Column


class SchemaViolation(ValueError):
    pass


def required(column: str, kind: str) -> list[Rule]:
    """Column must be present in every row and castable to ``kind``."""
    c = F.col(column)
    return [Rule(column, "not_nullable", c.isNull()), typed(column, kind)]


def typed(column: str, kind: str) -> Rule:
    c = F.col(column)
    return Rule(column, f"type_{kind}", c.isNotNull() & c.try_cast(kind).isNull())


def isin(column: str, allowed: Sequence) -> Rule:
    c = F.col(column)
    return Rule(column, "isin", c.isNotNull() & ~c.isin(*allowed))


def at_least_zero(column: str) -> Rule:
    return Rule(column, "ge_0", F.coalesce(F.col(column).try_cast("double") < 0, F.lit(False)))


def date_order(done: str, placed: str) -> Rule:
    """``done`` must not precede ``placed``; empty passes, text that is no date fails."""
    empty = F.col(done).isNull() | (F.col(done) == "")
    fine = F.coalesce(safe_date(done) >= F.col(placed).cast("date"), F.lit(False))
    return Rule(done, "date_order", ~(empty | fine))


def table_rules() -> dict[str, list[Rule]]:
    """Declared rules of the five tables."""
    return {
        "customer_info": [
            *required(ID, "string"), *required("datevalue", "date"), isin("contract_status", CONTRACT_STATUSES), isin("technology", TECHNOLOGIES),
            *[r for c in ("contract_dd_cancels", "dd_cancel_60_day", "speed", "line_speed", "tenure_days") for r in (typed(c, "double"), at_least_zero(c))],
            typed("ooc_days", "double"),
        ],
        "cease": [*required(ID, "string"), *required("cease_placed_date", "date"), isin("reason_description_insight", LEAVING_REASONS), date_order("cease_completed_date", "cease_placed_date")],
        "calls": [*required(ID, "string"), *required("event_date", "date"), at_least_zero("talk_time_seconds"), at_least_zero("hold_time_seconds")],
        "usage": [*required(ID, "string"), *required("calendar_date", "date")],
        "matrix": [*required(ID, "string"), *required("snapshot_date", "date"), *required("churned", "int"), isin("churned", (0, 1))],
    }


def rule_counts(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """(table, column, check, n_fail) from a single pass."""
    cells = [F.struct(F.lit(r.column).alias("column"), F.lit(r.check).alias("check"), F.count_if(r.fails).alias("n_fail")) for r in rules]
    row = df.agg(F.array(*cells).alias("cells"))
    return row.select(F.lit(table).alias("table"), F.explode("cells").alias("c")).select("table", "c.*")


def full_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    rules = table_rules()
    return reduce(DataFrame.unionByName, [rule_counts(df, rules[name], name) for name, df in tables.items()])


def validate(df: DataFrame, table: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Return ``df`` unchanged, or raise with every broken rule and its count."""
    rules = rules if rules is not None else table_rules()[table]
    present = {c.lower() for c in df.columns}
    missing = sorted({r.column for r in rules if r.column.lower() not in present})
    if missing:
        raise SchemaViolation(f"{table}: missing columns {missing}")
    broken = rule_counts(df, rules, table).where("n_fail > 0").collect()
    if broken:
        raise SchemaViolation(f"{table}: " + "; ".join(f"{b['column']} fails {b['check']} in {b['n_fail']} rows" for b in broken))
    return df


# ---- single checks ---------------------------------------------------------------------------
def date_issues(cease: DataFrame) -> DataFrame:
    placed, done = F.col("cease_placed_date").cast("date"), safe_date("cease_completed_date")
    return cease.agg(F.count_if(done < placed).alias("inverted"), F.count_if(placed.isNull() & done.isNotNull()).alias("completed_without_placed"))


def nulls_gate(rates: DataFrame, limit: float = 0.30) -> DataFrame:
    return rates.where(F.col("null_pct") > limit).withColumn("status", F.lit("WARN"))


def duplicate_profile(cease: DataFrame) -> DataFrame:
    """Customers with several cancellations and how they spread over dates and reasons."""
    placed = F.col("cease_placed_date")
    span = F.datediff(F.max(placed), F.min(placed))
    per = cease.groupBy(ID).agg(
        F.count("*").alias("n_events"), F.countDistinct(placed).alias("n_dates"), F.countDistinct("reason_description_insight").alias("n_reasons"), span.alias("span_days"),
    )
    return per.where("n_events > 1").withColumn("kind", F.when(F.col("span_days") == 0, "same-day").otherwise("multi-date"))


def duplicate_summary(profile: DataFrame) -> DataFrame:
    return profile.groupBy("kind").agg(F.count("*").alias("customers"), F.sum("n_events").alias("events"))


def extra_rows(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Rows beyond the first of each key tuple; NULL fields take part in the tuple."""
    per = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per.agg(F.lit(table).alias("table"), F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("extra_rows"))


# --- fixed values: the tuple that makes a row of each table unique ----------------------------
TABLE_KEYS = {
    "cease": [ID],
    "customer_info": [ID, "datevalue"],
    "calls": [ID, "event_date", "call_type", "talk_time_seconds", "hold_time_seconds"],
    "usage": [ID, "calendar_date", "usage_download_mbs", "usage_upload_mbs"],
}
TABLE_DATES = {"cease": "cease_placed_date", "customer_info": "datevalue", "calls": "event_date", "usage": "calendar_date"}
CARDINALITY_LIMITS = {"contract_status": 6, "technology": 4, "sales_channel": 20, "crm_package_name": 50, "call_type": 20}


def duplicate_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [extra_rows(tables[t], TABLE_KEYS[t], t) for t in TABLE_KEYS if t in tables])


def key_overlaps(tables: Mapping[str, DataFrame], other: DataFrame, key: str = ID) -> DataFrame:
    """Distinct keys of each table that also occur in ``other``."""
    known = other.select(key).distinct()
    parts = [df.select(key).distinct().join(known, key, "left_semi").agg(F.lit(name).alias("source"), F.count("*").alias("n")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def key_diff(a: DataFrame, b: DataFrame, key: str = ID) -> DataFrame:
    """Counts of keys only in ``a``, only in ``b`` and in both, from one aggregate over the union."""
    tagged = a.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(key, F.lit(0).alias("a"), F.lit(1).alias("b")))
    per = tagged.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return per.agg(F.count_if(F.col("b") == 0).alias("only_a"), F.count_if(F.col("a") == 0).alias("only_b"), F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("both"))


def pre_event_coverage(panel: DataFrame, cease: DataFrame) -> DataFrame:
    """Leavers with and without a panel row on or before their first cancellation."""
    start = panel.groupBy(ID).agg(F.min("datevalue").alias("oldest"))
    joined = first_cease(cease).join(start, ID, "left")
    covered = F.coalesce(F.col("oldest") <= F.col("first_cease"), F.lit(False))
    return joined.agg(F.count_if(covered).alias("covered"), F.count_if(~covered).alias("uncovered"))


def late_snapshots(panel: DataFrame, cease: DataFrame) -> DataFrame:
    """Leavers whose newest panel row lies after their first cancellation."""
    newest = panel.groupBy(ID).agg(F.max("datevalue").alias("newest"))
    return newest.join(first_cease(cease), ID).agg(F.count_if(F.col("newest") > F.col("first_cease")).alias("n_leaked"))


def coverage(tables: Mapping[str, DataFrame], minimum: float = 0.95) -> DataFrame:
    """Distinct customers per table, overlaps with the leavers, and the coverage rule, in one row."""
    sides = ("cease", "customer_info", "calls", "usage")
    tagged = reduce(DataFrame.unionByName, [tables[t].select(ID, F.lit(t).alias("t")) for t in sides])
    per = tagged.groupBy(ID).agg(*[F.max((F.col("t") == t).cast("int")).alias(t) for t in sides])
    both = {t: F.count_if((F.col("cease") == 1) & (F.col(t) == 1)) for t in sides}
    counts = per.agg(
        *[F.count_if(F.col(t) == 1).alias(f"n_{t}") for t in sides],
        *[both[t].alias(f"cease_in_{t}") for t in sides[1:]],
        F.count_if((F.col("cease") == 1) & (F.col("customer_info") == 0)).alias("cease_only"),
        F.count_if((F.col("cease") == 0) & (F.col("customer_info") == 1)).alias("info_only"),
    )
    pre = pre_event_coverage(tables["customer_info"], tables["cease"]).select(F.col("uncovered").alias("no_pre_cease"))
    row = one_row(counts, pre).withColumn("coverage_pct", ratio(F.col("cease_in_customer_info"), F.col("n_cease")))
    return row.withColumn("status", F.when(F.col("coverage_pct") > minimum, "PASS").otherwise("WARN"))


def temporal_coverage(tables: Mapping[str, DataFrame], data_end: str) -> DataFrame:
    parts = []
    for t, c in TABLE_DATES.items():
        d = F.col(c).cast("date")
        parts.append(tables[t].agg(
            F.lit(t).alias("table"), F.lit(c).alias("column"), F.min(d).alias("min_date"), F.max(d).alias("max_date"),
            F.countDistinct(d).alias("n_dates"), F.count_if(d > F.lit(data_end).cast("date")).alias("n_future"),
        ))
    return reduce(DataFrame.unionByName, parts)


def unused_horizon(temporal: DataFrame, test_end: str, window_days: int) -> DataFrame:
    """Whole 30-day months of data after the last label window."""
    label_end = F.date_add(F.lit(test_end).cast("date"), window_days)
    row = temporal.agg(F.min("min_date").alias("data_min"), F.max("max_date").alias("data_max"))
    months = F.floor(F.greatest(F.datediff("data_max", label_end), F.lit(0)) / 30).cast("int")
    return row.select("data_min", "data_max", label_end.alias("test_label_end"), F.floor(F.datediff("data_max", "data_min") / 30).cast("int").alias("months_of_data"), months.alias("unused_months"))


def outlier_checks() -> dict[str, Column]:
    speed, line = F.col("speed"), F.col("line_speed")
    return {
        "negative_tenure": F.col("tenure_days") < 0,
        "speed_zero_line_positive": (speed == 0) & (line > 0),
        "line_above_speed": (line > speed) & (speed > 0),
        "ooc_below_3650": F.col("ooc_days") < -3650,
    }


def outliers(panel: DataFrame) -> DataFrame:
    """Rows and customers per impossible or extreme combination, in one pass."""
    checks = outlier_checks()
    cells = [F.struct(F.lit(k).alias("check"), F.count_if(p).alias("n_rows"), F.countDistinct(F.when(p, F.col(ID))).alias("n_customers")) for k, p in checks.items()]
    suspect = panel.where(reduce(lambda a, b: a | b, checks.values()))  # few rows, so the distinct counts stay cheap
    return suspect.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def unparseable(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-empty text that is not a number, per column."""
    cells = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNotNull() & safe_double(c).isNull()).alias("n_bad"), F.count_if(F.col(c).isNull()).alias("n_null")) for c in columns]
    return df.agg(F.array(*cells).alias("cells")).select(F.explode("cells").alias("c")).select("c.*")


def cardinality(panel: DataFrame, calls: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    limits = dict(limits or CARDINALITY_LIMITS)
    parts = []
    for source, df in (("customer_info", panel), ("calls", calls)):
        cols = [c for c in limits if c in df.columns]
        cells = [F.struct(F.lit(c).alias("column"), F.countDistinct(c).alias("actual"), F.lit(limits[c]).alias("expected_max")) for c in cols]
        parts.append(df.agg(F.array(*cells).alias("cells")).select(F.lit(source).alias("table"), F.explode("cells").alias("c")).select("table", "c.*"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("ok", F.col("actual") <= F.col("expected_max"))


# ---- gate ------------------------------------------------------------------------------------
def _status(frame: DataFrame, check: str, ok: Column, otherwise: str = "WARN") -> DataFrame:
    return frame.agg(F.lit(check).alias("check"), F.when(ok, "PASS").otherwise(otherwise).alias("status"))


def scan_stats(df: DataFrame, table: str, data_end: str) -> DataFrame:
    """(table, kind, item, value): rule failures, null shares and late rows from one pass over a table."""
    cells = [("rule", f"{r.column}:{r.check}", F.count_if(r.fails)) for r in table_rules()[table]]
    cells += [("null", c, F.avg(F.col(c).isNull().cast("double"))) for c in df.columns]
    cells.append(("late", TABLE_DATES[table], F.count_if(F.col(TABLE_DATES[table]).cast("date") > F.lit(data_end).cast("date"))))
    if table == "customer_info":
        cells += [("outlier", k, F.count_if(p)) for k, p in outlier_checks().items() if k != "line_above_speed"]
    if table == "usage":
        cells.append(("outlier", "unparseable", F.count_if(F.col("usage_download_mbs").isNotNull() & safe_double("usage_download_mbs").isNull())))
    packed = [F.struct(F.lit(k).alias("kind"), F.lit(i).alias("item"), v.cast("double").alias("value")) for k, i, v in cells]
    return df.agg(F.array(*packed).alias("c")).select(F.lit(table).alias("table"), F.explode("c").alias("c")).select("table", "c.*")


def gate(tables: Mapping[str, DataFrame], data_end: str, matrix_columns: Sequence[str] = ()) -> DataFrame:
    """(check, status) for every gate check; most of them share one pass per table.

    A column of the matrix that is known only once a customer has left is a leak, whatever the panel holds.
    """
    stats = reduce(DataFrame.unionByName, [scan_stats(df, t, data_end) for t, df in tables.items()])
    kind, value = F.col("kind"), F.col("value")
    broken, known = F.sum(F.when(kind == "rule", value)), F.sum(F.when((kind == "rule") & (F.col("item") == "cease_completed_date:date_order"), value))
    found = F.lit(bool(set(c.lower() for c in matrix_columns) & set(_leaky())))
    scanned = stats.agg(F.array(
        _cell("Schema validation", F.when(broken == 0, "PASS").when(broken == known, "WARN").otherwise("FAIL")),
        _cell("Completeness", _pass(F.count_if((kind == "null") & (value > 0.30)) == 0)),
        _cell("Temporal coverage", _pass(F.sum(F.when(kind == "late", value)) == 0)),
        _cell("Outliers & cardinality", _pass(F.sum(F.when(kind == "outlier", value)) == 0)),
        _cell("Leakage risk", _pass(~found)),
    ).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    parts = [
        scanned,
        _status(duplicate_counts({"cease": tables["cease"]}), "Duplicates", F.max(F.col("extra_rows") < F.col("n_rows") * 0.15)),
        coverage(tables).select(F.lit("Join integrity").alias("check"), "status"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _pass(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("WARN")


def _cell(check: str, status: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), status.alias("status"))


def _leaky() -> tuple[str, ...]:
    from ebbtide.config import LEAKY_COLUMNS

    return LEAKY_COLUMNS


def verdict(gate_rows: DataFrame) -> DataFrame:
    n = {s: F.count_if(F.col("status") == s) for s in ("PASS", "WARN", "FAIL")}
    text = F.when(n["FAIL"] > 0, "BLOCKED").when(n["WARN"] > 0, "PROCEED WITH CAUTION").otherwise("ALL CLEAR")
    return gate_rows.agg(n["PASS"].alias("n_pass"), n["WARN"].alias("n_warn"), n["FAIL"].alias("n_fail"), text.alias("verdict"))


