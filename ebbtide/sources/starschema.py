"""Bind a retail star schema (orders, line items, events) to the attrition data model.

Every order is one row of the monthly customer panel, every line item a call,
every event a day of usage, and every order with status F a cancellation.
All frames are lazy; the only joins are the ones the mapping itself needs.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.config import LEAVING_REASONS, Splits
from ebbtide.functions.scalars import ID, month_of, portable_hash
from ebbtide.session import shuffle_width

SNAPSHOT = "1998-06-01"
SPLITS = Splits("1998-06-01", "1999-06-01", "2000-06-01")
USAGE_ANCHOR = "1998-06-15"

STATUS_BY_PRIORITY = {"1-URGENT": "06 OOC", "2-HIGH": "05 Newly OOC", "3-MEDIUM": "03 Soon to be OOC", "5-LOW": " 02 In Contract"}
TECH_BY_SEGMENT = {"AUTOMOBILE": "FTTC", "BUILDING": "FTTP", "FURNITURE": "GFAST", "HOUSEHOLD": "MPF"}
CALL_BY_FLAG = {"R": "Loyalty", "A": "Tech", "N": "Billing"}
JOIN_ROWS = 500_000  # line items that a task of the join with orders sorts, about
SPEEDS = (40.0, 55.0, 80.0, 160.0)


def _mapped(c, pairs):
    expr = None
    for key, value in pairs.items():
        expr = F.when(c == key, value) if expr is None else expr.when(c == key, value)
    return expr


class StarSchema:
    """Lazy domain frames over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.built: dict = {}  # results that several steps of one query share

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _orders(self) -> DataFrame:
        return self.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))

    @cached_property
    def _accounts(self) -> DataFrame:
        """Orders with every panel attribute, keyed by order."""
        orders = self._orders
        first = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
        who = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        who = who.join(first, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_mktsegment", "n_name", "first_order")
        k = F.col("o_orderkey")
        speed = F.when(k % 101 == 0, 0.0)
        for i, s in enumerate(SPEEDS[:-1]):
            speed = speed.when(k % 4 == i, s)
        speed = speed.otherwise(SPEEDS[-1])
        return orders.join(who, F.col("o_custkey") == F.col("c_custkey")).select(
            k,
            F.col("o_custkey").cast("string").alias(ID),
            "o_orderdate",
            "o_orderstatus",
            "o_orderpriority",
            "c_mktsegment",
            "o_totalprice",
            month_of("o_orderdate").alias("datevalue"),
            _mapped(F.col("o_orderpriority"), STATUS_BY_PRIORITY).alias("contract_status"),
            F.when(k % 53 != 0, (k % 400 - 200).cast("double")).alias("ooc_days"),
            F.when(k % 59 != 0, (k % 3).cast("double")).alias("contract_dd_cancels"),
            F.when(k % 7 == 0, 1.0).otherwise(0.0).alias("dd_cancel_60_day"),
            _mapped(F.col("c_mktsegment"), TECH_BY_SEGMENT).alias("technology"),
            speed.alias("speed"),
            F.when(k % 67 != 0, speed * (F.lit(0.6) + (k % 60).cast("double") / 100.0)).alias("line_speed"),
            F.col("n_name").alias("sales_channel"),
            F.concat_ws(" ", "c_mktsegment", "o_orderpriority").alias("crm_package_name"),
            F.datediff("o_orderdate", "first_order").cast("double").alias("tenure_days"),
        )

    PANEL_COLUMNS = (
        ID, "datevalue", "contract_status", "ooc_days", "contract_dd_cancels", "dd_cancel_60_day", "technology",
        "speed", "line_speed", "sales_channel", "crm_package_name", "tenure_days",
    )

    def panel(self) -> DataFrame:
        return self._accounts.select(*self.PANEL_COLUMNS)

    def panel_keyed(self) -> DataFrame:
        """Panel with the unique order key, for row-level tie-breaks."""
        return self._accounts.select("o_orderkey", *self.PANEL_COLUMNS)

    @cached_property
    def _call_parts(self) -> int:
        """Partitions of the join of line items and orders, more with more rows; 0 while the session's own number is enough."""
        n = math.ceil(self.table("lineitem").count() / JOIN_ROWS)  # from the files' footers
        return n if n > shuffle_width(self.spark) else 0

    def calls(self) -> DataFrame:
        """Calls carry the customer of their order."""
        items = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_shipdate")
        owner = self._orders.select("o_orderkey", "o_custkey")
        if self._call_parts:
            items, owner = items.repartition(self._call_parts, "l_orderkey"), owner.repartition(self._call_parts, "o_orderkey")
        return items.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").cast("string").alias(ID),
            F.col("l_shipdate").cast("date").alias("event_date"),
            _mapped(F.col("l_returnflag"), CALL_BY_FLAG).alias("call_type"),
            (F.col("l_quantity") * 12).alias("talk_time_seconds"),
            F.when(F.col("l_linenumber") != 7, F.col("l_tax") * 1000).alias("hold_time_seconds"),
        )

    def usage(self) -> DataFrame:
        e = F.col("event_id")
        back = F.datediff(F.lit("2024-01-31").cast("date"), F.col("ts").cast("date")) * 3
        return self.table("events").select(
            F.col("user_id").cast("string").alias(ID),
            F.date_sub(F.lit(USAGE_ANCHOR).cast("date"), back).alias("calendar_date"),
            F.when(e % 97 == 0, "n/a")
            .when(e % 89 == 0, F.lit(None))
            .when(e % 41 == 0, "0")
            .otherwise(F.col("value").cast("string"))
            .alias("usage_download_mbs"),
            F.get_json_object("props", "$.k").alias("usage_upload_mbs"),
        )

    def cease_keyed(self) -> DataFrame:
        k = F.col("o_orderkey")
        reason = F.element_at(F.array(*[F.lit(r) for r in LEAVING_REASONS]), (k % 11 + 1).cast("int"))
        return self._orders.where("o_orderstatus = 'F'").select(
            k,
            F.col("o_custkey").cast("string").alias(ID),
            F.col("o_orderdate").alias("cease_placed_date"),
            F.when(k % 3 != 0, F.date_add("o_orderdate", (k % 40 - 2).cast("int")).cast("string")).alias("cease_completed_date"),
            F.when(k % 211 == 0, "INVALID").otherwise(reason).alias("reason_description_insight"),
        )

    def cease(self) -> DataFrame:
        return self.cease_keyed().drop("o_orderkey")

    def raw_tables(self) -> dict[str, DataFrame]:
        return {"customer_info": self.panel(), "cease": self.cease(), "calls": self.calls(), "usage": self.usage()}

    def _score(self):
        y = (F.col("o_orderstatus") == "F").cast("int")
        h = portable_hash("o_orderkey") % 10000
        # 0.7·h/10000 + 0.3·y rounded half-up to four digits, in whole units so that no float tie decides.
        units = 7 * h + 30000 * y
        return y, F.floor((units + 5) / 10) / 10000.0

    def scored(self) -> DataFrame:
        y, p = self._score()
        return self._orders.select(F.col("o_orderkey").alias("id"), y.alias("y"), p.alias("p"))

    def scored_accounts(self) -> DataFrame:
        """Scores together with all panel attributes of the same row."""
        y, p = self._score()
        return self._accounts.withColumn("id", F.col("o_orderkey")).withColumn("y", y).withColumn("p", p)

    def lifetimes(self) -> DataFrame:
        ship = self.table("lineitem").groupBy("l_orderkey").agg(F.min(F.col("l_shipdate").cast("date")).alias("ship"))
        orders = self._orders
        seg = self.table("customer").select("c_custkey", "c_mktsegment")
        return (
            orders.join(ship, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(seg, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias("id"),
                F.greatest(F.lit(1), F.abs(F.datediff("ship", "o_orderdate"))).alias("duration"),
                (F.col("o_orderstatus") == "F").cast("int").alias("event"),
                F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("urgent"),
                F.col("c_mktsegment").alias("segment"),
                F.col("o_totalprice").alias("price"),
                (F.col("o_orderkey") % 7 == 0).cast("int").alias("dd_flag"),
            )
        )

    DRIFT_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

    def drift_pair(self) -> tuple[DataFrame, DataFrame]:
        items = self.table("lineitem").select(*self.DRIFT_COLUMNS, F.col("l_shipdate").cast("date").alias("d"))
        ref = items.where(F.col("d") < F.lit(SNAPSHOT).cast("date")).drop("d")
        cur = items.where(F.col("d") >= F.lit(SNAPSHOT).cast("date")).drop("d")
        return ref, cur.withColumn("l_discount", F.col("l_discount") * 1.5)
