"""Structured Streaming versions of scoring and call counting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.scalars import ID
from ebbtide.session import scratch, settle, share_package
from ebbtide.streaming import packs


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process everything available now into Parquet, with its checkpoint in the shared folder, and read it back."""
    spark = stream.sparkSession
    out, state = scratch(spark, name), scratch(spark, f"{name}-state")
    _advance(stream, out, state, mode)
    return spark.read.schema(stream.schema).parquet(out)


def _advance(stream: DataFrame, out: str, state: str, mode: str) -> None:
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


PARTS = 8  # of the customers, by hash: with the windows of a batch they spread the state over the tasks
ROWS_PER_STEP = 2_000_000  # of a finite table that a stream reads before its watermark moves


def replay(rows: DataFrame, job: Callable[[DataFrame], DataFrame], name: str, time_col: str = "event_time") -> DataFrame:
    """A finite table sent through a stream in the order of its days, all of it, and closed by ``closing_row``.

    Rows are sent in steps of whole days, one after another, so that the state holds the windows
    of a step and of the watermark's delay, however long the table's history is. All rows of a
    step are newer than those before it, so none is late. A table of ``ROWS_PER_STEP`` rows is one step.
    """
    spark = rows.sparkSession
    day = F.coalesce(utc_date(F.col(time_col)), F.lit("1970-01-01").cast("date"))
    # Written once, by day within each task, so that a step reads its own days' pages only.
    kept = settle(rows.withColumn("_day", day).sortWithinPartitions("_day"))
    starts, held = [], 0
    for r in kept.groupBy("_day").count().orderBy("_day").collect():  # one row per day
        if not starts or held + r["count"] > ROWS_PER_STEP:
            starts.append(r["_day"])
            held = 0
        held += r["count"]
    sent, out, state = (scratch(spark, f"{name}-{kind}") for kind in ("sent", "out", "state"))
    stream = job(read_parquet_stream(spark, f"{sent}/step-*", rows.schema))
    query = None
    try:
        for i in range(max(1, len(starts))):
            last = i >= len(starts) - 1
            part = kept if len(starts) < 2 else kept.where((F.col("_day") >= F.lit(starts[i])) & (F.lit(True) if last else F.col("_day") < F.lit(starts[i + 1])))
            part = part.drop("_day")
            if last:
                part = part.unionByName(closing_row(part, time_col))
            part.write.parquet(f"{sent}/_next-{i:06d}")
            _rename(spark, f"{sent}/_next-{i:06d}", f"{sent}/step-{i:06d}")  # the stream sees a step whole or not at all
            # One query for all steps: every start of a query would load the state once more, beside those before it.
            query = query or stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state).start()
            query.processAllAvailable()
            if any(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators):
                raise RuntimeError("rows of a step came late: the stream saw a part of it")
    finally:
        if query is not None:
            query.stop()
    return spark.read.schema(stream.schema).parquet(out)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    if not old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"{old} cannot be renamed to {new}")


def score_stream(requests: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stateless: the batch scoring function applied to an arriving stream."""
    return score(requests)


def call_counts(calls: DataFrame, time_col: str = "event_time", width: str = "7 days", slide: str = "1 day", delay: str = "30 days") -> DataFrame:
    """Calls and loyalty calls per customer in sliding event-time windows.

    A window is emitted once the watermark (newest event minus ``delay``) has
    passed its end; rows older than the watermark are dropped.

    The state has one entry per window and part of the customers, not one per window and
    customer: the counts of an instant are packed by task before they are copied to its
    windows, and a window's packs are added up per customer when it is emitted.
    """
    share_package(calls.sparkSession)
    known = calls.where(F.col(time_col).isNotNull()).select(
        time_col, F.pmod(F.xxhash64(ID), F.lit(PARTS)).cast("int").alias("_part"), F.col(ID).cast("string").alias("_id"),
        F.coalesce(F.col("call_type") == "Loyalty", F.lit(False)).cast("bigint").alias("_loyal"),
    )
    types = {c: calls.schema[c].dataType.simpleString() for c in (time_col, ID)}
    packed = known.mapInArrow(packs.pack, f"`{time_col}` {types[time_col]}, _part int, _pack binary")
    held = packed.withWatermark(time_col, delay).groupBy(F.window(time_col, width, slide).alias("w"), "_part").agg(F.collect_list("_pack").alias("packs"))
    ended = held.select(utc_date(F.col("w.start")).alias("window_start"), utc_date(F.col("w.end")).alias("window_end"), "packs")
    out = ended.mapInArrow(packs.unpack, f"`{ID}` string, window_start date, window_end date, n_calls bigint, n_loyalty bigint")
    return out.withColumn(ID, F.col(ID).cast(types[ID]))


def closing_row(calls: DataFrame, time_col: str = "event_time", days: int = 38) -> DataFrame:
    """One row without a customer, ``days`` after the newest call, that ends a finite stream.

    Sent last, it moves the watermark past the end of every window that holds a call
    (``days`` is the delay and one window or more), so these windows are all emitted;
    its own windows stay open. Without calls there is no row.
    """
    newest = calls.agg(F.max(time_col).alias("_newest")).where("_newest IS NOT NULL")
    end = F.timestamp_seconds(F.unix_seconds("_newest") + days * 86400)
    return newest.select(*[(end if f.name == time_col else F.lit(None)).cast(f.dataType).alias(f.name) for f in calls.schema])


def utc_midnight(day: Column) -> Column:
    """Instant at which ``day`` starts in UTC, whatever the session time zone."""
    return F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86400)


def utc_date(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))
