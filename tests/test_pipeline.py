import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ebbtide.operators import association, quality, scoring, splitting
from ebbtide.plans import features as plans
from ebbtide.session import scratch
from ebbtide.sources import readers, schemas, sinks
from ebbtide.sources.starschema import SPLITS, StarSchema
from ebbtide.streaming import jobs

D = dt.date


def cease(spark, done, reason="CompetitorDeals"):
    return spark.createDataFrame([("a", D(2023, 6, 1), done, reason)], "unique_customer_identifier string, cease_placed_date date, cease_completed_date string, reason_description_insight string")


@pytest.mark.parametrize("done", ["2023-06-01", "2023-07-01", None, ""])
def test_valid_cease(spark, done):
    assert quality.validate(cease(spark, done), "cease").count() == 1


@pytest.mark.parametrize("done,reason,text", [("2023-05-01", "HomeMove", "date_order"), ("soon", "HomeMove", "date_order"), (None, "INVALID_CATEGORY", "isin")])
def test_broken_cease(spark, done, reason, text):
    with pytest.raises(quality.SchemaViolation, match=text):
        quality.validate(cease(spark, done, reason), "cease")


def test_missing_column_is_a_violation(spark):
    with pytest.raises(quality.SchemaViolation, match="missing columns"):
        quality.validate(cease(spark, None).drop("cease_placed_date"), "cease")


def test_split_is_disjoint_and_guarded(spark):
    df = spark.range(500).select(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("snapshot_date"))
    s = splitting.temporal_split(df)
    s.check()
    assert s.train.agg(F.max("snapshot_date")).first()[0] < s.test.agg(F.min("snapshot_date")).first()[0]
    assert s.train.count() + s.val.count() + s.test.count() == df.where("snapshot_date <= '2023-10-01'").count()
    with pytest.raises(AssertionError, match="DATA LEAKAGE DETECTED.*2023-06-01"):
        splitting.assert_no_leakage(s.train, s.train)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.1), (2.0, 4.1, 0.1), (3.0, None, 0.1), (None, 1.0, 0.1), (4.0, 7.0, 0.1)], "a double, b double, c double").repartition(3)
    got = {(r["a"], r["b"]): r["r"] for r in association.pearson_pairs(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4.1, 7])[0, 1]) and got[("a", "c")] is None and got[("b", "c")] is None


@pytest.mark.parametrize("width", [2, 12])
def test_correlation_does_not_depend_on_other_columns_or_rows(spark, width):
    """Complete rows lie far from the column's mean over all rows."""
    rows = [(1e8 + i % 2, float(i % 2)) for i in range(40)] + [(0.0, None)] * 4000
    df = spark.createDataFrame(rows, "a double, b double").repartition(4)
    df = df.withColumns({f"x{i}": F.rand(i) for i in range(width - 2)})
    got = {(r["a"], r["b"]): r["r"] for r in association.pearson_pairs(df, df.columns).collect()}
    assert len(got) == width * (width - 1) // 2 and got[("a", "b")] == pytest.approx(1.0)


def test_two_by_two_uses_the_continuity_correction(spark):
    rows = [("x", "u")] * 10 + [("x", "v")] * 5 + [("y", "u")] * 3 + [("y", "v")] * 12
    v = association.cramers_v(spark.createDataFrame(rows, "a string, b string").withColumn("k", F.lit("same")), ["a", "b", "k"]).collect()
    got = {(r["a"], r["b"]): r["v"] for r in v}
    n, o = 30, [[10, 5], [3, 12]]
    chi = sum((abs(o[i][j] - 15 * c / n) - 0.5) ** 2 / (15 * c / n) for i in (0, 1) for j, c in enumerate((13, 17)))
    assert got[("a", "b")] == pytest.approx((chi / n) ** 0.5) and got[("a", "k")] == 0.0


def test_csv_matches_header_by_name(spark):
    path = scratch(spark, "calls") + ".csv"
    spark.createDataFrame([(60.0, "a", "2023-06-01", "Tech", None)], "talk_time_seconds double, unique_customer_identifier string, event_date string, call_type string, hold_time_seconds double").write.option("header", True).csv(path)
    r = readers.read_csv(spark, path, schemas.CALLS).first()
    assert (r["unique_customer_identifier"], r["event_date"], r["talk_time_seconds"], r["hold_time_seconds"]) == ("a", D(2023, 6, 1), 60.0, None)


def test_snapshots_are_replaced_by_date_and_must_exist(spark):
    folder = scratch(spark, "features")
    with pytest.raises(FileNotFoundError):
        readers.read_snapshots(spark, folder)
    one = spark.range(3).select("id", F.lit("2023-06-01").cast("date").alias("snapshot_date"))
    two = spark.range(5).select("id", F.lit("2023-08-01").cast("date").alias("snapshot_date"))
    for df in (one, two, one.limit(2)):
        sinks.write_features(df, folder)
    assert {str(r[0]): r[1] for r in sinks.verify_snapshots(spark, folder).select("snapshot_date", "n_rows").collect()} == {"2023-06-01": 2, "2023-08-01": 5}


def test_materialised_matrix_equals_single_snapshots(spark):
    d = StarSchema(spark, SMALL)
    folder = scratch(spark, "all")
    enc = plans.materialise(d.panel(), d.calls(), d.usage(), d.cease(), SPLITS.snapshots, folder)
    late = spark.read.parquet(folder + "/matrix").where(F.col("snapshot_date") == SPLITS.test_end)
    alone = plans.feature_matrix(d.panel(), d.calls(), d.usage(), d.cease(), SPLITS.test_end, enc)
    cols = ["unique_customer_identifier", "call_count_90d", "zero_usage_days_30d", "churned", "tenure_bucket"]
    assert late.count() == alone.count() and late.select(cols).exceptAll(alone.select(cols)).count() == 0


def test_tiers_fall_back_to_ranks_when_all_low(spark):
    df = spark.range(40).select(F.concat(F.lit("c"), F.lpad("id", 2, "0")).alias("unique_customer_identifier"), (F.col("id") / 1000).alias("p"), F.array(F.lit("x")).alias("drivers"))
    rows = scoring.format_scored(df).orderBy("priority_rank").collect()
    assert [r["risk_tier"] for r in rows] == ["High"] * 2 + ["Medium"] * 6 + ["Low"] * 32
    assert rows[0]["driver_1"] == "x" and rows[0]["driver_2"] == "" and rows[0]["priority_rank"] == 1
    tiny = scoring.format_scored(df.limit(2)).orderBy("priority_rank").collect()
    assert [r["risk_tier"] for r in tiny] == ["High", "Medium"]


def test_requests_take_defaults(spark):
    r = scoring.complete_requests(spark.createDataFrame([(1, 5.0, 100.0, None)], "request_id int, ooc_days double, tenure_days double, contract_status_risk double")).first()
    assert (r["contract_status_risk"], r["download_trend_7_30"], r["call_count_30d"]) == (1.0, 1.0, 0.0)
    with pytest.raises(ValueError, match="tenure_days"):
        scoring.complete_requests(spark.createDataFrame([(5.0,)], "ooc_days double"))


def test_late_calls_are_dropped(spark):
    path = scratch(spark, "calls")
    schema = "unique_customer_identifier string, event_time timestamp, call_type string"
    # A row counts as late against the watermark of the batch before, so one more batch lies in between.
    days = [(1, 1, "Loyalty"), (6, 1, "Tech"), (6, 2, "Tech"), (1, 2, "Tech"), (12, 1, "Tech")]
    batches = [[("a", dt.datetime(2024, m, d), kind)] for m, d, kind in days]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.read_parquet_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    out = jobs.run_to_table(jobs.call_counts(stream), "late").where("window_start = '2023-12-31' OR window_start = '2024-01-01'").collect()
    assert out and all(r["n_calls"] == 1 and r["n_loyalty"] == 1 for r in out)


def test_closing_row_ends_all_windows(spark):
    path = scratch(spark, "calls")
    calls = spark.createDataFrame([(i, dt.datetime(2024, 3, day), "Tech") for i, day in (("a", 1), ("a", 9), ("b", 9), (None, 9))], "unique_customer_identifier string, event_time timestamp, call_type string")
    calls.unionByName(jobs.closing_row(calls)).write.parquet(path)
    out = jobs.run_to_table(jobs.call_counts(jobs.read_parquet_stream(spark, path, calls.schema)), "closed").collect()
    got = {(r["unique_customer_identifier"], r["window_start"]): r["n_calls"] for r in out}
    first = lambda day: [dt.date(2024, 3, day) - dt.timedelta(i) for i in range(7)]
    assert got == {("a", d): 1 for d in first(1) + first(9)} | {(i, d): 1 for i in ("b", None) for d in first(9)}
    assert jobs.closing_row(calls.limit(0)).count() == 0


def test_a_replayed_table_gives_all_windows_whatever_its_steps(spark, monkeypatch):
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(k * 17 % 200) for k in range(60)]
    rows = [("a" if k % 3 else None, day, "Loyalty" if k % 4 == 0 else "Tech") for k, day in enumerate(days)] + [("b", None, "Tech")]
    calls = spark.createDataFrame(rows, "unique_customer_identifier string, event_time timestamp, call_type string").repartition(3)
    want = {}
    for who, day, kind in rows[:-1]:
        for i in range(7):
            n = want.setdefault((who, (day - dt.timedelta(i)).date()), [0, 0])
            n[0], n[1] = n[0] + 1, n[1] + (kind == "Loyalty")
    for size in (1000, 25):
        monkeypatch.setattr(jobs, "ROWS_PER_STEP", size)
        out = jobs.replay(calls, jobs.call_counts, "replayed").collect()
        assert len(out) == len(want) and {(r["unique_customer_identifier"], r["window_start"]): [r["n_calls"], r["n_loyalty"]] for r in out} == want
    assert jobs.replay(calls.limit(0), jobs.call_counts, "empty").count() == 0


def test_all_steps_go_through_one_query(spark, monkeypatch):
    calls = spark.createDataFrame([(str(k % 3), dt.datetime(2024, 1, 1) + dt.timedelta(k), "Tech") for k in range(8)], "unique_customer_identifier string, event_time timestamp, call_type string")
    read, opened = jobs.read_parquet_stream, []
    monkeypatch.setattr(jobs, "read_parquet_stream", lambda *args: opened.append(args) or read(*args))
    monkeypatch.setattr(jobs, "ROWS_PER_STEP", 2)
    assert sum(r["n_calls"] for r in jobs.replay(calls, jobs.call_counts, "one").collect()) == 8 * 7
    assert len(opened) == 1 and not spark.streams.active


def test_the_state_of_call_counts_does_not_grow_with_the_customers(spark):
    path, out, state = (scratch(spark, name) for name in ("calls", "out", "state"))
    ids = F.when(F.col("id") % 1000 > 0, F.concat(F.lit("ü"), (F.col("id") % 1000).cast("string")))
    day = F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3 * 86400)
    calls = spark.range(3000).select(ids.alias("unique_customer_identifier"), day.alias("event_time"), F.when(F.col("id") % 5 > 0, F.lit("Tech")).alias("call_type"))
    calls.write.parquet(path)
    jobs._advance(jobs.call_counts(jobs.read_parquet_stream(spark, path, calls.schema)), out, state, "append")
    assert 0 < spark.read.format("statestore").load(state).count() <= 9 * jobs.PARTS


def test_packs_give_back_their_counts(monkeypatch):
    import random

    import pyarrow as pa

    from ebbtide.streaming import packs

    rng = random.Random(5)
    ids = [None, "", "a", "ö€", "x" * 300, *map(str, range(40))]
    rows = [(rng.randrange(4), rng.randrange(2), rng.choice(ids), int(rng.random() < 0.3)) for _ in range(900)] + [(1, 1, "often", 1)] * 70_000
    names = ["when", "_part", "_id", "_loyal"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i::3]]) for i in range(3)]
    want = {}
    for when, part, who, loyal in rows:
        n = want.setdefault((when, part), {}).setdefault(who, [0, 0])
        n[0], n[1] = n[0] + 1, n[1] + loyal
    for size in (10_000_000, 400):
        monkeypatch.setattr(packs, "PACK_ROWS", size)
        held = {}
        for batch in packs.pack(iter(batches)):
            for r in batch.to_pylist():
                held.setdefault((r["when"], r["part"]), []).append(r["pack"])
        assert {k: {r["id"]: [r["n_calls"], r["n_loyalty"]] for r in packs.totals(v).to_pylist()} for k, v in held.items()} == want
    monkeypatch.setattr(packs, "EMIT_ROWS", 7)
    ended = pa.RecordBatch.from_pylist([{"start": k[0], "end": k[1], "packs": v} for k, v in held.items()])
    out = [r for b in packs.unpack(iter([ended])) for r in b.to_pylist()]
    assert len(out) == sum(map(len, want.values())) and all(want[r["start"], r["end"]][r["id"]] == [r["n_calls"], r["n_loyalty"]] for r in out)


def test_the_join_of_calls_gets_more_partitions_with_more_rows(spark, monkeypatch):
    from conftest import SMALL
    from ebbtide.session import shuffle_width
    from ebbtide.sources import starschema

    plain = starschema.StarSchema(spark, SMALL).calls()
    monkeypatch.setattr(starschema, "JOIN_ROWS", 100)
    many = starschema.StarSchema(spark, SMALL)
    n = many.table("lineitem").count()
    assert many._call_parts == -(-n // 100) > shuffle_width(spark)
    assert many.calls().rdd.getNumPartitions() > shuffle_width(spark)
    assert many.calls().exceptAll(plain).count() == 0 and many.calls().count() == plain.count()


def test_gate_warns_of_leaking_columns(spark):
    from conftest import SMALL
    from ebbtide.operators import quality
    from ebbtide.sources.starschema import StarSchema

    tables = StarSchema(spark, SMALL).raw_tables()
    status = lambda columns: {r["check"]: r["status"] for r in quality.gate(tables, "2000-01-01", columns).collect()}["Leakage risk"]
    assert status(["speed", "churned"]) == "PASS" and status(["speed", "Cease_Placed_Date"]) == "WARN"
