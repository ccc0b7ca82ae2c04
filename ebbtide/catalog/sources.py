"""Scans, sources and sinks. Sinks write below the shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbtide.catalog.ctes import ID, S, sql
from ebbtide.catalog.features import KEYED
from ebbtide.catalog.registry import query
from ebbtide.catalog.shared import MATRIX_COLS, assembled, rounded
from ebbtide.operators import metrics, scoring
from ebbtide.operators.ranking import capped_sample, hash_sample
from ebbtide.plans import features as plans
from ebbtide.session import scratch
from ebbtide.sources import readers, schemas, sinks
from ebbtide.sources.starschema import SPLITS

TABLE_COLS = {"customer_info": 12, "cease": 4, "calls": 5, "usage": 4}
SOURCE = {"customer_info": "panel", "cease": "cease", "calls": "calls", "usage": "usage"}
INVENTORY = " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS n_rows, {n} AS n_columns FROM {SOURCE[t]}" for t, n in TABLE_COLS.items())


@query("src_csv", sql("calls cease", f"SELECT 'calls' AS source, {ID}, event_date AS day, call_type AS kind, round(talk_time_seconds, 6) AS v FROM calls UNION ALL SELECT 'cease', {ID}, cease_placed_date, reason_description_insight, NULL FROM cease"))
def src_csv(d):
    out = None
    for name, df, day, kind, v in (("calls", d.calls(), "event_date", "call_type", "talk_time_seconds"), ("cease", d.cease(), "cease_placed_date", "reason_description_insight", None)):
        path = scratch(d.spark, name) + ".csv"
        df.write.option("header", True).csv(path)
        back = readers.read_raw(d.spark, name, path)
        one = back.select(F.lit(name).alias("source"), ID, F.col(day).alias("day"), F.col(kind).alias("kind"), (F.round(v, 6) if v else F.lit(None).cast("double")).alias("v"))
        out = one if out is None else out.unionByName(one)
    return out


@query("src_parquet", "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders")
def src_parquet(d):
    return d.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def ingested(d):
    root = scratch(d.spark, "raw")
    return readers.load_all(d.spark, readers.ingest(d.raw_tables(), root))


@query("src_ingest", sql("panel cease calls usage", INVENTORY))
def src_ingest(d):
    return readers.inventory(ingested(d))


@query("src_inventory", sql("panel cease calls usage", INVENTORY))
def src_inventory(d):
    return readers.inventory(d.raw_tables())


@query("src_query", sql("panel cease", f"SELECT p.contract_status, count(*) AS n FROM panel p WHERE p.{ID} IN (SELECT {ID} FROM cease) GROUP BY 1"))
def src_query(d):
    text = f"SELECT p.contract_status, count(*) AS n FROM {{panel}} p LEFT SEMI JOIN {{cease}} c ON p.{ID} = c.{ID} GROUP BY p.contract_status"
    return readers.run_sql(d.spark, text, {"panel": d.panel(), "cease": d.cease()})


@query("src_load_full", sql("cease", "SELECT * FROM cease"))
def src_load_full(d):
    return d.cease()


@query("src_sample_n", sql("accounts", "SELECT o_orderkey, ooc_days FROM accounts WHERE ooc_days IS NOT NULL ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 5000"))
def src_sample_n(d):
    return hash_sample(d.panel_keyed().where("ooc_days IS NOT NULL").select(KEYED, "ooc_days"), KEYED, 5000)


@query("src_sample_capped", sql("accounts", "SELECT o_orderkey, speed FROM accounts WHERE line_speed > speed ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100000"))
def src_sample_capped(d):
    return capped_sample(d.panel_keyed().where("line_speed > speed").select(KEYED, "speed"), KEYED, 100000)


def written_matrix(d):
    folder = scratch(d.spark, "features")
    plans.materialise(d.panel(), d.calls(), d.usage(), d.cease(), SPLITS.snapshots, folder)
    return folder


@query("src_glob_concat", sql("assembled_all", f"SELECT snapshot_date, {ID}, ooc_days, call_count_30d, churned FROM assembled_all"))
def src_glob_concat(d):
    folder = scratch(d.spark, "snapshots")
    sinks.write_features(assembled(d, SPLITS.snapshots), folder)
    return readers.read_snapshots(d.spark, folder).select("snapshot_date", ID, "ooc_days", "call_count_30d", "churned")


@query("sink_features", sql("assembled_all", f""", g AS (SELECT avg(churned) AS mu FROM assembled_all WHERE snapshot_date = {S}),
 m AS (SELECT sales_channel, (sum(churned) + (SELECT mu FROM g)) / (count(*) + 1.0::DOUBLE) AS enc FROM assembled_all WHERE snapshot_date = {S} GROUP BY 1)
 SELECT snapshot_date, count(*) AS n, sum(churned)::BIGINT AS churners, round(CASE WHEN snapshot_date > {S} THEN sum(coalesce(m.enc, g.mu)) END, 6) AS sum_encoded FROM assembled_all LEFT JOIN m USING (sales_channel) CROSS JOIN g GROUP BY snapshot_date"""))
def sink_features(d):
    df = d.spark.read.parquet(written_matrix(d) + "/matrix")
    later = F.col("snapshot_date") > F.lit(SPLITS.train_end).cast("date")
    return rounded(df.groupBy("snapshot_date").agg(F.count("*").alias("n"), F.sum("churned").alias("churners"), F.sum(F.when(later, F.col("sales_channel_encoded"))).alias("sum_encoded")))


@query("src_verify_outputs", sql("assembled_all", f"SELECT snapshot_date, count(*) AS n_rows, {len(MATRIX_COLS) + 2} AS n_columns FROM assembled_all GROUP BY 1"))
def src_verify_outputs(d):
    return sinks.verify_snapshots(d.spark, written_matrix(d) + "/matrix")


@query("sink_scored_csv", sql("scored", """SELECT CAST(row_number() OVER (ORDER BY round(p, 4) DESC, id) AS INTEGER) AS priority_rank, CAST(id AS INTEGER) AS id, round(p, 4) AS churn_probability FROM scored"""))
def sink_scored_csv(d):
    ranked = scoring.priority_rank(d.scored().select("id", F.round("p", 4).alias("churn_probability")), "churn_probability", "id")
    path = scratch(d.spark, "scored") + ".csv"
    sinks.write_scored_csv(ranked.select("priority_rank", "id", "churn_probability"), path)
    return d.spark.read.schema("priority_rank int, id int, churn_probability double").option("header", True).csv(path)


@query("sink_metrics", sql("scored", "SELECT 'run-1' AS run_id, 'brier_score' AS metric, round(avg((p - y) * (p - y)), 6) AS value FROM scored UNION ALL SELECT 'run-1', 'base_rate', round(avg(y), 6) FROM scored"))
def sink_metrics(d):
    path = scratch(d.spark, "runs")
    s = d.scored()
    brier = metrics.f1_brier(s).select(F.lit("brier_score").alias("metric"), F.col("brier_score").alias("value"))
    sinks.log_metrics(brier.unionByName(s.agg(F.lit("base_rate").alias("metric"), F.avg(F.col("y").cast("double")).alias("value"))), path, "run-1")
    return d.spark.read.parquet(path)
