"""Training-corpus pipeline: toxicity, line dedup, near duplicates, source mix, packing.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a
DataFrame; all but the last return the columns of ``docs``. Null texts pass every
filter (they are never toxic, hold no lines and link with nothing) and vanish in the
mix, which takes nothing from a document without words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import jaccard, line_templates, mixing, packing, toxicity
from ebbtide.llm.catalog import tokenizer_path
from ebbtide.llm.names import field
from ebbtide.session import settle, share_package


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the field is fitted on the labelled ones that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_rows(docs, labels)
    return scored.where(F.col(scored.columns[-2]) < 0.5).select(*[field(c) for c in docs.columns])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go, except in their first document; no document goes. n_chars follows the text."""
    kept = line_templates.drop_recurring_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col(kept.columns[-1]) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select(*[field(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every component of similar documents stays; rows without an id stay."""
    return jaccard.one_per_component(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("source_mix", mixing_stage),
    ("packing", packing_stage),
]

#: The toxicity model, the subset sums and the packing are not SQL. tests/llm/test_whole_pipeline.py holds run() against
#: plain Python over a planted table, given the scores of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the table documents."""
    share_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
