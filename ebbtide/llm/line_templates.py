"""Line dedup by a log-template tree, in DataFrame operations only.

A line goes down a tree of fixed depth: its number of tokens, then its first tokens,
where tokens with a digit count as one variable token. Below a leaf, a token stays
part of the template when it stands at its position in at least ``MIN_DOCS`` lines of the
leaf; other tokens are generalised. A line fits its template when at least ``ALIKE`` of its
tokens agree with it, variable tokens at any position included (``Page 12`` agrees wholly
with ``Page <*>``): lines of free text that share only their first words are no template.
A template without any constant token is the line itself. Templates that occur in at
least ``MIN_DOCS`` documents recur: their lines are dropped from every document but the one
with the smallest id, so no content is lost. Byte-identical lines always share a template.

Edge cases: a null text stays null; empty lines never count and stay; lines are split
at \\n only; a document whose lines all go keeps its row with an empty text; rows that
repeat a doc_id count as one document; a null doc_id keeps its lines; very long texts are
rows like others; columns of the caller keep their names and values whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.names import field, free_name
from ebbtide.session import settle

DEPTH = 3  # leading tokens in the tree
MIN_DOCS = 5
ALIKE = 0.6
GAP = r"[ \t\x0B\f\r]+"
VARIABLE = "<*>"


def _masked(token):
    return F.when(F.translate(token, "0123456789", "") != token, F.lit(VARIABLE)).otherwise(token)


def _lines(docs: DataFrame) -> DataFrame:
    """(_doc, _print, _pos, line, n, leaf) of every line with a token."""
    rows = docs.where("_doc IS NOT NULL").select("_doc", "_print", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line"))
    rows = rows.withColumn("_line", F.trim(F.translate("_line", "\t\x0b\f\r", "    "))).where("_line <> ''")
    # Tokens are the gaps between them plus one: counted without building them.
    rows = rows.withColumn("_n", (F.regexp_count("_line", F.lit(" +")) + 1).cast("int"))
    lead = F.slice(F.split("_line", " +", DEPTH + 1), 1, F.least(F.lit(DEPTH), F.col("_n")))
    return rows.withColumn("_leaf", F.xxhash64("_n", F.transform(lead, _masked)))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(_doc, _print, _drop): positions of the lines that go, for documents (_doc, _text, _print)."""
    lines = settle(_lines(docs))  # lexed once, read twice
    leaves = lines.groupBy("_leaf").agg(F.count("*").alias("_lines")).where(F.col("_lines") >= min_docs).drop("_lines")
    held = settle(lines.join(leaves, "_leaf").select("_doc", "_print", "_pos", "_leaf", "_line", "_n"))
    tokens = held.select("_doc", "_print", "_pos", "_leaf", "_n", F.posexplode(F.split("_line", " +")).alias("_at", "_token"))
    tokens = tokens.withColumn("_token", F.xxhash64(_masked(F.col("_token"))))
    common = tokens.where(F.col("_at") >= DEPTH).groupBy("_leaf", "_at", "_token").agg(F.count("*").alias("_c")).where(F.col("_c") >= min_docs).drop("_c")
    # Only common tokens matter from here on: a line's template is its leaf and the common tokens at their places.
    kept = tokens.where(F.col("_at") >= DEPTH).join(common, ["_leaf", "_at", "_token"])
    variable = F.xxhash64(F.lit(VARIABLE))
    extra = kept.groupBy("_doc", "_print", "_pos").agg(F.count("*").alias("_k"), F.count_if(F.col("_token") != variable).alias("_const"), F.bit_xor(F.xxhash64("_at", "_token")).alias("_mark"))
    depth = F.least(F.lit(DEPTH), F.col("_n"))
    lead = F.filter(F.slice(F.split("_line", " +", DEPTH + 1), 1, depth), lambda t: F.translate(t, "0123456789", "") == t)
    own = F.when(F.size(lead) + F.coalesce("_const", F.lit(0)) == 0, F.xxhash64("_line")).otherwise(F.coalesce("_mark", F.lit(0)))
    line = held.join(extra, ["_doc", "_print", "_pos"], "left").where((depth + F.coalesce("_k", F.lit(0))) / F.col("_n") >= ALIKE)
    line = line.select("_doc", "_print", "_pos", F.xxhash64("_leaf", own).alias("_template"))
    per_doc = line.select("_template", "_doc").distinct()
    # Settled, so that the join below reads two plain exchanges, whose large partitions Spark can split.
    known = settle(per_doc.groupBy("_template").agg(F.count("*").alias("_docs"), F.min("_doc").alias("_first")).where(F.col("_docs") >= min_docs).drop("_docs"))
    gone = line.join(known, "_template").where("_doc > _first")
    return gone.groupBy("_doc", "_print").agg(F.collect_set("_pos").alias("_drop"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """All rows and columns of ``docs``; ``text_col`` without recurring lines, and _n_lines, _n_dropped (the last two columns; taken names get more underscores)."""
    mark = F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0))
    base = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text"), mark.alias("_print"))
    gone = recurring_lines(base, min_docs).withColumnsRenamed({"_doc": "_gone_doc", "_print": "_gone_print"})
    rows = docs.select(F.struct(*[field(c) for c in docs.columns]).alias("_row"), F.col(id_col).cast("long").alias("_doc"), mark.alias("_print"))
    rows = rows.join(gone, (F.col("_doc") == F.col("_gone_doc")) & (F.col("_print") == F.col("_gone_print")), "left")
    text = F.col("_row").getField(text_col)
    parts = F.split(text, "\n")
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("_drop"), i)), "\n")
    kept = F.when(F.col("_drop").isNull(), text).otherwise(kept)
    lines = F.coalesce(F.when(text.isNotNull(), F.size(parts)), F.lit(0)).cast("long")
    dropped = F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long")
    own = [kept.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return rows.select(*own, lines.alias(free_name(docs, "_n_lines")), dropped.alias(free_name(docs, "_n_dropped")))


def digest(kept: DataFrame) -> DataFrame:
    lines, dropped = kept.columns[-2:]
    return kept.select("doc_id", F.col(lines).alias("n_lines"), F.col(dropped).alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
