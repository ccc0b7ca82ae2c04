"""Queries of this subpackage and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import exact_topk, jaccard, line_templates, mixing, multi_index, packing, presence_masks, rule_ensemble, secrets, toxicity, vector_codes, window_dedup, wrappers
from ebbtide.session import share_package

BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str = BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.digest(toxicity.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels")))


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan_texts(_table(spark, folder, "documents")))


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.digest(line_templates.drop_recurring_lines(_table(spark, folder, "documents")))


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return window_dedup.digest(window_dedup.drop_repeated_windows(_table(spark, folder, "documents")))


def ann_search(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.nearest(_table(spark, folder, "embeddings"))


def pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), tokenizer_path())


def html_text(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.digest(wrappers.extract(_table(spark, folder, "pages")))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(mixing.mix(_table(spark, folder, "documents")))


def similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, folder, "documents"))


def exact_search(spark: SparkSession, folder: str) -> DataFrame:
    return exact_topk.top_k(_table(spark, folder, "embeddings"))


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rule_ensemble.digest(rule_ensemble.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels")))


def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return presence_masks.rank(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def vector_codes_of(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.digest(vector_codes.encode(_table(spark, folder, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity_scores,
    "op2_secret_scan": secret_spans,
    "op3_line_dedup": line_dedup,
    "op4_substring_dedup": substring_dedup,
    "op5_ann_multi_index": ann_search,
    "op6_packing": pack_sequences,
    "op7_html_extraction": html_text,
    "op8_source_mix": source_mix,
    "op9_jaccard_join": similar_documents,
    "op10_exact_topk": exact_search,
    "op11_rule_ensemble": quality_scores,
    "op12_presence_masks": ranked_search,
    "op13_vector_codes": vector_codes_of,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def _lloyd_sql(rounds: int) -> str:
    """Assignment and update steps, one table each; the last assignment is a<rounds>."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT rid, part, arg_min(entry, d * 16 + entry) AS entry, min(d) AS d FROM
  (SELECT rid, c.part, entry, sum((x - y) * (x - y))::BIGINT AS d FROM cell c JOIN b{k} b ON c.part = b.part AND c.place = b.place GROUP BY rid, c.part, entry) GROUP BY rid, part)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS n FROM a{k} JOIN cell USING (rid, part) GROUP BY part, entry, place),
b{k + 1} AS MATERIALIZED (SELECT part, entry, place, coalesce((s - (((s % n) + n) % n)) // n, y)::BIGINT AS y FROM b{k} LEFT JOIN m{k} USING (part, entry, place))""")
    return ",\n".join(steps)


ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": r"""
WITH docs AS (SELECT doc_id, text, row_number() OVER () AS rid FROM documents),
parts AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs WHERE text IS NOT NULL),
lines AS (SELECT rid, doc_id, pos, trim(translate(raw, chr(9) || chr(11) || chr(12) || chr(13), '    ')) AS line FROM parts WHERE doc_id IS NOT NULL),
toks AS (SELECT rid, doc_id, pos, line, list_transform(regexp_split_to_array(line, ' +'), lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS t FROM lines WHERE line <> ''),
leaf AS (SELECT *, len(t) AS n, array_to_string(t[1:3], ' ') AS lead FROM toks),
places AS (SELECT rid, pos, n, lead, unnest(t[4:]) AS tok, generate_subscripts(t[4:], 1) AS place FROM leaf),
common AS (SELECT n, lead, place, tok FROM places GROUP BY ALL HAVING count(*) >= 5),
kept AS (SELECT rid, pos, count(*) AS k, count(*) FILTER (WHERE tok <> '<*>') AS c, string_agg(place || ':' || tok, ' ' ORDER BY place) AS sig FROM places JOIN common USING (n, lead, place, tok) GROUP BY rid, pos),
tpl AS (SELECT rid, doc_id, pos, n, lead, CASE WHEN len(list_filter(t[1:3], lambda x: x <> '<*>')) + coalesce(c, 0) = 0 THEN 'line:' || line ELSE coalesce(sig, '') END AS sig
  FROM leaf LEFT JOIN kept USING (rid, pos) WHERE (least(n, 3) + coalesce(k, 0)) / n >= 0.6),
known AS (SELECT n, lead, sig, min(doc_id) AS first FROM tpl GROUP BY n, lead, sig HAVING count(DISTINCT doc_id) >= 5),
gone AS (SELECT rid, pos FROM tpl JOIN known USING (n, lead, sig) WHERE doc_id > first),
done AS (SELECT p.rid, count(*) AS n_lines, count(g.pos) AS n_dropped, coalesce(string_agg(p.raw, chr(10) ORDER BY p.pos) FILTER (WHERE g.pos IS NULL), '') AS txt
  FROM parts p LEFT JOIN gone g ON p.rid = g.rid AND p.pos = g.pos GROUP BY p.rid)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, sha256(coalesce(txt, '')) AS kept_sha256
FROM docs LEFT JOIN done USING (rid)""",
    "op4_substring_dedup": rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM docs, unnest(range(1, len(w) - 48)) AS r(i)),
first AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN first USING (h), range(50) AS o(k) WHERE d < doc_id),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM docs),
kept AS (SELECT w.doc_id, count(g.p) AS gone, string_agg(w.x, ' ' ORDER BY w.p) FILTER (WHERE g.p IS NULL) AS t FROM word w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p GROUP BY w.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)""",
    "op9_jaccard_join": r"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM docs, unnest(range(1, greatest(len(w) - 3, 2))) AS r(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT x, y FROM pairs JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach(x, y) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT d.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id FROM docs d JOIN reach r ON r.x = d.doc_id LEFT JOIN size s ON s.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op10_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_presence_masks": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
doc AS (SELECT rid, doc_id, t, len(t) AS n FROM d WHERE len(t) > 0),
corpus AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM doc),
post AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(t) AS term FROM doc) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
ask AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term),
w AS (SELECT item_id, term, q, floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT AS w FROM ask JOIN df USING (term), corpus),
s AS (SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score FROM w JOIN post USING (term) JOIN doc USING (rid), corpus GROUP BY item_id, rid, doc_id),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20""",
    "op13_vector_codes": f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cell AS MATERIALIZED (SELECT rid, (i - 1) // (n // 8) AS part, (i - 1) % (n // 8) AS place, x FROM (SELECT rid, len(e) AS n, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v)),
seed AS (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT 16),
b0 AS MATERIALIZED (SELECT part, entry, place, x AS y FROM seed JOIN cell USING (rid)),
{_lloyd_sql(6)},
h AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b6),
c AS (SELECT rid, string_agg('0' || substr('0123456789abcdef', entry::INTEGER + 1, 1), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY rid),
l AS (SELECT label, sum(error)::BIGINT AS label_error FROM c JOIN v USING (rid) GROUP BY label)
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM c JOIN v USING (rid) JOIN l ON v.label IS NOT DISTINCT FROM l.label, h""",
}
