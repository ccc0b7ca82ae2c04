"""Clashing columns, empty tables, line templates with variable fields, and the two ways to encode units."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from ebbtide.llm import line_templates, toxicity, unit_encoder
from ebbtide.llm.catalog import tokenizer_path

CLASHES = ["_text", "_score", "_spans", "_print", "_drop", "_hash", "_copies", "_head", "_n_lines", "_n_dropped", "_row", "_doc", "_times", "text.x", "c0", "score"]


def clashing(spark, rows):
    names = ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *[f"{c} of {i}" for c in CLASHES]) for i, t, s in rows], f"doc_id long, text string, lang string, source string, n_chars long, {names}")


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_whose_names_they_use_themselves(spark, stage):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = [(i, "\n".join(["Shared line of the site", " ".join(word() for _ in range(30))]), "ab"[i % 2]) for i in range(30)] + [(90, None, "a"), (91, "", None)]
    docs = clashing(spark, rows)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SMALL)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    got = out.collect()
    assert len(got) >= 25 and all(r[c] == f"{c} of {r['doc_id']}" for r in got for c in CLASHES)
    texts = {i: t for i, t, _ in rows}
    assert all(r["text"] == texts[r["doc_id"]] for r in got) or stage == 1
    if stage == 1:
        assert sum((r["text"] or "").startswith("Shared") for r in got) == 1 and all(r["n_chars"] == len(r["text"] or "") for r in got)


@pytest.mark.parametrize("stage", range(5))
def test_stages_of_an_empty_table(spark, stage):
    assert corpus_pipeline.STAGES[stage][1](spark, clashing(spark, []), SMALL).count() == 0


def test_scores_and_spans_take_free_names(spark):
    docs = clashing(spark, [(1, "abc", "a"), (2, "def", "a")])
    out = toxicity.score_rows(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert out.columns == [*docs.columns, "__score", "__spans"]


def test_an_id_that_repeats_gives_one_fitting_row(spark):
    docs = spark.createDataFrame([(7, f"text {i}".encode()) for i in range(500)] + [(i, b"x") for i in range(20, 40)], "_doc long, _text binary")
    labels = spark.createDataFrame([(7, 1), (7, 1), *[(i, i % 2) for i in range(20, 40)]], "doc_id long, toxic int")
    rows = toxicity.training_sample(docs, labels).collect()
    assert len(rows) == len({r["_doc"] for r in rows}) and [bytes(r["_text"]) for r in rows if r["_doc"] == 7] in ([], [b"text 0"])


def test_the_field_does_not_depend_on_what_it_holds(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdef") for _ in range(4)) for _ in range(40)).encode() + (b" awful" if i % 3 == 0 else b"") for i in range(200)]
    import numpy as np

    toxic, weight = np.array([i % 3 == 0 for i in range(200)]), np.ones(200)
    monkeypatch.setattr(toxicity, "SLICE", 2000)
    held = toxicity.fit_field(texts, toxic, weight)
    monkeypatch.setattr(toxicity, "HELD", 0)
    anew = toxicity.fit_field(texts, toxic, weight)
    assert (held.weight == anew.weight).all() and held.bias == anew.bias and (held.doc == anew.doc).all()


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["text"] for r in line_templates.drop_recurring_lines(docs).collect()}


@pytest.mark.parametrize("line", [lambda i: f"Page {i}", lambda i: f"Copyright {1990 + i}", lambda i: f"Posted 2023-05-{i:02d} 1{i % 10}:30", lambda i: f"2023-01-{i:02d} 12:00:{i:02d} INFO Started", lambda i: "12 34", lambda i: "7"])
def test_lines_with_variable_fields_recur(spark, line):
    got = kept(spark, [f"own text no{'abcdefgh'[i]} here\n{line(i)}" for i in range(8)])
    assert got[0].endswith(line(0)) and all(got[i] == f"own text no{'abcdefgh'[i]} here" for i in range(1, 8))


def test_lines_of_numbers_alone_and_lines_that_share_only_their_start_stay(spark):
    texts = [f"{i} {i * 7}\nThe site has " + " ".join("abcdefghij"[(i * k + k) % 10] * (i + 2) for k in range(1, 9)) for i in range(1, 9)]
    assert list(kept(spark, texts).values()) == texts or sorted(kept(spark, texts).values()) == sorted(texts)


def test_both_ways_to_encode_units_give_the_tokenizers_ids():
    path = tokenizer_path()
    assert unit_encoder.merges_agree(path)
    rng = random.Random(9)
    bits = ["th", "e", " ", "ing", "é", "ß", "'s", "'re", "12", "..", "$$", "\n", "日本", "א", "ࡰ", "𝒳", "zq", "X", "\t", " word", "!?", "_", "İ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    plain, quick = unit_encoder.UnitEncoder(path), unit_encoder.UnitEncoder(path, True)
    assert quick.quick is not None
    for t, a, b in zip(texts, plain.encode(texts), quick.encode(texts), strict=True):
        assert a.tolist() == b.tolist() == plain.tok.encode(t, add_special_tokens=False).ids


def test_units_survive_the_change_of_generations(monkeypatch):
    monkeypatch.setattr(unit_encoder, "CACHE_UNITS", 3000)
    enc = unit_encoder.UnitEncoder(tokenizer_path(), True)
    rng = random.Random(4)
    for _ in range(12):
        texts = [" ".join(rng.choice(["common", "words"]) if rng.random() < 0.5 else f"x{rng.randrange(10**6)}q" for _ in range(100)) for _ in range(20)]
        for t, ids in zip(texts, enc.encode(texts), strict=True):
            assert ids.tolist() == enc.tok.encode(t, add_special_tokens=False).ids
    assert enc.old.table.used and enc.young.table.used


def test_merges_that_disagree_are_noticed(tmp_path):
    """A token whose bytes encode to other tokens, and ids out of order."""
    import json

    spec = json.loads(open(tokenizer_path(), encoding="utf-8").read())
    spec["model"]["merges"] = spec["model"]["merges"][:200] + spec["model"]["merges"][201:]
    (tmp_path / "t.json").write_text(json.dumps(spec))
    assert not unit_encoder.merges_agree(str(tmp_path / "t.json"))
