"""Toxicity, secrets, line templates, packing, mixing and page text."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from ebbtide.llm import line_templates, mixing, packing, secrets, toxicity, wrappers
from ebbtide.llm.catalog import tokenizer_path
from ebbtide.llm.unit_encoder import UnitEncoder

SCHEMA = "doc_id long, text string, score double, spans string, source string"


def docs(spark, texts, source=lambda i: "s"):
    return spark.createDataFrame([(i, t, 0.1, "x", source(i)) for i, t in texts], SCHEMA)


# ---- toxicity ----------------------------------------------------------------------------------
def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, toxicity.SEGMENT_TOKENS + 3):
        score, trans = rng.normal(0, 2, n), rng.normal(0, 1, (2, 2))
        got = toxicity.marginals(score, np.array([0, 0, n, n]), trans)
        alpha, a = np.zeros((n, 2)), np.exp(trans)
        emit = np.stack([np.ones(n), np.exp(score)], 1)
        alpha[0] = emit[0] * (0.5 * a.sum(axis=0))
        beta = np.ones((n, 2))
        for t in range(1, n):
            alpha[t] = emit[t] * (alpha[t - 1] @ a)
            alpha[t] /= alpha[t].sum()
        for t in range(n - 2, -1, -1):
            beta[t] = a @ (emit[t + 1] * beta[t + 1])
            beta[t] /= beta[t].sum()
        # The last position is followed by nothing; the operator's end message is uniform as well.
        want = alpha * beta
        assert got == pytest.approx(want[:, 1] / want.sum(axis=1), abs=1e-9)


def test_marginals_match_all_tag_sequences():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 9):
        score, trans = rng.normal(0, 2, n), rng.normal(0, 1, (2, 2))
        weight = {}
        for tags in itertools.product((0, 1), repeat=n):  # the tag before the first token is either, equally likely
            before = [np.exp(trans[s, tags[0]]) / 2 for s in (0, 1)]
            inner = sum(trans[a, b] for a, b in itertools.pairwise(tags)) + sum(x for x, t in zip(score, tags, strict=True) if t)
            weight[tags] = sum(before) * np.exp(inner)
        total = sum(weight.values())
        want = [sum(w for tags, w in weight.items() if tags[i]) / total for i in range(n)]
        assert toxicity.marginals(score, np.array([0, n]), trans) == pytest.approx(want, abs=1e-9)


def toxic_corpus(spark, n=400):
    rng = random.Random(3)
    bad = ["idiot", "moronweg", "moronlich"]
    texts, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 40))]
        y = int(rng.random() < 0.3)
        if y:
            w[rng.randrange(len(w))] = rng.choice(bad).title() + rng.choice(["", "!", ","])
        texts.append((i, " ".join(w)))
        labels.append((i, y))
    return texts, labels


def test_toxic_documents_and_their_spans_are_found(spark):
    texts, labels = toxic_corpus(spark)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    extra = [(1000, None), (1001, ""), (1002, "!!! ??"), (1003, "wor " * 30000 + "Idiot " + "wor " * 30000), (1003, "clean abc")]
    out = toxicity.score_documents(docs(spark, texts + extra), lab).collect()
    by = {r["doc_id"]: r for r in out if r["doc_id"] < 1000}
    assert len(out) == len(texts) + 5
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(by[i]["score"] >= 0.5) == bool(labels[i][1]) for i in held]) > 0.95
    low = [r["score"] for r in out if r["doc_id"] in (1000, 1001, 1002)]
    assert max(low) == min(low) < 0.5 and all(0 <= r["score"] <= 1 for r in out)
    long = max((r for r in out if r["doc_id"] == 1003), key=lambda r: r["score"])
    assert [(s["start"], s["end"]) for s in long["spans"]] == [(120000, 120005)]


def test_labels_of_held_out_rows_do_not_matter(spark):
    texts, labels = toxic_corpus(spark, 200)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.score_documents(docs(spark, texts), spark.createDataFrame(x, "doc_id long, toxic int")).collect()} for x in (labels, flipped))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 0)]])
def test_one_sided_labels_give_a_constant(spark, labels):
    out = toxicity.score_documents(docs(spark, [(1, "a b"), (2, "c")]), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len({r["score"] for r in out}) == 1


def test_scoring_keeps_clashing_columns(spark):
    df = docs(spark, [(1, "a")])
    out = toxicity.score_rows(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert out.columns == [*df.columns, "_score", "_spans"] and out.first()["score"] == 0.1


# ---- secrets -----------------------------------------------------------------------------------
def brute_base(text):
    out = []
    for k, (kind, pattern, least) in enumerate((("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), ("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24))):
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans_match_the_patterns():
    rng = random.Random(1)
    bits = ["password", "PassWd", "token", "api_key", "APIKEY", "secret", "ſecret", "toKen", "=", ":", " ", "'", '"', "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMNOPQRST", "x", "é", "\n", "+/"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert secrets.base_spans(text) == brute_base(text)


@pytest.mark.parametrize("text,kind,value", [
    ('db_pwd = "S3cr3t!pass#9"', "literal", "S3cr3t!pass#9"),
    ("K = 'aZ81kQpw77Lm'\nauth_key = K\n", "const", "aZ81kQpw77Lm"),
    ("privateKey: q8Zt0Lm4Xw2R", "literal", "q8Zt0Lm4Xw2R"),
])
def test_assigned_literals_are_found(text, kind, value):
    assert (kind, text.index(value), text.index(value) + len(value)) in secrets.lexed_spans(text)


def test_prose_has_no_spans(spark):
    assert secrets.lexed_spans("The key: nobody knew. Auth = none. access: denied token of love") == []
    rows = secrets.digest(secrets.scan_texts(docs(spark, [(1, None), (2, ""), (3, 'pwd="Zq81kQpw7" token = "Zq81kQpw77"')]))).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [r["base_sha256"] for r in sorted(rows)][:2] == [empty, empty]
    third = max(rows, key=lambda r: r["doc_id"])
    assert third["n_assign"] == 1 and third["spans"].count("assign") == 1 and third["spans"].startswith("literal:5:14,assign:16:")


# ---- line templates -----------------------------------------------------------------------------
def test_recurring_templates_stay_once(spark):
    texts = [(i, f"unique line {chr(97 + i)} of doc number\nUser u{i}x logged in at {i}:30 today ok\n\nFooter text here") for i in range(8)] + [(20, None), (21, ""), (22, "\n\n")]
    out = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(docs(spark, texts)).collect()}
    assert out[0]["text"] == texts[0][1] and out[0]["_n_dropped"] == 0
    assert out[5]["text"] == "unique line f of doc number\n" and out[5]["_n_dropped"] == 2
    assert out[20]["text"] is None and out[21]["text"] == "" and out[22]["text"] == "\n\n" and out[3]["score"] == 0.1


def test_few_documents_or_few_constants_do_not_recur(spark):
    rng = random.Random(2)
    texts = [(i, "a b c " + " ".join(str(rng.random()).replace("0", "q").translate(str.maketrans("123456789", "abcdefghi")) for _ in range(9))) for i in range(9)]
    texts += [(20 + i, "only four documents hold this line") for i in range(line_templates.MIN_DOCS - 1)] + [(30, "seven rows\n" * 7)] * 7
    out = line_templates.drop_recurring_lines(docs(spark, texts))
    assert out.where("_n_dropped > 0").count() == 0 and out.count() == len(texts)
    assert line_templates.drop_recurring_lines(docs(spark, [])).count() == 0


# ---- packing -------------------------------------------------------------------------------------
def test_units_encode_like_whole_texts():
    enc = UnitEncoder(tokenizer_path())
    rng = random.Random(3)
    bits = ["a", "b", " ", "  ", "\n", "\t", "é", "'s", "'re", "12", "..", "$", "\xa0", "\x1c", "\x85", "<|endoftext|>", "日本", "\r\n", "\x0b", " ", "word"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["x y" * 700000]
    got = enc.encode(texts)
    for t, ids in zip(texts, got, strict=True):
        assert ids.tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_packing_is_an_exact_round_trip(spark):
    rng = random.Random(4)
    texts = [(i, " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.choice([0, 3, 200, 900, 3000])))) for i in range(120)] + [(200, None), (201, ""), (5, "again"), (None, "no id")]
    rows = packing.pack(docs(spark, texts).repartition(3), tokenizer_path()).collect()
    tok = UnitEncoder(tokenizer_path()).tok
    want = sorted(((-1 if i is None else i), zlib.crc32(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()), 1) for i, t in texts)
    pieces, seqs = {}, {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == 1024 or at & (at - 1) == 0
    assert sum(r["length"] for r in rows) == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
    whole = [(i, t) for i, t in texts if i is not None and i != 5]
    for i, t in whole:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r for (d, n), v in pieces.items() if d == i and n == len(ids) for r in v), key=lambda r: r["start"])
        at = 0
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert len(want) == len(texts)


def test_level_array_takes_the_least_sum_of_squares():
    rng = random.Random(5)
    levels = packing.LevelArray(16)
    count = [0] * 17
    for k in range(400):
        size = rng.randint(1, 15)

        def total(level):
            c = list(count)
            if level:
                c[level] -= 1
            c[level + size] += 1
            return sum(x * x for x in c[1:16])

        choices = [0] + [h for h in range(1, 16) if count[h] and h + size <= 16]
        got, window = levels.place(size)
        assert total(got) == min(map(total, choices)) and (window is None) == (got == 0)
        if got:
            count[got] -= 1
        if got + size < 16:
            count[got + size] += 1
        levels.settle(got + size, k if window is None else window)
        assert levels.count[1:16].tolist() == count[1:16]


# ---- mixing ---------------------------------------------------------------------------------------
def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / total >= 3 * sizes[s]] if total else []
        if not over:
            return target | {s: rest * weight[s] / total for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
        rest -= sum(target[s] for s in over)
        free -= set(over)


def test_mix_meets_its_targets(spark):
    rng = random.Random(6)
    name = lambda i: [None, "a", "b", "B", "é", "tiny", "zero"][min(i % 11, 6)] if i % 11 < 7 else "a"
    texts = [(i, "" if name(i) == "zero" else " ".join("w" * rng.randint(1, 3) for _ in range(2 if name(i) == "tiny" else rng.choice([1, 7, 40, 300])))) for i in range(600)]
    texts += [(700, None), (701, texts[1][1]), (701, texts[1][1])]
    df = docs(spark, texts, name)
    out = mixing.mix(df).collect()
    again = mixing.digest(mixing.mix(df.repartition(7))).collect()
    assert sorted(map(tuple, mixing.digest(spark.createDataFrame(out)).collect())) == sorted(map(tuple, again)) and len(out) == len(texts)
    sizes, got = {}, {}
    for r in out:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        got[r["source"]] = got.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = brute_targets(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s, t in want.items():
        assert abs(got[s] - t) <= 2
    assert mixing.apply_mix(df).count() == sum(r["copies"] for r in out)
    assert mixing.mix(docs(spark, [])).count() == 0


@pytest.mark.parametrize("exact", [50, 1 << 16])
def test_budgets_are_hit_when_they_can_be(exact):
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 60, 6))
        counts = rng.integers(0, 5, len(lengths))
        total = int((lengths * counts).sum())
        budget = int(rng.integers(0, total + 1))
        take = mixing.fit_counts(lengths, counts, budget, exact)
        assert (take >= 0).all() and (take <= counts).all()
        sums = {0}
        for x, n in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + k * x for s in sums for k in range(n + 1)}
        best = max(s for s in sums if s <= budget)
        assert 0 <= best - int((take * lengths).sum()) <= 60


# ---- pages ----------------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T {k}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href=/a>Menu {k}</a></ul></nav><!-- ad {k} --><div class="ad">Buy {k}</div><div class='cookie-notice'>We use cookies</div>
<article><h1>Title {k}</h1><p>Share this story<p><b>First&nbsp;&amp;
 second {k}<br>line<p>Third &lt;{k}&gt;</p><form><input>Sign up</form><div id=comments>Nice {k}</div></article><aside>Side {k}</aside><footer>&copy; {k}</footer>"""


def test_main_text_of_pages(spark):
    pages = [(k, f"http://Host.example/{k}", PAGE.format(k=f"x{k}")) for k in range(12)] + [(50, None, PAGE.format(k="n")), (51, "http://other/", "just text &eacute;"), (52, "http://other/2", None), (53, "bad url", ""), (1, "http://Host.example/1", PAGE.format(k="x1"))]
    out = wrappers.digest(wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string"))).collect()
    assert len(out) == len(pages)
    by = {r["page_id"]: r["text"] for r in out}
    assert by[3] == "Title x3\n\nFirst & second x3 line\n\nThird <x3>"  # the constant line is template
    assert by[50] == "Title n\n\nShare this story\n\nFirst & second n line\n\nThird <n>"
    assert by[51] == "just text é" and by[52] == "" and by[53] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_copies_do_not_make_each_other_template(spark):
    pages = [(k, f"http://h/{k}", PAGE.format(k="same") + f"<!-- {k} -->") for k in range(20)]
    out = wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in out} == {"Title same\n\nShare this story\n\nFirst & second same line\n\nThird <same>"}


def plain_wrapper(trees):
    """Wrapper of one layout in plain Python: reference, counts and conclusion over all different pages."""
    different = list({tuple(t.text): t for t in trees}.values())
    often = {m for t in different for m in t.mark if m and sum(m in u.mark for u in different) >= 0.9 * len(different)}
    ref = min(different, key=lambda t: (-len(often & set(t.mark)), len(t.up), wrappers._hash("\n".join(x for x in t.text if x))))
    counts = {}
    for t in different:
        for k, (n, size) in wrappers.seen(ref, t).items():
            counts[k] = (counts.get(k, (0, 0))[0] + n, counts.get(k, (0, 0))[1] + size)
    return wrappers.conclude(ref, len(different), counts)


def plain_match_weight(ref, tree, a=0, b=0):
    """Heaviest order-preserving match of the children of two nodes, by its definition."""
    left, right = ref.kids[a], tree.kids[b]
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, x in enumerate(left, 1):
        for j, y in enumerate(right, 1):
            w = 0
            if ref.tag[x] == tree.tag[y]:
                same = ref.mark[x] == tree.mark[y] if ref.tag[x] == "#text" else ref.label[x] == tree.label[y]
                w = 2 + same + plain_match_weight(ref, tree, x, y)
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w)
    return best[-1][-1]


def random_page(rng, depth=3):
    if depth == 0 or rng.random() < 0.3:
        return rng.choice(["alpha", "beta", "gamma delta", ""])
    tag = rng.choice(["div", "p", "ul", "section"])
    return f"<{tag}{rng.choice(['', ' class=a', ' class=b'])}>" + "".join(random_page(rng, depth - 1) for _ in range(rng.randint(0, 4))) + f"</{tag}>"


def test_simple_tree_matching_is_the_heaviest():
    rng = random.Random(4)
    for _ in range(300):
        ref, tree = (wrappers.outline("".join(random_page(rng) for _ in range(rng.randint(0, 5)))) for _ in range(2))
        to = wrappers.match(ref, tree)
        used = [(r, k) for k, r in enumerate(to) if r > 0]
        assert all(ref.tag[r] == tree.tag[k] and to[tree.up[k]] == ref.up[r] for r, k in used) and [r for r, _ in used] == sorted({r for r, _ in used})
        got = sum(2 + (ref.mark[r] == tree.mark[k] if ref.tag[r] == "#text" else ref.label[r] == tree.label[k]) for r, k in used)
        assert got == plain_match_weight(ref, tree)


def test_long_lists_are_aligned_by_equal_children(monkeypatch):
    monkeypatch.setattr(wrappers, "CELLS", 10)
    page = "".join(f"<p>{k} of many</p>" for k in range(50))
    ref, tree = wrappers.outline(page), wrappers.outline(page.replace("<p>7 of many</p>", "<p>new</p><p>newer</p>"))
    to = wrappers.match(ref, tree)
    assert {tree.text[k] for k in tree.runs() if to[k] < 0} == {"new", "newer"}
    assert all(ref.text[to[k]] == tree.text[k] for k in tree.runs() if to[k] >= 0)


def test_lists_of_any_length_are_aligned_alike():
    for n in (50, 2100):  # 2,100 children on both sides were more pairs than were aligned exactly
        page = "".join(f"<p>{k} of many</p>" for k in range(n))
        ref, tree = wrappers.outline(page), wrappers.outline(page.replace("<p>7 of many</p>", "<p>new</p>"))
        to = wrappers.match(ref, tree)
        assert [ref.text[to[k]] for k in tree.runs() if ref.text[to[k]] != tree.text[k]] == ["7 of many"]


def test_every_pair_of_children_is_looked_into():
    page = lambda n, word: "".join(f"<div><p>{word} {k}</p><p>{k * 7} {word}</p></div>" for k in range(n))
    ref, tree = wrappers.outline(page(160, "a") + "<div><p>same</p><p>last</p></div>"), wrappers.outline(page(150, "b") + "<div><p>same</p><p>other</p></div>")
    to = wrappers.match(ref, tree)
    assert [ref.text[to[k]] for k in tree.runs() if ref.text[to[k]] == tree.text[k]] == ["same"]


def test_bounds_on_memory_decide_nothing(monkeypatch):
    rng = random.Random(9)
    trees = [tuple(wrappers.outline("".join(random_page(rng, 4) for _ in range(rng.randint(0, 12)))) for _ in range(2)) for _ in range(60)]
    whole = [wrappers.match(*pair) for pair in trees]
    monkeypatch.setattr(wrappers, "HELD", 1)
    monkeypatch.setattr(wrappers, "KNOWN", 1)
    assert [wrappers.match(*pair) for pair in trees] == whole


def test_extraction_equals_the_plain_version(spark):
    """One host: layouts told by their containers, each with its own wrapper; singles use the largest one's."""
    rng = random.Random(8)
    def page(k):
        menu = "<ul><li>Home</li><li>About</li></ul>" if k % 2 else ""
        more = "".join(f"<p>{_prose(k * 50 + j)}</p>" for j in range(rng.randint(1, 4)))
        if k == 33:
            return f"<body><section><div><p>All rights are ours.</p>{more}</div></section></body>"
        return f"<body><div class=top>{menu}<p>Site {'news' if k % 3 else 'blog'}</p></div><div class=c>{more}<p>All rights are ours.</p></div></body>"
    pages = [(k, f"http://plain.org/{k}", page(k)) for k in range(40)] + [(90, "http://plain.org/90", page(4)), (91, "http://plain.org/91", None)]
    groups = {}
    for _, _, html in pages:
        tree = wrappers.outline(html or "")
        if tree.runs():
            groups.setdefault(wrappers.layout(tree), []).append(tree)
    made = {g: plain_wrapper(ts) for g, ts in groups.items() if len({tuple(t.text) for t in ts}) > 1}
    main = made[max(made, key=lambda g: (len({tuple(t.text) for t in groups[g]}), g))]
    want = {k: wrappers.main_text(html, made.get(wrappers.layout(wrappers.outline(html or "")), main) if html else None) for k, _, html in pages}
    got = {r["page_id"]: r["text"] for r in _pages(spark, pages).collect()}
    assert got == want and got[91] == "" and len(made) >= 1
    assert all("rights" not in got[k] and _prose(k * 50) in got[k] for k in range(40) if k != 33)


def test_minority_headings_stay_and_common_notices_go(spark):
    part = [(k, f"http://part/{k}", f"<body><article><h1>{_prose(k, 4)}</h1>" + ("<h2>T</h2>" * (k % 8 == 0)) + f"<p>{_prose(k)}</p>" + ("<h2>Introduction</h2>" * (k % 8 == 0)) + f"<p>{_prose(k + 900)}</p></article></body>") for k in range(64)]
    notice = " ".join(f"notice{j}" for j in range(120))
    same = [(100 + k, f"http://same/{k}", f"<body><div><p>{_prose(k, 20)}</p><p>{notice}</p></div></body>") for k in range(10)]
    out = {r["page_id"]: r["text"] for r in _pages(spark, part + same).collect()}
    for k in range(64):
        blocks = [_prose(k, 4), _prose(k), _prose(k + 900)]
        assert out[k].split("\n\n") == ([blocks[0], "T", blocks[1], "Introduction", blocks[2]] if k % 8 == 0 else blocks)
    assert all(out[100 + k] == _prose(k, 20) for k in range(10))


def test_names_within_an_article_leave_out_whole_lists_only():
    page = """<body><article><header><h1>Title</h1></header><h2 id="comments-on-history">Comments on history</h2><p id="share">Shares rose</p>
<section class="related">Related work</section><div class="alert">Mind the gap</div><div id="comments">Nice</div><div class="share-bar">Tweet</div><form>x</form></article><div class="related">Other</div></body>"""
    assert wrappers.main_text(page) == "Title\n\nComments on history\n\nShares rose\n\nRelated work\n\nMind the gap"


def test_tables_without_pages_and_with_null_columns(spark):
    schema = "page_id long, url string, html string, _host int, text string"
    assert wrappers.extract(spark.createDataFrame([], schema)).collect() == []
    rows = wrappers.extract(spark.createDataFrame([(None, None, None, 1, "x"), (1, "http://h/", "", 2, None), (1, "http://h/", "", 2, None)], schema)).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in rows) == [(0, ""), (1, ""), (1, "")]


def test_region_without_article():
    page = "<body><div class=menu><a>m</a></div><div id=main><p>A {k} long text of its own</p><p>B {k} more of it</p></div><div><p>s</p></div></body>"
    wrapper = plain_wrapper([wrappers.outline(page.format(k=f"v{k}" * 5)) for k in range(6)])
    assert wrapper.tree.path(wrapper.region) == "/body/div" and wrappers.main_text(page.format(k="q"), wrapper).startswith("A q long text")
    assert wrappers.main_text("<p>" * 3000 + "deep") == "deep"


def _pages(spark, pages):
    return wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string"))


def _prose(k, n=12):
    return " ".join(f"w{k}x{j * k % 97}" for j in range(n))


def test_templates_of_all_pages_of_a_host_are_learnt(spark):
    """Two page types, and a notice on a few of 200 pages: no small sample of pages shows all of them."""
    def page(k):
        notice = "<div class='msg'>We moved to a new address.</div>" if k % 25 == 3 else ""
        if k % 10 == 7:
            return f"<body><section>{notice}<p>Second type legend.</p><p>{_prose(k)}</p></section></body>"
        return f"<body><div>{notice}<p>{_prose(k)}</p><p>{_prose(k + 1000)}</p><p>All rights are ours.</p></div></body>"

    out = {r["page_id"]: r["text"] for r in _pages(spark, [(k, f"http://h.org/{k}", page(k)) for k in range(200)]).collect()}
    for k in range(200):
        assert out[k] == (_prose(k) if k % 10 == 7 else f"{_prose(k)}\n\n{_prose(k + 1000)}"), k


def test_templates_of_small_hosts_and_of_near_copies(spark):
    small = [(k, f"http://small.org/{k}", f"<body><div><p>{_prose(k)}</p><p>Made by us.</p></div></body>") for k in range(3)]
    near = [(10 + k, f"http://near.org/{k}", f"<body><div><p>{_prose(5, 60)}</p><p>{_prose(6, 60)}</p><p>No {k}</p></div></body>") for k in range(9)]
    out = {r["page_id"]: r["text"] for r in _pages(spark, small + near).collect()}
    assert all(out[k] == _prose(k) for k in range(3))
    assert all(out[10 + k] == f"{_prose(5, 60)}\n\n{_prose(6, 60)}\n\nNo {k}" for k in range(9))


def test_induced_region_goes_before_article(spark):
    """Main text in a div, teasers in articles; and a host with two layouts."""
    teaser = "<article><p>Teaser {}</p></article>"
    div = [(k, f"http://d/{k}", f"<body><div><section><p>{_prose(k)}</p><p>{_prose(k + 500)}</p></section></div>{teaser.format(k)}</body>") for k in range(30)]
    two = [(100 + k, f"http://t/{k}", f"<body><article><p>{_prose(k)}</p></article></body>" if k % 3 else f"<body><div><p>{_prose(k)}</p></div>{teaser.format(k)}</body>") for k in range(30)]
    out = {r["page_id"]: r["text"] for r in _pages(spark, div + two).collect()}
    assert all(out[k] == f"{_prose(k)}\n\n{_prose(k + 500)}" for k in range(30))
    assert all(out[100 + k] == _prose(k) for k in range(30))


LONG = "".join(hashlib.sha256(str(k).encode()).hexdigest()[:9] + "Zq" for k in range(600))


@pytest.mark.parametrize("text,value", [
    ("<password>aZ81kQpw</password>", "aZ81kQpw"),
    ("<ns:auth kind='x'>\n  aZ81kQpw77\n</ns:auth>", "aZ81kQpw77"),
    ("run --token aZ81kQpw77 --verbose", "aZ81kQpw77"),
    ("run --auth='aZ81 kQpw' --credential=\"aZ81kQpw77\"", "aZ81kQpw77"),
    ("run -pwd=aZ81kQpw77", "aZ81kQpw77"),
    (f"auth: {LONG}", LONG),
    (f"<credential>{LONG}</credential>", LONG),
    (f"--pwd {LONG}", LONG),
    (f'privateKey = "{LONG}"', LONG),
    (f"{'part_' * 40}pwd = aZ81kQpw77", "aZ81kQpw77"),
])
def test_all_forms_and_lengths_are_found(text, value):
    assert secrets.lexed_spans(text) == [("literal", text.index(value), text.index(value) + len(value))]


def test_constants_have_any_number_of_parts():
    parts = [f"Zq{k}w8" for k in range(40)]
    text = "\n".join(f"c{k} = '{p}'" for k, p in enumerate(parts)) + "\nall = " + " + ".join(f"c{k}" for k in range(40)) + "\npassword = all\n"
    assert [text[a:b] for _, a, b in secrets.lexed_spans(text)] == parts
    doubled = "x = 'Zq81kQpw77'\n" + "x = x + x\n" * 200 + "secret = x\n"
    assert [doubled[a:b] for _, a, b in secrets.lexed_spans(doubled)] == ["Zq81kQpw77"]


@pytest.mark.parametrize("text,parts", [
    ("DB_PASS = 'aZ81kQpw77Lm'\npassword: ${DB_PASS}\n", ["aZ81kQpw77Lm"]),
    ("K='aZ81kQpw77Lm'\nauth_key=$K\n", ["aZ81kQpw77Lm"]),
    ("set K=aZ81kQpw77Lm\nset AUTH_KEY=%K%\n", ["aZ81kQpw77Lm"]),
    ("K='aZ81kQpw77Lm'\nprivate_key = \"${K}\"", ["aZ81kQpw77Lm"]),
    ('os.environ["AUTH_KEY"] = "aZ81kQpw77Lm"', ["aZ81kQpw77Lm"]),
    ('{"auth": {"value": "aZ81kQpw77Lm"}, "other": {"value": "bZ81kQpw77Lm"}}', ["aZ81kQpw77Lm"]),
    ('auth_key = """aZ81kQ\npw77Lm9x"""', []),
    ('auth_key = """aZ81kQpw77Lm9x"""', ["aZ81kQpw77Lm9x"]),
    (r'auth_key = "aZ81\"kQ\\pw77"', [r'aZ81\"kQ\\pw77']),
    ('pwd = "Pa$$w0rd%99x7"', ["Pa$$w0rd%99x7"]),
    ("credential: Zq81%kQpw77", ["Zq81%kQpw77"]),
    ('auth_key = "aZ81kQ" + "pw77Lm9x"', ["aZ81kQ", "pw77Lm9x"]),
    ('auth_key = "aZ81kQ" "pw77Lm9x"', ["aZ81kQ", "pw77Lm9x"]),
    ('auth_key: str = "aZ81kQpw77Lm"', ["aZ81kQpw77Lm"]),
    ("url = ftp://bob:aZ81kQpw77@host.org/x", ["aZ81kQpw77"]),
    ("auth = <your-Token-12345>\nauth_key = ${MISSING}\npwd = '{{ Vault_12345 }}'", []),
])
def test_lexer_reads_the_forms_of_languages(text, parts):
    assert [text[a:b] for _, a, b in secrets.lexed_spans(text)] == parts


def test_random_assignments_equal_a_plain_evaluator():
    """Programs of assignments: the literals that reach a sensitive name are those a plain evaluator collects."""
    rng = random.Random(12)
    for _ in range(300):
        held, lines, want, serial = {}, [], set(), 0
        for _ in range(rng.randint(1, 12)):
            name, parts, code = rng.choice(["a", "b", "c", "auth_key", "pwd"]), [], []
            for _ in range(rng.randint(1, 3)):
                if held and rng.random() < 0.5:
                    other = rng.choice(sorted(held))
                    parts += held[other]
                    code.append(other)
                else:
                    serial += 1
                    parts.append(f"Zq{serial:04d}kQpw7X")
                    code.append(rng.choice(["'{}'", '"{}"', '"""{}"""']).format(parts[-1]))
            held[name] = parts
            lines.append(f"{name} = {' + '.join(code)}")
            if name in ("auth_key", "pwd"):
                want.update(parts)
        text = "\n".join(lines)
        assert {text[a:b] for _, a, b in secrets.lexed_spans(text)} == want, text


def test_options_and_elements_without_a_secret():
    assert secrets.lexed_spans("--password --token -v <key>value</key> <auth></auth> --secret required") == []


def test_field_is_the_same_in_any_slices_and_needs_less_memory(monkeypatch):
    import tracemalloc

    assert toxicity.SAMPLE == 3000
    monkeypatch.setattr(toxicity, "STEPS", 10)
    texts, labels = toxic_corpus(None, 400)
    texts, toxic = [t.encode() * 8 + b" " for _, t in texts] + [b"", b"!?"], np.array([y for _, y in labels] + [0, 1])
    fields, peaks = [], []
    for size in (1 << 40, 20_000):
        monkeypatch.setattr(toxicity, "SLICE", size)
        tracemalloc.start()
        fields.append(toxicity.fit_field(texts, toxic, np.ones(len(toxic))))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    for f in fields[1:]:
        assert np.allclose(f.weight, fields[0].weight, atol=1e-4) and np.allclose(f.trans, fields[0].trans, atol=1e-6) and np.allclose(f.doc, fields[0].doc, atol=1e-4)
    assert peaks[1] < peaks[0]
