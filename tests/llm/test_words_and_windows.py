"""Word hashing, window dedup and the near-duplicate join against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from ebbtide.llm import components, jaccard, words, window_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, score double, n long"


def rows_of(texts):
    return [(i, t, 0.5, 1) for i, t in texts]


def test_equal_words_have_equal_hashes_across_cuts():
    rng = random.Random(1)
    pool = ["".join(rng.choice("abcdé日") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = [[rng.choice(pool) for _ in range(rng.randint(0, 80))] for _ in range(50)]
    blobs = [" ".join(t).encode() for t in texts] + [None, b"", b" \t\n"]
    h, bounds = words.hash_words(blobs)
    flat = [w for t in texts for w in t]
    assert np.diff(bounds).tolist() == [len(t) for t in texts] + [0, 0, 0]
    names = {}
    for w, x in zip(flat, h.tolist(), strict=True):
        assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000)).encode()
    whole, _ = words.hash_words([text])
    monkeypatch.setattr(words, "SEGMENT", 1000)
    parts, bounds = words.hash_words([b"x", text, b"y z"])
    assert bounds.tolist() == [0, 1, 5001, 5003] and (parts[1:5001] == whole).all()


def brute_windows(texts, width):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in texts]
    for i, w in split:
        if i is None:
            continue
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((-1 if i is None else i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_windows_match_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [" ".join(f"p{k}{rng.randint(0, 30)}" for _ in range(20)) for k in range(4)]
    texts = [(0, None), (1, ""), (2, " \n\t "), (None, passages[0]), (3, "short text")]
    for i in range(4, 60):
        parts = [" ".join(f"u{rng.randint(0, 5 if i % 7 == 0 else 5000)}" for _ in range(rng.randint(0, 30))) for _ in range(3)]
        texts.append((i, "  ".join(p for pair in zip(parts, rng.choices([*passages, ""], k=3), strict=True) for p in pair)))
    texts += [(70, texts[10][1]), (71, texts[10][1]), (71, texts[10][1]), (72, texts[11][1]), (72, texts[12][1])]
    df = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(5)
    got = window_dedup.digest(window_dedup.drop_repeated_windows(df, window=8)).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == brute_windows(texts, 8)


def test_windows_of_an_empty_table(spark):
    assert window_dedup.drop_repeated_windows(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_components(texts):
    sets = []
    for _, t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(texts):
        least[find(i)].append(d)
    return sorted((d, len(sets[i]), min(least[find(i)])) for i, (d, _) in enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rng = random.Random(seed)
    texts = [(0, None), (1, ""), (2, "  "), (3, "One two"), (4, "one TWO"), (5, "one two three"), (6, "One")]
    base = [[f"w{rng.randint(0, 40)}" for _ in range(rng.choice([6, 9, 14, 30, 80]))] for _ in range(9)]
    common = ["license", "terms", "apply", "to", "all", "of", "this", "work"]
    for i in range(7, 130):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w))
            w[k : k + 1] = rng.choice([[f"x{rng.randint(0, 9)}"], [], [w[k].upper(), "y"]])
        texts.append((i, " ".join(w + (common if i % 3 == 0 else []))))
    df = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(4)
    got = jaccard.similar_documents(df).collect()
    assert sorted(map(tuple, got)) == brute_components(texts)


def test_group_of_near_copies_is_one_component_with_few_checks(spark):
    """A chain of thousands of copies must not become all of its pairs."""
    rng = random.Random(5)
    core = [f"c{i}" for i in range(60)]
    texts = [(i, " ".join(core + [f"own{i}"])) for i in range(1500)]
    rng.shuffle(texts)
    out = jaccard.similar_documents(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    assert {r["component_id"] for r in out} == {0} and len(out) == 1500


def test_join_of_an_empty_table(spark):
    assert jaccard.similar_documents(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_star_rounds_find_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(40)] + [(rng.randint(50, 120), rng.randint(50, 120)) for _ in range(40)]
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["a"]: r["b"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
