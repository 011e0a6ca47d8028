from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np

import corpus
from siltworks.llm import near_dup


def sets_of(rows, width):
    out = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        n = min(width, len(w))
        out[doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
    return out


def expected(rows, width, percent=80):
    sets = sets_of(rows, width)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def planted(seed):
    """Groups of edited copies around and away from a base, chains, exact copies, and unrelated texts."""
    rng = random.Random(seed)
    rows, doc_id = [], 0
    for group in range(12):
        base = corpus.text(rng, "en", 150).split()
        for _ in range(rng.choice([1, 2, 6, 25])):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"edit{rng.random()}"
            rows.append((doc_id, " ".join(words)))
            doc_id += 1
            if group % 3 == 0:
                base = words  # each copy is made from the last one
    return rows


def test_components_equal_brute_force(spark):
    rows = planted(3)
    df = spark.createDataFrame(corpus.shuffled(rows), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.cluster(df, width=4).collect()}
    assert found == expected(rows, 4)


def test_awkward_rows(docs, no_docs):
    out = near_dup.cluster(docs, width=5).collect()
    assert len(out) == docs.count()
    by = defaultdict(set)
    for r in out:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[100] == {(0, 100, True)} and by[101] == {(0, 101, True)} and by[102] == {(0, 102, True)}
    assert {c for _, c, _ in by[104]} == {103} and {c for _, c, _ in by[106]} == {105}
    assert {(c, k) for n, c, k in by[None] if n} == {(105, False)}
    assert by[107] == {(1, 107, True)} and by[108] == {(1, 108, True)}
    one = near_dup.keep_one(docs)
    assert one.columns == docs.columns
    ids = [r["doc_id"] for r in one.collect()]
    assert ids.count(105) == 1 and 106 not in ids and 104 not in ids and ids.count(None) == 1
    assert near_dup.cluster(no_docs).count() == 0 and near_dup.keep_one(no_docs).count() == 0


def test_texts_that_share_a_key_stay(spark):
    a, b, c = (corpus.text(random.Random(i), "en", 40) for i in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "x"), (2, a, "x"), (3, c, "x"), (3, c, "y"), (None, b, "x"), (None, None, "x"), (1, "", "x"), (1, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = sorted(((r["doc_id"], r["text"]) for r in near_dup.keep_one(df).collect()), key=repr)
    assert kept == sorted([(1, a), (1, b), (3, c), (None, None), (1, ""), (1, "")], key=repr)


def common_passage(seed):
    """Texts that share passages and differ elsewhere, and edits of a base that use the same few words."""
    rng = random.Random(seed)
    passages, base = [corpus.text(rng, "en", 30) for _ in range(3)], corpus.text(rng, "de", 60).split()
    rows = [" ".join([*rng.sample(passages, rng.randint(1, 2)), corpus.text(rng, "fr", rng.randint(2, 40))]) for _ in range(60)]
    for _ in range(80):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(["red", "green"])
        rows.append(" ".join(words[: rng.choice([60, 60, 52, 45])]))
    return list(enumerate(rows))


def test_common_passages_and_edits(spark):
    rows = common_passage(1)
    df = spark.createDataFrame(corpus.shuffled(rows), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in near_dup.cluster(df, width=4).collect()}
    assert found == {i: c for i, (_, c) in expected(rows, 4).items()}


def test_partners_of_a_frequent_node_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "PARTNERS", 4)
    rows = planted(9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dup.cluster(df, width=4).collect()}
    assert found == {i: c for i, (_, c) in expected(rows, 4).items()}


def test_bands_find_similar_pairs():
    """Of pairs with similarity 0.8, hardly one shares no table."""
    rng, half, missed = np.random.default_rng(1), near_dup.Bands(), 0
    for _ in range(400):
        both = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
        a, b = (half.of(np.concatenate([both, rng.integers(0, 1 << 63, 20, dtype=np.uint64)])) for _ in range(2))
        missed += not ((a == b)[: near_dup.BANDS].any() and (a == b)[near_dup.BANDS :].any())
    assert missed <= 4


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["root"] for r in near_dup.components(df).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
