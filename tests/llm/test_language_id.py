from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

import corpus
from siltworks.llm import language_id


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(corpus.text(rng, lang, 80), lang) for lang in ("en", "de", "fr") for _ in range(30)]
    return language_id.collect_model(language_id.learn(spark.createDataFrame(rows, "text string, lang string")))


def test_held_out_accuracy(spark, model):
    rng = random.Random(2)
    rows = [(corpus.text(rng, lang, rng.randint(5, 60)), lang) for lang in ("en", "de", "fr") for _ in range(60)]
    found = language_id.identify(spark.createDataFrame(rows, "text string, lang string"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_mixtures_get_their_shares(spark, model):
    rng = random.Random(3)
    rows = [(corpus.text(rng, "en", 300) + " " + corpus.text(rng, "de", 100),), (corpus.text(rng, "fr", 300),)]
    mixed, plain = language_id.identify(spark.createDataFrame(rows, "text string"), model).collect()
    assert [x["lang"] for x in mixed["languages"]] == ["en", "de"] and mixed["lang_pred"] == "en"
    assert 0.55 < mixed["score"] < 0.9 and sum(x["share"] for x in mixed["languages"]) == pytest.approx(1, abs=1e-3)
    assert [x["lang"] for x in plain["languages"]] == ["fr"]


def em(p, n, steps=400):
    """Shares of the columns of p, and the log likelihood, fitted until nothing moves."""
    shares = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(steps):
        w = p * shares
        shares = (w * (n / w.sum(axis=1))[:, None]).sum(axis=0) / n.sum()
    return shares, float((n * np.log((p * shares).sum(axis=1))).sum())


def test_sets_equal_brute_force():
    """The set chosen is the best of all sets of languages by penalised likelihood, also one of five and six."""
    rng = np.random.default_rng(5)
    names = list("abcdefg")
    p = rng.dirichlet(np.full(400, 0.15), len(names)).T + 1e-6
    model = language_id.Model(names, np.log(p / p.sum(axis=0)).astype(np.float32))
    p = np.exp(model.log_p.astype(np.float64))
    texts, sizes = [], []
    for size in (1, 2, 3, 4, 5, 5, 6, 6):
        chosen = rng.choice(len(names), size, replace=False)
        drawn = np.concatenate([rng.choice(400, 150, p=p[:, c] / p[:, c].sum()) for c in chosen])
        texts.append(np.unique(drawn, return_counts=True))
        sizes.append(size)
    shares, _ = language_id.mixtures(model, texts)
    for (bins, n), row, size in zip(texts, shares, sizes, strict=True):
        cost = language_id.PENALTY + 0.5 * np.log(n.sum())
        sets = [s for k in range(1, len(names) + 1) for s in combinations(range(len(names)), k)]
        best = max(sets, key=lambda s: em(p[bins][:, list(s)], n)[1] - (len(s) - 1) * cost)  # noqa: B023
        assert set(np.flatnonzero(row > 0)) == set(best) and len(best) == size
        assert row[list(best)] == pytest.approx(em(p[bins][:, list(best)], n)[0], abs=0.05)


def test_many_labels_are_handed_on(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(corpus.text(rng, "en", 10), f"l{i % 7}") for i in range(70)]
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    whole = sorted(map(tuple, language_id.learn(df).collect()))
    monkeypatch.setattr(language_id, "HELD", 2)
    assert sorted(map(tuple, language_id.learn(df).collect())) == whole


def test_awkward_rows(docs, no_docs, model):
    found = language_id.identify(docs, model)
    assert found.columns == [*(c for c in docs.columns if c != "score"), "lang_pred", "score", "languages"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"], r["languages"]) == ("und", 0.0, [])
        else:
            assert r["lang_pred"] in ("en", "de", "fr")
    assert len({r["score"] for r in rows if r["doc_id"] == 105}) == 1
    assert language_id.identify(no_docs, model).count() == 0
    nothing = language_id.collect_model(language_id.learn(no_docs))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_too_many_languages_raise(docs):
    with pytest.raises(ValueError, match="more than 1"):
        language_id.collect_model(language_id.learn(docs), most_languages=1)


def test_held_out_parts(spark):
    df = spark.createDataFrame([(1,), (None,), (7,)], "doc_id long").withColumn("out", language_id.held_out("doc_id", 1, 0))
    assert [r["out"] for r in df.collect()] == [True, False, True]
