from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus
from siltworks.llm import mixing


def shared_out(sizes, weights, most=3):
    """Share by weight, cut, share the excess again among those below, until none is above."""
    target = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), set(range(len(sizes)))
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        for i in list(open_):
            target[i] += left * weights[i] / total
        left = 0.0
        for i in list(open_):
            if target[i] >= most * sizes[i]:
                left += target[i] - most * sizes[i]
                target[i] = most * sizes[i]
                open_.discard(i)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sources = [None, *sorted(f"s{i}" for i in range(7))][seed % 2 :]
    sizes = [rng.choice([0, 1, 50, 400, 9000]) for _ in sources]
    order = sorted(range(len(sources)), key=lambda i: (sources[i] is None, sources[i] or ""))
    weights = [0] * len(sources)
    for turn, i in enumerate(order):
        weights[i] = (5, 2, 1)[turn % 3]
    df = spark.createDataFrame(list(zip(sources, sizes, strict=True)), "_source string, source_size long")
    found = {r["_source"]: r["target"] for r in mixing.targets(df, (5, 2, 1)).collect()}
    for s, t in zip(sources, shared_out(sizes, weights), strict=True):
        assert found[s] == pytest.approx(t, rel=1e-9, abs=1e-6)


def test_mix_meets_targets(spark):
    rng = random.Random(8)
    rows = [(i, corpus.text(rng, "en", rng.choice([1, 5, 30, 80])), f"s{min(i % 7, 3)}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(df).withColumn("taken", F.col("size") * F.col("copies")).join(df, "doc_id")
    for r in plan.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("t"), F.max("copies").alias("m")).collect():
        assert abs(r["taken"] - r["t"]) <= max(3, 0.002 * r["t"]) and r["m"] <= 3
    again = mixing.plan_mix(df.repartition(5))
    first = {r["doc_id"]: r["copies"] for r in plan.collect()}
    assert first == {r["doc_id"]: r["copies"] for r in again.collect()}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(first.values())


def test_frequent_class_is_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 10)
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), (F.when(F.col("id") < 300, "x").otherwise("y")).alias("source"))
    plan = mixing.plan_mix(df).join(df, "doc_id").groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"), F.max("target").alias("t"))
    for r in plan.collect():
        assert abs(r["n"] - r["t"]) < 3


def test_awkward_rows(docs, no_docs):
    plan = mixing.plan_mix(docs)
    assert plan.count() == docs.count()
    assert plan.filter("size = 0 and size * copies <> 0").count() == 0
    assert plan.filter("copies not between 0 and 3 or copies is null").count() == 0
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.plan_mix(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0


def test_texts_that_share_a_key_have_their_own_copies(spark):
    """One key, or none, for a third of all rows: copies go to texts, and ranks split them."""
    rng = random.Random(3)
    rows = [(1 if i % 3 == 0 else None if i % 3 == 1 else i, f"t{i} " + corpus.text(rng, "en", 9), f"s{i % 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = [r["text"] for r in mixing.mix(df).collect()]
    by = {s: sum(10 * mixed.count(t) for _, t, source in rows if source == s) for s in ("s0", "s1")}
    # Targets are 5/7 and 2/7 of 3000 words.
    assert abs(by["s0"] - 3000 * 5 / 7) <= 15 and abs(by["s1"] - 3000 * 2 / 7) <= 15
    assert max(mixed.count(t) for _, t, _ in rows) <= 3
