from __future__ import annotations

import math

import numpy as np
import pytest

from siltworks.llm import ann

SCHEMA = "vec_id long, embedding array<float>, rank string, score string"


def nearest(rows, q, v, k):
    """Distances of all other rows with a usable vector of the same length, nearest first."""
    out = []
    for i, x in rows:
        if i is not None and i != q and x is not None and len(x) == len(v):
            out.append((math.sqrt(sum((np.float64(np.float32(a)) - np.float64(np.float32(b))) ** 2 for a, b in zip(x, v, strict=True))), i))
    return sorted(set(out))[:k]


def usable(x):
    return x is not None and len(x) > 0 and all(c is not None and math.isfinite(c) for c in x) and any(x)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "r", "s") for i, x in rows], SCHEMA)


@pytest.mark.parametrize("clusters", [0, 30])
def test_recall(spark, clusters, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24))
    if clusters:
        x = rng.normal(size=(clusters, 24))[rng.integers(0, clusters, len(x))] + 0.3 * x
    rows = [(i, [float(c) for c in r.astype(np.float32)]) for i, r in enumerate(x)]
    df = frame(spark, rows)
    found = {}
    for r in ann.search(df, df.filter("vec_id % 50 = 0")).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hits = 0
    for q in range(0, 1500, 50):
        want = {i for _, i in nearest(rows, q, rows[q][1], 10)}
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 11)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
        hits += len(want & {g[2] for g in got})
    assert hits >= 0.9 * 300


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(60)]  # many ties and equal vectors
    rows += [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 2.0]), (104, [nan, 1.0, 1.0]), (105, [inf, 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (200, [1.0, 2.0]), (300, [3.0, 1.0]), (0, [0.0, 1.0, 0.0])]
    df = frame(spark, rows)
    good = [(i, x) for i, x in rows if usable(x)]
    found = {}
    for r in ann.search(df, df.filter("vec_id % 20 = 0")).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    for q, x in {(i, tuple(x)) for i, x in good if i is not None and i % 20 == 0}:
        got = [g[1:] for g in sorted(found[q])]
        want = nearest(good, q, x, 10)
        assert [i for _, i in got] == [i for _, i in want]
        assert [d for d, _ in got] == pytest.approx([d for d, _ in want])
    assert set(found) == {0, 20, 40, 200, 300}


def test_empty(spark):
    df = frame(spark, [])
    assert ann.search(df, df).count() == 0
    df = frame(spark, [(0, None), (1, [0.0])])
    assert ann.search(df, df).count() == 0


def test_codes():
    x = np.random.default_rng(1).normal(size=(50, 8))
    codes = ann.prefix_codes(x, x.mean(axis=0))
    bits = ann.common_bits(codes[:, None, :], codes[None, :, :])
    for a, b, t in ((0, 1, 0), (3, 9, 5), (4, 4, 2)):
        sa, sb = (format(int(codes[i, t]), f"0{ann.BITS}b") for i in (a, b))
        assert bits[a, b, t] == next((k for k in range(ann.BITS) if sa[k] != sb[k]), ann.BITS)
    assert ann.stop_length(np.array([5, 3, 2, 1]), 3) == 2 and ann.stop_length(np.array([1, 0]), 9) == 0


def test_parts_take_no_candidates(spark, monkeypatch):
    """Rows outside of the clusters need shorter prefixes than the sampled queries; parts must not change what they find."""
    rng = np.random.default_rng(3)
    crowds = [c + 0.01 * rng.normal(size=8) for c in 5 * np.array([np.ones(8), -np.ones(8)]) for _ in range(750)]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate([*crowds, *(9 * rng.normal(size=(6, 8)))])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    monkeypatch.setattr(ann, "SAMPLE", 2)
    asked = df.filter("vec_id % 25 = 0 or vec_id >= 1500")
    results = []
    for block in (16_384, 20):
        monkeypatch.setattr(ann, "BLOCK", block)
        results.append(sorted(map(tuple, ann.search(df, asked).select("query_id", "rank", "vec_id").collect())))
    assert results[0] == results[1]
    assert len(results[1]) == 66 * 10
