from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import corpus
import numpy as np
import pytest

from siltworks.llm import queries, runs

SPACE = re.compile("[^\x20\x09-\x0d]+")


def brute(words, least=24, cycles=3):
    """All maximal stretches by comparing each word with the one q before, for all q."""
    n, out = len(words), {}
    for q in range(1, n // cycles + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, cycles * q):
                out.setdefault((start, i + q - start), q)
            i = max(i, start + 1)
    return sorted((s, length, q) for (s, length), q in out.items())


def repetitive(rng):
    n, k = rng.randint(0, 240), rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a = rng.randrange(n)
        p, end = rng.randint(1, max(1, (n - a) // 3)), rng.randint(a, n)
        for i in range(a, end):
            words[i] = words[a + (i - a) % p]
    return words


def test_cover():
    for d in range(1, runs.V):
        assert [(a - b) % runs.V for a in runs.COVER for b in runs.COVER].count(d) == 1


def test_extensions():
    rng = random.Random(1)
    for _ in range(300):
        words = repetitive(rng) or [0]
        index, n = runs.Extensions(np.array(words, np.int64)), len(words)
        pairs = [sorted(rng.sample(range(n + 1), 2)) for _ in range(40)]
        found = index.of(*(np.array(c) for c in zip(*pairs, strict=True)))
        for (i, j), length in zip(pairs, found.tolist(), strict=True):
            assert words[i : i + length] == words[j : j + length]
            assert j + length == n or words[i + length] != words[j + length]


@pytest.mark.parametrize(("table", "pairs"), [(runs.TABLE, runs.PAIRS), (10, 200)])
def test_runs(table, pairs, monkeypatch):
    monkeypatch.setattr(runs, "TABLE", table)
    monkeypatch.setattr(runs, "PAIRS", pairs)
    rng, grid, met = random.Random(2), runs.Grid(), 0
    for _ in range(600):
        words = repetitive(rng)
        want = brute(words)
        assert runs.find_runs(np.array(words, np.int64), grid) == want
        met += len(want)
    assert met > 200
    for _ in range(100):
        words = repetitive(rng)
        assert runs.find_runs(np.array(words, np.int64), grid, 9, 4) == brute(words, 9, 4)


def test_long_texts():
    start = time.time()
    for p in (1, 2, 777, 30_000):
        assert runs.find_runs(np.arange(100_000) % p, runs.Grid()) == [(0, 100_000, p)]
    assert runs.find_runs(np.arange(500_000), runs.Grid()) == []
    assert time.time() - start < 60


def test_detect(spark, no_docs):
    rows = corpus.awkward() + [(900, "la " * 400_000, "en", "s", 1, "k", "s", "z", "n"), (901, "x\x1cy z\x0b" * 30, "en", "s", 1, "k", "s", "z", "n")]
    got = runs.detect(corpus.frame(spark, rows), keep=["doc_id", "kept", "size"]).collect()
    assert len(got) == len(rows) and {(r["kept"], r["size"]) for r in got} == {("k", "z")}
    for r in got:
        if r["doc_id"] == 900:
            assert [tuple(x) for x in r["runs"]] == [(0, 400_000, 1)] and r["collapsed"] == "la"
        if r["doc_id"] == 901:
            assert [tuple(x) for x in r["runs"]] == [(0, 60, 2)] and r["collapsed"] == "x\x1cy z"
        if r["doc_id"] == 100:
            assert (r["n_words"], r["runs"], r["collapsed"]) == (0, [], "")
    assert runs.detect(no_docs).count() == 0
    with pytest.raises(ValueError, match="three"):
        runs.detect(no_docs, cycles=2)


def test_query(spark, tmp_path):
    """The registered query against brute force, with planted repetitions of its own."""
    rng = random.Random(6)
    rows = corpus.awkward()
    rows += [(200 + i, " ".join(f"w{k}" for k in repetitive(rng)), "en", "s", 1, "k", "s", "z", "n") for i in range(150)]
    corpus.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for key, text, *_ in rows:
        words = SPACE.findall(text or "")
        n, h = len(words), zlib.crc32(str(key).encode())
        if key is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found, kept = (brute(words) if n < 1000 else runs.find_runs(runs.Numbers().of([w.encode() for w in words]), runs.Grid())), [True] * n
        for s, length, q in found:
            kept[s + q : s + length] = [False] * (length - q)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        rest = " ".join(w for w, k in zip(words, kept, strict=True) if k)
        milli = 1000 * best[1] // best[2] if found else None
        want.append((key, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest()))
    got = [tuple(r) for r in queries.op13_difference_cover_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(w[1] for w in want) > 30
