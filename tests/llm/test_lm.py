from __future__ import annotations

import math
import pickle
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus
from siltworks.llm import lm


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 1), (5, 10), (1000, 5000), (5000, 1 << 40), (70_000, 1 << 33)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, top, n)).astype(np.uint64)
    level = lm.EliasFano(lm.elias_fano(values, "x"), "x")
    asked = np.concatenate([values, rng.integers(0, 2 * top + 100, 1000).astype(np.uint64)])
    place = {int(v): i for i, v in enumerate(values)}
    assert level.find(asked).tolist() == [place.get(int(v), -1) for v in asked]
    assert level.get(np.arange(len(values))).tolist() == values.tolist()


def test_shard_is_a_distribution():
    rng, v = np.random.default_rng(0), 200
    draw = lambda: (rng.zipf(1.5, 20_000) % v).astype(np.uint64)
    keys = np.unique(draw() << np.uint64(32) | draw() << np.uint64(16) | draw())
    unigram = rng.random(v)
    unigram /= unigram.sum()
    shard = lm.Shard(lm.build_shard(keys, rng.geometric(0.5, len(keys)).astype(np.int64), unigram))
    for root, before in ((1, 1), (1, 2), (3, 7), (150, 199), (199, 0)):
        every = (np.uint64(root) << np.uint64(32)) | (np.uint64(before) << np.uint64(16)) | np.arange(v).astype(np.uint64)
        assert (10 ** shard.log_p(every, np.log10(unigram))).sum() == pytest.approx(1, abs=0.03)


def test_packing():
    a = np.sort(np.random.default_rng(1).integers(0, 1 << 60, 1000)).astype(np.uint64)
    assert (lm._sums(lm.unpack(lm._deltas(a), np.uint64)) == a).all()
    assert len(lm.unpack(lm.pack(a[:0]), np.uint64)) == 0


def base_scores(learned, texts):
    counts = Counter()
    for t in learned:
        counts.update((t or "").encode().lower().split())
        counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for t in texts:
        tokens = [*(t or "").encode().lower().split(), None]
        out.append((len(tokens), sum(counts[x] > 0 for x in tokens), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_scores(spark, monkeypatch, small):
    if small:  # several shards, frequent words dealt further, many words in the one class, short runs
        monkeypatch.setattr(lm, "SHARD_TOKENS", 300)
        monkeypatch.setattr(lm, "CLASSES", 40)
        monkeypatch.setattr(lm, "RUN_TOKENS", 200)
    rng = random.Random(5)
    shared = corpus.text(rng, "en", 200).split()
    rows = [(i, " ".join(shared[k : k + 40] + corpus.text(rng, "en", 20).split())) for i, k in enumerate(rng.choices(range(160), k=120))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = lm.train(df.filter("doc_id % 4 <> 0"))
    found = {r["doc_id"]: r for r in lm.score(df, model).collect()}
    for (i, _), want in zip(rows, base_scores([t for i, t in rows if i % 4], [t for _, t in rows]), strict=True):
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["base_score"] == pytest.approx(want[3])
    held = [r for i, r in found.items() if i % 4 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_awkward_rows(docs, no_docs):
    model = lm.train(docs)
    out = lm.score(docs, model).collect()
    assert len(out) == docs.count()
    texts = [r["text"] for r in docs.collect()]
    got = sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out)
    assert got == sorted((n, k, round(b, 6)) for n, k, _, b in base_scores(texts, texts))
    assert len({r["score"] for r in out if r["doc_id"] == 105}) == 1
    nothing = lm.train(no_docs)
    assert lm.score(no_docs, nothing).count() == 0
    assert lm.score(docs, nothing).filter(F.col("n_known") > 0).count() == 0


def whole_model(learned, texts, least=1):
    """Scores of the model on plain words, without classes, shards or codes."""
    def trigrams(t):
        w = [None, None, *(t or "").encode().lower().split(), None]
        return list(zip(w, w[1:], w[2:], strict=False))

    tri = Counter(x for t in learned for x in trigrams(t))
    uni = Counter(x[2] for x in tri.elements())
    bi = Counter((b, c) for _, b, c in tri)
    d2, d3 = lm.discount(np.array(list(bi.values()))), lm.discount(np.array(list(tri.values())))
    total, kinds, seen, share = Counter(), Counter(), Counter(), Counter()
    for (b, _), n in bi.items():
        total[b] += n
        kinds[b] += 1
    for (a, b, _), n in tri.items():
        seen[a, b] += n
    for (a, b, _), n in tri.items():
        share[a, b] += (n - d3) / seen[a, b] * (n >= least)

    def p(a, b, c):
        low = (uni[c] + 1) / (sum(uni.values()) + len(uni) + 1)
        if total[b]:
            low = max(0, bi[b, c] - d2) / total[b] + d2 * kinds[b] / total[b] * low
        n = tri[a, b, c]
        return ((n - d3) / seen[a, b] if n >= least else 0) + (1 - share[a, b]) * low if seen[a, b] else low

    return [sum(math.log10(p(*x)) for x in trigrams(t)) for t in texts]


def zipf_rows(n=80):
    rng = np.random.default_rng(7)
    return [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 5000)) for i in range(n)]


def compare_with_whole_model(spark, least):
    rows = zipf_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["score"] for r in lm.score(df, lm.train(df.filter("doc_id % 4 <> 0"))).collect()}
    want = whole_model([t for i, t in rows if i % 4], [t for _, t in rows], least)
    off = [abs(found[i] - w) / 61 for (i, _), w in zip(rows, want, strict=True)]
    assert max(off) < 0.01


def test_rare_words_are_words_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(lm, "CLASSES", 5)
    monkeypatch.setattr(lm, "RUN_TOKENS", 200)  # texts in several parts
    compare_with_whole_model(spark, lm.LEAST_TRIGRAM)


def test_shards_of_frequent_roots_share_their_bigrams(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 300)
    compare_with_whole_model(spark, lm.LEAST_TRIGRAM)


def test_trigrams_met_once_have_entries(spark):
    compare_with_whole_model(spark, 1)


def test_workers_need_no_package(spark):
    classes = lm.Classes(np.array([3, 5], np.uint64), np.array([1, 0], np.uint32), np.array([2, 1]), 3, 2, 1)
    shared = lm.sent(spark, classes)
    assert b"siltworks" not in pickle.dumps(shared.value)
    assert lm.received(shared).numbers(np.array([5, 4, 3], np.uint64)).tolist() == [0, -1, 1]


def test_trigrams_as_differences():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 4000):
        keys = np.unique(rng.zipf(1.4, (n, 3)) % 900, axis=0).reshape(-1, 3).astype(np.int64)
        back = lm.unpacked_keys(*lm.packed_keys(*keys.T))
        assert all((a == b).all() and len(a) == len(keys) for a, b in zip(back, keys.T, strict=True))


def test_memory_of_a_trie():
    rng, v = np.random.default_rng(2), 5000
    root, before, word = (rng.integers(0, v, 300_000).astype(np.int32) for _ in range(3))
    order = np.lexsort((word, before, root))
    root, before, word = root[order], before[order], word[order]
    n, unigram = np.ones(len(root), np.int32), np.full(v, 1 / v)
    tracemalloc.start()
    trie = lm.build_trie(root, before, word, n, unigram)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(lm.Shard(trie).a["p3.code"]) == len(root)
    assert most < 160 * len(root)


def test_words_are_those_of_bytes(monkeypatch):
    texts = [b" A  b\x0b\x0c\r\tc ", b"", b" \n", b"a\x1cB\xc2\x85\xc2\xa0c\x00 \xff\xc3 d", "É é İ".encode(), b"a b a", None, b"x" * 99]
    monkeypatch.setattr(lm, "SLICE_BYTES", 10)
    column = pa.array([b"cut off", *texts], pa.binary()).slice(1)
    found, at = [], 0
    for first, part in lm.slices(column):
        assert first == at
        hashes, place, lengths = lm.distinct_words(part)
        assert len(np.unique(hashes)) == len(hashes)
        found += np.split(hashes[place], np.cumsum(lengths)[:-1])
        at += len(part)
    assert [f.tolist() for f in found] == [[xxhash.xxh3_64_intdigest(w) for w in (t or b"").lower().split()] for t in texts]


def test_texts_are_read_once_for_all_scores(spark, monkeypatch):
    """Once for the names of rows and once for all words; base scores had a pass of their own."""
    monkeypatch.setattr(lm, "CLASSES", 5)
    rows = zipf_rows(40)
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.train(df)
    found = {r["doc_id"]: r for r in lm.score(df.mapInArrow(counting, df.schema), model).collect()}
    assert read.value == 2 * len(rows)
    for (i, t), want in zip(rows, base_scores([t for _, t in rows], [t for _, t in rows]), strict=True):
        assert (found[i]["n_tokens"], found[i]["n_known"], found[i]["train_tokens"]) == want[:3]
        assert found[i]["base_score"] == pytest.approx(want[3])
