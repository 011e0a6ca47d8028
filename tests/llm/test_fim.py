from __future__ import annotations

import hashlib
import random
import re

import corpus
import pytest
from pyspark.sql import functions as F

from siltworks.llm import fim

TOKENS = re.compile("[A-Za-z]+|[^A-Za-z]")


def expected(key, text):
    """Tokens, form, characters of prefix and middle, and output, by cutting a list of all tokens."""
    text = text or ""
    units = TOKENS.findall(text)
    n = len(units)
    if key is None:
        return n, "plain", None, None, text
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def awkward_text(rng, shared):
    parts = ["a", "Bc", "é", "中", " ", "\n", "\t", "😀", "<", "<P", "S>", "0", "\x00", "x" * rng.randint(1, 500), rng.choice(shared)]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))


def test_chunks_cover_texts_and_repeat():
    rng = random.Random(1)
    passage = corpus.text(rng, "fr", 2000).encode()
    one, two = b"q" * 1000 + passage + b"z" * 500, corpus.text(rng, "en", 700).encode() + passage
    ends = [fim.chunk_ends(t) for t in (one, two)]
    pieces = [{t[a:b] for a, b in zip([0, *e], e, strict=False)} for t, e in zip((one, two), ends, strict=True)]
    assert len(pieces[0] & pieces[1]) > 10
    for t, e in zip((one, two), ends, strict=True):
        assert e[-1] == len(t) and all(fim.LEAST_CHUNK <= b - a <= fim.MOST_CHUNK for a, b in zip([0, *e], e[:-1], strict=False))
    assert fim.chunk_ends(b"") == [] and fim.chunk_ends(b"a") == [1]


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_blocks_change_no_chunk(block, monkeypatch):
    rng = random.Random(2)
    text = corpus.text(rng, "de", 3000).encode()
    whole = fim.chunk_ends(text)
    monkeypatch.setattr(fim, "BLOCK", block)
    assert fim.chunk_ends(text) == whole


def test_summaries_combine():
    rng = random.Random(3)
    shared = [corpus.text(rng, "de", 300) for _ in range(4)]
    known = fim.Summaries(30_000)
    for _ in range(400):
        text = awkward_text(rng, shared)
        units = TOKENS.findall(text)
        counted = fim.Counted(text.encode(), known)
        assert counted.n == len(units)
        for k in (0, rng.randint(0, len(units)), len(units)):
            pre = "".join(units[:k])
            assert counted.cut(k) == (len(pre.encode()), len(pre))
    assert known.hits > 100 and known.held <= 30_000


def test_summaries_are_verified(monkeypatch):
    """Chunks of one name but another content are summed up by themselves."""
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda chunk: 7)
    known = fim.Summaries()
    assert known.of(b"ab cd") == (3, 5, True, True) and known.of(b"  ") == (2, 2, False, False) and known.of(b"ab cd") == (3, 5, True, True)


def test_outputs(spark):
    rng = random.Random(4)
    shared = [corpus.text(rng, "en", 500) for _ in range(3)]
    rows = corpus.awkward() + [(1000 + i, awkward_text(rng, shared), "en", "s", 1, "k", "s", "z", "n") for i in range(300)]
    rows += [(2000, "a" * 1_500_000, "en", "s", 1, "k", "s", "z", "n"), (2001, "é b\n" * 400_000, "en", "s", 1, "k", "s", "z", "n")]
    df = fim.transform(corpus.frame(spark, rows), keep=["doc_id", "kept", "score"])
    got = df.withColumn("back", fim.restored()).collect()
    want = sorted(((r[0], *expected(r[0], r[1]), r[1] or "") for r in rows), key=repr)
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got), key=repr) == want
    assert {"plain", "psm", "spm"} == {r["form"] for r in got} and {(r["kept"], r["score"]) for r in got} == {("k", "s")}


def test_shares_and_empty(spark, no_docs):
    assert fim.transform(no_docs).count() == 0
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    forms = {r["form"]: r["count"] for r in fim.transform(docs, plain=40, spm=50).groupBy("form").count().collect()}
    assert 1050 < forms["plain"] < 1350 and 750 < forms["psm"] < 1050 and 750 < forms["spm"] < 1050
