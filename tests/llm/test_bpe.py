from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

import corpus
from siltworks.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


def texts():
    rng = random.Random(3)
    odd = [chr(i) for i in [*range(0x250), *range(0x300, 0x330), 0x3A3, 0x130, 0x2028, 0x3000, 0x200B, 0x212B, 0x1F600, 0x4E2D, 0x1100, 0x1161]]
    out = ["", " ", "don't WE'LL", "ΑΣ", "a\x1cb", "<|endoftext|>x<|startoftext|>", "ab" * 300, "x" * 5000, "á ́"]
    for _ in range(400):
        letters = odd if rng.random() < 0.4 else list("abc thein'sre  llvd123!?<|>\n")
        out.append("".join(rng.choices(letters, k=rng.choice([3, 10, 40, 300]))))
    return out


def test_equals_the_library(spark, library):
    cases = texts()
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    out = bpe.decode(bpe.encode(df, PATH), PATH).select("doc_id", "ids", "decoded", bpe.ids_array().alias("list")).collect()
    for r in out:
        want = ids_of(library, cases[r["doc_id"]])
        assert np.frombuffer(r["ids"], "<u4").tolist() == want == r["list"]
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_short_and_long_words_agree():
    v = bpe.Vocabulary(open(PATH, encoding="utf-8").read())
    rng = random.Random(6)
    for _ in range(300):
        word = "".join(rng.choices("theinrsao", k=rng.randint(2, 60))).encode()
        start = [*(v.inner[b] for b in word[:-1]), v.last[word[-1]]]
        assert v._short(list(start)) == v._long(list(start))


def test_awkward_rows(docs, no_docs, library):
    out = bpe.encode(docs, PATH)
    assert out.columns == [*docs.columns, "ids"]
    for r in out.collect():
        assert hashlib.sha256(r["ids"]).digest() == hashlib.sha256(np.array(ids_of(library, r["text"] or ""), "<u4").tobytes()).digest()
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    memory = bpe.Memory(bpe.Vocabulary(open(PATH, encoding="utf-8").read()))
    words = corpus.text(random.Random(1), "en", 50).split()
    assert [memory[w] for w in words] == [memory.run(w) for w in words] and len(memory) <= 3
