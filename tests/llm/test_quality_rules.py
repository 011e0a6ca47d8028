from __future__ import annotations

import random
import re
from collections import Counter

import corpus
from siltworks.llm import quality_rules


def expected(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", " ", "\n\n", "a\na\n \n \nb a", "x " * 40, "a b c d e a b c d e f", "é" * 9 + "\x0b*#|\x1c z", "\x85 \xa0x y"]
    texts += ["".join(rng.choices("ab c\n*", k=rng.randint(0, 300))) for _ in range(150)]
    texts += [" ".join(rng.choices("abc", k=rng.randint(0, 40))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in quality_rules.measure(df).collect()}
    assert found == {i: expected(t) for i, t in enumerate(texts)}


def test_awkward_rows(docs):
    judged = quality_rules.judge(docs).collect()
    assert len(judged) == docs.count()
    assert all(expected(r["text"]) == tuple(r[c] for c in COLUMNS) for r in judged)
    assert not any(r["kept"] for r in judged if r["base_failed"])
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["kept"] for r in kept.collect()} == {"k"}  # the input's own column
    assert kept.count() == sum(r["kept"] for r in judged)


def test_fences_follow_the_group(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        source = ("plain", "code")[i % 2]
        words = corpus.text(rng, "en", 60).split()
        if source == "code" or i % 20 == 2:  # symbols are usual in one source and rare in the other
            words = [w + "*" if k % 3 == 0 else w for k, w in enumerate(words)]
        rows.append((i, " ".join(words), "en", source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    gone = {r["doc_id"] for r in quality_rules.judge(df).filter("not kept").collect()}
    assert gone == {i for i in range(0, 400, 2) if i % 20 == 2}


def test_small_groups_take_the_fences_of_larger_ones(spark):
    rng = random.Random(5)
    rows = [(i, corpus.text(rng, "en", 60), "en", "large") for i in range(200)]
    rows += [(1000 + i, " ".join(w + "#" for w in corpus.text(rng, "en", 15).split()), "en", "small") for i in range(3)]
    rows += [(2000 + i, corpus.text(rng, "en", 60), "en", "small") for i in range(3)]
    rows += [(3000 + i, " ".join(w + "#" for w in corpus.text(rng, "de", 15).split()), "de", None) for i in range(3)]  # no language as large
    rows += [(4000, corpus.text(rng, "de", 60), None, "large")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    gone = {r["doc_id"] for r in quality_rules.judge(df).filter("not kept").collect()}
    assert gone == {1000, 1001, 1002, 3000, 3001, 3002}
    alone = {r["doc_id"] for r in quality_rules.judge(df, by=()).filter("not kept").collect()}
    assert alone == gone


def test_empty(no_docs):
    assert quality_rules.judge(no_docs).count() == 0
    assert quality_rules.keep_good(no_docs).count() == 0
