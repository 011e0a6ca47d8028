from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import corpus
import corpus_pipeline
import test_mixing
import test_near_dup
import test_quality_rules
import tokenizers
from siltworks.llm import quality_rules, queries
from siltworks.session import stored


def test_stages(spark, tmp_path):
    rows = corpus.awkward()
    corpus.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stored(stage(spark, docs, str(tmp_path)), "stage")
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        seen.append(ids)
        if name != "encoding":
            assert docs.columns == before
            assert {(r["kept"], r["score"], r["size"], r["node"]) for r in docs.collect()} == {("k", "s", "z", "n")}
    good = [r[0] for r in rows if not test_quality_rules.expected(r[1])[-1]]
    assert sorted(seen[0], key=repr) == sorted(good, key=repr)
    assert not {100, 101, 102, 107, 108, 109} & set(seen[1])
    assert 104 not in seen[2] and 106 not in seen[2] and seen[2].count(105) == 1
    assert max(seen[3].count(i) for i in set(seen[3])) <= 3
    assert sorted(seen[3], key=repr) == sorted(seen[4], key=repr)


def planted_corpus():
    """Three languages, junk, near copies in groups and chains, texts that share an id."""
    rng = random.Random(11)
    rows = []
    for i in range(90):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, corpus.text(rng, lang, rng.randint(60, 140)), lang, f"s{i % 2}"))
    for k, i in enumerate((0, 1, 2, 5, 9)):
        words = rows[i][1].split()
        for c in range(4):
            words[rng.randrange(len(words))] = f"edit{k}{c}"
            rows.append((200 + 10 * k + c, " ".join(words), rows[i][2], rows[i][3]))
    rows += [(300 + i, " ".join(w + "#*|" for w in corpus.text(rng, "en", 40).split()), "en", "s0") for i in range(4)]
    rows += [(310 + i, corpus.text(rng, "de", 4), "de", "s1") for i in range(4)] + [(320, "one two three four five six " * 20, "en", "s0")]
    rows += [(0, corpus.text(rng, "en", 90), "en", "s0"), (400, None, "en", "s0"), (401, "", None, None)]
    return [(*r, None if r[1] is None else len(r[1]), "k", "s", "z", "n") for r in rows]


def fences(rows):
    """Documents that the quality rules keep: quartiles by sorting, per group, language and all."""
    measured = {}
    for i, r in enumerate(rows):
        n, chars, symbols, dup, repeats, failed = test_quality_rules.expected(r[1])
        lines = [x for x in (r[1] or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        if not failed:
            measured[i] = (symbols / chars, dup / len(lines), repeats / n, chars / n)
    groups = defaultdict(list)
    for i in measured:
        for key in ((rows[i][2], rows[i][3]), (rows[i][2],), ()):
            groups[key].append(i)
    kept = []
    for i, own in measured.items():
        keys = [(rows[i][2], rows[i][3]), (rows[i][2],), ()]
        group = next((groups[k] for k in keys if len(groups[k]) >= quality_rules.LEAST_GROUP or not k))
        good = True
        for at, ratio in enumerate(quality_rules.RATIOS):
            values = sorted(measured[j][at] for j in group)
            half, upper = (values[math.ceil(q * len(values)) - 1] for q in (0.5, 0.75))
            good &= own[at] <= upper + max(quality_rules.SPREADS * (upper - half), ratio.margin)
        if good:
            kept.append(rows[i])
    return kept


def test_stages_equal_brute_force(spark, tmp_path):
    rows = planted_corpus()
    corpus.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs, out = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), "stage")
        out.append([tuple(r) for r in docs.collect()])
    named = lambda found: sorted((r[0], r[1]) for r in found)
    assert named(out[0]) == named(fences(rows))
    assert {r[0] for r in out[0]}.isdisjoint({300, 301, 302, 303, 310, 311, 312, 313, 320, 400, 401})
    # Every text here is of one language, so none is rejected.
    assert named(out[1]) == named(out[0])
    sets = test_near_dup.sets_of(list(enumerate(r[1] for r in out[1])), corpus_pipeline.SHINGLE)
    joined = test_near_dup.expected(list(enumerate(r[1] for r in out[1])), corpus_pipeline.SHINGLE, corpus_pipeline.SIMILAR)
    groups = defaultdict(list)
    for i in sets:
        groups[joined[i][1]].append((out[1][i][0], out[1][i][1]))
    assert named(out[2]) == sorted(min(g) for g in groups.values())
    copies = Counter(named(out[3]))
    assert set(copies) <= set(named(out[2])) and max(copies.values()) <= 3
    sizes, taken, source = Counter(), Counter(), {(r[0], r[1]): r[3] for r in out[2]}
    for doc, s in source.items():
        sizes[s] += len(doc[1].split())
        taken[s] += len(doc[1].split()) * copies[doc]
    goal = test_mixing.shared_out([sizes[s] for s in sorted(sizes)], [5, 2, 1][: len(sizes)])
    assert all(abs(taken[s] - t) <= 0.02 * t for s, t in zip(sorted(sizes), goal, strict=True))
    library = tokenizers.Tokenizer.from_file(queries.vocabulary())
    texts = Counter()
    for doc_id, text in copies.elements():
        found = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(found, skip_special_tokens=False)
        texts[doc_id, struct.pack(f"<{len(found)}I", *found), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    last = docs.select("doc_id", "ids", "decoded_sha256").collect()
    assert Counter((r[0], bytes(r[1]), r[2]) for r in last) == texts


def test_empty(spark, tmp_path):
    corpus.frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
