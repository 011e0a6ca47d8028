"""Small corpora with the awkward rows that every operator must bear."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, size string, node string"
SYLLABLES = {"en": "the ing er an re tion ly of".split(), "de": "sch ung der ein ü ver keit".split(), "fr": "eau oi é ment aux è".split()}


def text(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def awkward(seed: int = 1) -> list[tuple]:
    """Null and blank texts, a very long one, repeated rows, ties, a null key; extra columns with clashing names."""
    rng = random.Random(seed)
    long, plain = text(rng, "en", 30_000), text(rng, "en", 60)
    rows = [(i, text(rng, lang, rng.randint(20, 120)), lang, f"s{i % 3}") for i, lang in enumerate(["en", "de", "fr"] * 12)]
    rows += [
        (100, None, "en", "s0"), (101, "", "en", None), (102, " \n\t ", None, "s1"), (103, long, "en", "s1"), (104, long + " end", "en", "s2"),
        (105, plain, "en", "s0"), (105, plain, "en", "s0"), (106, plain, "en", "s1"), (None, plain, None, None), (None, None, None, None),
        (107, "a b", "en", "s0"), (108, "a b c", "en", "s0"), (109, "!!! *** 123", "de", "s9"), (110, "Ünïcode ΑΣ İ 中文 text\x1cx", "fr", "s9"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), "k", "s", "z", "n") for r in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def shuffled(rows: list[tuple], seed: int = 5) -> list[tuple]:
    return random.Random(seed).sample(rows, len(rows))
