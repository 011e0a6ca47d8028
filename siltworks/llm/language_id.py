"""Language identification as a mixture: which languages is a text made of, and in which shares?

Each learned language is a distribution over letter trigrams (byte trigrams of the lower-case text, hashed to
``BINS``). Expectation-maximisation finds the shares of all languages in a text. A larger set of languages never fits
worse, so sets are compared by penalised likelihood: each language after the first costs ``PENALTY`` plus half
the logarithm of the number of trigrams. Where even all languages together gain less than one such cost, one
language is chosen at once; else the sets of the 1, 2, ... largest shares are fitted and compared, up to the size from which
even the fit of all languages could not pay for one more.

Learning counts trigrams in Arrow tasks, which hold ``HELD`` languages at once; Spark sums their partial counts. The model is a table of at most
``MOST_LANGUAGES * BINS`` counts, some 130 MB at worst and 1 MB for four languages, which bounds the broadcast. Texts are
scored whole and one by one, without a shuffle.

Defined results: null text, or text without a letter, is ``und`` with score 0 and no shares; equal texts get equal
results, ties go to the language first in order; with no learned language every text is ``und``; empty tables give
empty results. Columns named ``lang_pred``, ``score`` and ``languages`` in the input are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.words import added_schema, by_value

BINS = 1 << 16
MOST_LANGUAGES = 500
SMOOTHING = 0.1
STEPS = 15
PENALTY = 8.0
#: Languages whose counts a task holds before it hands them on.
HELD = 64
#: Elements (distinct trigrams of texts) that are fitted at once.
ELEMENTS = 300_000
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
_LETTERS_ONLY = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Bins of the trigrams whose middle is a letter, in order."""
    b = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_LETTERS_ONLY) + b" ", np.uint8).astype(np.uint32)
    mid = b[1:-1]
    bins = (b[:-2] * np.uint32(40503) + mid * np.uint32(2654435761) + b[2:] * np.uint32(97)) >> np.uint32(3)
    return (bins & np.uint32(BINS - 1))[mid != 32]


def learn(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Counts ``lang, bin, n`` over all rows with a language and a text."""
    rows = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, own in counts.items():
                at = np.flatnonzero(own)
                columns = [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "bin", "n"])
            counts.clear()

        for batch in batches:
            for lang_, text_ in zip(batch.column(0), batch.column(1), strict=True):
                name = lang_.as_py()
                if name not in counts and len(counts) == HELD:
                    yield from out()
                own = counts.setdefault(name, np.zeros(BINS, np.int64))
                own += np.bincount(trigrams(text_.as_py()), minlength=BINS)
        yield from out()

    return rows.mapInArrow(task, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Log probabilities of trigrams, one column per language, in order of their names."""

    languages: list[str]
    log_p: np.ndarray


def collect_model(counts: DataFrame, most_languages: int = MOST_LANGUAGES) -> Model:
    """The learned table on the driver; more languages than ``most_languages`` raise."""
    names = [r[0] for r in counts.select("lang").distinct().orderBy("lang").limit(most_languages + 1).collect()]
    if len(names) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    packed = counts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("all"))
    table = np.full((BINS, max(len(names), 1)), SMOOTHING)
    for row in packed.toLocalIterator():
        pairs = np.array([(x[0], x[1]) for x in row["all"]], np.int64)
        table[pairs[:, 0], names.index(row["lang"])] += pairs[:, 1]
    return Model(names, np.log(table / table.sum(axis=0)).astype(np.float32))


def _fit(p: np.ndarray, n: np.ndarray, starts: np.ndarray, total: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares after EM from the given ones (zero stays zero), and the log likelihood relative to ``p``'s scale."""
    sizes = np.diff(np.append(starts, len(n)))
    for _ in range(STEPS):
        w = p * np.repeat(shares, sizes, axis=0)
        w *= (n / w.sum(axis=1))[:, None]
        shares = np.add.reduceat(w, starts, axis=0) / total[:, None]
    fit = (p * np.repeat(shares, sizes, axis=0)).sum(axis=1)
    return shares, np.add.reduceat(n * np.log(np.maximum(fit, 1e-30)), starts)


def mixtures(model: Model, texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """For texts given by distinct bins and counts: shares of the chosen set, and the score of its largest."""
    counts = np.array([len(b) for b, _ in texts])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    log_p = model.log_p[np.concatenate([b for b, _ in texts])]
    top = log_p.max(axis=1)
    p = np.exp(log_p - top[:, None])
    n = np.concatenate([c for _, c in texts]).astype(np.float32)
    total = np.add.reduceat(n, starts)
    width = len(model.languages)
    single = np.add.reduceat(n[:, None] * (log_p - top[:, None]), starts, axis=0).astype(np.float64)
    shares, all_fit = _fit(p, n, starts, total, np.full((len(texts), width), 1 / width, np.float32))
    best = single.argmax(axis=1)
    chosen = np.zeros((len(texts), width))
    chosen[np.arange(len(texts)), best] = 1
    odds = np.exp(single - single.max(axis=1)[:, None])
    score = 1 / odds.sum(axis=1)
    cost = PENALTY + 0.5 * np.log(np.maximum(total, 1))
    value = single.max(axis=1)
    order = np.argsort(-shares, axis=1, kind="stable")
    for k in range(2, width + 1):
        # No set fits better than all languages, so from here on only these can gain.
        mixed = np.flatnonzero(all_fit - (k - 1) * cost > value)
        if not len(mixed):
            break
        keep = np.concatenate([np.arange(starts[i], starts[i] + counts[i]) for i in mixed])
        begin = np.concatenate([[0], np.cumsum(counts[mixed])[:-1]])
        start = np.zeros((len(mixed), width), np.float32)
        np.put_along_axis(start, order[mixed, :k], np.float32(1 / k), axis=1)
        fitted, fit = _fit(p[keep] + np.float32(1e-12), n[keep], begin, total[mixed], start)
        better = fit - (k - 1) * cost[mixed] > value[mixed]
        at = mixed[better]
        value[at] = (fit - (k - 1) * cost[mixed])[better]
        chosen[at] = fitted[better]
        score[at] = fitted[better].max(axis=1)
    return chosen, np.clip(score, 0, 1)


def identify(df: DataFrame, model: Model, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``languages``, the chosen set with shares, largest first.

    ``keep`` names the columns to pass on; all, if it is not given.
    """
    added = ("lang_pred", "score", "languages")
    rows = df.select(F.col(text).alias("_read"), *(F.col(f"`{c}`") for c in (df.columns if keep is None else keep) if c not in added))
    shipped = df.sparkSession.sparkContext.broadcast((model.languages, model.log_p))
    set_kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shipped.value)
        for batch in batches:
            yield from _identified(own, batch, set_kind)

    new = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    return rows.mapInArrow(task, added_schema(rows.schema[1:], new))


def _identified(model: Model, batch: pa.RecordBatch, set_kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The batch with its results, in slices of about ``ELEMENTS``."""
    at, queue, results = 0, [], []
    for i in range(batch.num_rows):
        text = batch.column(0)[i].as_py()
        bins = trigrams(text) if text and model.languages and _LETTER.search(text) else None
        if bins is None or not len(bins):
            queue.append(None)
        elif len(bins) < 4000:
            queue.append(np.unique(bins, return_counts=True))
        else:
            every = np.bincount(bins, minlength=BINS)
            found = np.flatnonzero(every)
            queue.append((found, every[found]))
        if i + 1 == batch.num_rows or sum(len(q[0]) for q in queue[-256:] if q) > ELEMENTS or len(queue) == 256:
            results = _results(model, queue)
            part = batch.slice(at, len(queue))
            made = [pa.array(x, kind) for x, kind in zip(results, (pa.string(), pa.float64(), set_kind), strict=True)]
            names = [*part.schema.names[1:], "lang_pred", "score", "languages"]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *made], names)
            at, queue = i + 1, []


def _results(model: Model, queue: list) -> tuple[list, list, list]:
    preds, scores, sets = [UNDETERMINED] * len(queue), [0.0] * len(queue), [[] for _ in queue]
    known = [i for i, q in enumerate(queue) if q]
    if known:
        shares, score = mixtures(model, [queue[i] for i in known])
        for i, row, s in zip(known, shares, score, strict=True):
            order = [k for k in np.argsort(-row, kind="stable") if row[k] > 0]
            preds[i], scores[i] = model.languages[order[0]], float(s)
            sets[i] = [{"lang": model.languages[k], "share": float(row[k])} for k in order]
    return preds, scores, sets


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text falls into the part that is not learned from; a null key does not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == part, F.lit(False))


def unsure(least: float) -> Column:
    """Whether a text has no language, or no language with that share."""
    return (F.col("lang_pred") == UNDETERMINED) | (F.col("score") < least)


by_value(sys.modules[__name__])
