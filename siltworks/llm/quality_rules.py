"""Quality rules with adaptive thresholds, in column expressions only.

Counts of each text are turned into ratios. For every language and source a mergeable quantile sketch
(``percentile_approx``) summarises each ratio, and a document is rejected where a ratio lies above the fence of its
own group: the upper quartile plus a multiple of the distance between median and upper quartile, at least a margin
for groups whose documents are all alike. No cutoff on a ratio is fixed; what is usual in the group decides. Groups of fewer than
``LEAST_GROUP`` documents are judged by the sketch of their language, or of all documents.

Defined results: a null or empty text has no words and is rejected; a null language or source is a group of its own;
repeated rows are judged one by one; an empty table gives an empty result. Columns of the input are kept; in ``judge``
the ones added (``MEASURES`` and ``kept``) replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.words import words
from siltworks.session import stored

#: Characters that are markup rather than language (fixed by the contract).
SYMBOLS = "[#*$%&|<>]"
#: A line counts if it has a word.
WORD_IN_LINE = "[^\\x20\\x09-\\x0D]"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "base_failed")


@dataclass(frozen=True)
class Ratio:
    """A ratio of counts, and how far above the group's upper quartile it may always lie."""

    name: str
    top: str
    bottom: str
    margin: float


RATIOS = (
    Ratio("symbols", "n_symbols", "word_chars", 0.04),
    Ratio("dup_lines", "n_dup_lines", "n_lines", 0.34),
    Ratio("repeats", "n_repeat_words", "n_words", 0.16),
    Ratio("word_length", "word_chars", "n_words", 3.0),
)
SPREADS = 4.0
#: Documents from which a group has fences of its own.
LEAST_GROUP = 20
ACCURACY = 2000
#: Groups whose thresholds may be broadcast: at about 100 bytes a row, 20 MB.
MOST_BROADCAST = 200_000


def _pairs(left: Column, right_from: int, width: int) -> Column:
    return F.slice(left, F.lit(right_from), F.greatest(width, F.lit(0)))


def _both(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """The input with ``MEASURES``. Arrays are columns of their own, so that each is computed once a row."""
    out = df.withColumn("_t", F.coalesce(F.col(text), F.lit(""))).withColumn("_w", words("_t"))
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda x: x.rlike(WORD_IN_LINE))
    out = out.withColumns(
        {
            "_lines": lines,
            "_h": F.transform("_w", lambda w: F.xxhash64(w)),
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": F.regexp_count("_t", F.lit(SYMBOLS)).cast("long"),
        }
    )
    n = F.size("_h")
    out = out.withColumns(
        {
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_p": F.zip_with(_pairs(F.col("_h"), 1, n - 1), _pairs(F.col("_h"), 2, n - 1), _both),
        }
    )
    n = F.size("_p")
    out = out.withColumn("_q", F.zip_with(_pairs(F.col("_p"), 1, n - 2), _pairs(F.col("_p"), 3, n - 2), _both))
    n = F.size("_q")
    out = out.withColumn("_v", F.zip_with(_pairs(F.col("_q"), 1, n - 1), _pairs(F.col("_h"), 5, n - 1), _both))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    indexed = F.sort_array(F.transform("_v", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("_s", F.when(F.size(F.array_distinct("_v")) < F.size("_v"), indexed).otherwise(none))
    n = F.size("_s")
    # Each window with the one before and after it in order of hash: equal neighbours are repeats.
    before = F.concat(F.array(F.lit(None).cast("bigint")), F.transform("_s", lambda x: x["h"]))
    out = out.withColumn("_b", F.slice(before, F.lit(1), F.greatest(n, F.lit(0))))
    after = F.concat(
        _pairs(F.transform("_s", lambda x: x["h"]), 2, n - 1), F.array(F.lit(None).cast("bigint"))
    )
    out = out.withColumn("_a", F.when(n > 0, after).otherwise(F.array().cast("array<bigint>")))
    repeated = F.filter(
        F.arrays_zip("_s", "_b", "_a"),
        lambda x: x["_s"]["h"].eqNullSafe(x["_b"]) | x["_s"]["h"].eqNullSafe(x["_a"]),
    )
    out = out.withColumn("_r", F.sort_array(F.transform(repeated, lambda x: x["_s"]["i"])))
    n = F.size("_r")
    steps = F.zip_with(_pairs(F.col("_r"), 2, n - 1), _pairs(F.col("_r"), 1, n - 1), lambda b, a: F.least(b - a, F.lit(WINDOW)))
    covered = F.when(n > 0, F.aggregate(steps, F.lit(WINDOW), lambda x, y: x + y)).otherwise(0)
    out = out.withColumn("n_repeat_words", covered.cast("long"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("_t", "_w", "_lines", "_h", "_p", "_q", "_v", "_s", "_b", "_a", "_r")


def _ratio(r: Ratio) -> Column:
    return F.when(F.col(r.bottom) > 0, F.col(r.top) / F.col(r.bottom)).otherwise(0.0)


def thresholds(measured: DataFrame, by: Sequence[str], ratios: Sequence[Ratio] = RATIOS, least: int = LEAST_GROUP) -> DataFrame:
    """One row per group with the fence of each ratio, from sketches over all its documents that pass the base rules.

    A group with fewer than ``least`` of these takes the fences of the next larger one that has as many: of its language, say, then of
    all documents.

    The sketches are merged from partial ones, so a group that holds a third of all rows is no burden to one task.
    """
    sketches = [F.percentile_approx(_ratio(r), F.array(F.lit(0.5), F.lit(0.75)), F.lit(ACCURACY)).alias(r.name) for r in ratios]
    fences = [
        (F.col(r.name)[1] + F.greatest(SPREADS * (F.col(r.name)[1] - F.col(r.name)[0]), F.lit(r.margin))).alias(f"_most_{r.name}")
        for r in ratios
    ]
    keys = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    rows = measured.filter(~F.col("base_failed")).select(*keys, *(c for c in MEASURES))
    names = [f"_by{i}" for i in range(len(by))]
    most = [f"_most_{r.name}" for r in ratios]
    # Sketches of all groups, of those that share all but the last column, and so on to all rows, from one pass.
    level = F.grouping_id() if names else F.lit(0)
    rolled = (rows.rollup(*names) if names else rows.groupBy()).agg(*sketches, F.count("*").alias("_n"), level.alias("_level"))
    rolled = stored(rolled.select(*names, *fences, "_n", "_level"), "sketches")
    found = rolled.filter("_level = 0").select(*names, F.when((F.col("_n") >= least) | F.lit(not names), F.struct(*most)).alias("_fences"))
    for k in range(1, len(names) + 1):
        shared = names[: len(names) - k]
        parent = rolled.filter(F.col("_level") == (1 << k) - 1)
        enough = (F.col("_n") >= least) | F.lit(not shared)
        parent = parent.select(*(F.col(c).alias(f"_of{c}") for c in shared), F.when(enough, F.struct(*most)).alias("_parent"), F.lit(k).alias("_k"))
        same = F.col("_k") == F.lit(k)
        for c in shared:
            same = same & F.col(c).eqNullSafe(F.col(f"_of{c}"))
        found = found.withColumn("_mine", F.lit(k)).join(parent, same & (F.col("_mine") == F.col("_k")), "left")
        found = found.select(*names, F.coalesce("_fences", "_parent").alias("_fences"))
    return found.select(*names, "_fences.*")


def _judged(df: DataFrame, text: str, by: Sequence[str], ratios: Sequence[Ratio]) -> DataFrame:
    """``_row``, a struct of the input's columns, with ``MEASURES`` and ``kept``; so names of the input can't clash."""
    measured = stored(measure(df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row")), f"_row.`{text}`"), "quality")
    groups = [f"_row.`{c}`" for c in by]
    limits = stored(thresholds(measured, groups, ratios), "thresholds")
    few = limits.count() <= MOST_BROADCAST
    same = F.lit(True)
    for i, c in enumerate(groups):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    joined = measured.join(F.broadcast(limits) if few else limits, same, "left")
    within = F.lit(True)
    for r in ratios:
        within = within & F.coalesce(_ratio(r) <= F.col(f"_most_{r.name}"), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & within)


def judge(df: DataFrame, text: str = "text", by: Sequence[str] = ("lang", "source"), ratios: Sequence[Ratio] = RATIOS) -> DataFrame:
    """The input with ``MEASURES`` and ``kept``.

    Starts jobs: the measured rows are written once to the shared folder, since both the sketches and the filter
    read them. The thresholds are broadcast if counted to be few; otherwise Spark joins by shuffle.
    """
    added = (*MEASURES, "kept")
    own = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c not in added]
    return _judged(df, text, by, ratios).select(*own, *added)


def keep_good(df: DataFrame, text: str = "text", by: Sequence[str] = ("lang", "source")) -> DataFrame:
    """The rows that pass, with the columns of the input."""
    return _judged(df, text, by, RATIOS).filter("kept").select("_row.*")
