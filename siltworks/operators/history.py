"""Versioned (type 2) history: building it, and finding the version valid at an instant.

A version is valid in ``[valid_from, valid_to)``; the open version has no ``valid_to``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.dates import half_open, open_end
from siltworks.functions.keys import version_key
from siltworks.operators import timeline
from siltworks.session import cut_lineage

VALID_FROM, VALID_TO = "valid_from", "valid_to"

# A version table is broadcast if it has at most this many rows and bytes, and no key has more versions than
# each fact row should be compared with.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
BROADCAST_VERSIONS_PER_KEY = 200

# Versions of a key that a fact is compared with at least, before they are cut into chapters.
CHAPTER = 64


def start_history(source: DataFrame, updated_at: str) -> DataFrame:
    """First snapshot: every row is an open version that starts at its own clock."""
    open_until = F.lit(None).cast(source.schema[updated_at].dataType)
    return source.withColumns({VALID_FROM: F.col(updated_at), VALID_TO: open_until})


def snapshot(history: DataFrame, source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The history after one look at a mutable table with one row per key.

    A new key opens a version. A row whose clock is later than the open version closes that version
    at the new clock and opens the next. An equal or older row changes nothing, and a key that left
    the source stays open. Closed versions pass through unchanged and are not shuffled.
    """
    columns = source.columns
    clock = F.col(f"_new.{updated_at}")
    before = [F.col(f"_old.{c}").alias(c) for c in [*columns, VALID_FROM]]
    after = [F.col(f"_new.{c}").alias(c) for c in columns]
    kept = F.struct(*before, F.col(f"_old.{VALID_TO}").alias(VALID_TO))
    closed = F.struct(*before, clock.alias(VALID_TO))
    fresh = F.struct(*after, clock.alias(VALID_FROM), F.col("_open_end").alias(VALID_TO))

    is_open = F.col(VALID_TO).isNull()
    old = history.filter(is_open).select(F.col(key).alias("_key"), F.struct(*columns, VALID_FROM, VALID_TO).alias("_old"))
    new = source.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    both = old.join(new, "_key", "full_outer").withColumn(
        "_open_end", F.lit(None).cast(history.schema[VALID_TO].dataType)
    )
    versions = (
        F.when(F.col("_old").isNull(), F.array(fresh))
        .when(clock > F.col(f"_old.{VALID_FROM}"), F.array(closed, fresh))
        .otherwise(F.array(kept))
    )
    current = both.select(F.inline(versions))
    order = [*columns, VALID_FROM, VALID_TO]
    return history.filter(~is_open).select(*order).unionByName(current.select(*order))


def dimension(history: DataFrame, key: str, attributes: Sequence[str], surrogate: str) -> DataFrame:
    """The dimension a history gives: surrogate key, bounds without nulls, current flag."""
    return history.select(
        version_key(F.col(key), F.col(VALID_FROM)).alias(surrogate),
        key,
        *attributes,
        F.col(VALID_FROM).cast("timestamp_ntz").alias("effective_start_date"),
        F.coalesce(F.col(VALID_TO).cast("timestamp_ntz"), open_end()).alias("effective_end_date"),
        F.col(VALID_TO).isNull().alias("is_current"),
    )


def history_from_log(
    log: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    rows_per_slot: int = timeline.ROWS_PER_SLOT,
) -> DataFrame:
    """The same history from a change log, in one run: each change is valid until the next.

    Of several changes of a key at one instant the last stands, in the order of ``attributes``; so no version is
    empty, and key and start identify a version. Changes without an instant are left out. The log is shuffled once.
    """
    changes = log.filter(F.col(ts).isNotNull()).select(key, *attributes, F.col(ts).alias(VALID_FROM))
    followed = timeline.next_instant(changes, [key], VALID_FROM, VALID_TO, attributes, rows_per_slot)
    return followed.filter(F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col(VALID_FROM)))


def can_broadcast(
    versions: DataFrame,
    key: str,
    rows: int = BROADCAST_ROWS,
    versions_per_key: int = BROADCAST_VERSIONS_PER_KEY,
    size: int = BROADCAST_BYTES,
) -> bool:
    """Whether the versions fit every executor, and few enough of each key are compared with a fact. Runs a job."""
    width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 16 for c in versions.columns), F.lit(0))
    sizes = versions.groupBy(key).agg(F.count("*").alias("n"), F.sum(width).alias("bytes"))
    total = [F.coalesce(f, F.lit(0)).alias(n) for n, f in (("rows", F.sum("n")), ("most", F.max("n")), ("bytes", F.sum("bytes")))]
    found = sizes.agg(*total).first()
    return found["rows"] <= rows and found["most"] <= versions_per_key and found["bytes"] <= size


def _by_chapters(fact: DataFrame, side: DataFrame, fact_key: str, ts: str, attach: Sequence[str], rows_per_slot: int) -> DataFrame:
    """The interval join as equalities: a fact meets one row with the versions that may be valid, and keeps those that are.

    The versions of a key are one such row if they are few. If some key has more than ``CHAPTER``, versions are numbered by start
    and cut into chapters of about the root of the most that a key has; a chapter also holds the versions that reach into it, and a fact first
    learns its chapter from the starts of all of its key's. Facts are read once, neither sorted by time nor counted, and a
    frequent key is a skewed join, which adaptive execution splits.
    """
    most = side.groupBy("_version_of").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    entry = F.struct("_start", "_end", *attach)
    if most <= CHAPTER:
        book = side.filter("_version_of is not null").groupBy("_version_of").agg(F.collect_list(entry).alias("_versions"))
        found = fact.join(book, F.col(fact_key) == F.col("_version_of"), "left")
    else:
        each = max(CHAPTER, math.isqrt(most))
        ranked = side.filter("_version_of is not null")
        ranked = timeline.running(ranked, ["_version_of"], "_start", F.lit(1), "_rank", F.sum, ["_end"], rows_per_slot, inclusive=True)
        ranked = cut_lineage(ranked.withColumn("_chapter", F.floor((F.col("_rank") - 1) / each).cast("int")).drop("_rank"))
        firsts = ranked.groupBy("_version_of", "_chapter").agg(F.min("_start").alias("_first"))
        index = firsts.groupBy("_version_of").agg(F.array_sort(F.collect_list("_first")).alias("_firsts"))
        before = lambda c, o: F.size(F.filter("_firsts", lambda f: (f <= F.col(c)) if o else (f < F.col(c)))) - 1
        reach = F.sequence(F.col("_chapter"), F.greatest("_chapter", before("_end", False)))
        chapters = ranked.join(index, "_version_of").withColumn("_chapter", F.explode(reach))
        chapters = chapters.groupBy("_version_of", "_chapter").agg(F.collect_list(entry).alias("_versions"))
        placed = fact.join(index.withColumnRenamed("_version_of", "_of"), F.col(fact_key) == F.col("_of"), "left")
        placed = placed.withColumn("_at", before(ts, True)).drop("_of", "_firsts")
        found = placed.join(chapters, (F.col(fact_key) == F.col("_version_of")) & (F.col("_at") == F.col("_chapter")), "left")
    valid = F.filter("_versions", lambda v: (v["_start"] <= F.col(ts)) & (F.col(ts) < v["_end"]))
    found = found.select(*(F.col(f"`{c}`") for c in fact.columns), F.explode_outer(valid).alias("_version"))
    return found.select(*(F.col(f"`{c}`") for c in fact.columns), *(F.col(f"_version.{c}") for c in attach))


def point_in_time(
    fact: DataFrame,
    versions: DataFrame,
    fact_key: str,
    ts: str,
    attach: Mapping[str, str],
    key: str,
    start: str = "effective_start_date",
    end: str = "effective_end_date",
    strategy: str = "auto",
    rows_per_slot: int = timeline.ROWS_PER_SLOT,
) -> DataFrame:
    """Left join each fact to the versions valid at its instant; ``attach`` is ``{output: version column}``.

    A fact without a version stays, with nulls; a fact with several has a row for each. All strategies give these
    rows at any size. ``broadcast`` is a hash join on the key with the interval as residual condition, hinted only if
    ``can_broadcast`` says so. ``chapters`` joins each fact with a row of the versions that may be valid, however many there are, and
    whether they overlap or not. ``auto`` takes the first if it fits. Runs jobs that size up the versions, not the facts.
    """
    if strategy not in ("auto", "broadcast", "chapters"):
        raise ValueError(f"unknown strategy {strategy!r}")
    side = versions.filter(F.col(start) < F.col(end)).select(
        F.col(key).alias("_version_of"),
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        *[F.col(c).alias(out) for out, c in attach.items()],
    )
    small = strategy != "chapters" and can_broadcast(side, "_version_of")
    if small or strategy == "broadcast":
        valid = (F.col(fact_key) == F.col("_version_of")) & half_open(F.col(ts), F.col("_start"), F.col("_end"))
        return fact.join(F.broadcast(side) if small else side, valid, "left").drop("_version_of", "_start", "_end")
    return _by_chapters(fact, side, fact_key, ts, list(attach), rows_per_slot)


def coverage(fact: DataFrame, version_column: str, by: Sequence[str] = ()) -> DataFrame:
    """Facts that found no version."""
    unmatched = F.count("*") - F.count(version_column)
    return fact.groupBy(*by).agg(F.count("*").alias("rows_total"), unmatched.alias("rows_unmatched"))


def missing_keys(fact: DataFrame, versions: DataFrame, fact_key: str, key: str) -> DataFrame:
    """Keys that have facts but no version at all, with the facts they hold."""
    used = fact.filter(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias(key)).agg(F.count("*").alias("rows_fact"))
    return used.join(versions.select(key).distinct(), key, "left_anti")
