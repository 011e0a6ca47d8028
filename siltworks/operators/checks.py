"""Table checks. Each returns the offenders: no rows means that the check passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.operators import timeline
from siltworks.session import cut_lineage


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in one of the columns, and which; all columns in one pass."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.filter(any_null).withColumn("null_columns", missing)


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a null is not compared."""
    return df.dropna("any", subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with the number of rows that carry them.

    Child rows are counted per key before the join, so a key that many rows share is one row there.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias("key")).distinct()
    return used.join(known, "key", "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Values outside the list, with their rows; null is accepted."""
    return df.filter(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def _in_range(column: str, low: object | None, high: object | None, inclusive: bool) -> Column:
    value, ok = F.col(column), F.lit(True)
    if low is not None:
        ok = ok & (value >= low if inclusive else value > low)
    if high is not None:
        ok = ok & (value <= high if inclusive else value < high)
    return ok


def accepted_range(
    df: DataFrame,
    column: str,
    low: object | None = None,
    high: object | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Rows outside the range; null is accepted."""
    return df.filter(~_in_range(column, low, high, inclusive))


#: Versions that are numbered in a row and compared together.
STRETCH = 64

_OLD_END, _OLD_KEY = "_before.end", "_before.version"


def _ordered(versions: DataFrame, key: str, version: str, start: str, end: str, rows_per_slot: int) -> DataFrame:
    """Versions with the furthest end of the earlier ones of their key.

    An empty version sorts before others of the same start, which it does not overlap.
    """
    rows = versions.dropna("any", subset=[key, start, end])
    reach = F.struct(F.col(end).alias("end"), F.col(version).alias("version"))
    return timeline.running(rows, [key], start, reach, "_before", F.max, [end, version], rows_per_slot)


def no_overlap(
    versions: DataFrame,
    key: str,
    version: str,
    start: str = "effective_start_date",
    end: str = "effective_end_date",
    touching: bool = False,
    rows_per_slot: int = timeline.ROWS_PER_SLOT,
) -> DataFrame:
    """Versions that begin before an earlier version of the same key has ended.

    Each is reported once, with the earlier version that reaches furthest, so the output has at
    most one row per version. ``touching`` also reports a version that begins at the very end of
    another; half-open bounds make that correct, so it only shows that the check can tell.
    """
    ordered = _ordered(versions, key, version, start, end, rows_per_slot)
    clash = F.col(start) <= F.col(_OLD_END) if touching else F.col(start) < F.col(_OLD_END)
    return ordered.filter(clash).select(
        key,
        F.col(_OLD_KEY).alias("earlier_version"),
        F.col(version).alias("later_version"),
        F.col(_OLD_END).alias("earlier_end"),
        F.col(start).alias("later_start"),
    )


def pair_candidates(
    versions: DataFrame,
    key: str,
    version: str,
    start: str = "effective_start_date",
    end: str = "effective_end_date",
    rows_per_slot: int = timeline.ROWS_PER_SLOT,
) -> DataFrame:
    """Versions that begin before an earlier one ends, next to all that begin in the same or neighbouring stretches.

    Versions of a key are numbered by start. Those that begin within a version have the numbers from its own to the number of
    starts before its end, ``_upto``, so how many pairs it is in is known without looking at them. Numbers are cut into stretches of
    ``STRETCH``; a version meets the stretches that it reaches, all of which but the first and last it overlaps whole. So
    the rows here are at most the pairs and ``2 * STRETCH`` for each version that overlaps one, and none for a sound history.
    """
    rows = versions.select(key, version, start, end).dropna("any", subset=[key, start, end])
    ranked = timeline.running(rows, [key], start, F.lit(1), "_rank", F.sum, [version, end], rows_per_slot, inclusive=True)
    ranked = cut_lineage(ranked)
    # At one instant ends come before starts.
    moments = ranked.withColumns({"_at": F.col(start), "_begins": F.lit(1)})
    moments = moments.unionByName(ranked.withColumns({"_at": F.col(end), "_begins": F.lit(0)}))
    counted = timeline.running(moments, [key], "_at", F.col("_begins"), "_upto", F.sum, ["_begins"], rows_per_slot, inclusive=True)
    stretch = lambda rank: F.floor(rank / STRETCH)
    earlier = counted.filter((F.col("_begins") == 0) & (F.col("_upto") > F.col("_rank"))).select(
        key,
        F.explode(F.sequence(stretch(F.col("_rank") + 1), stretch(F.col("_upto")))).alias("_stretch"),
        F.col(version).alias("earlier_version"),
        F.col(start).alias("_from"),
        F.col(end).alias("earlier_end"),
        F.col("_rank").alias("_after"),
        "_upto",
    )
    later = ranked.select(
        key,
        stretch(F.col("_rank")).alias("_stretch"),
        F.col(version).alias("later_version"),
        F.col(start).alias("later_start"),
        F.col(end).alias("_to"),
        "_rank",
    )
    return earlier.join(later, [key, "_stretch"])


def overlapping_pairs(
    versions: DataFrame,
    key: str,
    version: str,
    start: str = "effective_start_date",
    end: str = "effective_end_date",
    rows_per_slot: int = timeline.ROWS_PER_SLOT,
) -> DataFrame:
    """Every pair of overlapping versions, each once: work in proportion to the pairs, see ``pair_candidates``.

    Runs jobs that look for frequent keys; the numbered versions are used three times and kept in the shared folder.
    """
    near = pair_candidates(versions, key, version, start, end, rows_per_slot)
    inside = (F.col("_rank") > F.col("_after")) & (F.col("_rank") <= F.col("_upto"))
    # An empty version is in the way only if it starts after the other's first instant; rows of one version and start are one.
    follows = F.struct("later_start", "later_version") > F.struct("_from", "earlier_version")
    pairs = near.filter(inside & follows & (F.col("_from") < F.col("_to")))
    return pairs.select(key, "earlier_version", "later_version", "earlier_end", "later_start")


@dataclass(frozen=True)
class TableChecks:
    """The checks declared for one table."""

    table: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted_values: Mapping[str, tuple[object, ...]] = field(default_factory=dict)
    above: Mapping[str, float] = field(default_factory=dict)
    relationships: Mapping[str, tuple[str, str]] = field(default_factory=dict)


#: Parents with at most so many rows, and bytes of keys, are looked up within the scan of the child.
PARENT_ROWS, PARENT_BYTES = 500_000, 32 << 20


def small_parents(tables: Mapping[str, DataFrame], suite: Sequence[TableChecks]) -> set[tuple[str, str]]:
    """Parents and their columns whose keys fit into every task. One job reads the key columns of all."""
    asked = sorted({parent for checks in suite for parent in checks.relationships.values()})
    sizes = []
    for i, (parent, column) in enumerate(asked):
        width = F.coalesce(F.length(F.col(column).cast("string")), F.lit(0)) + 32
        sizes.append(tables[parent].agg(F.lit(i).alias("i"), F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")))
    found = reduce(lambda a, b: a.unionByName(b), sizes).collect() if sizes else []
    return {asked[r["i"]] for r in found if r["n"] <= PARENT_ROWS and r["bytes"] <= PARENT_BYTES}


def _known_keys(tables: Mapping[str, DataFrame], parent: str, column: str) -> DataFrame:
    return tables[parent].filter(F.col(column).isNotNull()).select(F.col(column).alias("key")).distinct()


def _counted_checks(df: DataFrame, checks: TableChecks, tables: Mapping[str, DataFrame], small: set[tuple[str, str]]) -> DataFrame | None:
    """Row checks and foreign keys of a table from one scan.

    Foreign keys of ``small`` parents are looked up in the scan, so they and the row checks are conditional counts. Of
    foreign keys of large parents each row gives its keys; these are counted before the shuffle, and an anti join with the parents' keys,
    stacked in the same form, leaves those without a parent.
    """
    failing = [("not_null", c, F.col(c).isNull()) for c in checks.not_null]
    failing += [("accepted_values", c, ~F.col(c).isin(*v)) for c, v in checks.accepted_values.items()]
    failing += [("accepted_range", c, ~_in_range(c, low, None, False)) for c, low in checks.above.items()]
    large = []
    for i, (column, parent) in enumerate(checks.relationships.items()):
        kind = tables[parent[0]].schema[parent[1]].dataType
        if parent in small:
            known = _known_keys(tables, *parent).withColumnsRenamed({"key": f"_parent_{i}"})
            df = df.join(F.broadcast(known), F.col(column).cast(kind) == F.col(f"_parent_{i}"), "left")
            failing.append(("relationships", column, F.col(column).isNotNull() & F.col(f"_parent_{i}").isNull()))
        else:
            large.append((column, parent, kind))
    names = [(kind, column) for kind, column, _ in failing] + [("relationships", c) for c, _, _ in large]
    if not names:
        return None
    listed = [
        F.struct(F.lit(i).alias("i"), F.lit(checks.table).alias("table"), F.lit(kind).alias("check"), F.lit(column).alias("column"))
        for i, (kind, column) in enumerate(names)
    ]
    if not large:
        counted = df.agg(*[F.count_if(condition).alias(f"_n{i}") for i, (_, _, condition) in enumerate(failing)])
        lines = [F.struct(*[line[c].alias(c) for c in ("table", "check", "column")], F.col(f"_n{i}").alias("failures")) for i, line in enumerate(listed)]
        return counted.select(F.inline(F.array(*lines)))
    pairs = [F.when(condition, F.struct(F.lit(i).alias("i"), F.lit("").alias("key"))) for i, (_, _, condition) in enumerate(failing)]
    parents = []
    for i, (column, parent, kind) in enumerate(large, len(failing)):
        key = F.col(column).cast(kind).cast("string")
        pairs.append(F.when(F.col(column).isNotNull(), F.struct(F.lit(i).alias("i"), F.coalesce(key, F.lit("")).alias("key"))))
        parents.append(_known_keys(tables, *parent).select(F.lit(i).alias("i"), F.col("key").cast("string").alias("key")))
    found = df.select(F.inline(F.array_compact(F.array(*pairs)))).groupBy("i", "key").agg(F.count("*").alias("n"))
    found = found.join(reduce(lambda a, b: a.unionByName(b), parents), ["i", "key"], "left_anti")
    sums = found.groupBy(F.col("i").alias("_i")).agg(F.sum("n").alias("_n"))
    lines = df.sparkSession.range(1).select(F.inline(F.array(*listed)))
    return lines.join(sums, F.col("i") == F.col("_i"), "left").select("table", "check", "column", F.coalesce("_n", F.lit(0)).alias("failures"))


def run(tables: Mapping[str, DataFrame], suite: Sequence[TableChecks]) -> DataFrame:
    """Failures of every declared check: ``table, check, column, failures``.

    ``unique`` counts repeated keys, ``relationships`` rows without a parent, the others rows. A table is scanned once
    for all of its checks but ``unique``, which scans the key alone. Runs a job that sizes up the parents.
    """
    results: list[DataFrame] = []
    small = small_parents(tables, suite)

    def total(offenders: DataFrame, failures: Column, table: str, kind: str, column: str) -> DataFrame:
        named = [F.lit(v).alias(n) for n, v in (("table", table), ("check", kind), ("column", column))]
        return offenders.agg(F.coalesce(failures, F.lit(0)).alias("failures")).select(*named, "failures")

    for checks in suite:
        df = tables[checks.table]
        counted = _counted_checks(df, checks, tables, small)
        if counted is not None:
            results.append(counted)
        for column in checks.unique:
            results.append(total(unique(df, [column]), F.count("*"), checks.table, "unique", column))
    return reduce(lambda a, b: a.unionByName(b), results)
