"""Candidate keys: how many duplicates they leave, and what the duplicates are.

Counts are grouped before they are shuffled, so a group that holds a large share of the rows
reaches a reducer as one partial count per input split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.functions.casting import money


HOT_ROWS = 2_000_000


def groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups that share a key, with their size ``n > 1``. Nulls count as equal."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def top_groups(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The ``k`` largest groups, ties broken by the key itself."""
    return groups(df, keys).orderBy(F.desc("n"), *keys).limit(k)


_MEASURES = ("rows_total", "distinct_keys", "excess_rows", "duplicate_groups")


def _measure(total: Column, distinct: Column, duplicated: Column) -> list[Column]:
    columns = (total, distinct, total - distinct, duplicated)
    return [c.alias(n) for c, n in zip(columns, _MEASURES, strict=True)]


def audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, rows beyond the first of each key, and keys that repeat."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.agg(*_measure(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") > 1)))


def _nested(key_lists: Mapping[str, Sequence[str]]) -> list[tuple[str, list[str]]] | None:
    ordered = sorted(((name, list(keys)) for name, keys in key_lists.items()), key=lambda x: -len(x[1]))
    chain = all(set(small) <= set(large) for (_, large), (_, small) in zip(ordered, ordered[1:], strict=False))
    return ordered if chain else None


def compare_keys(df: DataFrame, key_lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """``audit`` for several candidate keys, from a single scan and one shuffle of its rows.

    Where each key extends the next, the narrower ones are counted from the groups of the wider one. Keys that are not
    nested are counted from the groups of all their columns together, which every key shuffles for itself.
    """
    chain = _nested(key_lists)
    if chain is None:
        columns = list(dict.fromkeys(c for keys in key_lists.values() for c in keys))
        # Once for all keys: the plans below share this exchange.
        together = df.groupBy(*columns).agg(F.count("*").alias("_rows"))
        audits = []
        for name, keys in key_lists.items():
            counted = together.groupBy(*keys).agg(F.sum("_rows").alias("n"))
            measures = _measure(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") > 1))
            audits.append(counted.agg(*measures).select(F.lit(name).alias("candidate"), "*"))
        return reduce(lambda a, b: a.unionByName(b), audits)

    carried: list[str] = []
    current = df
    for depth, (_, keys) in enumerate(chain):
        rows = F.sum("n") if depth else F.count("*")
        current = current.groupBy(*keys).agg(rows.alias("n"), *[F.sum(c).alias(c) for c in carried])
        current = current.withColumns({f"_d{depth}": F.lit(1), f"_g{depth}": (F.col("n") > 1).cast("int")})
        carried += [f"_d{depth}", f"_g{depth}"]
    totals = current.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["n", *carried]])
    lines = [
        F.struct(F.lit(name).alias("candidate"), *_measure(F.col("n"), F.col(f"_d{i}"), F.col(f"_g{i}")))
        for i, (name, _) in enumerate(chain)
    ]
    return totals.select(F.inline(F.array(*lines)))


def group_summary(df: DataFrame, keys: Sequence[str], amount: str, keep_null_keys: bool = True) -> DataFrame:
    """Size, net amount and distinct amounts of each duplicated group.

    Without ``keep_null_keys`` a group with a null in its key is left out, which is what joining
    the groups back to their rows by equality does.
    """
    rows = df if keep_null_keys else df.dropna("any", subset=list(keys))
    # Only rows are counted per amount, so tasks hold no sums for what are nearly all rows.
    amounts = rows.groupBy(*keys, money(amount).alias("_amount")).agg(F.count("*").alias("_rows"))
    summary = amounts.groupBy(*keys).agg(
        F.sum("_rows").alias("n"),
        F.sum(F.col("_amount") * F.col("_rows")).cast("decimal(28,2)").alias("net"),
        F.count("_amount").alias("distinct_amounts"),
    )
    return summary.filter("n > 1")


def classify(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    tolerance: float = 0.01,
    keep_null_keys: bool = True,
) -> DataFrame:
    """Tell charges with their reversals (net zero) from true duplicates (one amount, as it is stored).

    Smallest and largest amount tell whether a group has one, without the shuffle of a distinct count.
    """
    rows = df if keep_null_keys else df.dropna("any", subset=list(keys))
    groups = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(money(amount)).alias("net"), F.min(amount).alias("_low"), F.max(amount).alias("_high")
    )
    cancels = F.abs("net") < F.lit(tolerance)
    same = F.col("_low") == F.col("_high")
    return groups.filter("n > 1").agg(
        F.count("*").alias("groups_total"),
        F.count_if(cancels).alias("groups_net_zero"),
        F.count_if(same).alias("groups_same_amount"),
        F.count_if(~F.coalesce(cancels | same, F.lit(False))).alias("groups_other"),
    )


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])


def duplicate_rows(df: DataFrame, keys: Sequence[str], null_safe: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row of every duplicated group, with the size ``n`` of its group.

    Groups with more than ``hot_rows`` rows are at most ``rows / hot_rows`` in number, so they are
    broadcast and their rows stay where they are. Only rows of smaller groups are shuffled.
    """
    repeated = groups(df if null_safe else df.dropna("any", subset=list(keys)), keys)
    named = repeated.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "n")
    same = _same_key(keys)
    hot = F.broadcast(named.filter(F.col("n") > hot_rows))
    spread = df.join(hot, same, "inner")
    shuffled = df.join(hot, same, "left_anti").join(named.filter(F.col("n") <= hot_rows), same, "inner")
    return spread.unionByName(shuffled).drop(*[f"_key_{k}" for k in keys])


def rows_like(df: DataFrame, sample: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys equal those of a sample row, nulls included."""
    wanted = sample.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    return df.join(wanted, _same_key(keys), "left_semi")


def guard(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    expect_none: bool = False,
) -> DataFrame:
    """One row per key, the first under an explicit order.

    ``row_number() = 1`` is limited to one row per key in each input split before the shuffle, so
    many copies of a row never meet in one task. With ``expect_none`` the keys alone are counted
    first, and where none repeats the rows are returned as they are, without shuffling them.
    """
    if expect_none and groups(df, keys).isEmpty():
        return df
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy")
