"""Ordered computations per key that do not put a frequent key into one task.

A window over ``partitionBy(key)`` sorts all rows of a key in a single task. One job first asks for the rows of the
most frequent key, from a scan of the keys alone. If no key has more than ``rows_per_slot``, that window is what
runs. Otherwise the frequent keys are cut at quantiles of their own times into
slots of about equal numbers of rows, so that the window runs over ``(key, slot)`` and a burst is no
heavier than quiet times. What a slot has to know about its neighbours is
aggregated to one small row per slot, looked up over the slots of the key, and fed back as one
extra row of the slot; no join is needed for that. All other keys have one slot.

There are at most ``rows / rows_per_slot`` frequent keys, which bounds what is broadcast. Slots are
whole seconds, so only rows of one key in one second always stay together. A key has at most ``QUANTILES`` slots,
which keeps them within the target up to ``QUANTILES * rows_per_slot / 2`` rows of one key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLOT = 2_000_000

# Quantiles of time that are found for a frequent key; it uses as many as its rows need.
QUANTILES = 512
_SLOT, _REAL = "_slot", "_real"


def frequent_keys(df: DataFrame, keys: Sequence[str], ts: str, rows_per_slot: int) -> DataFrame:
    """Keys with more rows than one slot should hold, with the seconds at which their slots after the first begin."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_slot)
    counted = counted.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_n")
    own = df.select(*keys, F.unix_timestamp(ts).alias("_second")).join(F.broadcast(counted), _same(keys))
    steps = [i / QUANTILES for i in range(1, QUANTILES)]
    found = F.percentile_approx("_second", steps, 8 * QUANTILES).alias("_all")
    cut = own.groupBy(*[f"_key_{k}" for k in keys], "_n").agg(found)
    # Twice as many slots as the count asks for: every so-manieth quantile, each once.
    every = F.greatest(F.floor(QUANTILES / (2 * F.ceil(F.col("_n") / rows_per_slot))), F.lit(1))
    bounds = F.array_distinct(F.filter("_all", lambda x, i: (i + 1) % every == 0))
    return cut.select(*[f"_key_{k}" for k in keys], bounds.alias("_bounds"))


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])


def _in_slots(df: DataFrame, keys: Sequence[str], ts: str, frequent: DataFrame, how: str) -> DataFrame:
    """Add the slot of each row; ``inner`` keeps only the rows of frequent keys."""
    placed = df.join(F.broadcast(frequent), _same(keys), how).withColumn("_second", F.unix_timestamp(ts))
    slot = F.size(F.filter("_bounds", lambda b: b <= F.col("_second")))
    slot = F.when(F.col("_bounds").isNotNull() & F.col("_second").isNotNull(), slot).otherwise(0)
    return placed.withColumn(_SLOT, slot.cast("bigint")).drop(*[f"_key_{k}" for k in keys], "_bounds", "_second")


def _crowded(df: DataFrame, keys: Sequence[str], ts: str, rows_per_slot: int) -> DataFrame | None:
    """``frequent_keys``, or None if there are none. Runs a job that counts the rows of each key."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    none = counted.filter(F.col("_n") > rows_per_slot).isEmpty()
    return None if none else frequent_keys(df, keys, ts, rows_per_slot)


def next_instant(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    out: str,
    tie_break: Sequence[str] = (),
    rows_per_slot: int = ROWS_PER_SLOT,
) -> DataFrame:
    """Add the time of the following row of the same key; null for the last. Runs a job."""
    frequent = _crowded(df, keys, ts, rows_per_slot)
    if frequent is None:
        return df.withColumn(out, F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts, *tie_break)))
    rows = _in_slots(df, keys, ts, frequent, "left").withColumn(_REAL, F.lit(1))
    crowded = _in_slots(df.select(*keys, ts), keys, ts, frequent, "inner")
    firsts = crowded.groupBy(*keys, _SLOT).agg(F.min(ts).alias(ts))
    by_slot = Window.partitionBy(*keys).orderBy(_SLOT)
    edges = firsts.withColumns({ts: F.lead(ts).over(by_slot), _REAL: F.lit(0)}).filter(F.col(ts).isNotNull())
    within = Window.partitionBy(*keys, _SLOT).orderBy(ts, F.desc(_REAL), *tie_break)
    both = rows.unionByName(edges, allowMissingColumns=True)
    return both.withColumn(out, F.lead(ts).over(within)).filter(F.col(_REAL) == 1).drop(_SLOT, _REAL)


def running(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: Column,
    out: str,
    fold: Callable[[str], Column] = F.max,
    tie_break: Sequence[str] = (),
    rows_per_slot: int = ROWS_PER_SLOT,
    inclusive: bool = False,
) -> DataFrame:
    """Add the ``fold``, a maximum or a sum, of ``value`` over the earlier rows of the same key; null if there are none. Runs a job.

    With ``inclusive`` the row itself counts too. ``value`` may be a struct.
    """
    frame = Window.unboundedPreceding, 0 if inclusive else -1
    valued = df.withColumn("_value", value)
    frequent = _crowded(df, keys, ts, rows_per_slot)
    if frequent is None:
        within = Window.partitionBy(*keys).orderBy(ts, *tie_break).rowsBetween(*frame)
        return valued.withColumn(out, fold("_value").over(within)).drop("_value")
    rows = _in_slots(valued, keys, ts, frequent, "left").withColumn(_REAL, F.lit(1))
    crowded = _in_slots(valued.select(*keys, ts, "_value"), keys, ts, frequent, "inner")
    tops = crowded.groupBy(*keys, _SLOT).agg(fold("_value").alias("_value"))
    earlier = Window.partitionBy(*keys).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    edges = tops.withColumns({"_value": fold("_value").over(earlier), _REAL: F.lit(0)})
    within = Window.partitionBy(*keys, _SLOT).orderBy(_REAL, ts, *tie_break).rowsBetween(*frame)
    both = rows.unionByName(edges.filter(F.col("_value").isNotNull()), allowMissingColumns=True)
    found = both.withColumn(out, fold("_value").over(within))
    return found.filter(F.col(_REAL) == 1).drop(_SLOT, _REAL, "_value")
