"""Rules, reasons, quarantine and quality measures.

All counts are taken in one pass over the rows: a check is a conditional count, not a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.dates import month_text

REASON = "_quarantine_reason"

Condition = Column | str


def _column(condition: Condition) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


@dataclass(frozen=True)
class Rule:
    """A row fails if ``condition`` is true, or null where ``null_is_fatal``."""

    name: str
    condition: Condition
    null_is_fatal: bool = False

    def fails(self) -> Column:
        return F.coalesce(_column(self.condition), F.lit(self.null_is_fatal))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` of ``whole`` in percent; null if there is no whole."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def fails_any(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [r.fails() for r in rules])


def first_reason(df: DataFrame, rules: Sequence[Rule], out: str = REASON, all_failed: str | None = None) -> DataFrame:
    """Add the name of the first rule that fails, or null; optionally the names of all that do."""
    named = [F.when(r.fails(), F.lit(r.name)) for r in rules]
    columns = {out: F.coalesce(*named)}
    if all_failed:
        columns[all_failed] = F.array_compact(F.array(*named))
    return df.withColumns(columns)


def split(df: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantine)``: every row is in exactly one of them."""
    return df.filter(F.col(reason).isNull()).drop(reason), df.filter(F.col(reason).isNotNull())


def profile(df: DataFrame, checks: Mapping[str, Condition], by: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Rows that meet each check: ``check, rows_failed, pct`` per group, from one scan."""
    counted = df.groupBy(*by).agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_column(c)).alias(f"_check_{i}") for i, c in enumerate(checks.values())],
    )
    lines = [
        F.struct(F.lit(name).alias("check"), F.col(f"_check_{i}").alias("rows_failed")) for i, name in enumerate(checks)
    ]
    long = counted.select(*by, "_rows", F.explode(F.array(*lines)).alias("_line"))
    return long.select(
        *by,
        F.col("_line.check").alias("check"),
        F.col("_line.rows_failed").alias("rows_failed"),
        F.col("_rows").alias("rows_total"),
        percent(F.col("_line.rows_failed"), F.col("_rows"), digits).alias("pct"),
    )


def fatal_totals(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Totals, quarantined and clean rows under a set of rules, before anything is split."""
    counted = df.groupBy(*by).agg(F.count("*").alias("rows_total"), F.count_if(fails_any(rules)).alias("rows_quarantined"))
    return counted.withColumns(
        {
            "rows_clean": F.col("rows_total") - F.col("rows_quarantined"),
            "quarantine_pct": percent(F.col("rows_quarantined"), F.col("rows_total"), digits),
        }
    )


def reason_counts(quarantine: DataFrame, by: Sequence[str] = (), reason: str = REASON) -> DataFrame:
    return quarantine.groupBy(*by, reason).agg(F.count("*").alias("rows_quarantined"))


def metrics(
    clean: DataFrame,
    quarantine: DataFrame,
    by: Sequence[str],
    flags: Mapping[str, str],
    reason: str = REASON,
    digits: int = 3,
) -> DataFrame:
    """``metrics_in_one_pass`` for a source that is already split: its two tables are put back together and counted."""
    columns = [*by, *flags.values()]
    accepted = clean.select(*columns, F.lit(None).cast("string").alias(reason))
    rejected = quarantine.select(*by, reason)
    return metrics_in_one_pass(accepted.unionByName(rejected, allowMissingColumns=True), by, flags, reason, digits)


def metrics_in_one_pass(
    classified: DataFrame,
    by: Sequence[str],
    flags: Mapping[str, str],
    reason: str = REASON,
    digits: int = 3,
) -> DataFrame:
    """Accepted, rejected and flagged rows of each source, and the rejected share: one scan, one shuffle of totals.

    ``flags`` maps output names to flag columns, which count among accepted rows.
    """
    ok = F.col(reason).isNull()
    counted = classified.groupBy(*by).agg(
        F.count_if(ok).alias("rows_clean"),
        F.count_if(~ok).alias("rows_quarantined"),
        *[F.count_if(ok & F.col(c)).alias(n) for n, c in flags.items()],
        F.count("*").alias("rows_total"),
    )
    return counted.withColumn("quarantine_pct", percent(F.col("rows_quarantined"), F.col("rows_total"), digits))


def conservation(source: DataFrame, parts: Mapping[str, DataFrame], by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Compare a table with the parts it was split into, per group.

    ``rows_lost`` is negative where parts hold rows the source does not. ``same_content`` compares
    a sum of row hashes over ``columns``, which finds rows that were changed or swapped.
    """
    digest = F.xxhash64(*columns).cast("decimal(20,0)")
    tagged = [source.select(*by, F.lit("_source").alias("_part"), digest.alias("_digest"))]
    tagged += [part.select(*by, F.lit(name).alias("_part"), digest.alias("_digest")) for name, part in parts.items()]
    rows = reduce(lambda a, b: a.unionByName(b), tagged)
    is_source = F.col("_part") == "_source"
    counted = rows.groupBy(*by).agg(
        F.count_if(is_source).alias("rows_source"),
        *[F.count_if(F.col("_part") == name).alias(f"rows_{name}") for name in parts],
        F.sum(F.when(is_source, F.col("_digest")).otherwise(-F.col("_digest"))).alias("_difference"),
    )
    held = reduce(lambda a, b: a + b, [F.col(f"rows_{name}") for name in parts])
    return counted.withColumns(
        {"rows_lost": F.col("rows_source") - held, "same_content": F.col("_difference") == 0}
    ).drop("_difference")


def unaccounted(source: DataFrame, parts: Sequence[DataFrame], id_columns: Sequence[str]) -> DataFrame:
    """Ids that occur more often in the source than in the parts (``surplus > 0``), or the reverse.

    Grouping by a struct keeps Spark from reusing the partitioning of a join below, which it could
    then no longer split for a frequent key.
    """
    key = F.struct(*id_columns).alias("_id")
    tagged = [source.select(key, F.lit(1).alias("_sign"))]
    tagged += [part.select(key, F.lit(-1).alias("_sign")) for part in parts]
    rows = reduce(lambda a, b: a.unionByName(b), tagged)
    return rows.groupBy("_id").agg(F.sum("_sign").alias("surplus")).filter("surplus <> 0").select("_id.*", "surplus")


def missing_trend(df: DataFrame, ts: str, flag: str, by: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """Share of rows with ``flag`` set, per month and group.

    A month where every row is missing points at the load and not at the source: ``all_missing``.
    """
    counted = df.groupBy(F.trunc(F.col(ts).cast("date"), "month").alias("month"), *by).agg(
        F.count("*").alias("rows_total"), F.count_if(F.col(flag)).alias("rows_missing")
    )
    return counted.withColumns(
        {
            "month": month_text(F.col("month")),
            "pct_missing": percent(F.col("rows_missing"), F.col("rows_total"), digits),
            "all_missing": F.col("rows_missing") == F.col("rows_total"),
        }
    )


def rescue_audit(
    df: DataFrame,
    by: Sequence[str],
    null_columns: Sequence[str] = (),
    rescued: str = "_rescued_data",
) -> DataFrame:
    """Rows with rescued values per file or source, and nulls of the columns they come from."""
    return df.groupBy(*by).agg(
        F.count("*").alias("rows_total"),
        F.count_if(F.col(rescued).isNotNull()).alias("rows_rescued"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_columns],
    )
