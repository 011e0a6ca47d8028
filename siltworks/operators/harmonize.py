"""Bring differing feeds to one schema."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.contracts import FeedContract
from siltworks.functions import rescue
from siltworks.functions.dates import period_from_name

LINEAGE = ("_source_file", "_ingested_at", "_run_id", rescue.RESCUED)


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name except those that start with an underscore."""
    names = [c if c.startswith("_") else c.lower() for c in df.columns]
    twice = [n for n, count in Counter(names).items() if count > 1]
    if twice:
        raise ValueError(f"columns differ only in case: {twice}")
    return df.toDF(*names)


def to_canonical(df: DataFrame, contract: FeedContract, tags: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Rename, cast and tag one feed in a single projection.

    ``tags`` are constant columns such as ``service_type``. Lineage columns that are present pass
    through. Columns the feed lacks are added later by ``union_feeds``.
    """
    tagged = [(F.lit(v) if isinstance(v, str) else v).alias(n) for n, v in (tags or {}).items()]
    fields = [F.col(f"`{f.column}`").cast(f.type).alias(f.name) for f in contract.fields]
    return df.select(*tagged, *fields, *[c for c in LINEAGE if c in df.columns])


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, matched by name; a column that a feed lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def recover_rescued(df: DataFrame, fields: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Fill nulls from the rescued JSON: ``{column: (type, spellings)}``, the first spelling found wins."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            name: rescue.first_of(F.col(name), spellings, target).try_cast(types[name])
            for name, (target, spellings) in fields.items()
        }
    )


def recovery_plan(
    contracts: Sequence[FeedContract],
    only: Sequence[str] | None = None,
) -> dict[str, tuple[str, tuple[str, ...]]]:
    """What ``recover_rescued`` needs, from the contracts of the feeds that were united."""
    plan: dict[str, tuple[str, tuple[str, ...]]] = {}
    for contract in contracts:
        for field in contract.fields:
            if only is not None and field.name not in only:
                continue
            target, spellings = plan.get(field.name, (field.type, ()))
            plan[field.name] = (target, tuple(dict.fromkeys((*spellings, *field.spellings))))
    return plan


def with_file_period(
    df: DataFrame,
    source: str = "_source_file",
    out: str = "_file_period",
    pattern: str = r"(\d{4}-\d{2})",
) -> DataFrame:
    """Add the month the source file claims to hold."""
    return df.withColumn(out, period_from_name(F.col(source), pattern))
