"""History of a mutable table, kept from run to run.

A run compares a look at the source with the open versions that earlier runs stored. It publishes two tables under one
number: the open versions as they are now, and those that this run closed. Closed versions are never read or written again by
later runs, so a run costs the open versions and the look. A run that changes nothing publishes nothing, so it can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import history
from siltworks.operators.history import VALID_TO
from siltworks.session import cut_lineage
from siltworks.sources import versions

SNAPSHOT = "SNAPSHOT"


def _open(name: str) -> str:
    return f"{name}_open"


def _closed(name: str) -> str:
    return f"{name}_closed"


def latest_rows(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """One row per key, the one with the latest clock; ties go to the largest row. Rows without a key or a clock are left out."""
    others = [c for c in source.columns if c not in (key, updated_at)]
    usable = source.filter(F.col(key).isNotNull() & F.col(updated_at).isNotNull())
    last = usable.groupBy(key).agg(F.max(F.struct(updated_at, *others)).alias("_last"))
    return last.select(*[F.col(c) if c == key else F.col(f"_last.{c}").alias(c) for c in source.columns])


def apply(source: DataFrame, root: str, name: str, key: str, updated_at: str) -> int | None:
    """Take a look at the source into the stored history: its new number, or None if nothing changed.

    A new key opens a version, a later clock closes the open one and opens the next, an equal or earlier clock changes
    nothing, and a key that left the source stays open.
    """
    spark = source.sparkSession
    look = latest_rows(source, key, updated_at)
    try:
        before = versions.read(spark, root, _open(name))
    except versions.VersionNotFound:
        parts = {_open(name): history.start_history(look, updated_at)}
        parts[_closed(name)] = parts[_open(name)].limit(0)
        return versions.publish_all(parts, root, SNAPSHOT)
    after = cut_lineage(history.snapshot(before, look, key, updated_at))
    closed = after.filter(F.col(VALID_TO).isNotNull())
    # A version closes where another opens; without either there are as many open ones as before.
    if closed.isEmpty() and after.count() == before.count():
        return None
    return versions.publish_all({_open(name): after.filter(F.col(VALID_TO).isNull()), _closed(name): closed}, root, SNAPSHOT)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All versions, those that each run closed and those that are open."""
    current = versions.read(spark, root, _open(name))
    runs = versions.history(spark, root, _closed(name)).filter(F.col("operation") == SNAPSHOT).select("version").distinct()
    paths = [versions.version_path(root, _closed(name), r["version"]) for r in runs.collect()]
    return spark.read.schema(current.schema).parquet(*paths).unionByName(current)
