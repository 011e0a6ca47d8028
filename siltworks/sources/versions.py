"""Numbered versions of a table on plain Parquet.

``publish`` writes a new directory and then adds one row to the history of the root. Readers look
only at versions the history lists, so a write that fails half way is never seen, and tables
published together share a number and appear together. One writer per root is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.sources import events_log
from siltworks.sources.landing import inventory

_LOG = "name string, version int, at timestamp, operation string, rows bigint, files bigint, bytes bigint, schema string"

REPLACE, CLUSTER, EXPIRE = "REPLACE", "CLUSTER", "EXPIRE"


class VersionNotFound(LookupError):
    """The history does not list the version."""


class VersionExpired(LookupError):
    """The history lists the version, but its data is past retention."""


def _log_path(root: str) -> str:
    return f"{root}/_history"


def version_path(root: str, name: str, version: int) -> str:
    return f"{root}/{name}/v={version}"


def history(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """What was done to the tables of a root, also to versions whose data has expired."""
    log = events_log.read(spark, _log_path(root), _LOG)
    return log if name is None else log.filter(F.col("name") == name)


def publish_all(
    tables: Mapping[str, DataFrame],
    root: str,
    operation: str = REPLACE,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    even_files: bool = False,
) -> int:
    """Write several tables and make them visible under one new version number.

    ``even_files`` spends one shuffle to write files of about the advisory partition size, where
    the plan would leave many small or a few very large ones.
    """
    spark = next(iter(tables.values())).sparkSession
    last = history(spark, root).agg(F.max("version").alias("v")).first()["v"]
    version = 0 if last is None else last + 1
    now = datetime.now(timezone.utc)
    entries = []
    for name, df in tables.items():
        path = version_path(root, name, version)
        columns = (partition_by or {}).get(name, ())
        rows_out = df.hint("rebalance", *columns) if even_files else df
        rows_out.write.mode("overwrite").partitionBy(*columns).parquet(path)
        # Counting the stored rows reads footers only.
        rows = spark.read.schema(df.schema).parquet(path).count()
        files = inventory(spark, path)
        size = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
        entries.append((name, version, now, operation, rows, size["files"], size["bytes"], df.schema.json()))
    events_log.append(spark, _log_path(root), _LOG, entries)
    return version


def publish(
    df: DataFrame,
    root: str,
    name: str,
    operation: str = REPLACE,
    partition_by: Sequence[str] = (),
    even_files: bool = False,
) -> int:
    return publish_all({name: df}, root, operation, {name: partition_by}, even_files)


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The latest version of a table, or the one asked for, with the schema it was published with."""
    log = history(spark, root, name)
    if version is not None:
        log = log.filter(F.col("version") == version)
    published = F.when(F.col("operation") != EXPIRE, F.struct("version", "schema"))
    # Without a number the newest counts, and that never expires.
    found = log.agg(F.count("*").alias("n"), F.count_if(F.col("operation") == EXPIRE).alias("expired"), F.max(published).alias("last")).first()
    if found["last"] is None:
        asked = "published version" if version is None else f"version {version}"
        raise VersionNotFound(f"{name} has no {asked} in {root}")
    if version is not None and found["expired"]:
        raise VersionExpired(f"version {version} of {name} is past retention; its history remains")
    schema = T.StructType.fromJson(json.loads(found["last"]["schema"]))
    return spark.read.schema(schema).parquet(version_path(root, name, found["last"]["version"]))


def compare(
    spark: SparkSession,
    root: str,
    name: str,
    versions: Sequence[int],
    measures: Mapping[str, Column],
) -> DataFrame:
    """The same measures on several versions, one row each."""
    named = [m.alias(n) for n, m in measures.items()]
    rows = [read(spark, root, name, v).agg(*named).select(F.lit(v).alias("version"), *measures) for v in versions]
    return reduce(lambda a, b: a.unionByName(b), rows)


def expire(spark: SparkSession, root: str, name: str, before: int) -> int:
    """Mark versions below ``before`` as past retention; the newest is always kept.

    Nothing is deleted here: a storage lifecycle rule can remove the marked directories.
    """
    log = history(spark, root, name)
    gone = log.filter(F.col("operation") == EXPIRE).select("version")
    newest = log.agg(F.max("version").alias("v")).first()["v"]
    if newest is None:
        return 0
    live = log.select("version").distinct().join(gone, "version", "left_anti")
    old = sorted(r["version"] for r in live.filter(F.col("version") < min(before, newest)).collect())
    now = datetime.now(timezone.utc)
    if old:
        events_log.append(spark, _log_path(root), _LOG, [(name, v, now, EXPIRE, None, None, None, None) for v in old])
    return len(old)
