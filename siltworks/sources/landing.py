"""The landing directory: what should be there, what is there, and what the files look like."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from siltworks import contracts
from siltworks.contracts import FeedContract
from siltworks.session import stored


def expand_template(template: str) -> Column:
    """``"{service}_{year}.parquet"`` as a concatenation of columns and text."""
    pieces = [p for p in re.split(r"(\{\w+\})", template) if p]
    return F.concat(*[F.col(p[1:-1]) if p.startswith("{") else F.lit(p) for p in pieces])


def expand_manifest(manifest: DataFrame, template: str, out: str = "file_name") -> DataFrame:
    return manifest.withColumn(out, expand_template(template))


def inventory(spark: SparkSession, directory: str, glob: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """Path, name, size and time of the files. Their content is not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(directory)
        .select("path", "length", "modificationTime")
    )
    # Large files come one to a partition, which is too little work for a task without content.
    tasks = max(1, spark.sparkContext.defaultParallelism * 4)
    return files.coalesce(tasks).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


_LISTED = "path string, is_folder boolean, bytes bigint, modified_at timestamp"


def _lister(glob: str) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInPandas`` that lists folders, each by itself; names that begin with _ or . are not data."""

    def read(batches: Iterator) -> Iterator:
        from fnmatch import fnmatchcase

        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            for folder in batch["path"]:
                if folder.startswith("file:") or "://" not in folder:
                    source, inner, head = fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/"), "file:"
                else:
                    source, inner = fs.FileSystem.from_uri(folder)
                    head = folder[: len(folder) - len(inner)] if folder.endswith(inner) else folder.split("://")[0] + "://"
                rows = []
                for entry in source.get_file_info(fs.FileSelector(inner)):
                    is_folder = entry.type == fs.FileType.Directory
                    if entry.base_name[:1] not in ("_", ".") and (is_folder or fnmatchcase(entry.base_name, glob)):
                        rows.append((head + entry.path, is_folder, None if is_folder else entry.size, entry.mtime))
                for at in range(0, len(rows), 10_000):
                    yield pd.DataFrame(rows[at : at + 10_000], columns=["path", "is_folder", "bytes", "modified_at"])

    return read


def list_files(spark: SparkSession, directory: str, glob: str = "*.parquet") -> DataFrame:
    """``path, bytes, modified_at`` of the files in a folder and all below it, listed by the executors, one job for each depth.

    The driver holds no path but that of the folder itself; what was found is kept in the shared folder.
    """
    if ":" not in directory:
        directory = os.path.abspath(directory)
    level, found = spark.createDataFrame([(directory,)], "path string"), []
    while True:
        listed = stored(level.mapInPandas(_lister(glob), _LISTED), "listing")
        found.append(listed.filter("not is_folder").drop("is_folder"))
        level = listed.filter("is_folder").select("path")
        n = level.count()
        if not n:
            return reduce(lambda a, b: a.unionByName(b), found)
        level = level.repartition(min(n, 4 * spark.sparkContext.defaultParallelism))


def completeness(manifest: DataFrame, files: DataFrame, name: str = "file_name") -> DataFrame:
    """Every file that is listed or present, with ``status`` present, missing or unexpected."""
    listed = manifest.select(name).distinct().withColumn("_listed", F.lit(True))
    present = files.select(name).distinct().withColumn("_present", F.lit(True))
    status = (
        F.when(F.col("_listed").isNull(), "unexpected").when(F.col("_present").isNull(), "missing").otherwise("present")
    )
    return listed.join(present, name, "full_outer").select(name, status.alias("status"))


_FOOTER = "path string, signature string, position int, column string, type string"


def _footer_reader() -> Callable[[Iterator], Iterator]:
    """A function for ``mapInPandas`` that reads schemas from file footers.

    It is nested so that it travels to the executors by value, together with what it imports.
    """

    def read(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        names = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "bool": "boolean"}
        names |= {"large_string": "string", "date32[day]": "date", "halffloat": "float"}

        def spark_name(kind: pa.DataType) -> str:
            if pa.types.is_timestamp(kind):
                return "timestamp" if kind.tz else "timestamp_ntz"
            if pa.types.is_decimal(kind):
                return f"decimal({kind.precision},{kind.scale})"
            if pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
                return "binary"
            return names.get(str(kind), str(kind))

        for batch in batches:
            rows = []
            for path in batch["path"]:
                if path.startswith("file:") or "://" not in path:
                    source, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
                else:
                    source, inner = fs.FileSystem.from_uri(path)
                schema = pq.read_schema(inner, filesystem=source)
                columns = [(field.name, spark_name(field.type)) for field in schema]
                signature = ",".join(f"{name}:{kind}" for name, kind in columns)
                rows += [(path, signature, i, name, kind) for i, (name, kind) in enumerate(columns)]
            yield pd.DataFrame(rows, columns=["path", "signature", "position", "column", "type"])

    return read


def file_columns(paths: DataFrame) -> DataFrame:
    """One row per file and column with its type; footers are read by the executors."""
    return paths.select("path").mapInPandas(_footer_reader(), _FOOTER)


def drift_report(columns: DataFrame) -> DataFrame:
    """The types each column was seen with. A column with ``n_variants > 1`` drifts."""
    seen = columns.groupBy(F.lower("column").alias("name"), "column", "type").agg(
        F.count("*").alias("n_files"),
        F.min("position").alias("first_position"),
        F.min("path").alias("first_file"),
        F.max("path").alias("last_file"),
    )
    variants = seen.groupBy("name").agg(F.count("*").alias("n_variants"))
    return seen.join(variants, "name")


def infer_contract(
    spark: SparkSession,
    directory: str,
    feed: str,
    glob: str,
    hints: Mapping[str, str] | None = None,
    canonical: Mapping[str, str] | None = None,
) -> FeedContract:
    """A contract from the files that are there, with hinted types and canonical names."""
    seen = drift_report(file_columns(inventory(spark, directory, glob)))
    return contracts.infer(seen, feed, glob, hints, canonical)


def schema_mismatches(columns: DataFrame, contract: FeedContract) -> DataFrame:
    """File columns that a plain read under the contract's types rejects or does not find.

    Which differences of type Spark's reader bridges is its own business: for each pair of physical and declared type that
    occurs, one file that has it is read under the declared type, all in one job. Types are few, however many the files.
    """
    known = [
        F.struct(F.lit(s.lower()).alias("name"), F.lit(f.type).alias("declared"))
        for f in contract.fields
        for s in f.spellings
    ]
    spark = columns.sparkSession
    lookup = spark.range(1).select(F.inline(F.array(*known))).distinct()
    both = columns.withColumn("name", F.lower("column")).join(F.broadcast(lookup), "name", "left")
    differing = both.filter("declared is not null and type <> declared")
    samples = differing.groupBy("type", "declared").agg(F.min(F.struct("path", "column")).alias("one")).select("type", "declared", "one.*")
    bad = [f"{r['type']}>{r['declared']}" for r in unreadable(spark, samples.collect())]
    fails = F.concat_ws(">", "type", "declared").isin(bad) if bad else F.lit(False)
    return both.select(
        "path",
        "column",
        "type",
        "declared",
        F.when(F.col("declared").isNull(), "not in contract").when(fails, "type differs").alias("problem"),
    ).filter("problem is not null")


def unreadable(spark: SparkSession, probes: list[Row]) -> list[Row]:
    """Those of ``type, declared, path, column`` whose file the reader does not give in the declared type.

    All are tried in one job. The reader leaves a file where it fails, so fewer rows than the footer states tell. The whole column is
    read, as values may decide.
    """
    tried = []
    for i, r in enumerate(probes):
        for kind, column in ((r["type"], None), (r["declared"], r["column"])):
            rows = spark.read.option("ignoreCorruptFiles", True).schema(f"`{r['column']}` {kind}").parquet(r["path"])
            values = F.count(F.lit(1) if column is None else F.col(f"`{column}`"))
            tried.append(rows.agg(F.lit(i).alias("i"), F.lit(column is None).alias("plain"), F.count("*").alias("n"), values.alias("values")))
    if not tried:
        return []
    found = reduce(lambda a, b: a.unionByName(b), tried).collect()
    sizes = {(r["i"], r["plain"]): r["n"] for r in found}
    return [r for i, r in enumerate(probes) if sizes[i, False] < sizes[i, True]]


def schema_groups(columns: DataFrame) -> dict[str, list[str]]:
    """Paths by schema. Callers bound the number of files, as the stream does for each batch."""
    rows = columns.select("signature", "path").distinct().collect()
    found: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["signature"], r["path"])):
        found.setdefault(row["signature"], []).append(row["path"])
    return found


def read_group(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files that share one schema, with the lineage that only the scan knows."""
    return spark.read.parquet(*paths).select(
        "*", F.col("_metadata.file_name").alias("_source_file"), F.col("_metadata.file_path").alias("_source_path")
    )
