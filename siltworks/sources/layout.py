"""Physical layout: clustering a table, and how many files a predicate has to open."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.sources.landing import inventory

_SPREAD = "_spread"


def cluster(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Rows in ``files`` ranges of the columns, in the order of the list, sorted within each.

    Rows of one value may outnumber a file; the partition a row comes from then decides, so a frequent value fills
    several files. That number is the same when a lost task is repeated, which a random one would not be.
    """
    spread = df.withColumn(_SPREAD, F.spark_partition_id())
    return spread.repartitionByRange(files, *columns, _SPREAD).sortWithinPartitions(*columns).drop(_SPREAD)


def _detail() -> list[Column]:
    return [
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_total"),
        F.min("bytes").alias("min_file_bytes"),
        F.max("bytes").alias("max_file_bytes"),
        F.round(F.avg("bytes"), 1).alias("avg_file_bytes"),
    ]


def table_detail(files: DataFrame) -> DataFrame:
    """Number and sizes of the files of a table, from its inventory."""
    return files.agg(*_detail())


def suggested_files(files: DataFrame, target_bytes: int = 256 * 1024**2) -> int:
    """How many files of about ``target_bytes`` hold what the inventory lists."""
    total = files.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()["bytes"]
    return max(1, -(-total // target_bytes))


_EXACT = ("tinyint", "smallint", "int", "bigint", "date", "timestamp_ntz", "string")


def _stats_reader(columns: Sequence[str]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInPandas`` that reads minima and maxima from file footers."""
    wanted = list(columns)

    def read(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path, size in zip(batch["path"], batch["bytes"], strict=True):
                if path.startswith("file:") or "://" not in path:
                    source, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
                else:
                    source, inner = fs.FileSystem.from_uri(path)
                with source.open_input_file(inner) as handle:
                    footer = pq.ParquetFile(handle).metadata
                row = {"path": path, "bytes": size, "n_rows": footer.num_rows}
                for column in wanted:
                    found = []
                    for group in range(footer.num_row_groups):
                        chunks = footer.row_group(group)
                        chunk = next(c for c in map(chunks.column, range(chunks.num_columns)) if c.path_in_schema == column)
                        stats = chunk.statistics
                        if stats is not None and stats.has_min_max:
                            found.append((stats.min, stats.max))
                        elif stats is None or stats.null_count != chunk.num_values:
                            found = None
                            break
                    row[f"known_{column}"] = found is not None
                    row[f"min_{column}"] = min(x for x, _ in found) if found else None
                    row[f"max_{column}"] = max(x for _, x in found) if found else None
                rows.append(row)
            names = [n for c in wanted for n in (f"known_{c}", f"min_{c}", f"max_{c}")]
            yield pd.DataFrame(rows, columns=["path", "bytes", "n_rows", *names], dtype=object)

    return read


def file_stats(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows, minimum and maximum of the columns in each file. Executors read footers, not data.

    ``known`` is false where a file does not say; ``min`` and ``max`` are null where it holds only nulls.
    """
    kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema}
    for column in columns:
        if kinds[column] not in _EXACT:
            raise ValueError(f"{column}: footers give no exact bounds for {kinds[column]}")
    ddl = "path string, bytes bigint, n_rows bigint"
    ddl += "".join(f", `known_{c}` boolean, `min_{c}` {kinds[c]}, `max_{c}` {kinds[c]}" for c in columns)
    return inventory(spark, path).select("path", "bytes").mapInPandas(_stats_reader(columns), ddl)


def may_hold(ranges: Mapping[str, tuple[object, object]]) -> Column:
    """Whether a file can hold rows with every column in its inclusive range."""
    tests = [
        ~F.col(f"known_{c}") | ((F.col(f"max_{c}") >= F.lit(low)) & (F.col(f"min_{c}") <= F.lit(high)))
        for c, (low, high) in ranges.items()
    ]
    return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))


def _opened(ranges: Mapping[str, tuple[object, object]]) -> list[Column]:
    kept = may_hold(ranges)
    return [
        F.count_if(kept).alias("files_scanned"),
        F.coalesce(F.sum(F.when(kept, F.col("bytes"))), F.lit(0)).alias("bytes_opened"),
        F.coalesce(F.sum(F.when(kept, F.col("n_rows"))), F.lit(0)).alias("rows_opened"),
    ]


def files_scanned(stats: DataFrame, ranges: Mapping[str, tuple[object, object]]) -> DataFrame:
    """How many files, bytes and rows a range predicate has to open, of how many."""
    return stats.agg(F.count("*").alias("n_files"), *_opened(ranges))


def layout_report(spark: SparkSession, layouts: Mapping[str, str], ranges: Mapping[str, tuple[object, object]]) -> DataFrame:
    """Table detail and files scanned for several copies of a table: ``{label: path}``."""
    lines = [
        file_stats(spark, path, list(ranges)).agg(*_detail(), *_opened(ranges)).select(F.lit(label).alias("layout"), "*")
        for label, path in layouts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), lines)
