"""Named tables, reference files and simple reports on them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators.harmonize import lower_names


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a Parquet path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def write_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table and its schema. The plan must not read the table it replaces."""
    df.write.mode("overwrite").saveAsTable(name)


def read_reference_csv(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """A reference file with a header: lower-case names, file name and load time.

    Types are inferred, at the price of a second read, unless ``ddl`` declares them.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(ddl) if ddl else reader.option("inferSchema", True)
    rows = reader.csv(path).select("*", F.col("_metadata.file_name").alias("_source_file"))
    return lower_names(rows).withColumn("_ingested_at", F.current_timestamp())


def read_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A small hand-kept file whose column types are declared; a value that does not parse raises."""
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(ddl).csv(path)


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def shape_report(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each feed."""

    def shape(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("feed"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )

    return reduce(lambda a, b: a.unionByName(b), [shape(n, df) for n, df in feeds.items()])


def describe(df: DataFrame) -> DataFrame:
    """One row per column with its position and type; no data is read."""
    lines = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
        for i, f in enumerate(df.schema)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*lines)))


def column_report(df: DataFrame) -> DataFrame:
    """``describe`` with the rows and nulls of every column, from one scan."""
    nulls = [(F.count("*") - F.count(F.col(f"`{c}`"))).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    counted = df.agg(F.count("*").alias("n_rows"), *nulls)
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("n_rows"),
            F.col(f"_n{i}").alias("n_null"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counted.select(F.inline(F.array(*lines)))
