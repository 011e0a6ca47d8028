"""Small append-only logs kept as Parquet. A row in the log is what makes a write visible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def append(spark: SparkSession, path: str, ddl: str, rows: Sequence[tuple]) -> None:
    """Append all rows in one file, so that they appear together."""
    spark.createDataFrame(list(rows), ddl).coalesce(1).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The log, empty if nothing was appended yet."""
    try:
        return spark.read.schema(ddl).parquet(path).select("*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)
