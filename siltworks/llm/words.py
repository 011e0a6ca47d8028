"""Words of a text as column expressions, and as bytes inside Arrow tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: The white space of the contracts, space and \\t to \\r.
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
WORD_CLASS = "[^\\x20\\x09-\\x0D]+"
SPACES = "' \\t\\n\\u000b\\u000c\\r'"


def word_count(text: str) -> Column:
    """Number of words; null is no word."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def words(text: str) -> Column:
    """The words in order; null and blank texts have none."""
    trimmed = F.expr(f"trim(BOTH {SPACES} FROM coalesce(`{text}`, ''))")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def text_bytes(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Key and text as UTF-8 bytes, which Arrow hands to Python without decoding; null becomes empty.

    ``bytes.split()`` and ``bytes.lower()`` treat exactly the ASCII white space and letters of the contracts.
    """
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a task holds what it makes of few rows at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def added_schema(kept: Sequence[StructField], new: str) -> StructType:
    """The kept fields, whatever their names, and new ones in DDL."""
    return StructType([*kept, *StructType.fromDDL(new).fields])


def by_value(module: object) -> None:
    """Let executors receive the functions of a module, so that they need not have this package installed."""
    cloudpickle.register_pickle_by_value(module)


by_value(sys.modules[__name__])
