"""Dimensions built from the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import keys as keys_fn
from siltworks.functions.dates import date_key


def date_dim(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last day in the data."""
    bounds = df.agg(F.to_date(F.min(ts)).alias("low"), F.to_date(F.max(ts)).alias("high"))
    days = bounds.filter("low is not null").select(
        F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias("full_date")
    )
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def with_unknown(
    df: DataFrame,
    key: str,
    unknown: int = keys_fn.UNKNOWN_KEY,
    text: str = keys_fn.UNKNOWN_LABEL,
) -> DataFrame:
    """Add the member that facts without a match point to: texts say so, other columns are null."""

    def value(field: T.StructField):
        if field.name == key:
            return F.lit(unknown)
        return F.lit(text if isinstance(field.dataType, T.StringType) else None)

    member = df.sparkSession.range(1).select(*[value(f).cast(f.dataType).alias(f.name) for f in df.schema])
    return df.unionByName(member)


def location_dim(zones: DataFrame, columns: Mapping[str, str], key: str) -> DataFrame:
    """Reference table with chosen columns (``{output: source}``) and the unknown member."""
    chosen = [F.col(source).cast("int" if out == key else "string").alias(out) for out, source in columns.items()]
    return with_unknown(zones.select(*chosen), key)


def code_dim(df: DataFrame, code: str, names: Mapping[object, str], default: str, key: str, name: str) -> DataFrame:
    """The codes that occur in the data, named from a fixed table. A new code appears by itself."""
    codes = df.select(F.col(code).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return codes.withColumn(name, keys_fn.label(F.col(key), names, default))


def unknown_usage(fact: DataFrame, columns: Sequence[str], unknown: int = keys_fn.UNKNOWN_KEY) -> DataFrame:
    """Fact rows that point to the unknown member, per key column, from one scan."""
    counted = fact.agg(*[F.count_if(F.col(c) == unknown).alias(c) for c in columns])
    lines = [F.struct(F.lit(c).alias("key_column"), F.col(c).alias("rows_unknown")) for c in columns]
    return counted.select(F.inline(F.array(*lines)))
