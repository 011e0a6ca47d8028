"""Fact tables and the measures taken from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.casting import money, money_sum
from siltworks.functions.dates import date_key, minutes_between
from siltworks.functions.keys import or_unknown


def build(
    df: DataFrame,
    start: str,
    end: str,
    date_key_name: str,
    duration_name: str,
    keys: Mapping[str, str],
    unknown_keys: Mapping[str, str],
    columns: Sequence[str],
) -> DataFrame:
    """One row per input row: keys, chosen columns, date key and duration in minutes.

    ``keys`` are renamed, ``unknown_keys`` also point to the unknown member where null.
    """
    return df.select(
        date_key(F.col(start)).alias(date_key_name),
        *[or_unknown(F.col(source)).alias(out) for out, source in unknown_keys.items()],
        *[F.col(source).alias(out) for out, source in keys.items()],
        start,
        end,
        minutes_between(F.col(start), F.col(end)).cast("double").alias(duration_name),
        *columns,
    )


def gross_net(df: DataFrame, amount: str, reversal: str, by: Sequence[str] = ()) -> DataFrame:
    """Revenue without reversals, and with them; ``net`` is never above ``gross``."""
    forward = F.when(~F.col(reversal), money(amount))
    return df.groupBy(*by).agg(
        F.count("*").alias("rows_total"),
        F.count_if(F.col(reversal)).alias("rows_reversed"),
        F.coalesce(F.sum(forward), F.lit(0)).cast("double").alias("gross"),
        F.coalesce(money_sum(amount), F.lit(0.0)).alias("net"),
    )


def with_attribute(fact: DataFrame, versions: DataFrame, fact_key: str, key: str, attribute: str, out: str) -> DataFrame:
    """Left join one attribute of a dimension by equality.

    Spark broadcasts the dimension if its measured size allows, and otherwise shuffles.
    """
    side = versions.select(F.col(key).alias("_key"), F.col(attribute).alias(out))
    return fact.join(side, F.col(fact_key) == F.col("_key"), "left").drop("_key")


def attribution_matrix(
    fact: DataFrame,
    versions: DataFrame,
    attribute: str,
    amount: str,
    fact_key: str,
    fact_version_key: str,
    key: str,
    version_key: str,
    is_current: str = "is_current",
) -> DataFrame:
    """Amounts by the attribute that is current now (type 1) and the one valid then (type 2).

    Facts are summed per key and version first, so the joins see one row for each version in use
    however many facts it has.
    """
    summed = fact.groupBy(fact_key, fact_version_key).agg(
        F.count("*").alias("rows_total"), F.sum(money(amount)).alias("amount")
    )
    then = with_attribute(summed, versions, fact_version_key, version_key, attribute, "type2")
    both = with_attribute(then, versions.filter(F.col(is_current)), fact_key, key, attribute, "type1")
    return both.groupBy("type1", "type2").agg(
        F.sum("rows_total").alias("rows_total"), F.sum("amount").alias("amount")
    )


def attribution(matrix: DataFrame) -> DataFrame:
    """Each attribute value's amount under type 1 and type 2 from ``attribution_matrix``."""
    amount, none = F.col("amount"), F.lit(0).cast(matrix.schema["amount"].dataType)
    sides = F.array(
        F.struct(F.col("type1").alias("attribute"), amount.alias("type1"), none.alias("type2")),
        F.struct(F.col("type2").alias("attribute"), none.alias("type1"), amount.alias("type2")),
    )
    return (
        matrix.select(F.inline(sides))
        .groupBy("attribute")
        .agg(F.sum("type1").cast("double").alias("amount_type1"), F.sum("type2").cast("double").alias("amount_type2"))
    )


def misattributed(matrix: DataFrame) -> DataFrame:
    """The amount that type 1 gives to the wrong attribute value, and its share."""
    wrong = ~F.col("type1").eqNullSafe(F.col("type2"))
    totals = matrix.agg(
        F.coalesce(F.sum(F.when(wrong, F.col("amount"))), F.lit(0)).cast("double").alias("amount_misattributed"),
        F.sum("amount").cast("double").alias("amount_total"),
        F.coalesce(F.sum(F.when(wrong, F.col("rows_total"))), F.lit(0)).alias("rows_misattributed"),
        F.sum("rows_total").alias("rows_total"),
    )
    share = F.round(F.try_divide("amount_misattributed", "amount_total") * 100, 2)
    return totals.withColumn("pct_misattributed", share)
