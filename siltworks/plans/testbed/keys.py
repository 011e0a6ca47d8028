"""Candidate keys and duplicates, on order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import duplicates
from siltworks.plans.testbed.standins import query, table


NAIVE_KEY = ("l_orderkey", "l_linenumber")
WIDER_KEY = (*NAIVE_KEY, "l_partkey", "l_suppkey")


def signed_lines(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    sign = F.when(F.col("l_returnflag") == "R", -price).otherwise(price)
    return table(spark, sf, "lineitem").withColumn("amount", F.round(sign / 50000) * 10)


@query
def duplicate_key_audit(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates.audit(table(spark, sf, "lineitem"), NAIVE_KEY)


@query
def duplicate_key_comparison(spark: SparkSession, sf: str) -> DataFrame:
    lists = {"order": NAIVE_KEY[:1], "order_line": NAIVE_KEY, "order_line_part": WIDER_KEY}
    return duplicates.compare_keys(table(spark, sf, "lineitem"), lists)


@query
def duplicate_key_comparison_unrelated(spark: SparkSession, sf: str) -> DataFrame:
    lists = {"order_line": NAIVE_KEY, "order_part": ("l_orderkey", "l_partkey")}
    return duplicates.compare_keys(table(spark, sf, "lineitem"), lists)


@query
def duplicate_group_classes(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates.classify(signed_lines(spark, sf), NAIVE_KEY, "amount")


@query
def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    summary = duplicates.group_summary(signed_lines(spark, sf), NAIVE_KEY, "amount")
    return summary.withColumn("net", F.col("net").cast("double"))


@query
def top_duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates.top_groups(table(spark, sf, "lineitem"), NAIVE_KEY, 10)


@query
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*WIDER_KEY, "l_extendedprice")
    return duplicates.duplicate_rows(lines, NAIVE_KEY)


@query
def rows_like_top_group(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*WIDER_KEY, "l_extendedprice")
    return duplicates.rows_like(lines, duplicates.top_groups(lines, NAIVE_KEY, 1), NAIVE_KEY)


@query
def dedup_guard(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*WIDER_KEY, "l_extendedprice", "l_shipdate")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return duplicates.guard(lines, NAIVE_KEY, order)


@query
def dedup_guard_none_expected(spark: SparkSession, sf: str) -> DataFrame:
    """The guard on a key that should not repeat."""
    lines = table(spark, sf, "lineitem").select(*WIDER_KEY, "l_extendedprice", "l_shipdate")
    return duplicates.guard(lines, WIDER_KEY, ["l_shipdate", "l_extendedprice"], expect_none=True)
