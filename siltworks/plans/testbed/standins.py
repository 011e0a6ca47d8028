"""The registry of queries, and what stands in for trips.

Order lines joined to their orders are trips. Suppliers are zones and vendors.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.dates import month_text, outside_period
from siltworks.operators import harmonize, quality
from siltworks.operators.quality import Rule
from siltworks.plans.trips import publish_silver
from siltworks.session import work_dir
from siltworks.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its own name."""
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf}/{name}.parquet")


def trips(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    price = F.col("l_extendedprice")
    claimed = month_text(F.col("o_orderdate") + F.expr("interval 3 days"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("vendor_id"),
        F.col("l_returnflag").alias("service_type"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.nullif(F.col("l_quantity"), F.lit(2.0)).alias("passenger_count"),
        price.alias("fare_amount"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("total_amount"),
        F.concat(F.lit("trips_"), claimed, F.lit(".parquet")).alias("_source_file"),
    )


def rules() -> list[Rule]:
    return [
        Rule("cheap_line", "fare_amount < 2000"),
        Rule("single_unit", "trip_distance <= 1"),
        Rule("shipped_before_order", "dropoff_datetime <= pickup_datetime"),
        Rule("order_outside_file_month", outside_period(F.col("pickup_datetime"), F.col("_file_period"))),
    ]


def classified(spark: SparkSession, sf: str) -> DataFrame:
    flagged = harmonize.with_file_period(trips(spark, sf)).withColumns(
        {"passenger_count_missing": F.col("passenger_count").isNull(), "is_reversal": F.col("total_amount") < 0}
    )
    return quality.first_reason(flagged, rules(), all_failed="_failed_rules")


FLAGS = {"passenger_count_missing": "passenger_count_missing", "reversal_rows": "is_reversal"}
ROW = ("order_key", "line_number", "part_key", "vendor_id", "service_type", "total_amount")


@cache
def silver_root(spark: SparkSession, sf: str) -> str:
    """Clean and rejected trips as published tables, written once for each session."""
    root = work_dir(spark, "silver")
    publish_silver(classified(spark, sf).drop("_failed_rules"), root)
    return root
