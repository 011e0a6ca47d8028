"""Checks that return the offenders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import checks, history
from siltworks.operators.checks import TableChecks
from siltworks.plans.testbed.keys import NAIVE_KEY
from siltworks.plans.testbed.model import date_dimension, purchases, state_dimension, tier_versions, trip_fact
from siltworks.plans.testbed.standins import query, table, trips


@query
def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = trips(spark, sf).select("order_key", "line_number", "part_key", "passenger_count")
    return checks.not_null(rows, ["order_key", "passenger_count"]).drop("null_columns", "passenger_count")


@query
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return checks.unique(table(spark, sf, "lineitem"), NAIVE_KEY)


@query
def check_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of orders that are not among those with a positive balance."""
    known = table(spark, sf, "customer").filter("c_acctbal > 0")
    return checks.relationships(table(spark, sf, "orders"), "o_custkey", known, "c_custkey")


@query
def check_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return checks.accepted_values(table(spark, sf, "orders"), "o_orderstatus", ["O", "F"])


@query
def check_accepted_range(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return checks.accepted_range(lines, "l_discount", low=0, inclusive=False)


def stretched_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Tier versions whose Premium ones last a day too long."""
    late = F.col("effective_end_date") + F.expr("interval 1 day")
    stretched = (F.col("contract_tier") == "Premium") & ~F.col("is_current")
    end = F.when(stretched, late).otherwise(F.col("effective_end_date"))
    return tier_versions(spark, sf).withColumn("effective_end_date", end)


@query
def check_no_overlap(spark: SparkSession, sf: str) -> DataFrame:
    found = checks.no_overlap(stretched_versions(spark, sf), "user_id", "version_key")
    return found.select("user_id", "later_version", "later_start", "earlier_end")


@query
def check_overlapping_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return checks.overlapping_pairs(stretched_versions(spark, sf), "user_id", "version_key")


def stretched_fact(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    """Purchases with every version valid at their instant."""
    attach = {"version_key": "version_key"}
    return history.point_in_time(
        purchases(spark, sf), stretched_versions(spark, sf), "user_id", "ts", attach, "user_id", strategy=strategy
    )


@query
def fact_point_in_time_overlapping_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    return stretched_fact(spark, sf, "broadcast")


@query
def fact_point_in_time_overlapping_merge(spark: SparkSession, sf: str) -> DataFrame:
    return stretched_fact(spark, sf, "chapters")


@query
def check_overlap_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    """The overlap check with its boundary operator inverted: it must report sound versions."""
    found = checks.no_overlap(tier_versions(spark, sf), "user_id", "version_key", touching=True)
    return found.select("user_id", "earlier_version", "later_version", "later_start")


@query
def check_suite_report(spark: SparkSession, sf: str) -> DataFrame:
    suite = [
        TableChecks(
            "dim_date",
            not_null=("date_key", "full_date"),
            unique=("date_key",),
            accepted_values={"is_weekend": (True, False)},
        ),
        TableChecks("dim_state", not_null=("state_key", "state_name"), unique=("state_key",)),
        TableChecks(
            "fct_trips",
            not_null=("pickup_date_key", "total_amount"),
            accepted_values={"service_type": ("A", "N")},
            above={"total_amount": 0},
            relationships={
                "pickup_date_key": ("dim_date", "date_key"),
                "pu_location_key": ("dim_location", "location_key"),
            },
        ),
    ]
    built = {
        "dim_date": date_dimension(spark, sf),
        "dim_state": state_dimension(spark, sf),
        "dim_location": table(spark, sf, "supplier").select(F.col("s_suppkey").alias("location_key")),
        "fct_trips": trip_fact(spark, sf),
    }
    return checks.run(built, suite)
