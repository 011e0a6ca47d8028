"""Small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.plans.testbed.standins import query, table, trips
from siltworks.sources import tables


@query
def preview_rows(spark: SparkSession, sf: str) -> DataFrame:
    ordered = table(spark, sf, "orders").orderBy("o_orderkey")
    return tables.preview(ordered.select("o_orderkey", "o_orderstatus", "o_totalprice"), 5)


@query
def table_description(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of the trips with their types and nulls."""
    return tables.column_report(trips(spark, sf))


@query
def mean_distance_by_service(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.groupBy(F.col("l_returnflag").alias("service_type")).agg(
        F.count("*").alias("n_rows"), F.round(F.avg("l_quantity"), 2).alias("mean_distance")
    )


@query
def counts_by_status(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), "o_orderstatus")
