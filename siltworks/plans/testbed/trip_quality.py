"""Rules, reasons and quality measures on trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.casting import money_sum
from siltworks.functions.dates import outside_period
from siltworks.operators import harmonize, quality
from siltworks.plans.testbed.standins import FLAGS, ROW, classified, query, rules, silver_root, trips
from siltworks.plans.trips import publish_metrics, read_silver
from siltworks.session import work_dir


@query
def profile_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What is worth knowing of order lines before rules are chosen."""
    waited = F.col("dropoff_datetime") - F.expr("interval 7 days")
    named: dict[str, Column | str] = {
        "whole_price": "fare_amount = floor(fare_amount)",
        "bulk_quantity": "trip_distance >= 40",
        "first_line": "line_number = 1",
        "returned": "total_amount < 0",
        "weekend_order": F.weekday("pickup_datetime") >= 5,
        "shipped_within_week": waited <= F.col("pickup_datetime"),
        "missing_quantity": "passenger_count is null",
    }
    return quality.profile(trips(spark, sf), named, ["service_type"])


@query
def fatal_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = harmonize.with_file_period(trips(spark, sf))
    return quality.fatal_totals(rows, rules(), ["service_type"])


@query
def quarantine_reason_counts(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = quality.split(classified(spark, sf))
    counts = quality.reason_counts(rejected, ["service_type"])
    return counts.orderBy("service_type", F.desc("rows_quarantined"), quality.REASON)


@query
def failed_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    failed = classified(spark, sf).select("service_type", F.explode("_failed_rules").alias("rule"))
    return failed.groupBy("service_type", "rule").agg(F.count("*").alias("rows_failed"))


@query
def quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Of trips that are published apart: each part is scanned once, and what they have in common counted together."""
    clean, rejected = read_silver(spark, silver_root(spark, sf))
    return quality.metrics(clean, rejected, ["service_type"], FLAGS)


@query
def stored_quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics and reasons of the published trips as tables of their own, measured at one instant."""
    per_service, reasons = publish_metrics(*read_silver(spark, silver_root(spark, sf)), work_dir(spark, "metrics"))
    instants = F.count_distinct("measured_at").alias("n_instants")
    total = per_service.agg(F.sum("rows_quarantined").alias("rows_quarantined"), F.sum("rows_clean").alias("rows_clean"), instants)
    counted = reasons.agg(F.sum("rows_quarantined").alias("by_reason"), F.count_distinct(quality.REASON).alias("n_reasons"))
    return total.join(counted, F.col("rows_quarantined") == F.col("by_reason"), "left")


@query
def quality_metrics_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    return quality.metrics_in_one_pass(classified(spark, sf), ["service_type"], FLAGS)


@query
def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    clean, _ = quality.split(classified(spark, sf))
    return clean.select(*ROW, "passenger_count_missing", "is_reversal", "_file_period")


@query
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = quality.split(classified(spark, sf))
    return rejected.select(*ROW, quality.REASON)


@query
def conservation_check(spark: SparkSession, sf: str) -> DataFrame:
    """The trips against the two tables they were published as."""
    clean, rejected = read_silver(spark, silver_root(spark, sf))
    parts = {"clean": clean, "quarantine": rejected}
    return quality.conservation(trips(spark, sf), parts, ["service_type", "_source_file"], ROW)


@query
def unaccounted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that would be lost if quarantine were thrown away."""
    clean, _ = read_silver(spark, silver_root(spark, sf))
    return quality.unaccounted(trips(spark, sf), [clean], ["order_key", "line_number"])


@query
def missing_rate_by_month(spark: SparkSession, sf: str) -> DataFrame:
    rows = trips(spark, sf).withColumn("passenger_count_missing", F.col("passenger_count").isNull())
    return quality.missing_trend(rows, "pickup_datetime", "passenger_count_missing", ["service_type"])


@query
def service_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Orders, suppliers and the largest line behind the accepted rows of each return flag."""
    clean, _ = quality.split(classified(spark, sf))
    return clean.groupBy("service_type").agg(
        F.count_distinct("order_key").alias("n_orders"),
        F.count_distinct("vendor_id").alias("n_suppliers"),
        F.max("fare_amount").alias("largest_line"),
        money_sum("total_amount").alias("balance"),
    )


@query
def period_window_violations(spark: SparkSession, sf: str) -> DataFrame:
    rows = harmonize.with_file_period(trips(spark, sf))
    outside = rows.filter(outside_period(F.col("pickup_datetime"), F.col("_file_period")))
    return outside.groupBy("_source_file", "_file_period").agg(F.count("*").alias("rows_outside"))


@query
def published_split(spark: SparkSession, sf: str) -> DataFrame:
    """Clean and rejected rows written in one job under one version, and read back apart."""
    clean, rejected = read_silver(spark, silver_root(spark, sf))
    good = clean.groupBy("service_type").agg(F.count("*").alias("rows_clean"), money_sum("total_amount").alias("revenue"))
    bad = rejected.groupBy("service_type").agg(F.count("*").alias("rows_quarantined"))
    return good.join(bad, "service_type", "full_outer")
