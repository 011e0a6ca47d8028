"""Physical layout and table versions."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.casting import money_sum
from siltworks.functions.dates import date_key
from siltworks.operators import history
from siltworks.plans.testbed import feeds
from siltworks.plans.testbed.model import purchases, tier_changes, tier_versions
from siltworks.plans.testbed.standins import query, table
from siltworks.session import stored, work_dir
from siltworks.sources import landing, layout, versions


DAY_RANGE = (19970301, 19970307)


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("pickup_date_key", date_key(F.col("o_orderdate")))


@cache
def order_layouts(spark: SparkSession, sf: str) -> dict[str, str]:
    """Orders as they come and clustered by day, written once for each session."""
    orders, root = order_days(spark, sf), work_dir(spark, "layout")
    files = max(4, layout.suggested_files(landing.inventory(spark, f"{sf}/orders.parquet")))
    plain = versions.publish(orders.repartition(files, "o_orderkey"), root, "orders")
    arranged = versions.publish(layout.cluster(orders, ["pickup_date_key"], files), root, "orders", versions.CLUSTER)
    two = layout.cluster(orders, ["pickup_date_key", "o_custkey"], files)
    both = versions.publish(two, root, "orders", versions.CLUSTER)
    named = {"plain": plain, "clustered": arranged, "morton": both}
    return {label: versions.version_path(root, "orders", v) for label, v in named.items()}


def pruned_measure(spark: SparkSession, sf: str, low: int, high: int) -> DataFrame:
    """A range of days from the clustered table; the scan skips what its footers exclude."""
    rows = spark.read.parquet(order_layouts(spark, sf)["clustered"]).filter(F.col("pickup_date_key").between(low, high))
    return rows.agg(F.count("*").alias("trips"), F.coalesce(money_sum("o_totalprice"), F.lit(0.0)).alias("revenue"))


@query
def clustered_day_query(spark: SparkSession, sf: str) -> DataFrame:
    return pruned_measure(spark, sf, DAY_RANGE[0], DAY_RANGE[0])


@query
def clustered_range_query(spark: SparkSession, sf: str) -> DataFrame:
    return pruned_measure(spark, sf, *DAY_RANGE)


@query
def unclustered_range_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = order_days(spark, sf).filter(F.col("pickup_date_key").between(*DAY_RANGE))
    return rows.agg(F.count("*").alias("trips"), F.coalesce(money_sum("o_totalprice"), F.lit(0.0)).alias("revenue"))


@query
def file_stats_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and key bounds of each layout, as the footers of its files state them."""
    lines = []
    for label, path in order_layouts(spark, sf).items():
        totals = layout.file_stats(spark, path, ["pickup_date_key", "o_orderkey"]).agg(
            F.sum("n_rows").alias("n_rows"),
            F.min("min_pickup_date_key").alias("first_day"),
            F.max("max_pickup_date_key").alias("last_day"),
            F.min("min_o_orderkey").alias("first_order"),
            F.max("max_o_orderkey").alias("last_order"),
        )
        lines.append(totals.select(F.lit(label).alias("layout"), "*"))
    return reduce(lambda a, b: a.unionByName(b), lines)


@query
def files_scanned_report(spark: SparkSession, sf: str) -> DataFrame:
    return layout.layout_report(spark, order_layouts(spark, sf), {"pickup_date_key": DAY_RANGE})


@query
def clustered_opens_fewer(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a week of days opens fewer files of the clustered orders than of the others, which hold as many rows."""
    report = layout.layout_report(spark, order_layouts(spark, sf), {"pickup_date_key": DAY_RANGE})
    opened = lambda label: F.max(F.when(F.col("layout") == label, F.col("files_scanned")))
    return report.agg((opened("clustered") < opened("plain")).alias("fewer"))


@query
def landing_folders(spark: SparkSession, sf: str) -> DataFrame:
    """The folders in which the inventory finds files."""
    files = landing.inventory(spark, feeds.drifted_landing(spark, sf))
    folder = F.regexp_extract("path", "(period=[^/]+)/", 1)
    return files.groupBy(folder.alias("folder")).agg((F.count("*") > 0).alias("has_files"))


@query
def morton_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The table clustered by two columns holds the same rows."""
    stored = spark.read.parquet(order_layouts(spark, sf)["morton"])
    return stored.select("o_orderkey", "o_custkey", "pickup_date_key", "o_totalprice")


@query
def version_history(spark: SparkSession, sf: str) -> DataFrame:
    root = order_layouts(spark, sf)["plain"].rsplit("/orders/", 1)[0]
    return versions.history(spark, root, "orders").select("name", "version", "operation", "rows")


@query
def version_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases without a version, before and after error events count as changes."""
    root = work_dir(spark, "versions")
    everything = tier_versions(spark, sf)
    signups = tier_changes(spark, sf).filter("event_type = 'signup'")
    known = history.history_from_log(signups, "user_id", "updated_at", ["contract_tier"])
    partial = stored(history.dimension(known, "user_id", ["contract_tier"], "version_key"), "partial-versions")
    attach, bought = {"version_key": "version_key"}, purchases(spark, sf)
    numbers = []
    for side in (partial, everything):
        fact = history.point_in_time(bought, side, "user_id", "ts", attach, "user_id")
        numbers.append(versions.publish(fact, root, "fct_purchases"))
    measures = {"rows_total": F.count("*"), "rows_unmatched": F.count("*") - F.count("version_key")}
    return versions.compare(spark, root, "fct_purchases", numbers, measures)
