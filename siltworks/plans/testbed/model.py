"""Dimensions, version history, facts and their measures.

Sign-up and error events of users stand in for contract changes, purchases for trips that need a version.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions.casting import money_sum
from siltworks.functions.dates import instant
from siltworks.operators import dimensions, facts, history
from siltworks.plans.testbed.standins import classified, query, table, trips
from siltworks.session import work_dir
from siltworks.sources import snapshots, tables, versions


def date_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.date_dim(table(spark, sf, "orders"), "o_orderdate")


def zones(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with their nation stand in for zones with their borough."""
    suppliers, nations = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))


def location_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.location_dim(
        zones(spark, sf), {"location_key": "s_suppkey", "borough": "n_name", "zone_name": "s_name"}, "location_key"
    )


@query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return date_dimension(spark, sf)


@query
def dim_location_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return location_dimension(spark, sf)


@query
def reference_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The reference file as it lands, with a header in mixed case, and its dimension."""
    place = work_dir(spark, "zones")
    columns = {"LocationID": "s_suppkey", "Borough": "n_name", "Zone": "s_name"}
    landed = zones(spark, sf).select(*[F.col(source).alias(name) for name, source in columns.items()])
    landed.write.option("header", True).csv(place)
    read = tables.read_reference_csv(spark, place, "LocationID int, Borough string, Zone string")
    columns = {"location_key": "locationid", "borough": "borough", "zone_name": "zone"}
    return dimensions.location_dim(read, columns, "location_key")


# Names of the order states; one state is left to the default.
ORDER_STATES = {"O": "Open", "F": "Filled"}


def state_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.code_dim(
        table(spark, sf, "orders"), "o_orderstatus", ORDER_STATES, "Unknown state", "state_key", "state_name"
    )


@query
def dim_code_table(spark: SparkSession, sf: str) -> DataFrame:
    return state_dimension(spark, sf)


def tier_changes(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").filter(F.col("event_type").isin("signup", "error"))
    tier = F.when(F.col("value") >= 100, "Premium").otherwise("Standard")
    return events.select("user_id", "event_type", tier.alias("contract_tier"), F.col("ts").alias("updated_at"))


def build_versions(spark: SparkSession, sf: str) -> DataFrame:
    log = history.history_from_log(tier_changes(spark, sf), "user_id", "updated_at", ["contract_tier"])
    return history.dimension(log, "user_id", ["contract_tier"], "version_key")


@cache
def versions_root(spark: SparkSession, sf: str) -> str:
    """The version dimension as a table, which facts and checks read; written once for each session."""
    root = work_dir(spark, "gold")
    versions.publish(build_versions(spark, sf), root, "dim_user_scd2")
    return root


def tier_versions(spark: SparkSession, sf: str) -> DataFrame:
    return versions.read(spark, versions_root(spark, sf), "dim_user_scd2")


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    bought = table(spark, sf, "events").filter("event_type = 'purchase'")
    return bought.select("event_id", "user_id", "ts", F.col("value").alias("amount"))


def purchase_fact(spark: SparkSession, sf: str, strategy: str = "auto") -> DataFrame:
    attach = {"version_key": "version_key"}
    return history.point_in_time(
        purchases(spark, sf), tier_versions(spark, sf), "user_id", "ts", attach, "user_id", strategy=strategy
    )


@query
def scd2_versions(spark: SparkSession, sf: str) -> DataFrame:
    return build_versions(spark, sf)


@query
def scd2_same_day(spark: SparkSession, sf: str) -> DataFrame:
    """The history of changes known by day only: of several on one day the last stands."""
    log = tier_changes(spark, sf).withColumn("updated_at", F.date_trunc("day", "updated_at").cast("timestamp_ntz"))
    built = history.history_from_log(log, "user_id", "updated_at", ["contract_tier"])
    versions_ = history.dimension(built, "user_id", ["contract_tier"], "version_key")
    return versions_.select("user_id", "contract_tier", "effective_start_date", "effective_end_date")


@query
def snapshot_apply(spark: SparkSession, sf: str) -> DataFrame:
    """The history after three looks at each user's latest state."""
    changes = tier_changes(spark, sf)
    result = None
    for cut in ("2024-01-08", "2024-01-15", "2024-01-31"):
        seen = changes.filter(F.col("updated_at") < instant(cut))
        latest = seen.groupBy("user_id").agg(F.max(F.struct("updated_at", "contract_tier")).alias("last"))
        source = latest.select("user_id", "last.contract_tier", "last.updated_at")
        if result is None:
            result = history.start_history(source, "updated_at")
        else:
            result = history.snapshot(result, source, "user_id", "updated_at")
    return result


@cache
def seeded_history(spark: SparkSession, sf: str) -> str:
    """The history that three seed files leave in stored snapshots, the second of them taken twice."""
    place = work_dir(spark, "seeds")
    ddl = "user_id bigint, contract_tier string, updated_at timestamp_ntz"
    for cut in ("2024-01-08", "2024-01-15", "2024-01-31"):
        seen = tier_changes(spark, sf).filter(F.col("updated_at") < instant(cut))
        latest = seen.groupBy("user_id").agg(F.max(F.struct("updated_at", "contract_tier")).alias("last"))
        seed = latest.select("user_id", "last.contract_tier", F.col("last.updated_at").cast("string").alias("updated_at"))
        seed.write.option("header", True).csv(f"{place}/{cut}")
        for _ in range(1 + (cut == "2024-01-15")):
            snapshots.apply(tables.read_seed(spark, f"{place}/{cut}", ddl), f"{place}/root", "user_tiers", "user_id", "updated_at")
    return f"{place}/root"


@query
def seed_snapshot_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Seed files, the snapshots stored of each, and the dimension that they give."""
    stored = snapshots.read(spark, seeded_history(spark, sf), "user_tiers")
    return history.dimension(stored, "user_id", ["contract_tier"], "version_key").drop("version_key")


@query
def seed_snapshot_runs(spark: SparkSession, sf: str) -> DataFrame:
    """What each run stored: a repeated seed has no run."""
    log = versions.history(spark, seeded_history(spark, sf))
    return log.groupBy("version").pivot("name", ["user_tiers_open", "user_tiers_closed"]).agg(F.sum("rows"))


@query
def fact_point_in_time(spark: SparkSession, sf: str) -> DataFrame:
    return purchase_fact(spark, sf)


@query
def fact_point_in_time_merge(spark: SparkSession, sf: str) -> DataFrame:
    return purchase_fact(spark, sf, "chapters")


@query
def version_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return history.coverage(purchase_fact(spark, sf), "version_key")


@query
def missing_version_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Users who bought but never had a Premium version."""
    premium = tier_versions(spark, sf).filter("contract_tier = 'Premium'")
    return history.missing_keys(purchases(spark, sf), premium, "user_id", "user_id")


def trip_fact(spark: SparkSession, sf: str) -> DataFrame:
    rows = classified(spark, sf).withColumn("location_id", F.nullif(F.col("vendor_id"), F.lit(5)))
    return facts.build(
        rows,
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_date_key",
        "trip_duration_minutes",
        {"vendor_key": "vendor_id"},
        {"pu_location_key": "location_id"},
        ("order_key", "line_number", "service_type", "trip_distance", "fare_amount", "total_amount", "is_reversal"),
    )


@query
def fact_trips(spark: SparkSession, sf: str) -> DataFrame:
    return trip_fact(spark, sf)


@query
def unknown_member_usage(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.unknown_usage(trip_fact(spark, sf), ["pu_location_key", "vendor_key"])


@query
def gross_net_measures(spark: SparkSession, sf: str) -> DataFrame:
    rows = trips(spark, sf).withColumn("is_reversal", F.col("total_amount") < 0)
    return facts.gross_net(rows, "total_amount", "is_reversal", ["vendor_id"])


def tier_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return facts.attribution_matrix(
        purchase_fact(spark, sf),
        tier_versions(spark, sf),
        "contract_tier",
        "amount",
        "user_id",
        "version_key",
        "user_id",
        "version_key",
    )


@query
def attribution_type1_type2(spark: SparkSession, sf: str) -> DataFrame:
    return facts.attribution(tier_matrix(spark, sf))


@query
def misattributed_amount(spark: SparkSession, sf: str) -> DataFrame:
    return facts.misattributed(tier_matrix(spark, sf))


@query
def fact_star_join(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases with the tier of their version, by one equality."""
    fact = purchase_fact(spark, sf)
    joined = facts.with_attribute(fact, tier_versions(spark, sf), "version_key", "version_key", "contract_tier", "tier")
    return joined.select("event_id", "amount", "tier")


@query
def fact_current_join(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases with the tier that is current now."""
    current = tier_versions(spark, sf).filter("is_current")
    joined = facts.with_attribute(purchases(spark, sf), current, "user_id", "user_id", "contract_tier", "tier")
    return joined.select("event_id", "amount", "tier")


@query
def fact_location_join(spark: SparkSession, sf: str) -> DataFrame:
    fact = trip_fact(spark, sf)
    places = location_dimension(spark, sf)
    joined = facts.with_attribute(fact, places, "pu_location_key", "location_key", "borough", "borough")
    return joined.groupBy("borough").agg(F.count("*").alias("n_rows"), money_sum("total_amount").alias("revenue"))
