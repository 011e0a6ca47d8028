"""Taxi trips of two services, from landing files to a tested star schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import FeedContract, Field
from siltworks.functions.dates import instant, outside_period
from siltworks.operators import checks, dimensions, facts, harmonize, history, quality
from siltworks.operators.checks import TableChecks
from siltworks.operators.quality import Rule
from siltworks.sources import versions
from siltworks.streaming import ingest

# Names, spellings and types of the source columns. Where monthly files disagree on
# a type, the wider one is declared.
_COMMON_ENDS = (
    Field("fare_amount", "double"),
    Field("extra", "double"),
    Field("mta_tax", "double"),
    Field("tip_amount", "double"),
    Field("tolls_amount", "double"),
    Field("improvement_surcharge", "double"),
    Field("total_amount", "double"),
    Field("congestion_surcharge", "double"),
)
YELLOW = FeedContract(
    "yellow",
    "yellow_tripdata_*.parquet",
    (
        Field("vendor_id", "bigint", "VendorID"),
        Field("pickup_datetime", "timestamp_ntz", "tpep_pickup_datetime"),
        Field("dropoff_datetime", "timestamp_ntz", "tpep_dropoff_datetime"),
        Field("passenger_count", "double"),
        Field("trip_distance", "double"),
        Field("ratecode_id", "double", "RatecodeID"),
        Field("store_and_fwd_flag", "string"),
        Field("pu_location_id", "bigint", "PULocationID"),
        Field("do_location_id", "bigint", "DOLocationID"),
        Field("payment_type", "bigint"),
        *_COMMON_ENDS,
        Field("airport_fee", "double", "airport_fee", ("Airport_fee",)),
    ),
)
GREEN = FeedContract(
    "green",
    "green_tripdata_*.parquet",
    (
        Field("vendor_id", "bigint", "VendorID"),
        Field("pickup_datetime", "timestamp_ntz", "lpep_pickup_datetime"),
        Field("dropoff_datetime", "timestamp_ntz", "lpep_dropoff_datetime"),
        Field("store_and_fwd_flag", "string"),
        Field("ratecode_id", "double", "RatecodeID"),
        Field("pu_location_id", "bigint", "PULocationID"),
        Field("do_location_id", "bigint", "DOLocationID"),
        Field("passenger_count", "double"),
        Field("trip_distance", "double"),
        *_COMMON_ENDS,
        Field("ehail_fee", "double"),
        Field("payment_type", "bigint"),
        Field("trip_type", "double"),
    ),
)
FEEDS = (YELLOW, GREEN)

# File names, columns recovered from rescued data, rule names and their order.
LANDING_NAME = "{service_type}_tripdata_{year}-{month}.parquet"
RECOVERED = (
    "vendor_id",
    "passenger_count",
    "ratecode_id",
    "pu_location_id",
    "do_location_id",
    "payment_type",
    "airport_fee",
    "ehail_fee",
    "trip_type",
)
NEGATIVE_FARE = "negative_fare"
BAD_DISTANCE = "zero_or_negative_distance"
BAD_ORDER = "dropoff_before_pickup"
OUTSIDE_PERIOD = "pickup_outside_file_period"

# Vendor names by code, and the typed columns of the hand-kept vendor file.
VENDOR_NAMES = {1: "Creative Mobile Technologies, LLC", 2: "VeriFone Inc."}
UNKNOWN_VENDOR = "Unknown vendor"
VENDOR_SEED = "vendor_id int, vendor_name string, contract_tier string, updated_at timestamp"

# What makes two trips the same. The short key also matches a charge and its
# reversal; the long one tells them apart.
SHORT_KEY = ("pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id", "trip_distance", "fare_amount")
LONG_KEY = (*SHORT_KEY, "total_amount", "vendor_id", "payment_type")


def fatal_rules() -> list[Rule]:
    """In order: the first that fails is the reason. A null value does not fail."""
    return [
        Rule(NEGATIVE_FARE, "fare_amount < 0"),
        Rule(BAD_DISTANCE, "trip_distance <= 0"),
        Rule(BAD_ORDER, "dropoff_datetime <= pickup_datetime"),
        Rule(OUTSIDE_PERIOD, outside_period(F.col("pickup_datetime"), F.col("_file_period"))),
    ]


def profile_checks(first: str, after: str) -> dict[str, Column | str]:
    """Checks on harmonised trips for a window ``[first, after)``, and rows the period rule cannot judge."""
    pickup = F.col("pickup_datetime")
    # The names of the checks.
    return {
        "negative_fare": "fare_amount < 0",
        "zero_or_neg_distance": "trip_distance <= 0",
        "passenger_zero": "passenger_count = 0",
        "passenger_over_8": "passenger_count > 8",
        "passenger_null": "passenger_count is null",
        "dropoff_before_pickup": "dropoff_datetime <= pickup_datetime",
        "outside_window": (pickup < instant(first)) | (pickup >= instant(after)),
        "null_pickup_location": "pu_location_id is null",
        "unknown_file_period": "_file_period is null",
    }


def ingest_feeds(spark: SparkSession, landing_dir: str, bronze: str, state: str, **options) -> dict[str, ingest.Ingestion]:
    """Load what is new in every feed, under one run id."""
    run_id = options.pop("run_id", None) or ingest.new_run_id()
    return {c.feed: ingest.ingest(spark, c, landing_dir, bronze, state, run_id, **options) for c in FEEDS}


def harmonise(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """One table of trips with recovered values and the period of their file."""
    feeds = [harmonize.to_canonical(bronze[c.feed], c, {"service_type": c.feed}) for c in FEEDS if c.feed in bronze]
    plan = harmonize.recovery_plan(FEEDS, RECOVERED)
    trips = harmonize.union_feeds(*feeds)
    plan = {name: how for name, how in plan.items() if name in trips.columns}
    return harmonize.with_file_period(harmonize.recover_rescued(trips, plan))


def classify(trips: DataFrame) -> DataFrame:
    """Add the reason for quarantine and the flags that do not reject a trip."""
    flagged = trips.withColumns(
        {"passenger_count_missing": F.col("passenger_count").isNull(), "is_reversal": F.col("total_amount") < 0}
    )
    return quality.first_reason(flagged, fatal_rules())


SILVER = "silver_trips"
_REJECTED = "_rejected"


def publish_silver(classified: DataFrame, root: str, even_files: bool = False) -> int:
    """Write clean and rejected trips in one job, as two partitions of one version.

    Every input split writes its rejected rows to a file of its own unless ``even_files`` is set.
    """
    marked = classified.withColumn(_REJECTED, F.col(quality.REASON).isNotNull())
    return versions.publish(marked, root, SILVER, partition_by=[_REJECTED], even_files=even_files)


def read_silver(spark: SparkSession, root: str, version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantine)`` of one version; each reads only its own partition."""
    rows = versions.read(spark, root, SILVER, version)
    clean = rows.filter(~F.col(_REJECTED)).drop(_REJECTED, quality.REASON)
    return clean, rows.filter(F.col(_REJECTED)).drop(_REJECTED)


# The flags that the metrics count, and the measures of the fact.
METRIC_FLAGS = {"passenger_count_missing": "passenger_count_missing", "reversal_rows": "is_reversal"}


def silver_metrics(clean: DataFrame, quarantine: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quality per service, and rejected rows per service and reason."""
    by = ["service_type"]
    now = F.current_timestamp()
    per_service = quality.metrics(clean, quarantine, by, METRIC_FLAGS).withColumn("measured_at", now)
    return per_service, quality.reason_counts(quarantine, by).withColumn("measured_at", now)


FACT_MEASURES = (
    "trip_distance",
    "passenger_count",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "total_amount",
)


@dataclass(frozen=True)
class Star:
    """The gold tables."""

    dim_date: DataFrame
    dim_location: DataFrame
    dim_vendor: DataFrame
    dim_vendor_scd2: DataFrame
    fct_trips: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def vendor_versions(vendor_history: DataFrame) -> DataFrame:
    return history.dimension(vendor_history, "vendor_id", ["vendor_name", "contract_tier"], "vendor_sk")


def fct_trips(trips: DataFrame, vendor_dim: DataFrame, strategy: str = "auto") -> DataFrame:
    """One row per trip, with the vendor version valid at pickup."""
    attached = history.point_in_time(
        trips,
        vendor_dim,
        "vendor_id",
        "pickup_datetime",
        {"vendor_version_key": "vendor_sk"},
        "vendor_id",
        strategy=strategy,
    )
    return facts.build(
        attached,
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_date_key",
        "trip_duration_minutes",
        {"vendor_key": "vendor_id", "vendor_version_key": "vendor_version_key"},
        {"pu_location_key": "pu_location_id", "do_location_key": "do_location_id"},
        ("service_type", "payment_type", "ratecode_id", *FACT_MEASURES, "passenger_count_missing", "is_reversal"),
    )


def publish_star(trips: DataFrame, zones: DataFrame, vendor_history: DataFrame, root: str) -> Star:
    """The gold tables as stored: the dimensions first, then the fact, which reads the stored versions."""
    built = star(trips, zones, vendor_history).tables()
    spark = trips.sparkSession
    dims = {name: df for name, df in built.items() if name.startswith("dim_")}
    versions.publish_all(dims, root)
    kept = {name: versions.read(spark, root, name) for name in dims}
    versions.publish(fct_trips(trips, kept["dim_vendor_scd2"]), root, "fct_trips")
    return Star(**kept, fct_trips=versions.read(spark, root, "fct_trips"))


def publish_metrics(clean: DataFrame, quarantine: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """The silver metrics as stored tables: quality per service, and reasons."""
    per_service, reasons = silver_metrics(clean, quarantine)
    versions.publish_all({"silver_metrics": per_service, "silver_reasons": reasons}, root)
    return versions.read(clean.sparkSession, root, "silver_metrics"), versions.read(clean.sparkSession, root, "silver_reasons")


def star(trips: DataFrame, zones: DataFrame, vendor_history: DataFrame) -> Star:
    vendor_dim = vendor_versions(vendor_history)
    zone_columns = {"location_key": "locationid", "borough": "borough", "zone_name": "zone", "service_zone": "service_zone"}
    return Star(
        dim_date=dimensions.date_dim(trips, "pickup_datetime"),
        dim_location=dimensions.location_dim(zones, zone_columns, "location_key"),
        dim_vendor=dimensions.code_dim(trips, "vendor_id", VENDOR_NAMES, UNKNOWN_VENDOR, "vendor_key", "vendor_name"),
        dim_vendor_scd2=vendor_dim,
        fct_trips=fct_trips(trips, vendor_dim),
    )


# The declared checks, as table, columns and accepted values.
SUITE = (
    TableChecks(
        "dim_date",
        not_null=("date_key", "full_date"),
        unique=("date_key",),
        accepted_values={"is_weekend": (True, False)},
    ),
    TableChecks("dim_location", not_null=("location_key", "borough", "zone_name"), unique=("location_key",)),
    TableChecks("dim_vendor", not_null=("vendor_key", "vendor_name"), unique=("vendor_key",)),
    TableChecks(
        "fct_trips",
        not_null=(
            "pickup_date_key",
            "pu_location_key",
            "do_location_key",
            "vendor_key",
            "vendor_version_key",
            "service_type",
            "total_amount",
            "trip_distance",
        ),
        accepted_values={"service_type": ("yellow", "green")},
        above={"trip_distance": 0},
        relationships={
            "pickup_date_key": ("dim_date", "date_key"),
            "pu_location_key": ("dim_location", "location_key"),
            "do_location_key": ("dim_location", "location_key"),
            "vendor_key": ("dim_vendor", "vendor_key"),
            "vendor_version_key": ("dim_vendor_scd2", "vendor_sk"),
        },
    ),
    TableChecks(
        "dim_vendor_scd2",
        not_null=("vendor_sk", "vendor_id", "effective_start_date", "effective_end_date", "is_current"),
        unique=("vendor_sk",),
        accepted_values={"contract_tier": ("Standard", "Premium")},
    ),
)


def check_star(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All 34 checks with their number of failures."""
    declared = checks.run(tables, SUITE)
    overlaps = checks.no_overlap(tables["dim_vendor_scd2"], "vendor_id", "vendor_sk")
    return declared.unionByName(
        overlaps.agg(F.count("*").alias("failures")).select(
            F.lit("dim_vendor_scd2").alias("table"),
            F.lit("no_overlap").alias("check"),
            F.lit("effective_start_date").alias("column"),
            "failures",
        )
    )


def key_range_measure(fact: DataFrame, low: int, high: int) -> DataFrame:
    """Trips and revenue of a range of days, by date key."""
    rows = fact.filter(F.col("pickup_date_key").between(low, high))
    return rows.agg(F.count("*").alias("trips"), F.sum("total_amount").alias("revenue"))
