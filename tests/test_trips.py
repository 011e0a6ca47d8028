from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from trip_files import write_june, write_landing

from helpers import at, rows
from siltworks.operators import duplicates, facts, history, quality
from siltworks.plans import trips
from siltworks.sources import versions
from siltworks.streaming import ingest

VENDOR_LOG = [
    (1, "Creative Mobile Technologies", "Standard", at("2022-12-01")),
    (1, "Creative Mobile Technologies", "Premium", at("2023-05-01")),
    (2, "Curb Mobility", "Standard", at("2022-12-01")),
    (2, "Curb Mobility", "Premium", at("2023-03-01")),
    (6, "Unlisted Provider (TLC VendorID 6)", "Standard", at("2023-02-01")),
]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landing, bronze, state = root / "landing", root / "bronze", root / "state"
    landing.mkdir()
    write_landing(landing)
    places = [str(p) for p in (landing, bronze, state)]
    first = trips.ingest_feeds(spark, *places)
    again = trips.ingest_feeds(spark, *places)
    write_june(landing)
    third = trips.ingest_feeds(spark, *places)
    tables = {c.feed: ingest.read_bronze(spark, places[1], places[2], c.feed) for c in trips.FEEDS}
    return {"root": root, "places": places, "runs": (first, again, third), "bronze": tables}


def test_second_run_loads_nothing(lake):
    first, again, third = lake["runs"]
    assert [r["yellow"].batches for r in lake["runs"]] == [1, 0, 1]
    assert [r["green"].batches for r in lake["runs"]] == [1, 0, 0]
    assert first["yellow"].run_id == first["green"].run_id != again["yellow"].run_id
    assert rows(lake["bronze"]["yellow"].groupBy("_source_file").count()) == [
        ("yellow_tripdata_2023-01.parquet", 9),
        ("yellow_tripdata_2023-05.parquet", 2),
        ("yellow_tripdata_2023-06.parquet", 1),
    ]


def test_drifted_values_convert_or_are_rescued(lake):
    yellow = lake["bronze"]["yellow"]
    assert dict(yellow.dtypes)["VendorID"] == "bigint"
    assert dict(yellow.dtypes)["passenger_count"] == "double"
    june = yellow.filter("_source_file like '%-06%'").first()
    assert (june["VendorID"], june["PULocationID"], june["DOLocationID"]) == (2, None, 30)
    assert json.loads(june["_rescued_data"]) == {"PULocationID": "x9"}
    may = yellow.filter("_source_file like '%-05%'")
    assert rows(may, "airport_fee", "passenger_count") == [(1.25, 1.0)] * 2
    assert [json.loads(r[0]) for r in rows(may, "_rescued_data")] == [{"surge": "yes"}] * 2
    assert yellow.filter("_source_file like '%-01%' and _rescued_data is not null").count() == 0


def test_rescue_audit_per_file(lake):
    audit = quality.rescue_audit(lake["bronze"]["yellow"], ["_source_file"], ["passenger_count", "PULocationID"])
    assert rows(audit) == [
        ("yellow_tripdata_2023-01.parquet", 9, 0, 1, 0),
        ("yellow_tripdata_2023-05.parquet", 2, 2, 0, 1),
        ("yellow_tripdata_2023-06.parquet", 1, 1, 0, 1),
    ]


@pytest.fixture(scope="module")
def silver(spark, lake):
    classified = trips.classify(trips.harmonise(lake["bronze"]))
    root = str(lake["root"] / "silver")
    trips.publish_silver(classified, root)
    clean, quarantine = trips.read_silver(spark, root)
    return {"classified": classified, "clean": clean, "quarantine": quarantine}


def test_reasons_follow_rule_order(silver):
    assert rows(quality.reason_counts(silver["quarantine"], ["service_type"])) == [
        ("yellow", "dropoff_before_pickup", 1),
        ("yellow", "negative_fare", 1),
        ("yellow", "pickup_outside_file_period", 1),
        ("yellow", "zero_or_negative_distance", 1),
    ]
    # A null fare is kept, and so is the first instant of the period.
    assert silver["clean"].filter("fare_amount is null").count() == 1
    assert silver["clean"].filter(F.col("pickup_datetime") == F.lit("2023-01-01").cast("timestamp_ntz")).count() == 1


def test_metrics_and_conservation(silver):
    per_service, _ = trips.silver_metrics(silver["clean"], silver["quarantine"])
    expected = [("green", 2, 0, 2, 0.0, 0, 0), ("yellow", 8, 4, 12, 33.333, 1, 1)]
    columns = ["service_type", "rows_clean", "rows_quarantined", "rows_total", "quarantine_pct", "passenger_count_missing", "reversal_rows"]
    assert rows(per_service, *columns) == expected
    one_pass = quality.metrics_in_one_pass(silver["classified"], ["service_type"], trips.METRIC_FLAGS)
    assert rows(one_pass, *columns) == expected
    kept = quality.conservation(
        silver["classified"],
        {"clean": silver["clean"], "quarantine": silver["quarantine"]},
        ["service_type", "_source_file"],
        ["vendor_id", "pickup_datetime", "total_amount"],
    )
    assert kept.filter("rows_lost <> 0 or not same_content").count() == 0 and kept.count() == 4


def test_recovery_from_rescued_json(spark):
    data = [
        (None, None, '{"VendorID":"2","Airport_fee":"1.25"}'),
        (None, None, '{"VendorID":"2.0","airport_fee":1.75}'),
        (7, 3.0, '{"VendorID":"2","Airport_fee":"1.25"}'),
        (None, None, '{"vendorid":"2","Airport_fee":"n/a"}'),
    ]
    df = spark.createDataFrame(data, "vendor_id bigint, airport_fee double, _rescued_data string")
    from siltworks.operators import harmonize

    plan = harmonize.recovery_plan(trips.FEEDS, ["vendor_id", "airport_fee"])
    found = rows(harmonize.recover_rescued(df, plan), "vendor_id", "airport_fee")
    assert found == [(2, 1.25), (2, 1.75), (7, 3.0), (None, None)]


def test_star_passes_and_finds_the_unlisted_vendor(spark, silver, tmp_path_factory):
    zones = spark.createDataFrame(
        [(10, "Queens", "A", "Boro Zone"), (20, "Bronx", "B", "Boro Zone"), (30, "Bronx", "C", "Boro Zone")],
        "locationid int, borough string, zone string, service_zone string",
    )
    log = spark.createDataFrame(VENDOR_LOG, "vendor_id int, vendor_name string, contract_tier string, updated_at timestamp_ntz")
    versions_of = history.history_from_log(log, "vendor_id", "updated_at", ["vendor_name", "contract_tier"])
    star = trips.star(silver["clean"], zones, versions_of)
    assert star.dim_vendor_scd2.count() == 5
    assert star.fct_trips.count() == silver["clean"].count() == 10
    assert rows(star.dim_vendor) == [
        (1, "Creative Mobile Technologies, LLC"),
        (2, "VeriFone Inc."),
        (6, "Unknown vendor"),
        (9, "Unknown vendor"),
    ]
    assert star.dim_date.count() == 154
    report = trips.check_star(star.tables())
    assert report.count() == 34
    assert rows(report.filter("failures > 0"), "check", "column", "failures") == [("not_null", "vendor_version_key", 1)]
    stored = trips.publish_star(silver["clean"], zones, versions_of, str(tmp_path_factory.mktemp("gold")))
    for name, built in star.tables().items():
        assert rows(stored.tables()[name]) == rows(built)
    assert rows(trips.check_star(stored.tables())) == rows(report)
    missing = history.missing_keys(star.fct_trips, star.dim_vendor_scd2, "vendor_key", "vendor_id")
    assert rows(missing) == [(9, 1)]
    assert rows(history.coverage(star.fct_trips, "vendor_version_key")) == [(10, 1)]
    assert star.fct_trips.filter("pu_location_key = -1").count() == 2
    merged = trips.fct_trips(silver["clean"], star.dim_vendor_scd2, "chapters")
    assert rows(merged) == rows(star.fct_trips)
    gross = facts.gross_net(star.fct_trips, "total_amount", "is_reversal")
    assert rows(gross) == [(10, 1, 100.0, 96.0)]
    matrix = facts.attribution_matrix(
        star.fct_trips, star.dim_vendor_scd2, "contract_tier", "total_amount", "vendor_key", "vendor_version_key", "vendor_id", "vendor_sk"
    )
    assert rows(facts.attribution(matrix)) == [("Premium", 72.0, 24.0), ("Standard", 12.0, 60.0), (None, 12.0, 12.0)]
    assert rows(facts.misattributed(matrix), "amount_misattributed", "rows_misattributed") == [(48.0, 6)]


def test_reversals_are_not_duplicates(silver):
    yellow = silver["clean"].filter("service_type = 'yellow'")
    compared = duplicates.compare_keys(yellow, {"short": trips.SHORT_KEY, "long": trips.LONG_KEY})
    assert rows(compared) == [("long", 8, 8, 0, 0), ("short", 8, 7, 1, 1)]
    assert rows(duplicates.classify(yellow, trips.SHORT_KEY, "total_amount")) == [(1, 1, 0, 0)]


def test_refresh_starts_a_new_generation(spark, lake):
    landing, bronze, state = lake["places"]
    run = ingest.ingest(spark, trips.GREEN, landing, bronze, state, refresh=True, files_per_batch=1)
    assert (run.generation, run.batches) == (1, 1)
    assert ingest.read_bronze(spark, bronze, state, "green").count() == 2
    assert spark.read.parquet(ingest.table_path(bronze, "green", 0)).count() == 2


def test_uniform_feed(spark, lake, tmp_path):
    landing = lake["places"][0]
    contract = trips.FeedContract("jan", "yellow_tripdata_2023-01.parquet", trips.YELLOW.fields)
    for _ in range(2):
        ingest.ingest_uniform(spark, contract, landing, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9


def test_versions_of_the_fact(spark, tmp_path):
    root = str(tmp_path)
    before = spark.createDataFrame([(1, None), (2, "a")], "id int, vendor_version_key string")
    after = before.fillna("b", ["vendor_version_key"])
    assert versions.publish(before, root, "fct") == 0
    assert versions.publish(after, root, "fct") == 1
    unmatched = F.count("*") - F.count("vendor_version_key")
    assert rows(versions.compare(spark, root, "fct", [0, 1], {"unmatched": unmatched})) == [(0, 1), (1, 0)]
    assert versions.expire(spark, root, "fct", 5) == 1
    assert versions.expire(spark, root, "fct", 5) == 0
    with pytest.raises(versions.VersionExpired):
        versions.read(spark, root, "fct", 0)
    with pytest.raises(versions.VersionNotFound):
        versions.read(spark, root, "fct", 7)
    assert versions.read(spark, root, "fct").count() == 2
    empty = versions.publish(before.limit(0), root, "fct", partition_by=["id"])
    assert rows(versions.read(spark, root, "fct", empty)) == []
    assert rows(versions.history(spark, root, "fct"), "version", "operation", "rows") == [
        (0, "EXPIRE", None),
        (0, "REPLACE", 2),
        (1, "REPLACE", 2),
        (2, "REPLACE", 0),
    ]


def test_failed_batch_is_repeated_without_duplicates(spark, tmp_path, monkeypatch):
    """A batch that wrote its rows and failed before it was committed replaces them when repeated."""
    landing_dir = tmp_path / "landing"
    landing_dir.mkdir()
    write_landing(landing_dir)
    places = [str(landing_dir), str(tmp_path / "bronze"), str(tmp_path / "state")]
    load = ingest.load_files

    def load_then_fail(session, paths, contract, policy):
        found = load(session, paths, contract, policy)
        found.write.mode("overwrite").parquet(ingest.table_path(places[1], "yellow", 0) + "/_batch=0")
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "load_files", load_then_fail)
    with pytest.raises(Exception, match="lost"):
        ingest.ingest(spark, trips.YELLOW, *places)
    monkeypatch.setattr(ingest, "load_files", load)
    assert ingest.ingest(spark, trips.YELLOW, *places).batches == 1
    assert ingest.read_bronze(spark, places[1], places[2], "yellow").count() == 11


def test_batches_are_bounded(spark, tmp_path):
    landing_dir = tmp_path / "landing"
    landing_dir.mkdir()
    write_landing(landing_dir)
    write_june(landing_dir)
    run = ingest.ingest(spark, trips.YELLOW, str(landing_dir), str(tmp_path / "b"), str(tmp_path / "s"), files_per_batch=1)
    assert run.batches == 3
    assert ingest.read_bronze(spark, str(tmp_path / "b"), str(tmp_path / "s"), "yellow").count() == 12


def test_even_files(spark, tmp_path):
    rows_in = spark.range(1000).repartition(20).withColumn("_quarantine_reason", F.when(F.col("id") < 100, "bad"))
    for even in (False, True):
        trips.publish_silver(rows_in, str(tmp_path), even)
    assert rows(versions.history(spark, str(tmp_path)), "version", "rows", "files") == [(0, 1000, 40), (1, 1000, 2)]
    clean, rejected = trips.read_silver(spark, str(tmp_path))
    assert (clean.count(), rejected.count()) == (900, 100)


def test_profile_of_trips(silver):
    found = quality.profile(silver["classified"], trips.profile_checks("2023-01-01", "2023-02-01"), ["service_type"])
    yellow = {r["check"]: r["rows_failed"] for r in found.filter("service_type = 'yellow'").collect()}
    assert yellow == {
        "negative_fare": 1,
        "zero_or_neg_distance": 2,
        "passenger_zero": 0,
        "passenger_over_8": 0,
        "passenger_null": 1,
        "dropoff_before_pickup": 1,
        "outside_window": 4,
        "null_pickup_location": 2,
        "unknown_file_period": 0,
    }


def test_day_measure(silver, spark):
    fact = spark.createDataFrame([(20230315, 1.5), (20230315, 2.0), (20230401, 9.0)], "pickup_date_key int, total_amount double")
    assert rows(trips.key_range_measure(fact, 20230315, 20230315)) == [(2, 3.5)]
    assert rows(trips.key_range_measure(fact, 20230301, 20230430)) == [(3, 12.5)]


def test_late_file_with_an_old_time_is_loaded(spark, tmp_path):
    """A file that arrives after newer ones is not taken for an expired one."""
    landing_dir = tmp_path / "landing"
    landing_dir.mkdir()
    write_landing(landing_dir)
    places = [str(landing_dir), str(tmp_path / "b"), str(tmp_path / "s")]
    ingest.ingest(spark, trips.YELLOW, *places)
    write_june(landing_dir)
    os.utime(landing_dir / "yellow_tripdata_2023-06.parquet", (1_600_000_000, 1_600_000_000))
    assert ingest.ingest(spark, trips.YELLOW, *places).batches == 1
    assert ingest.read_bronze(spark, places[1], places[2], "yellow").count() == 12
