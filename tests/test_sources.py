from __future__ import annotations

import random
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from trip_files import write_june, write_landing

from helpers import rows
from siltworks import contracts
from siltworks.contracts import FeedContract, Field
from siltworks.functions import rescue
from siltworks.plans import trips
from siltworks.session import shared_root, work_dir
from siltworks.sources import landing, layout, snapshots, tables, versions
from siltworks.streaming import ingest


def test_contract_rejects_ambiguous_names():
    with pytest.raises(ValueError):
        FeedContract("f", "*", (Field("a", "int"), Field("b", "int", "A")))


def test_contract_round_trip(spark, tmp_path):
    path = str(tmp_path / "schema")
    assert contracts.load(spark, path) is None
    contracts.save(spark, trips.YELLOW, path)
    assert contracts.load(spark, path) == trips.YELLOW


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ("int", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("int", "float", "double"),
        ("smallint", "float", "float"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("bigint", "string", "string"),
        ("decimal(10,2)", "double", "double"),
        ("boolean", "int", "string"),
    ],
)
def test_wider(a, b, expected):
    assert contracts.wider(a, b) == contracts.wider(b, a) == expected


def test_conform_refuses_two_spellings_in_one_file(spark):
    df = spark.range(1).select(F.lit(1.0).alias("airport_fee"), F.lit(2.0).alias("Airport_fee"))
    with pytest.raises(ValueError):
        rescue.conform(df, trips.YELLOW)


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    write_landing(folder)
    write_june(folder)
    return str(folder)


def test_inventory_and_manifest(spark, landed):
    files = landing.inventory(spark, landed, "yellow_*")
    assert files.count() == 3 and files.filter("bytes <= 0").count() == 0
    manifest = spark.createDataFrame(
        [("yellow", "2023", "01"), ("yellow", "2023", "02"), ("green", "2023", "01")], "service_type string, year string, month string"
    )
    listed = landing.expand_manifest(manifest, trips.LANDING_NAME)
    assert rows(landing.completeness(listed, landing.inventory(spark, landed))) == [
        ("green_tripdata_2023-01.parquet", "present"),
        ("yellow_tripdata_2023-01.parquet", "present"),
        ("yellow_tripdata_2023-02.parquet", "missing"),
        ("yellow_tripdata_2023-05.parquet", "unexpected"),
        ("yellow_tripdata_2023-06.parquet", "unexpected"),
    ]


def test_drift_report_and_inferred_contract(spark, landed):
    columns = landing.file_columns(landing.inventory(spark, landed, "yellow_*"))
    report = landing.drift_report(columns)
    vendor = rows(report.filter("name = 'vendorid'"), "type", "n_files", "n_variants")
    assert vendor == [("bigint", 1, 3), ("int", 1, 3), ("string", 1, 3)]
    assert rows(report.filter("name = 'airport_fee'"), "column", "n_variants") == [("Airport_fee", 2), ("airport_fee", 2)]
    found = contracts.infer(report, "yellow", "yellow_*", hints={"VendorID": "bigint"}, canonical={"VendorID": "vendor_id"})
    types = {f.name: f.type for f in found.fields}
    assert types["vendor_id"] == "bigint" and types["passenger_count"] == "double" and types["pulocationid"] == "string"
    assert found.field_for("AIRPORT_FEE").aliases == ("airport_fee",) or found.field_for("AIRPORT_FEE").aliases == ("Airport_fee",)


def test_mismatches_name_what_a_plain_read_rejects(spark, landed):
    columns = landing.file_columns(landing.inventory(spark, landed, "yellow_*-05*"))
    problems = landing.schema_mismatches(columns, trips.YELLOW)
    assert rows(problems, "column", "type", "declared", "problem") == [
        ("RatecodeID", "bigint", "double", "type differs"),
        ("passenger_count", "bigint", "double", "type differs"),
        ("surge", "string", None, "not in contract"),
    ]
    with pytest.raises(Exception, match="PARQUET_COLUMN_DATA_TYPE_MISMATCH|FAILED_READ_FILE"):
        spark.read.schema("RatecodeID double").parquet(f"{landed}/yellow_tripdata_2023-05.parquet").collect()


def test_csv_sources(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Borough\n1,Queens\n2,Bronx\n")
    zones = tables.read_reference_csv(spark, str(tmp_path / "zones.csv"))
    assert rows(zones, "locationid", "borough", "_source_file") == [(1, "Queens", "zones.csv"), (2, "Bronx", "zones.csv")]
    typed = tables.read_reference_csv(spark, str(tmp_path / "zones.csv"), "LocationID bigint, Borough string")
    assert dict(typed.dtypes)["locationid"] == "bigint"
    (tmp_path / "seed.csv").write_text("vendor_id,vendor_name,contract_tier,updated_at\n1,A,Premium,2023-05-01 00:00:00\n")
    seed = tables.read_seed(spark, str(tmp_path / "seed.csv"), trips.VENDOR_SEED)
    assert seed.dtypes == [("vendor_id", "int"), ("vendor_name", "string"), ("contract_tier", "string"), ("updated_at", "timestamp")]


def test_named_tables_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    assert tables.read_table(spark, path).count() == 2
    assert rows(tables.shape_report({"t": df})) == [("t", 2, 2)]
    assert rows(tables.describe(df)) == [(0, "id", "int"), (1, "t", "string")]
    assert tables.preview(df, 1).count() == 1


def test_catalog_table_is_replaced_with_its_schema(spark):
    tables.write_table(spark.createDataFrame([(1,)], "id int"), "zones_of_test")
    tables.write_table(spark.createDataFrame([(1, "a")], "id bigint, t string"), "zones_of_test")
    assert rows(tables.read_table(spark, "zones_of_test")) == [(1, "a")]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x") != work_dir(spark, "x")


# ---- Layout ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the rows share one day, and all of those are equal."""
    rng = random.Random(1)
    data = [(20230101, 0)] * 1000 + [(20230000 + rng.randrange(1, 200), rng.randrange(1000)) for _ in range(2000)]
    df = spark.createDataFrame(data, "day int, other int").repartition(8)
    root = str(tmp_path_factory.mktemp("layout"))
    df.write.parquet(f"{root}/plain")
    # Read back, so that input splits stand for the files of a table.
    plain = spark.read.parquet(f"{root}/plain").repartition(8)
    layout.cluster(plain, ["day"], 6).write.parquet(f"{root}/clustered")
    layout.cluster(plain, ["day", "other"], 6).write.parquet(f"{root}/morton")
    return root, data


def test_cluster_keeps_rows_and_splits_a_frequent_value(spark, skewed):
    root, data = skewed
    for name in ("clustered", "morton"):
        assert rows(spark.read.parquet(f"{root}/{name}")) == sorted(data, key=repr)
    sizes = spark.read.parquet(f"{root}/clustered").groupBy(F.col("_metadata.file_name")).count()
    assert sizes.agg(F.max("count")).first()[0] < 1000
    stored = landing.inventory(spark, f"{root}/clustered")
    total = layout.table_detail(stored).first()["bytes_total"]
    assert layout.suggested_files(stored, total) == 1
    assert layout.suggested_files(stored, total - 1) == 2


def test_fewer_files_are_opened(spark, skewed):
    root, data = skewed
    ranges = {"day": (20230150, 20230153)}
    report = {r["layout"]: r for r in layout.layout_report(spark, {n: f"{root}/{n}" for n in ("plain", "clustered")}, ranges).collect()}
    assert report["plain"]["files_scanned"] == report["plain"]["n_files"] == 8
    assert report["clustered"]["files_scanned"] <= 2


def test_two_columns_prune(spark, skewed):
    root, _ = skewed
    stats = layout.file_stats(spark, f"{root}/morton", ["day", "other"])
    total = stats.count()
    narrow = {"day": (20230150, 20230199), "other": (900, 999)}
    assert layout.files_scanned(stats, narrow).first()["files_scanned"] < total


def test_stats_of_nulls_and_unknown_bounds(spark, tmp_path):
    pq.write_table(pa.table({"x": pa.array([None, None], pa.int32())}), tmp_path / "nulls.parquet")
    pq.write_table(pa.table({"x": pa.array([1, 9], pa.int32())}), tmp_path / "silent.parquet", write_statistics=False)
    pq.write_table(pa.table({"x": pa.array([1, 2], pa.int32())}), tmp_path / "known.parquet")
    stats = layout.file_stats(spark, str(tmp_path), ["x"])
    kept = stats.filter(layout.may_hold({"x": (5, 9)})).select(F.element_at(F.split("path", "/"), -1))
    assert rows(kept) == [("silent.parquet",)]
    with pytest.raises(ValueError):
        layout.file_stats(spark, write_doubles(tmp_path / "d"), ["y"])


def write_doubles(folder) -> str:
    folder.mkdir()
    pq.write_table(pa.table({"y": pa.array([1.0])}), folder / "y.parquet")
    return str(folder)


def test_listing_by_executors(spark, tmp_path):
    """A hundred thousand files in folders of two depths go to the ledger in bounded files, and only once."""
    for folder in range(10):
        place = tmp_path / "landing" / f"period={folder % 5}" / f"part={folder}"
        place.mkdir(parents=True)
        for i in range(10_000):
            (place / f"a_{i}.parquet").touch()
    (tmp_path / "landing" / "_hidden").mkdir()
    (tmp_path / "landing" / "_hidden" / "a_1.parquet").touch()
    (tmp_path / "landing" / "a_top.parquet").touch()
    (tmp_path / "landing" / "b_1.parquet").touch()
    found = landing.list_files(spark, str(tmp_path / "landing"), "a_*.parquet")
    assert (found.count(), found.select("path").distinct().count()) == (100_001, 100_001)
    place, ledger = str(tmp_path / "landing"), str(tmp_path / "ledger")
    assert ingest.note_new_files(spark, place, "a_*.parquet", ledger, "one", 1_000) == 100_001
    assert ingest.note_new_files(spark, place, "a_*.parquet", ledger, "two", 1_000) == 0
    (tmp_path / "landing" / "a_late.parquet").touch()
    assert ingest.note_new_files(spark, place, "a_*.parquet", ledger, "three", 1_000) == 1
    sizes = spark.read.parquet(ledger).groupBy(F.input_file_name()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 1_000 and sizes.count() < 250


def test_snapshots_are_safe_to_repeat(spark, tmp_path):
    def look(*rows):
        data = [(k, v, None if d is None else datetime(2024, 1, d)) for k, v, d in rows]
        return spark.createDataFrame(data, "id int, tier string, updated_at timestamp_ntz")

    def seen():
        return rows(snapshots.read(spark, root, "t").select("id", "tier", F.dayofmonth("valid_from"), F.dayofmonth("valid_to")))

    root = str(tmp_path)
    first = look((1, "a", 1), (2, "b", 1), (2, "c", 2), (None, "x", 3), (3, "n", None))
    assert snapshots.apply(first, root, "t", "id", "updated_at") == 0
    assert seen() == [(1, "a", 1, None), (2, "c", 2, None)]
    assert snapshots.apply(first, root, "t", "id", "updated_at") is None
    second = look((1, "d", 5), (2, "z", 1), (4, "e", 5))
    assert snapshots.apply(second, root, "t", "id", "updated_at") == 1
    assert snapshots.apply(second, root, "t", "id", "updated_at") is None
    assert snapshots.apply(look(), root, "t", "id", "updated_at") is None
    assert snapshots.apply(look((4, "f", 7)), root, "t", "id", "updated_at") == 2
    assert seen() == [(1, "a", 1, 5), (1, "d", 5, None), (2, "c", 2, None), (4, "e", 5, 7), (4, "f", 7, None)]
    assert versions.read(spark, root, "t_closed").count() == 1
    empty = str(tmp_path / "empty")
    assert snapshots.apply(look(), empty, "t", "id", "updated_at") == 0
    assert snapshots.apply(second, empty, "t", "id", "updated_at") == 1 and snapshots.read(spark, empty, "t").count() == 3
