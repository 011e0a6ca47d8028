from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from siltworks.functions import casting, dates, keys
from siltworks.operators import checks, dimensions, duplicates, facts, harmonize, history, quality
from siltworks.operators.quality import Rule
from siltworks.session import cut_lineage


# ---- Functions ------------------------------------------------------------------------------


def test_period_from_name(spark):
    names = [("yellow_tripdata_2023-04.parquet",), ("notes.parquet",), ("x_2023-99.parquet",), (None,)]
    df = spark.createDataFrame(names, "name string")
    found = [r[0] for r in df.select(dates.period_from_name(F.col("name"))).collect()]
    assert [str(p) if p else None for p in found] == ["2023-04-01", None, None, None]


def test_period_is_half_open(spark):
    data = [("2023-01-01 00:00:00", False), ("2023-01-31 23:59:59", False), ("2023-02-01 00:00:00", True), ("2022-12-31 23:59:59", True)]
    df = spark.createDataFrame(data, "ts string, expected boolean").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    outside = dates.outside_period(F.col("ts"), F.lit("2023-01-01").cast("date"))
    assert df.filter(outside != F.col("expected")).count() == 0
    # An inclusive end would accept the first instant of the next month.
    assert df.filter(F.col("ts").between("2023-01-01", "2023-02-01") & F.col("expected")).count() == 1


def test_small_functions(spark):
    row = spark.createDataFrame([(at("2023-03-15T10:00:00"), at("2023-03-15T10:20:50"))], "a timestamp_ntz, b timestamp_ntz")
    found = row.select(
        dates.date_key(F.col("a")),
        dates.month_text(F.col("a")),
        dates.minutes_between(F.col("a"), F.col("b")).cast("double"),
        keys.label(F.lit(2), {1: "one", 2: "two"}, "other"),
        keys.label(F.lit(9), {1: "one", 2: "two"}, "other"),
        keys.label(F.lit(9), {}, "other"),
        keys.or_unknown(F.lit(None).cast("int")),
    ).first()
    assert tuple(found) == (20230315, "2023-03", 20.83, "two", "other", "other", -1)


CONVERSIONS = [
    ("1.5D", "bigint", None, False),
    ("2.0D", "bigint", "2", True),
    ("double('NaN')", "bigint", None, False),
    ("9007199254740993L", "double", None, False),
    ("7L", "double", "7.0", True),
    ("3000000000L", "int", None, False),
    ("'12'", "bigint", "12", True),
    ("'1x'", "bigint", None, False),
    ("' -12 '", "bigint", "-12", True),
    ("'+7'", "int", "7", True),
    ("'3000000000'", "int", None, False),
    ("'1.5'", "int", None, False),
    ("' 1.5e3 '", "double", "1500.0", True),
    ("'.5'", "double", "0.5", True),
    ("'7.'", "double", "7.0", True),
    ("'-Infinity'", "double", "-Infinity", True),
    ("'nan'", "double", "NaN", True),
    ("'1-URGENT'", "double", None, False),
    ("''", "double", None, False),
    ("'12.345'", "decimal(10,2)", "12.35", True),
    ("12.50BD", "double", "12.5", True),
    ("true", "int", None, False),
    ("timestamp_ntz'2023-01-01 05:00:00'", "date", None, False),
    ("date'2023-01-01'", "timestamp_ntz", "2023-01-01 00:00:00", True),
    ("array(1)", "int", None, False),
    ("cast(null as bigint)", "int", None, True),
]


@pytest.mark.parametrize(("text", "target", "expected", "fits"), CONVERSIONS)
def test_convert(spark, text, target, expected, fits):
    from pyspark.sql import types as T

    df = spark.range(1).select(F.expr(text).alias("x"))
    value, ok = casting.convert(F.col("x"), df.schema["x"].dataType, T.DataType.fromDDL(target))
    found = df.select(value.cast("string"), ok).first()
    assert tuple(found) == (expected, fits)


def test_cast_policies(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1",), ("x",)], "x string")
    assert rows(df.select(casting.apply_policy(F.col("x"), T.StringType(), T.LongType(), "null"))) == [(1,), (None,)]
    with pytest.raises(PySparkException):
        df.select(casting.apply_policy(F.col("x"), T.StringType(), T.LongType(), "strict")).collect()
    with pytest.raises(ValueError):
        casting.apply_policy(F.col("x"), T.StringType(), T.LongType(), "maybe")


# ---- Harmonise ------------------------------------------------------------------------------


def test_lower_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "LocationID int, Zone int, _Run int")
    assert harmonize.lower_names(df).columns == ["locationid", "zone", "_Run"]
    with pytest.raises(ValueError):
        harmonize.lower_names(df.toDF("Zone", "zone", "x"))


def test_union_matches_names_not_positions(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2, 0.5)], "t string, n int, fee double")
    assert rows(harmonize.union_feeds(a, b)) == [(1, "x", None), (2, "y", 0.5)]


# ---- Quality --------------------------------------------------------------------------------


def fare_rules():
    return [Rule("fare", "fare < 0"), Rule("distance", "distance <= 0", null_is_fatal=True)]


def test_first_match_and_nulls(spark):
    data = [(1, -1.0, -1.0), (2, 1.0, 0.0), (3, None, 1.0), (4, 1.0, None), (5, 1.0, 1.0)]
    df = spark.createDataFrame(data, "id int, fare double, distance double")
    named = quality.first_reason(df, fare_rules(), all_failed="failed")
    assert rows(named, "id", quality.REASON, "failed") == [
        (1, "fare", ["fare", "distance"]),
        (2, "distance", ["distance"]),
        (3, None, []),
        (4, "distance", ["distance"]),
        (5, None, []),
    ]
    assert rows(quality.fatal_totals(df, fare_rules())) == [(5, 3, 2, 60.0)]


def test_split_is_total_and_disjoint(spark):
    rng = random.Random(7)
    data = [(i, rng.choice([None, -1.0, 1.0]), rng.choice([None, 0.0, 2.0])) for i in range(200)]
    df = spark.createDataFrame(data, "id int, fare double, distance double")
    clean, rejected = quality.split(quality.first_reason(df, fare_rules()))
    good, bad = ({r[0] for r in part.select("id").collect()} for part in (clean, rejected))
    assert good | bad == set(range(200)) and not good & bad
    assert quality.unaccounted(df, [clean, rejected], ["id"]).count() == 0
    assert quality.unaccounted(df, [clean], ["id"]).count() == len(bad)
    changed = clean.withColumn("fare", F.lit(9.0))
    for part, same in ((clean, True), (changed, False)):
        kept = quality.conservation(df, {"clean": part, "rejected": rejected}, [], ["id", "fare"]).first()
        assert (kept["rows_lost"], kept["same_content"]) == (0, same)


def test_metrics_count_sources_with_one_side(spark):
    schema = "s string, flag boolean, _quarantine_reason string"
    df = spark.createDataFrame([("a", True, None), ("a", None, None), ("b", None, "r"), ("b", True, "q")], schema)
    clean, rejected = quality.split(df)
    expected = [("a", 2, 0, 2, 0.0, 1), ("b", 0, 2, 2, 100.0, 0)]
    columns = ["s", "rows_clean", "rows_quarantined", "rows_total", "quarantine_pct", "flags"]
    assert rows(quality.metrics(clean, rejected, ["s"], {"flags": "flag"}), *columns) == expected
    assert rows(quality.metrics_in_one_pass(df, ["s"], {"flags": "flag"}), *columns) == expected


def test_profile_of_nothing(spark):
    df = spark.createDataFrame([], "x int")
    assert rows(quality.profile(df, {"negative": "x < 0"})) == [("negative", 0, 0, None)]


def test_missing_trend_marks_total_loss(spark):
    data = [("2023-05-01", True), ("2023-05-09", True), ("2023-06-01", True), ("2023-06-02", False), ("2023-06-03", False)]
    df = spark.createDataFrame(data, "d string, gone boolean").withColumn("d", F.col("d").cast("timestamp_ntz"))
    assert rows(quality.missing_trend(df, "d", "gone")) == [("2023-05", 2, 2, 100.0, True), ("2023-06", 3, 1, 33.3, False)]


# ---- Duplicates -----------------------------------------------------------------------------

TRIPS = [
    (1, "x", -4.0),
    (1, "x", 4.0),
    (2, "x", 5.0),
    (2, "x", 5.0),
    (3, "x", 1.0),
    (4, None, 2.0),
    (4, None, 2.0),
    (5, "y", 1.0),
    (5, "y", 2.0),
]


def trips_df(spark):
    return spark.createDataFrame(TRIPS, "k int, place string, total double")


def test_audit_and_comparison(spark):
    df = trips_df(spark)
    assert rows(duplicates.audit(df, ["k", "place"])) == [(9, 5, 4, 4)]
    lists = {"short": ["k"], "middle": ["k", "place"], "long": ["k", "place", "total"]}
    nested = rows(duplicates.compare_keys(df, lists))
    single = [(name, *rows(duplicates.audit(df, cols))[0]) for name, cols in lists.items()]
    assert nested == sorted(single, key=repr)
    apart = rows(duplicates.compare_keys(df, {"place": ["place"], "k": ["k"]}))
    assert apart == [("k", 9, 5, 4, 4), ("place", 9, 3, 6, 3)]
    assert rows(duplicates.compare_keys(df.limit(0), lists)) == [("long", 0, 0, 0, 0), ("middle", 0, 0, 0, 0), ("short", 0, 0, 0, 0)]


def test_classes(spark):
    df = trips_df(spark)
    assert rows(duplicates.classify(df, ["k", "place"], "total")) == [(4, 1, 2, 1)]
    assert rows(duplicates.classify(df, ["k", "place"], "total", keep_null_keys=False)) == [(3, 1, 1, 1)]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_duplicate_rows(spark, hot_rows):
    df = trips_df(spark).unionByName(spark.createDataFrame([(9, "hot", float(i)) for i in range(50)], "k int, place string, total double"))
    found = duplicates.duplicate_rows(df, ["k", "place"], hot_rows=hot_rows)
    assert found.count() == 58 and found.filter("n = 50").count() == 50
    assert found.filter("place is null").count() == 2
    by_equality = duplicates.duplicate_rows(df, ["k", "place"], null_safe=False, hot_rows=hot_rows)
    assert by_equality.count() == 56


def test_rows_like_sample(spark):
    df = trips_df(spark)
    top = duplicates.top_groups(df, ["k", "place"], 4)
    assert top.count() == 4
    sample = df.filter("k = 4").limit(1)
    assert rows(duplicates.rows_like(df, sample, ["k", "place"])) == [(4, None, 2.0)] * 2


def test_guard_keeps_reversals(spark):
    df = trips_df(spark)
    key = ["k", "place", "total"]
    kept = duplicates.guard(df, key, ["total"])
    assert rows(duplicates.guard(df, key, ["total"], expect_none=True)) == rows(kept)
    assert duplicates.guard(kept, key, ["total"], expect_none=True) is kept
    assert kept.count() == 7
    assert kept.filter("k = 1").count() == 2
    assert rows(duplicates.guard(df, ["k"], [F.desc("total")]), "k", "total") == [(1, 4.0), (2, 5.0), (3, 1.0), (4, 2.0), (5, 2.0)]


# ---- Dimensions and facts -------------------------------------------------------------------


def test_date_dim(spark):
    df = spark.createDataFrame([(at("2022-12-31T23:00:00"),), (at("2023-01-02T01:00:00"),)], "ts timestamp_ntz")
    found = rows(dimensions.date_dim(df, "ts"), "date_key", "day_of_week", "day_name", "week_of_year", "is_weekend")
    assert found == [(20221231, 7, "Saturday", 52, True), (20230101, 1, "Sunday", 52, True), (20230102, 2, "Monday", 1, False)]
    assert dimensions.date_dim(df.limit(0), "ts").count() == 0


def test_unknown_member_and_codes(spark):
    zones = spark.createDataFrame([("1", "A", "Z1")], "locationid string, borough string, zone string")
    dim = dimensions.location_dim(zones, {"location_key": "locationid", "borough": "borough", "zone_name": "zone"}, "location_key")
    assert rows(dim) == [(-1, "Unknown", "Unknown"), (1, "A", "Z1")]
    codes = spark.createDataFrame([(1,), (7,), (1,), (None,)], "code bigint")
    assert rows(dimensions.code_dim(codes, "code", {1: "one"}, "other", "key", "name")) == [(1, "one"), (7, "other")]
    assert rows(dimensions.unknown_usage(spark.createDataFrame([(-1, 2), (-1, -1)], "a int, b int"), ["a", "b"])) == [("a", 2), ("b", 1)]


def test_net_is_never_above_gross(spark):
    df = spark.createDataFrame([("a", 5.0, False), ("a", -2.0, True), ("b", -1.0, True), ("b", None, None)], "g string, x double, r boolean")
    assert rows(facts.gross_net(df, "x", "r", ["g"])) == [("a", 2, 1, 5.0, 3.0), ("b", 2, 1, 0.0, -1.0)]


def test_snapshot_is_idempotent(spark):
    ddl = "id int, tier string, updated_at timestamp_ntz"

    def table(*data):
        return spark.createDataFrame(list(data), ddl)

    first = table((1, "S", at("2023-01-01")), (2, "S", at("2023-01-01")), (3, "S", at("2023-01-01")))
    later = table((1, "P", at("2023-05-01")), (2, "older", at("2022-01-01")), (4, "S", at("2023-02-01")))
    start = history.start_history(first, "updated_at")
    once = history.snapshot(start, later, "id", "updated_at")
    expected = [
        (1, "P", at("2023-05-01"), at("2023-05-01"), None),
        (1, "S", at("2023-01-01"), at("2023-01-01"), at("2023-05-01")),
        (2, "S", at("2023-01-01"), at("2023-01-01"), None),
        (3, "S", at("2023-01-01"), at("2023-01-01"), None),
        (4, "S", at("2023-02-01"), at("2023-02-01"), None),
    ]
    assert rows(once) == expected
    assert rows(history.snapshot(once, later, "id", "updated_at")) == expected
    again = history.snapshot(once, table((1, "S", at("2023-06-01"))), "id", "updated_at")
    dim = history.dimension(again, "id", ["tier"], "sk")
    assert dim.filter("id = 1").count() == 3 and dim.filter("is_current").count() == 4
    assert checks.no_overlap(dim, "id", "sk").count() == 0
    assert dim.select("sk").distinct().count() == dim.count() == 6


def test_snapshots_at_every_change_equal_the_log(spark, tmp_path):
    """Looking at the table after each change gives the history that the change log gives at once."""
    rng = random.Random(11)
    moments = [at(f"2023-01-0{d}") for d in range(1, 6)]
    log = [(key, rng.choice("PS"), m) for key in range(12) for m in moments if rng.random() < 0.5]
    ddl = "id int, tier string, updated_at timestamp_ntz"
    changes = spark.createDataFrame(log, ddl)
    current = history.start_history(changes.limit(0), "updated_at")
    for moment in moments:
        state = {}
        for key, tier, changed in log:
            if changed <= moment:
                state[key] = (key, tier, changed)
        current = history.snapshot(current, spark.createDataFrame(list(state.values()), ddl), "id", "updated_at")
        current = cut_lineage(current)
    expected = history.history_from_log(changes, "id", "updated_at", ["tier"])
    columns = ["id", "tier", "valid_from", "valid_to"]
    assert rows(current, *columns) == rows(expected, *columns)


# ---- Checks ---------------------------------------------------------------------------------


def test_checks_return_offenders(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, None, 0.0), (None, "c", None), (2, "b", 2.0), (3, "a", -1.0)], "id int, t string, x double")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    assert rows(checks.not_null(df, ["id", "t"]), "id", "null_columns") == [(1, ["t"]), (None, ["id"])]
    assert rows(checks.unique(df, ["id"])) == [(1, 2)]
    assert rows(checks.relationships(df, "id", parent, "key")) == [(2, 1), (3, 1)]
    assert rows(checks.accepted_values(df, "t", ["a", "b"])) == [("c", 1)]
    assert rows(checks.accepted_range(df, "x", low=0, inclusive=False), "id") == [(1,), (3,)]
    assert rows(checks.accepted_range(df, "x", low=0, high=1), "id") == [(2,), (3,)]
    suite = [
        checks.TableChecks(
            "t",
            not_null=("id", "t"),
            unique=("id",),
            accepted_values={"t": ("a", "b")},
            above={"x": 0},
            relationships={"id": ("parent", "key")},
        )
    ]
    report = checks.run({"t": df, "parent": parent}, suite)
    assert rows(report, "check", "column", "failures") == [
        ("accepted_range", "x", 2),
        ("accepted_values", "t", 1),
        ("not_null", "id", 1),
        ("not_null", "t", 1),
        ("relationships", "id", 2),
        ("unique", "id", 1),
    ]


def test_group_summary_counts_amounts_before_it_sums(spark):
    """Tasks that hold one entry per key and amount, nearly as many as rows, hold a count in each and no sum."""
    rows = [(1, None, 1.0), (1, None, 1.0), (1, None, -2.5), (1, None, None), (2, 7, 3.0), (3, 7, None), (3, 7, None), (None, 7, 0.1), (None, 7, 0.2)]
    df = spark.createDataFrame(rows, "a int, b int, amount double")
    summary = duplicates.group_summary(df, ["a", "b"], "amount")
    found = {(r["a"], r["b"]): (r["n"], None if r["net"] is None else float(r["net"]), r["distinct_amounts"]) for r in summary.collect()}
    assert found == {(1, None): (4, -0.5, 2), (3, 7): (2, None, 0), (None, 7): (2, 0.3, 2)}
    assert summary.schema["net"].dataType.simpleString() == "decimal(28,2)"
    first = [line for line in summary._jdf.queryExecution().simpleString().splitlines() if "Aggregate(" in line][-1]
    assert "partial_count(1)" in first and "sum(" not in first
