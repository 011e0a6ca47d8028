"""Properties of the plans that results alone do not show."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from siltworks.operators import checks, duplicates, history, quality
from siltworks.plans import testbed, trips
from siltworks.sources import landing, layout

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()


def nodes(df, name: str) -> int:
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(rf"[-+] (?:\* )?{name}\s+\(", tree))


@pytest.fixture()
def lines(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


@pytest.mark.parametrize("name", sorted(testbed.QUERIES))
def test_no_query_pairs_all_rows(spark, name):
    text = plan(testbed.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_profile_is_one_scan_and_one_shuffle(lines):
    df = quality.profile(lines, {"a": "l_tax > 0.05", "b": "l_discount = 0", "c": "l_quantity is null"}, ["l_returnflag"])
    assert (nodes(df, "Scan parquet"), nodes(df, "Exchange")) == (1, 1)
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_tax:double,l_returnflag:string>" in plan(df)


def test_nested_keys_share_a_scan(lines):
    df = duplicates.compare_keys(lines, {"a": ["l_orderkey"], "b": ["l_orderkey", "l_linenumber"]})
    assert nodes(df, "Scan parquet") == 1


def test_guard_drops_copies_before_the_shuffle(lines):
    tree = plan(duplicates.guard(lines, ["l_orderkey"], ["l_shipdate", "l_partkey"])).split("\n\n")[0]
    limits = [line for line in tree.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert ["Exchange" in line for line in limits] == [False, True, False]


def test_inventory_reads_no_content(spark):
    assert "content" not in re.search(r"ReadSchema: (.*)", plan(landing.inventory(spark, SF))).group(1)


def test_range_reaches_the_scan(spark, lines, tmp_path):
    path = str(tmp_path / "clustered")
    layout.cluster(lines.repartition(4), ["l_shipdate"], 4).write.parquet(path)
    found = spark.read.parquet(path).filter("l_partkey between 5 and 9")
    text = plan(found.agg(F.sum("l_tax")))
    assert "GreaterThanOrEqual(l_partkey,5)" in text and "LessThanOrEqual(l_partkey,9)" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_tax:double>" in text


def test_silver_parts_read_their_own_partition(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "bad")], "id int, _quarantine_reason string")
    trips.publish_silver(rows, str(tmp_path))
    for part in trips.read_silver(spark, str(tmp_path)):
        assert re.search(r"PartitionFilters: \[.*_rejected", plan(part)) and part.count() == 1


def test_checks_scan_the_fact_once(spark, tmp_path):
    lines = spark.createDataFrame([(1, 2, "A"), (1, 9, "B"), (None, 2, None)], "a int, b bigint, kind string")
    lines.write.parquet(f"{tmp_path}/fact")
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    parent.write.parquet(f"{tmp_path}/parent")
    tables = {"fact": spark.read.parquet(f"{tmp_path}/fact"), "parent": spark.read.parquet(f"{tmp_path}/parent")}
    suite = checks.TableChecks(
        "fact", not_null=("a", "kind"), accepted_values={"kind": ("A",)}, above={"b": 2},
        relationships={"a": ("parent", "id"), "b": ("parent", "id")},
    )
    report = checks.run(tables, [suite])
    assert plan(report).count(f"{tmp_path}/fact]") == 1
    found = {(r["check"], r["column"]): r["failures"] for r in report.collect()}
    assert found == {
        ("not_null", "a"): 1, ("not_null", "kind"): 1, ("accepted_values", "kind"): 1, ("accepted_range", "b"): 2,
        ("relationships", "a"): 0, ("relationships", "b"): 1,
    }


def test_large_parents_give_the_same_report(spark, monkeypatch):
    child = spark.createDataFrame([(1, 2, "A"), (1, 9, "B"), (None, 2, None), (7, 9, "A")], "a int, b bigint, kind string")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id bigint")
    other = spark.createDataFrame([("A",)], "code string")
    tables = {"child": child, "parent": parent, "other": other}
    suite = [
        checks.TableChecks(
            "child", not_null=("a",), above={"b": 2},
            relationships={"a": ("parent", "id"), "b": ("parent", "id"), "kind": ("other", "code")},
        )
    ]
    reports = []
    for most in (checks.PARENT_ROWS, 2, 0):  # all parents small, one of two, none
        monkeypatch.setattr(checks, "PARENT_ROWS", most)
        assert len(checks.small_parents(tables, suite)) == {2: 1, 0: 0}.get(most, 2)
        reports.append({(r["check"], r["column"]): r["failures"] for r in checks.run(tables, suite).collect()})
    assert reports[0] == reports[1] == reports[2]
    assert reports[0] == {("not_null", "a"): 1, ("accepted_range", "b"): 2, ("relationships", "a"): 1, ("relationships", "b"): 2, ("relationships", "kind"): 1}


def test_small_parents_need_no_shuffle_of_the_child(spark):
    child = spark.read.parquet(f"{SF}/lineitem.parquet")
    parent = spark.read.parquet(f"{SF}/supplier.parquet")
    suite = [checks.TableChecks("child", not_null=("l_orderkey",), relationships={"l_suppkey": ("parent", "s_suppkey")})]
    report = checks.run({"child": child, "parent": parent}, suite)
    text = plan(report).split("\n\n")[0]
    assert nodes(report, "Generate") == 1 and "ObjectHashAggregate" not in text
    assert plan(report).count("lineitem.parquet]") == 1


@pytest.mark.parametrize("many", [False, True])
def test_point_in_time_reads_the_fact_once(spark, many, monkeypatch, tmp_path):
    if many:
        monkeypatch.setattr(history, "CHAPTER", 1)
    events = spark.read.parquet(f"{SF}/events.parquet")
    built = history.dimension(history.history_from_log(events, "user_id", "ts", ["event_type"]), "user_id", ["event_type"], "sk")
    built.write.parquet(f"{tmp_path}/versions")
    fact = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    found = history.point_in_time(fact, spark.read.parquet(f"{tmp_path}/versions"), "user_id", "ts", {"sk": "sk"}, "user_id", strategy="chapters")
    assert plan(found).count("events.parquet]") == 1
    assert nodes(found, "Window") == 0 and found.count() == fact.count()


def test_unrelated_keys_share_one_scan_and_one_wide_shuffle(lines):
    df = duplicates.compare_keys(lines, {"a": ["l_orderkey", "l_linenumber"], "b": ["l_orderkey", "l_partkey"], "c": ["l_suppkey"]})
    assert df.count() == 3
    done = df._jdf.queryExecution()
    df.collect()
    final = done.executedPlan().toString().split("Initial Plan")[0]
    # Every further key shuffles groups of the rows that were shuffled once.
    assert len(re.findall("FileScan parquet", final)) == 1 and final.count("ReusedExchange") == 2


def test_metrics_scan_each_part_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", "bad")], "id int, kind string, _quarantine_reason string")
    trips.publish_silver(rows, str(tmp_path))
    found = quality.metrics(*trips.read_silver(spark, str(tmp_path)), ["kind"], {})
    assert (nodes(found, "Scan parquet"), nodes(found, "Exchange")) == (2, 1) and "Join" not in plan(found)


def test_probes_of_drifted_files_are_one_job(spark, tmp_path):
    spark.range(5).select(F.col("id").alias("n"), F.col("id").cast("string").alias("t")).write.parquet(f"{tmp_path}/a")
    path = landing.inventory(spark, f"{tmp_path}/a").first()["path"]
    probes = [Row(type=a, declared=b, path=path, column=c) for a, b, c in (("bigint", "int", "n"), ("string", "bigint", "t"), ("bigint", "bigint", "n"), ("bigint", "string", "n"))]
    spark.sparkContext.setJobGroup("probes", "probes")
    bad = landing.unreadable(spark, probes)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("probes")
    spark.sparkContext.setJobGroup("", "")
    assert {(r["type"], r["declared"]) for r in bad} >= {("string", "bigint"), ("bigint", "string")}
    assert ("bigint", "bigint") not in {(r["type"], r["declared"]) for r in bad} and len(jobs) <= 8
