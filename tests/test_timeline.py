"""Ordered operators against plain loops, with slots forced by a small row limit."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from siltworks.operators import checks, history, timeline

BASE = at("2024-01-01")


def random_versions(seed: int, n: int, overlapping: bool) -> list[tuple]:
    """One key holds a third of the rows, another is null."""
    rng = random.Random(seed)
    keys = [1] * (n // 3) + [rng.choice([2, 3, 4, None]) for _ in range(n - n // 3)]
    starts = {}
    for key in keys:
        moment = rng.randrange(20 * n)
        while moment in starts.setdefault(key, set()):
            moment += 1
        starts[key].add(moment)
    found = []
    for key, moments in starts.items():
        ordered = sorted(moments)
        for i, moment in enumerate(ordered):
            if overlapping:
                end = moment + rng.randrange(0, 60)
            else:
                last = i + 1 == len(ordered)
                end = 10**6 if last else rng.choice([ordered[i + 1], (moment + ordered[i + 1]) // 2])
            found.append((key, f"{key}-{moment:05d}", BASE + timedelta(seconds=moment), BASE + timedelta(seconds=end)))
    return found


VERSION_DDL = "k int, version string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz"


@pytest.mark.parametrize("rows_per_slot", [4, 10**6])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_next_instant(spark, rows_per_slot, zone):
    data = random_versions(1, 90, False)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(data, VERSION_DDL).select("k", "version", F.col("effective_start_date").alias("ts"))
        found = rows(timeline.next_instant(df, ["k"], "ts", "after", rows_per_slot=rows_per_slot))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    expected = []
    for key, version, start, _ in data:
        later = [s for k, _, s, _ in data if k == key and s > start]
        expected.append((key, version, start, min(later, default=None)))
    assert found == sorted(expected, key=repr)


@pytest.mark.parametrize("rows_per_slot", [4, 10**6])
def test_point_in_time_keeps_every_fact_once(spark, rows_per_slot):
    data = random_versions(2, 80, False)
    rng = random.Random(3)
    # Facts on the very start and end of versions, between them, before all, and without key or time.
    moments = [m for _, _, s, e in data for m in (s, e)] + [BASE - timedelta(days=1), None]
    facts = [(i, rng.choice([1, 1, 2, 3, 4, 9, None]), rng.choice(moments)) for i in range(300)]
    fact_df = spark.createDataFrame(facts, "id int, key int, ts timestamp_ntz").repartition(3)
    version_df = spark.createDataFrame(data, VERSION_DDL)
    expected = []
    for i, key, ts in facts:
        valid = [v for k, v, s, e in data if key is not None and k == key and ts is not None and s <= ts < e]
        assert len(valid) <= 1
        expected.append((i, key, ts, valid[0] if valid else None))
    for strategy in ("broadcast", "chapters"):
        joined = history.point_in_time(
            fact_df, version_df, "key", "ts", {"v": "version"}, "k", strategy=strategy, rows_per_slot=rows_per_slot
        )
        assert rows(joined) == sorted(expected, key=repr)


def test_strategy_follows_size(spark):
    versions = spark.createDataFrame(random_versions(2, 80, False), VERSION_DDL)
    assert history.can_broadcast(versions, "k")
    assert not history.can_broadcast(versions, "k", rows=10)
    assert not history.can_broadcast(versions, "k", versions_per_key=5)
    with pytest.raises(ValueError):
        history.point_in_time(versions, versions, "k", "effective_start_date", {}, "k", strategy="guess")


def brute_pairs(data: list[tuple]) -> set[tuple]:
    return {
        (a[0], a[1], b[1])
        for a in data
        for b in data
        if a[0] is not None and a[0] == b[0] and a[1] < b[1] and a[2] < b[3] and b[2] < a[3]
    }


def named(pairs):
    return {(r["k"], *sorted((r["earlier_version"], r["later_version"]))) for r in pairs.collect()}


@pytest.mark.parametrize("rows_per_slot", [4, 10**6])
@pytest.mark.parametrize("seed", [4, 5])
def test_overlaps(spark, rows_per_slot, seed):
    data = random_versions(seed, 60, True)
    df = spark.createDataFrame(data, VERSION_DDL)
    pairs = checks.overlapping_pairs(df, "k", "version", rows_per_slot=rows_per_slot)
    expected = brute_pairs(data)
    assert expected
    assert named(pairs) == expected
    assert pairs.count() == len(expected)
    starts = {v: s for _, v, s, _ in data}
    late = {(k, max((a, b), key=lambda v: (starts[v], v))) for k, a, b in expected}
    once = checks.no_overlap(df, "k", "version", rows_per_slot=rows_per_slot)
    assert {tuple(r) for r in once.select("k", "later_version").collect()} == late


def test_sound_history_has_no_overlap_but_touches(spark):
    data = [(1, "a", BASE, BASE + timedelta(1)), (1, "b", BASE + timedelta(1), BASE + timedelta(2)), (2, "c", BASE, BASE + timedelta(9))]
    df = spark.createDataFrame(data, VERSION_DDL)
    assert checks.no_overlap(df, "k", "version").count() == 0
    assert checks.overlapping_pairs(df, "k", "version").count() == 0
    assert rows(checks.no_overlap(df, "k", "version", touching=True), "earlier_version", "later_version") == [("a", "b")]


def test_empty_version_overlaps_only_inside_another(spark):
    def day(n):
        return BASE + timedelta(n)

    data = [(1, "a", day(0), day(4)), (1, "b", day(2), day(2)), (2, "c", day(0), day(4)), (2, "d", day(0), day(0)), (3, "e", day(4), day(4)), (3, "f", day(0), day(4))]
    df = spark.createDataFrame(data, VERSION_DDL)
    assert named(checks.overlapping_pairs(df, "k", "version")) == brute_pairs(data) == {(1, "a", "b")}
    assert rows(checks.no_overlap(df, "k", "version"), "later_version") == [("b",)]


def test_burst_does_not_fill_a_slot(spark):
    """Nine tenths of a key's rows lie in one day of ten years."""
    day, years = 86_400, 3_650
    second = F.when(F.col("id") % 10 == 0, F.pmod(F.hash("id"), day * years)).otherwise(day * 1000 + F.pmod(F.hash("id"), day))
    df = spark.range(40_000).select(F.lit(1).alias("k"), F.timestamp_seconds(second).cast("timestamp_ntz").alias("t"))
    frequent = timeline.frequent_keys(df, ["k"], "t", 1000)
    sizes = timeline._in_slots(df, ["k"], "t", frequent, "left").groupBy("_slot").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2000


@pytest.mark.parametrize("seed", [1, 2])
def test_point_in_time_does_not_depend_on_strategy(spark, monkeypatch, seed):
    """Versions overlap, tie and are empty; each fact finds all that are valid."""
    data = random_versions(seed, 60, True)
    versions = spark.createDataFrame(data, VERSION_DDL)
    facts = [(i, v[0], v[2]) for i, v in enumerate(data) if v[2] is not None] + [(900, None, BASE), (901, 77, BASE)]
    fact = spark.createDataFrame(facts, "f long, k long, at timestamp_ntz")
    expected = set()
    for f, k, at in facts:
        valid = [v for key, v, s, e in data if None not in (key, s, e, k) and key == k and s <= at < e]
        expected |= {(f, v) for v in valid or [None]}

    def found(strategy):
        out = history.point_in_time(fact, versions, "k", "at", {"v": "version"}, "k", strategy=strategy, rows_per_slot=4)
        return sorted(map(tuple, out.select("f", "v").collect()), key=repr)

    assert set(found("broadcast")) == expected
    assert found("broadcast") == found("chapters") == found("auto")
    monkeypatch.setattr(history.can_broadcast, "__defaults__", (1, 1, 1))
    assert set(found("auto")) == expected and set(found("broadcast")) == expected


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("rows_per_slot", [4, 10**6])
def test_chapters_of_many_versions(spark, monkeypatch, seed, rows_per_slot):
    """Versions of a key fill several chapters, reach over several, tie at their borders, and leave gaps."""
    monkeypatch.setattr(history, "CHAPTER", 3)
    data = random_versions(seed, 90, True)
    versions = spark.createDataFrame(data, VERSION_DDL)
    moments = [m for _, _, s, e in data for m in (s, e) if m is not None]
    facts = [(i, key, at) for i, at in enumerate(moments) for key in (1, 2)] + [(900, None, BASE), (901, 77, BASE), (902, 1, None)]
    fact = spark.createDataFrame(facts, "f long, k long, at timestamp_ntz")
    expected = []
    for f, k, at in facts:
        valid = [v for key, v, s, e in data if None not in (key, s, e, k, at) and key == k and s <= at < e]
        expected += [(f, k, v) for v in valid or [None]]
    out = history.point_in_time(fact, versions, "k", "at", {"v": "version"}, "k", strategy="chapters", rows_per_slot=rows_per_slot)
    assert rows(out, "f", "k", "v") == sorted(expected, key=repr)


def test_pairs_of_a_long_run_cost_what_they_give(spark):
    """A hundred thousand versions, each overlapping the next and a few long ones, all in one run."""
    n = 100_000
    begin = F.timestamp_seconds(F.col("id") * 10).cast("timestamp_ntz")
    length = F.when(F.col("id") % 25_000 == 0, 20_000).otherwise(15)
    end = F.timestamp_seconds(F.col("id") * 10 + length).cast("timestamp_ntz")
    df = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("v"), begin.alias("effective_start_date"), end.alias("effective_end_date"))
    pairs = (n - 1) + 4 * 1998
    assert checks.overlapping_pairs(df, "k", "v", rows_per_slot=20_000).count() == pairs
    near = checks.pair_candidates(df, "k", "v", rows_per_slot=20_000).count()
    assert near <= pairs + 2 * checks.STRETCH * n
    sound = df.withColumn("effective_end_date", F.timestamp_seconds(F.col("v") * 10 + 10).cast("timestamp_ntz"))
    assert checks.pair_candidates(sound, "k", "v").count() == 0


def test_changes_at_one_instant_give_one_version(spark):
    data = [(1, "a", BASE), (1, "b", BASE), (1, "c", BASE + timedelta(1)), (2, "x", BASE), (2, "x", BASE)]
    log = spark.createDataFrame(data, "k long, v string, at timestamp_ntz")
    built = history.dimension(history.history_from_log(log, "k", "at", ["v"]), "k", ["v"], "key")
    assert rows(built, "k", "v", "is_current") == [(1, "b", False), (1, "c", True), (2, "x", True)]
    assert checks.unique(built, ["key"]).count() == 0
    assert built.filter("effective_start_date >= effective_end_date").count() == 0
