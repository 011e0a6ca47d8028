"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then three times into a sink that discards the rows; the median
counts, and building the query is part of it. Queries that load or write tables run once, and
so do the builds of shared tables; the landing files that are loaded are written before.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siltworks.plans.testbed import QUERIES, feeds, files, model, standins  # noqa: E402
from siltworks.session import local_session  # noqa: E402

REPEATED = (
    "profile_checks",
    "quarantine_reason_counts",
    "quality_metrics",
    "quality_metrics_one_pass",
    "conservation_check",
    "missing_rate_by_month",
    "feeds_union_by_name",
    "rescued_values",
    "duplicate_key_comparison",
    "duplicate_group_classes",
    "duplicate_rows",
    "dedup_guard",
    "dim_date",
    "scd2_versions",
    "fact_point_in_time",
    "fact_point_in_time_merge",
    "fact_trips",
    "gross_net_measures",
    "attribution_type1_type2",
    "check_suite_report",
    "check_no_overlap",
    "clustered_day_query",
    "clustered_range_query",
    "unclustered_range_query",
)
#: Tables that queries share; building them is timed by itself.
BUILDS = {"build_silver": standins.silver_root, "build_versions": model.versions_root, "build_layouts": files.order_layouts}
ONCE = ("bronze_stream_counts", "version_compare")


def timed(spark, sf: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name, build in BUILDS.items():
        start = time.perf_counter()
        build(spark, sf)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in REPEATED:
        timed(spark, sf, name)
        spark.catalog.clearCache()
        seconds[name] = round(statistics.median(timed(spark, sf, name) for _ in range(3)), 3)
    feeds.drifted_landing(spark, sf)
    for name in ONCE:
        seconds[name] = round(timed(spark, sf, name), 3)
    scanned = QUERIES["files_scanned_report"](spark, sf).collect()
    files = {r["layout"]: f"{r['files_scanned']} of {r['n_files']}" for r in scanned}
    total = round(sum(seconds.values()), 3)
    result = {"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf)}
    print(json.dumps(result | {"files_scanned": files}))


if __name__ == "__main__":
    main()
