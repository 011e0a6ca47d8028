"""Run queries against their SQL: ``python tests/run_oracle.py <sf_dir> [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
import oracle  # noqa: E402
from siltworks.session import local_session  # noqa: E402

sf, *names = sys.argv[1:]
spark = local_session("oracle", 8)
con = oracle.connect(sf)
bad = 0
for name, build in entry.queries().items():
    if names and name not in names:
        continue
    start = time.time()
    try:
        sql = entry.oracle_sql().get(name)
        df = build(spark, sf)
        problem = oracle.compare(df, con, sql) if sql else None
        status = problem or ("ok" if sql else f"rows only: {df.count()}")
    except Exception as error:
        problem = status = f"{type(error).__name__}: {str(error)[:600]}"
        if names:
            traceback.print_exc()
    bad += problem is not None
    print(f"{name:40s} {time.time() - start:6.2f}s {status}", flush=True)
print("failures:", bad)
