"""The operators on the test tables, and the SQL each query must equal."""

from siltworks.plans.testbed import feeds, files, keys, model, reports, table_checks, trip_quality
from siltworks.plans.testbed.sql import SQL
from siltworks.plans.testbed.standins import QUERIES

__all__ = ["QUERIES", "SQL", "feeds", "files", "keys", "model", "reports", "table_checks", "trip_quality"]
