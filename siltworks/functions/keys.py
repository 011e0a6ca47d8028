"""Keys and code tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_KEY = -1
UNKNOWN_LABEL = "Unknown"


def version_key(key: Column, valid_from: Column) -> Column:
    """Surrogate key of a version: the same key and start always give the same text."""
    start = F.date_format(valid_from.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.sha2(F.concat_ws("|", key.cast("string"), start), 256)


def or_unknown(key: Column, unknown: int = UNKNOWN_KEY) -> Column:
    return F.coalesce(key, F.lit(unknown))


def label(code: Column, names: Mapping[object, str], default: str | None = None) -> Column:
    """Name of a code from a small fixed table."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), code) if pairs else F.lit(None).cast("string")
    return found if default is None else F.coalesce(found, F.lit(default))
