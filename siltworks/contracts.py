"""What a feed promises to deliver, kept as data.

A contract lists the fields of one feed with their canonical name, the wider of the types the
feed is known to use, and every spelling of the name that was seen. It replaces schema hints, and
it is the persisted schema of the feed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """``name`` is canonical, ``source`` the spelling in the feed, ``type`` a Spark type name."""

    name: str
    type: str
    source: str | None = None
    aliases: tuple[str, ...] = ()

    @property
    def column(self) -> str:
        return self.source or self.name

    @property
    def spellings(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.column, *self.aliases)))


@dataclass(frozen=True)
class FeedContract:
    feed: str
    glob: str
    fields: tuple[Field, ...]
    period_pattern: str = r"(\d{4}-\d{2})"

    def __post_init__(self) -> None:
        owner: dict[str, str] = {}
        for field in self.fields:
            for spelling in field.spellings:
                other = owner.setdefault(spelling.lower(), field.name)
                if other != field.name:
                    raise ValueError(f"{self.feed}: {spelling!r} names both {other!r} and {field.name!r}")

    def struct(self) -> T.StructType:
        """Schema of the bronze table, in the feed's own spelling."""
        return T.StructType([T.StructField(f.column, T.DataType.fromDDL(f.type)) for f in self.fields])

    def field_for(self, column: str) -> Field | None:
        """The field a file column belongs to, whatever its case."""
        wanted = column.lower()
        for field in self.fields:
            if wanted in (s.lower() for s in field.spellings):
                return field
        return None

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeedContract:
        raw = json.loads(text)
        fields = tuple(Field(**{**f, "aliases": tuple(f["aliases"])}) for f in raw.pop("fields"))
        return FeedContract(fields=fields, **raw)


def save(spark: SparkSession, contract: FeedContract, path: str) -> None:
    row = spark.range(1).select(F.lit(contract.to_json()).alias("value"))
    row.coalesce(1).write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> FeedContract | None:
    """The contract kept at ``path``, or None if none was saved."""
    try:
        rows = spark.read.text(path, wholetext=True).limit(1).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return FeedContract.from_json(rows[0]["value"]) if rows else None


# Types ordered from narrow to wide; a column seen with two of them takes the wider one.
NUMERIC_ORDER = ("tinyint", "smallint", "int", "bigint", "float", "double")
TIME_ORDER = ("date", "timestamp_ntz", "timestamp")


def wider(a: str, b: str) -> str:
    """The type both ``a`` and ``b`` convert to."""
    if a == b:
        return a
    for order in (NUMERIC_ORDER, TIME_ORDER):
        if a in order and b in order:
            widest = order[max(order.index(a), order.index(b))]
            # A float holds fewer digits than an int, so the two meet in a double.
            return "double" if widest == "float" and {a, b} & {"int", "bigint"} else widest
    if {a.split("(")[0], b.split("(")[0]} <= {"decimal", *NUMERIC_ORDER}:
        return "double"
    return "string"


def infer(
    columns: DataFrame,
    feed: str,
    glob: str,
    hints: Mapping[str, str] | None = None,
    canonical: Mapping[str, str] | None = None,
) -> FeedContract:
    """Build a contract from the columns seen in the files.

    ``columns`` has one row per distinct ``column`` and ``type`` (see ``landing.drift_report``), so
    only the width of the schema reaches the driver. ``hints`` fix a type, ``canonical`` renames.
    """
    hints, canonical = dict(hints or {}), dict(canonical or {})
    seen: dict[str, tuple[list[str], str]] = {}
    ordered = columns.groupBy("column", "type").agg(F.min("first_position").alias("at"))
    for row in ordered.orderBy("at", "column", "type").collect():
        names, kind = seen.get(row["column"].lower(), ([], row["type"]))
        seen[row["column"].lower()] = ([*names, row["column"]], wider(kind, row["type"]))
    fields = []
    for names, kind in seen.values():
        source, *others = dict.fromkeys(names)
        fields.append(Field(canonical.get(source, source.lower()), hints.get(source, kind), source, tuple(others)))
    return FeedContract(feed, glob, tuple(fields))
