"""Values that did not fit the schema, kept as JSON beside the row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.contracts import FeedContract
from siltworks.functions import casting

RESCUED = "_rescued_data"


def rescued_map(column: str = RESCUED) -> Column:
    """All rescued fields of a row as text by name. As one expression it is evaluated once, however many fields are taken from it."""
    return F.from_json(F.col(column), "map<string,string>")


def rescued_field(field: str, target: str, column: str | Column = RESCUED) -> Column:
    """One field of the rescued JSON. Field names are case-sensitive; a bad value gives null."""
    fields = rescued_map(column) if isinstance(column, str) else column
    text = fields[field]
    kind = T.DataType.fromDDL(target)
    if not isinstance(kind, T.IntegralType):
        return casting.parse(text, kind)
    # "1.0" is not integer text but is a whole number.
    number = casting.parse(text, T.DoubleType())
    return F.coalesce(casting.parse(text, kind), F.when(number == F.floor(number), number.try_cast(kind)))


def first_of(column: Column, spellings: Sequence[str], target: str) -> Column:
    """The column itself, else the first spelling found in the rescued JSON."""
    return F.coalesce(column, *[rescued_field(s, target) for s in spellings])


def conform(df: DataFrame, contract: FeedContract, policy: str = casting.RESCUE, keep: Sequence[str] = ()) -> DataFrame:
    """Bring rows of any drifted file to the contract, in one projection.

    Columns are matched whatever their case. Under ``rescue``, values that do not convert without
    loss and columns outside the contract go to ``_rescued_data`` in the file's own spelling; a row
    with nothing to rescue has null there. ``null`` drops them and ``strict`` raises. Columns in
    ``keep`` are not the file's own and pass through.
    """
    owners: dict[str, T.StructField] = {}
    extra = []
    for column in df.schema:
        if column.name in keep:
            continue
        field = contract.field_for(column.name)
        if field is None:
            extra.append(column)
        elif field.name in owners:
            raise ValueError(f"{owners[field.name].name!r} and {column.name!r} are both {field.name!r}")
        else:
            owners[field.name] = column

    values, rescued, misfits = [], [], []
    for field in contract.fields:
        target = T.DataType.fromDDL(field.type)
        found = owners.get(field.name)
        if found is None:
            values.append(F.lit(None).cast(target).alias(field.column))
            continue
        raw = F.col(f"`{found.name}`")
        values.append(casting.apply_policy(raw, found.dataType, target, policy).alias(field.column))
        if policy == casting.RESCUE and found.dataType != target:
            fits = casting.convert(raw, found.dataType, target)[1]
            rescued.append(F.when(~fits, raw).alias(found.name))
            misfits.append(~fits)
    if policy == casting.STRICT and extra:
        raise ValueError(f"{contract.feed}: columns outside the contract: {[c.name for c in extra]}")
    if policy == casting.RESCUE:
        rescued += [F.col(f"`{c.name}`").alias(c.name) for c in extra]
        misfits += [F.col(f"`{c.name}`").isNotNull() for c in extra]

    if rescued:
        # Most rows fit, and writing JSON is the expensive part.
        any_misfit = reduce(lambda a, b: a | b, misfits)
        values.append(F.when(any_misfit, F.to_json(F.struct(*rescued))).alias(RESCUED))
    else:
        values.append(F.lit(None).cast("string").alias(RESCUED))
    return df.select(*values, *keep)
