"""Conversions that say whether a value survived."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRICT, NULL, RESCUE = "strict", "null", "rescue"
POLICIES = (STRICT, NULL, RESCUE)

_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


# What text of a number can look like. A failed cast of text to a number costs an
# exception per row, and in a drifted column most rows fail, so text is looked at first.
_PADDING = r"[\s\p{Cntrl}]*"
_WHOLE = rf"^{_PADDING}[+-]?[0-9]+{_PADDING}$"
_NUMBER = (
    rf"(?i)^{_PADDING}[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?[df]?|nan|inf|infinity|0x.*){_PADDING}$"
)


def parse(text: Column, target: T.DataType) -> Column:
    """Text in the target type, or null if it does not parse."""
    if isinstance(target, T.IntegralType):
        return F.when(text.rlike(_WHOLE), text.try_cast(target))
    if isinstance(target, T.NumericType):
        return F.when(text.rlike(_NUMBER), text.try_cast(target))
    return text.try_cast(target)


def _convertible(source: T.DataType, target: T.DataType) -> bool:
    if source == target:
        return True
    if isinstance(source, T.NumericType) and isinstance(target, T.NumericType):
        return True
    if isinstance(source, _TIMES) and isinstance(target, _TIMES):
        return True
    atomic = isinstance(source, T.AtomicType) and isinstance(target, T.AtomicType)
    return atomic and T.StringType() in (source, target)


def convert(column: Column, source: T.DataType, target: T.DataType) -> tuple[Column, Column]:
    """``(value, fits)``: the value in the target type, and whether nothing was lost.

    ``fits`` is true for a null. Text fits if it parses. Any other value fits if casting it back
    returns it, so 1.5 does not fit a bigint, and a bigint beyond 2**53 does not fit a double.
    Booleans are not numbers.
    """
    if source == target:
        return column, F.lit(True)
    if not _convertible(source, target):
        return F.lit(None).cast(target), column.isNull()
    if isinstance(target, T.StringType):
        return column.try_cast(target), F.lit(True)
    if isinstance(source, T.StringType):
        value = parse(column, target)
        return value, column.isNull() | value.isNotNull()
    value = column.try_cast(target)
    fits = column.eqNullSafe(value.try_cast(source))
    return F.when(fits, value), fits


def apply_policy(column: Column, source: T.DataType, target: T.DataType, policy: str = STRICT) -> Column:
    """Convert under a policy: ``strict`` raises on a bad value, ``null`` and ``rescue`` blank it."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}, expected one of {POLICIES}")
    if policy == STRICT:
        return column.cast(target)
    return convert(column, source, target)[0]


def money(column: Column | str, scale: int = 2) -> Column:
    """An amount as a decimal, so that sums do not depend on the order of rows."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(T.DecimalType(18, scale))


def money_sum(column: Column | str) -> Column:
    return F.sum(money(column)).cast("double")
