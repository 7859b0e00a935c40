"""Scalar column functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# A decimal string with an integral part, e.g. '8.0', ' -3.75 '.
_DECIMAL_TEXT = r"^\s*([+-]?\d+)\.\d*\s*$"


def _as_type(t: T.DataType | str) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    return T._parse_datatype_string(t)


def safe_cast(value: Column, to: T.DataType | str) -> Column:
    """Cast that yields null instead of failing.

    Integral targets also accept decimal text by truncation (``'8.0'`` -> 8),
    matching the non-ANSI cast the original pipeline ran with, without turning
    ANSI mode off for the whole session.
    """
    target = _as_type(to)
    direct = value.try_cast(target)
    if isinstance(target, _INTEGRAL):
        integral_part = F.regexp_extract(value.cast("string"), _DECIMAL_TEXT, 1)
        return F.coalesce(direct, F.nullif(integral_part, F.lit("")).try_cast(target))
    return direct


def code_label(value: Column, labels: Mapping[object, str]) -> Column:
    """Map codes to labels; anything else (and null) becomes null.

    Built as a chain of ``when`` without ``otherwise``.
    """
    expr = None
    for code, label in labels.items():
        expr = F.when(value == F.lit(code), F.lit(label)) if expr is None else expr.when(value == F.lit(code), F.lit(label))
    if expr is None:
        return F.lit(None).cast("string")
    return expr


# Gender codes of the credits files.
GENDER_LABELS = {1: "F", 2: "M", 0: "U"}


def gender_label(value: Column) -> Column:
    """1 -> F, 2 -> M, 0 -> U, anything else -> null."""
    return code_label(value, GENDER_LABELS)


def with_audit(df: DataFrame, column: str = "last_updated") -> DataFrame:
    """Add the load timestamp; one constant value per query."""
    return df.withColumn(column, F.current_timestamp())


def fill_numeric_nulls(df: DataFrame, value: float = 0) -> DataFrame:
    """Nulls in int/float/double columns become ``value``.

    Boolean, string and date columns keep their nulls (``na.fill`` rules).
    """
    return df.na.fill(value)


def not_equal_keep_null(value: Column, other) -> Column:
    """``value != other`` where a missing value counts as different."""
    return ~value.eqNullSafe(other)
