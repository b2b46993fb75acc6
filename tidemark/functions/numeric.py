"""Coercion, null handling and hashing expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(column: Column) -> Column:
    """NaN becomes null; Spark would otherwise order it above every number."""
    return F.when(F.isnan(column), F.lit(None).cast("double")).otherwise(column)


def to_number(df: DataFrame, name: str) -> Column:
    """The column as double: text that is no number, blanks and NaN become null."""
    source = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        text = F.trim(source)
        # Java would read the suffixes d and f as part of a number
        text = F.when(~text.rlike("(?i)[0-9.][df]$"), text)
        return nan_to_null(text.try_cast("double"))
    return nan_to_null(source.cast("double"))


def fill_null(column: Column, value: object) -> Column:
    return F.coalesce(column, F.lit(value))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating-point columns."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def is_positive(column: Column, positive: object) -> Column:
    """Null-safe test for the positive class: a null label counts as negative."""
    return column.eqNullSafe(F.lit(positive))


def rate(condition: Column) -> Column:
    """Share of all rows that meet a never-null condition; null on no rows."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def key_hash(key: Column, seed: object) -> Column:
    """32 hex digits from key and seed: a repeatable random order without any shuffle."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed))))


def hash_percent(key: Column) -> Column:
    """Whole number from 0 to 99, fixed per key."""
    head = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % 100


def number_literal(value: float) -> str:
    """A double as a SQL literal with every digit kept."""
    return f"{float(value)!r}D"
