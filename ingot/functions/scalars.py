"""Scalar helpers (X1-X15) kept as Column expressions.

The source-value normaliser (X9) is a typed projection over a schema:
ids and decimals become strings, dates and times ISO text, bytes
lower-case hex. No per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed formats used when time values become text.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_DATE = "yyyy-MM-dd"


def iso_text(c: Column) -> Column:
    return F.date_format(c, ISO_MICROS)


def normalise_column(c: Column, dt: T.DataType) -> Column:
    """One column as it would be landed as JSON text."""
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(c)
    if isinstance(dt, T.DateType):
        return F.date_format(c, ISO_DATE)
    if isinstance(dt, T.DecimalType):
        return c.cast("string")
    if isinstance(dt, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(dt, T.StructType):
        # a NULL struct stays NULL
        return F.when(c.isNotNull(), F.struct(*[normalise_column(c.getField(f.name), f.dataType).alias(f.name)
                                                for f in dt.fields]))
    if isinstance(dt, T.ArrayType) and _needs_normalising(dt.elementType):
        return F.transform(c, lambda e: normalise_column(e, dt.elementType))
    return c


def _needs_normalising(dt: T.DataType) -> bool:
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType, T.BinaryType)):
        return True
    if isinstance(dt, T.StructType):
        return any(_needs_normalising(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _needs_normalising(dt.elementType)
    return False


def normalise_types(df: DataFrame) -> DataFrame:
    return df.select(*[normalise_column(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
                       for f in df.schema.fields])


def pct(part: Column, whole: Column, digits: int = 4) -> Column:
    """round(100*part/whole, digits); 0 when whole is 0 or null."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        F.round(F.lit(100.0) * part / whole, digits))


def divergence_pct(expected: Column, actual: Column) -> Column:
    """|expected - actual| / expected * 100, 0 when nothing was expected."""
    return F.when(F.coalesce(expected, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        F.abs(expected - actual) / expected * 100.0)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps, microsecond precision."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def truncate(c: Column, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(c, 1, n)


def with_default(c: Column, default) -> Column:
    """Null → default."""
    return F.coalesce(c, F.lit(default))


def safe_cast(c: Column, type_: str) -> Column:
    """Cast that yields NULL instead of failing under ANSI mode."""
    return c.try_cast(type_)
