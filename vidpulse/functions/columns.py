"""Column expressions shared by the operators. Nothing here raises on bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient(column: Column, dtype: str) -> Column:
    """Cast where possible, null elsewhere."""
    return column.try_cast(dtype)


def flag(column: Column, default: int) -> Column:
    """0/1 flag as int; text such as ``"1.0"`` is accepted, the rest is ``default``."""
    return F.coalesce(lenient(lenient(column, "double"), "int"), F.lit(default))


def parse_time(df: DataFrame, name: str, dtype: str = "timestamp") -> Column:
    """Text to time (null when unreadable); a time column stays as it is."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    return lenient(F.col(name).cast("string"), dtype)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division with a null for a zero denominator."""
    return F.try_divide(numerator, denominator)


def clamp(column: Column, low: Column | float, high: Column | float) -> Column:
    """Limit to ``[low, high]``; a null stays null."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(column < low, low).when(column > high, high).otherwise(column)


def finite_or_null(column: Column) -> Column:
    """NaN compares above every number in Spark; make it and infinite values null before ranking."""
    return F.when(~F.isnan(column) & (F.abs(column) < float("inf")), column)


def millis_text(column: Column) -> Column:
    """Milliseconds since 1970, also as text, to zone-less time text; null when unreadable."""
    seconds = (lenient(column, "bigint").cast("decimal(19,3)") / 1000).cast("decimal(18,6)")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (start + F.make_dt_interval(secs=seconds)).cast("string")


def time_text(column: Column, micros: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, with six decimals on request.

    From the text of the value, because formatting a zone-less time would pass it
    through the session's zone.
    """
    text = column.cast("string")
    seconds = F.substring(text, 1, 19)
    if not micros:
        return seconds
    return F.concat(seconds, F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))
