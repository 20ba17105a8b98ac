"""Casts with the reference's semantics, as plain Column expressions.

* integer cast rounds half to even (2.5 -> 2, 3.5 -> 4, 2.7 -> 3) instead of truncating;
  text that is not a number raises under ANSI mode, as the reference's cast does;
* timestamps are parsed with one explicit layout and bad text becomes NULL;
* NaN becomes NULL once, so later comparisons follow SQL NULL rules (in Spark ``NaN >= 0``
  is true, while the reference's survival filter drops NaN).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_double(c: Column, source_type: T.DataType | None = None) -> Column:
    """Text or number to double; NaN mapped to NULL."""
    d = c if isinstance(source_type, T.DoubleType) else c.cast("double")
    return nan_to_null(d)


def to_int_half_even(c: Column, source_type: T.DataType | None = None) -> Column:
    """Cast to int rounding half to even; integral sources pass through unchanged."""
    if isinstance(source_type, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("int")
    if isinstance(source_type, T.LongType):
        return c.cast("int")
    return F.rint(nan_to_null(c.cast("double"))).cast("int")


def to_timestamp_ntz(c: Column, fmt: str, source_type: T.DataType | None = None) -> Column:
    """Parse text with ``fmt`` into a zone-less timestamp; unparsable text -> NULL."""
    if isinstance(source_type, T.TimestampNTZType):
        return c
    if isinstance(source_type, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    text, pattern = c.cast("string"), F.lit(fmt)
    # try_to_timestamp decides validity (NULL for bad text); the value itself is parsed
    # zone-free, so a wall-clock time that falls in a daylight-saving gap of the session
    # time zone is not shifted. CASE WHEN only evaluates the branch it takes.
    return F.when(F.try_to_timestamp(text, pattern).isNotNull(),
                  F.to_timestamp_ntz(text, pattern))
