"""Date-part helpers. All parts are returned as ``bigint`` (the SQL twin's EXTRACT type)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week_sunday0(c: Column) -> Column:
    """Day of week with Sunday = 0 (Spark's ``dayofweek`` has Sunday = 1)."""
    return (F.dayofweek(c) - 1).cast("bigint")


def day_start(c: Column) -> Column:
    """Timestamp cut to midnight, kept zone-less."""
    return F.date_trunc("day", c).cast("timestamp_ntz")


def date_parts(c: Column) -> dict[str, Column]:
    return {
        "year": F.year(c).cast("bigint"),
        "month": F.month(c).cast("bigint"),
        "day": F.dayofmonth(c).cast("bigint"),
        "day_of_week": day_of_week_sunday0(c),
        "quarter": F.quarter(c).cast("bigint"),
    }


def micros_ntz(c: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, without the session zone."""
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    minutes = (F.hour(c) * 60 + F.minute(c)).cast("bigint")
    return days * 86_400_000_000 + minutes * 60_000_000 + seconds


# pattern letter run -> (part function, zero-padded width)
_PARTS = {
    "yyyy": (F.year, 4), "MM": (F.month, 2), "M": (F.month, 1), "dd": (F.dayofmonth, 2),
    "d": (F.dayofmonth, 1), "HH": (F.hour, 2), "H": (F.hour, 1), "mm": (F.minute, 2),
    "ss": (F.second, 2),
}


def format_ntz(c: Column, fmt: str) -> Column:
    """Render a zone-less timestamp as text with a date pattern, without the session zone.

    ``date_format`` converts through the session time zone, which shifts wall-clock
    times inside a daylight-saving gap; here each field comes from the zone-free date
    parts. Supported letters: yyyy, MM, M, dd, d, HH, H, mm, ss; other characters are
    copied.
    """
    pieces = []
    for tok in re.findall(r"yyyy|MM|M|dd|d|HH|H|mm|ss|[^yMdHms]+|.", fmt):
        if tok in _PARTS:
            fn, width = _PARTS[tok]
            part = fn(c).cast("string")
            pieces.append(F.lpad(part, width, "0") if width > 1 else part)
        else:
            pieces.append(F.lit(tok))
    return F.when(c.isNotNull(), F.concat(*pieces))
