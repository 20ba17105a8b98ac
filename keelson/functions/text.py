"""Number-to-text formatting for report labels.

``format_number`` rounds half to even on the exact binary value, like Python's and C's
fixed-point formatting, and inserts thousands separators. A NULL number gives the
text ``nan`` (the way the reference prints a missing float).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(c: Column, decimals: int, grouping: bool) -> Column:
    if grouping:
        return F.format_number(c, decimals)
    pattern = "0." + "0" * decimals if decimals else "0"
    return F.call_function("format_number", c, F.lit(pattern))


def fmt_fixed(c: Column, decimals: int, prefix: str = "", suffix: str = "",
              grouping: bool = True) -> Column:
    """``decimals`` places; ``grouping`` adds thousands separators (``1,234.5``)."""
    txt = F.coalesce(_number(c, decimals, grouping), F.lit("nan"))
    return F.concat(F.lit(prefix), txt, F.lit(suffix))


def fmt_signed(c: Column, decimals: int, suffix: str = "", grouping: bool = False) -> Column:
    """Forced sign: ``+1.5`` / ``-1.5`` / ``+0.0``."""
    body = _number(c, decimals, grouping)
    signed = F.when(c >= 0, F.concat(F.lit("+"), body)).otherwise(body)
    return F.concat(F.coalesce(signed, F.lit("nan")), F.lit(suffix))
