"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM side, codegen)."""

from keelson.functions.casts import nan_to_null, to_double, to_int_half_even, to_timestamp_ntz
from keelson.functions.dates import date_parts, day_of_week_sunday0, day_start
from keelson.functions.numbers import (
    money_fraction, money_sum, money_total, money_value, pct, round_money, safe_ratio,
)
from keelson.functions.text import fmt_fixed, fmt_signed

__all__ = [
    "date_parts", "day_of_week_sunday0", "day_start", "fmt_fixed", "fmt_signed",
    "money_fraction", "money_sum", "money_total", "money_value", "nan_to_null", "pct",
    "round_money", "safe_ratio", "to_double", "to_int_half_even", "to_timestamp_ntz",
]
