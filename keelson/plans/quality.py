"""Data-quality audit of the typed order lines.

All rules are counted in one pass (conditional aggregation, partial aggregate on the map
side), so the audit costs one scan and a one-row exchange whatever the data size. Rules
only report; the one removing rule is ``keep_valid`` in the silver step. The
missing-category rule is evaluated before the fill (in the reference it ran after the
fill and could never fire).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (rule, severity) in report order; quality_report holds the predicates.
RULES: tuple[tuple[str, str], ...] = (
    ("future_order_date", "error"), ("negative_sales", "error"),
    ("negative_ship_days", "error"), ("missing_category", "warning"),
)
DROPPED = ("overlong_line", "error")


def _as_of(as_of: dt.datetime | str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def quality_report(typed: DataFrame, as_of: dt.datetime | str | Column | None = None,
                   dropped: DataFrame | None = None) -> DataFrame:
    """``(rule, severity, violations)``, one row per rule, zeros included.

    ``dropped`` holds the raw lines that the reader left out, counted as one more rule.
    """
    now = _as_of(as_of)
    preds = {
        "future_order_date": F.col("order_ts") > now,
        "negative_sales": F.col("sales") < 0,
        "negative_ship_days": F.col("ship_days_real") < 0,
        "missing_category": F.col("category").isNull(),
    }
    counts = typed.agg(*[F.count_if(preds[r]).cast("bigint").alias(r) for r, _ in RULES])
    rules = RULES
    if dropped is not None:
        counts = counts.withColumn(DROPPED[0], dropped.agg(F.count(F.lit(1))).scalar())
        rules = (*RULES, DROPPED)
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"),
                              F.col(r).alias("violations")) for r, s in rules])
    return counts.select(F.inline(rows))
