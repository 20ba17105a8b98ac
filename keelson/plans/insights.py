"""Rule-based insights and the report-context records, both from the KPI row.

The rules are one ``array`` of conditional structs per KPI row; NULL entries (rules that
did not fire) are filtered out and the rest exploded with ``inline``. No Python runs per
row; the texts are built with ``format_number`` (half-even, like the reference's
fixed-point formatting), with thousands separators exactly where the reference puts
them (whole-currency amounts and the order count).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.config import (LATE_DANGER_PCT, LATE_EXCELLENT_PCT, MARGIN_HEALTHY_PCT,
                            PRICE_VOLATILE_STD)
from keelson.functions.text import fmt_fixed, fmt_signed


@dataclass(frozen=True)
class Rule:
    """Fires when ``column`` stands in ``relation`` to ``limit``; its texts say just that."""

    position: int
    severity: str
    label: str
    column: str
    relation: str
    limit: float
    digits: int

    def fires(self) -> Column:
        value = F.col(self.column)
        if self.relation == "below":
            return value < self.limit
        above = F.coalesce(value > self.limit, F.lit(False))
        return above if self.relation == "above" else ~above

    def row(self) -> Column:
        return F.struct(
            F.lit(self.position).cast("int").alias("position"),
            F.lit(self.severity).alias("severity"),
            F.lit(f"{self.label} {self.relation} {self.limit:g}").alias("title"),
            F.concat(F.lit(f"{self.label}: "),
                     fmt_fixed(F.col(self.column), self.digits, grouping=False),
                     F.lit(f", limit {self.limit:g}")).alias("message"))


_MARGIN, _LATE = "Profit margin (%)", "Late deliveries (%)"
RULES = (
    Rule(1, "success", _MARGIN, "margin_pct", "above", MARGIN_HEALTHY_PCT, 1),
    Rule(1, "warning", _MARGIN, "margin_pct", "not above", MARGIN_HEALTHY_PCT, 1),
    Rule(2, "danger", _LATE, "late_rate", "above", LATE_DANGER_PCT, 1),
    Rule(2, "success", _LATE, "late_rate", "below", LATE_EXCELLENT_PCT, 1),
    Rule(3, "warning", "Oil price deviation", "oil_std", "above", PRICE_VOLATILE_STD, 2),
)


def insights(kpi: DataFrame) -> DataFrame:
    """``(position, severity, title, message)`` for every rule that fires."""
    rules = F.array(*[F.when(r.fires(), r.row()) for r in RULES])
    return kpi.select(F.inline(F.filter(rules, lambda x: x.isNotNull())))


def _rec(section: str, pos: int, label: str, value: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), F.lit(pos).cast("int").alias("position"),
                    F.lit(label).alias("label"), value.alias("value"))


def _plain2(c: Column) -> Column:
    """Two decimals, no thousands separator."""
    return fmt_fixed(c, 2, grouping=False)


def prompt_context(kpi: DataFrame) -> DataFrame:
    """``(section, position, label, value)``: the three fixed record sets of the report."""
    c = F.col
    na = F.lit("N/A")
    recs = F.array(
        _rec("executive", 1, "Revenue", fmt_fixed(c("total_sales"), 0, "$ ")),
        _rec("executive", 2, "Margin",
             fmt_fixed(c("margin_pct"), 1, suffix="%", grouping=False)),
        _rec("executive", 3, "Profit", fmt_fixed(c("total_profit"), 0, "$ ")),
        _rec("executive", 4, "Trend", fmt_signed(c("sales_trend_pct"), 1, "%")),
        _rec("executive", 5, "Top category", F.coalesce(c("top_category"), na)),
        _rec("executive", 6, "Worst category", F.coalesce(c("worst_category"), na)),
        _rec("logistics", 1, "Late rate",
             fmt_fixed(c("late_rate"), 1, suffix="%", grouping=False)),
        _rec("logistics", 2, "On-time rate",
             fmt_fixed(c("on_time_rate"), 1, suffix="%", grouping=False)),
        _rec("logistics", 3, "Oil average", F.concat(F.lit("$ "), _plain2(c("oil_avg")))),
        _rec("logistics", 4, "Oil volatility", fmt_fixed(c("oil_std"), 1, "±", grouping=False)),
        _rec("commercial", 1, "Average ticket", F.concat(F.lit("$ "), _plain2(c("avg_ticket")))),
        _rec("commercial", 2, "Margin",
             fmt_fixed(c("margin_pct"), 1, suffix="%", grouping=False)),
        _rec("commercial", 3, "Top product", F.coalesce(c("top_category"), na)),
        _rec("commercial", 4, "Total orders", fmt_fixed(c("total_orders"), 0)),
    )
    return kpi.select(F.inline(recs))
