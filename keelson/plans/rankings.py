"""Rankings over the category and late-city marts (A17, A19, A20, A22-A25; O2-O8).

The category rankings take the category mart (``marts.category_mart``: one row per
category), so several rankings share one aggregation of the fact. Every top-k orders by
the measure and then by the key, so ties are resolved the same way everywhere
(alphabetically first key wins). ``orderBy(...).limit(k)`` plans as
TakeOrderedAndProject: each task keeps its own k best rows, the driver merges them. The
windows below run after the limit, over at most k rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.config import CHAMPIONS, LOWEST_MARGIN, QUADRANT_TOP, TOP_LATE_CITIES, TOP_MIX
from keelson.config import TOP_LATE_CITIES_PRIORITY
from keelson.functions.numbers import pct, safe_ratio


def _all() -> Window:
    """The whole (already limited) frame as one window."""
    return Window.partitionBy()


def _margin(df: DataFrame) -> DataFrame:
    return df.withColumn("margin_pct", pct(F.col("total_profit"), F.col("total_sales")))


def category_mix_top(mart: DataFrame, k: int = TOP_MIX) -> DataFrame:
    """Top categories by revenue, with each one's share of the k shown."""
    top = (mart.orderBy(F.col("total_sales").desc(), "category").limit(k)
           .select("category", "total_sales"))
    return top.withColumn("share_pct", pct(F.col("total_sales"), F.sum("total_sales").over(_all())))


def late_city_top(counts: DataFrame, k: int = TOP_LATE_CITIES) -> DataFrame:
    """Cities with the most late deliveries (A18, O4); ``counts`` from
    ``marts.late_city_counts``."""
    return counts.orderBy(F.col("late_count").desc(), "cust_city").limit(k)


def late_city_top_total(counts: DataFrame, k: int = TOP_LATE_CITIES_PRIORITY) -> DataFrame:
    """Sum of the late deliveries of the first k cities of the ranking."""
    return late_city_top(counts, k).agg(
        F.coalesce(F.sum("late_count"), F.lit(0)).cast("bigint").alias("late_top_total"))


def lowest_margin_categories(mart: DataFrame, k: int = LOWEST_MARGIN) -> DataFrame:
    """Categories with the lowest margin; zero revenue gives NULL, sorted last."""
    return (_margin(mart).drop("orders")
            .orderBy(F.col("margin_pct").asc_nulls_last(), "category").limit(k))


def category_quadrants(mart: DataFrame, k: int = QUADRANT_TOP) -> DataFrame:
    """Top k by revenue with margin, share of the k, and the two mean lines."""
    top = (mart.orderBy(F.col("total_sales").desc(), "category").limit(k)
           .drop("orders"))
    out = _margin(top).withColumn(
        "share_pct", pct(F.col("total_sales"), F.sum("total_sales").over(_all())))
    return (out.withColumn("avg_margin_pct", F.avg("margin_pct").over(_all()))
            .withColumn("avg_share_pct", F.avg("share_pct").over(_all())))


def champion_categories(mart: DataFrame, k: int = CHAMPIONS) -> DataFrame:
    """Top k by profit with margin and medal rank 1..k."""
    top = (mart.orderBy(F.col("total_profit").desc(), "category").limit(k)
           .drop("orders"))
    rank = F.row_number().over(Window.orderBy(F.col("total_profit").desc(), "category"))
    return _margin(top).withColumn("rank", rank.cast("bigint"))


def best_ticket_category(mart: DataFrame) -> DataFrame:
    """Category with the highest mean revenue per order line."""
    m = mart.select(
        "category", safe_ratio(F.col("total_sales"), F.col("orders")).alias("avg_ticket"))
    return m.orderBy(F.col("avg_ticket").desc_nulls_last(), "category").limit(1)
