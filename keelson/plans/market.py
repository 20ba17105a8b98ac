"""Sales against a dated market price (E1, E2, E3 of the README's claims).

The reference stamps one price on every row, so its price/sales comparison is flat.
Here each order day takes the latest quote of a dated price series at or before it
(``asof_join``), and the comparisons are plain aggregates: ``corr`` and ``regr_slope``,
which combine partially on the map side like sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.config import DEFAULT_STAR, StarConfig
from keelson.functions.dates import day_start
from keelson.operators.asof import asof_join
from keelson.operators.joins import bounded_left_join


def price_by_day(dim_time: DataFrame, prices: DataFrame) -> DataFrame:
    """``(day, price_day, price)``: the as-of price of every day with orders. The days come
    from the time dimension, so the order lines are not read for them."""
    days = dim_time.select(day_start(F.col("full_date")).alias("day")).distinct()
    return asof_join(days, prices, "day", "price_day", ["price"], match_time="price_day",
                     right_unit="day")


def price_asof_sales(daily: DataFrame, by_day: DataFrame) -> DataFrame:
    """``(day, total_sales, price_day, price)``: daily revenue with the as-of price.

    ``daily`` is the daily series (``marts.daily_sales_vs_price``).
    """
    return daily.select("day", "total_sales").join(by_day, "day", "left").select(
        "day", "total_sales", "price_day", "price")


def sales_price_corr(daily: DataFrame, by_day: DataFrame) -> DataFrame:
    """One row: days compared and the correlation of daily revenue with the price."""
    s = price_asof_sales(daily, by_day)
    return s.agg(F.count("price").cast("bigint").alias("days"),
                 F.corr("total_sales", "price").alias("corr_sales_price"))


def price_sensitivity(silver: DataFrame, by_day: DataFrame,
                      cfg: StarConfig = DEFAULT_STAR) -> DataFrame:
    """Per (category, order region): correlation and slope of line revenue and profit on
    the as-of price of the order day. Silver is read once (twice when the days do not fit
    a broadcast: the second time for a sample of their keys)."""
    rows = (silver.filter(F.col("order_ts").isNotNull())
            .select("category", "order_region", "sales", "profit",
                    day_start(F.col("order_ts")).alias("day")))
    price = by_day.select(F.col("day").alias("_day"), "price")
    j = bounded_left_join(rows, price, ["day"], ["_day"], cfg.broadcast_bytes)
    return j.groupBy("category", "order_region").agg(
        F.count("price").cast("bigint").alias("n"),
        F.corr("sales", "price").alias("corr_sales_price"),
        F.regr_slope("sales", "price").alias("slope_sales_price"),
        F.corr("profit", "price").alias("corr_profit_price"))
