"""Small marts over the flattened frame: per category, per day, per late city, status x mode.

Each one is a single ``groupBy`` with a map-side partial aggregate, so a hot key costs
one row per map task in the shuffle, never a hot reducer. The category mart feeds six
rankings; persist it when several of them run in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.config import LATE_DELIVERY
from keelson.functions.dates import day_start
from keelson.functions.numbers import money_sum, money_total, money_value
from keelson.plans.flatten import by_ids
from keelson.plans.star import Star


def has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


def category_mart(flat: DataFrame) -> DataFrame:
    """``(category, total_sales, total_profit, orders)``; NULL category dropped."""
    return (flat.filter(F.col("category").isNotNull()).groupBy("category")
            .agg(money_value(money_sum("sales")).alias("total_sales"),
                 money_value(money_sum("profit")).alias("total_profit"),
                 F.count("*").cast("bigint").alias("orders")))


def star_category_mart(star: Star) -> DataFrame:
    """``category_mart`` of a star: the fact is summed by product id, then joined."""
    rows = by_ids(star, ["product"], {"s": money_sum("sales"), "p": money_sum("profit"),
                                      "n": F.count("*")})
    return (rows.filter(F.col("category").isNotNull()).groupBy("category")
            .agg(money_value(money_total("s")).alias("total_sales"),
                 money_value(money_total("p")).alias("total_profit"),
                 F.sum("n").cast("bigint").alias("orders")))


def star_late_city_counts(star: Star) -> DataFrame:
    """``late_city_counts`` of a star: the fact is counted by geography and logistics id."""
    late = by_ids(star, ["customer_geo", "logistics"], {"n": F.count("*")}).filter(
        (F.col("delivery_status") == LATE_DELIVERY) & F.col("cust_city").isNotNull())
    return late.groupBy("cust_city").agg(F.sum("n").cast("bigint").alias("late_count"))


def star_status_mode_wide(star: Star) -> DataFrame:
    """``status_mode_wide`` of a star: the fact is counted by logistics id, and the mode
    columns come from the logistics dimension (however many there are)."""
    dim = star["dim_logistics"].filter("delivery_status IS NOT NULL AND ship_mode IS NOT NULL")
    modes = sorted(r.ship_mode for r in dim.select("ship_mode").distinct().collect())
    rows = by_ids(star, ["logistics"], {"n": F.count("*")}).filter(
        "delivery_status IS NOT NULL AND ship_mode IS NOT NULL")
    return rows.groupBy("delivery_status").agg(*[
        F.coalesce(F.sum(F.when(F.col("ship_mode") == m, F.col("n"))), F.lit(0))
        .cast("bigint").alias(m) for m in modes])


def daily_sales_vs_price(flat: DataFrame) -> DataFrame:
    """Revenue and mean oil price per calendar day (A16, F7); readers sort it."""
    day = day_start(F.col("full_date"))
    return (flat.filter(F.col("full_date").isNotNull()).groupBy(day.alias("day"))
            .agg(money_value(money_sum("sales")).alias("total_sales"),
                 F.avg("oil_price").alias("avg_oil_price")))


def late_city_counts(flat: DataFrame) -> DataFrame:
    """Late deliveries per customer city (A18, P7); NULL city dropped."""
    return (flat.filter((F.col("delivery_status") == LATE_DELIVERY)
                        & F.col("cust_city").isNotNull())
            .groupBy("cust_city").agg(F.count("*").cast("bigint").alias("late_count")))


def status_mode_wide(flat: DataFrame) -> DataFrame:
    """Contingency table: one row per status, one column per mode, empty cells 0."""
    both = flat.filter(F.col("delivery_status").isNotNull() & F.col("ship_mode").isNotNull())
    # The mode values become columns; Spark looks them up itself (a bounded domain,
    # limited by spark.sql.pivotMaxValues).
    wide = both.groupBy("delivery_status").pivot("ship_mode").count()
    modes = [c for c in wide.columns if c != "delivery_status"]
    return wide.na.fill(0, subset=modes).select(
        "delivery_status", *[F.col(f"`{m}`").cast("bigint").alias(m) for m in modes])


def unpivot_modes(wide: DataFrame) -> DataFrame:
    """Wide status x mode table -> long form ``(delivery_status, ship_mode, n)``."""
    modes = [c for c in wide.columns if c != "delivery_status"]
    return wide.unpivot(["delivery_status"], [F.col(f"`{m}`") for m in modes],
                        "ship_mode", "n")


def status_mode_long(flat: DataFrame) -> DataFrame:
    """The same table in long form ``(delivery_status, ship_mode, n)``, zeros included."""
    return unpivot_modes(status_mode_wide(flat))
