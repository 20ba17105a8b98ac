"""The two star-join reports (C9): category KPIs (A26, J5, O2) and status counts.

Both group by an attribute of a dimension. The fact is first aggregated by the surrogate
id (partial aggregate on the map side; the shuffle then carries one row per id and map
task instead of one per order line), joined to the dimension, and re-aggregated by the
attribute. Sums and counts re-aggregate exactly; the mean is carried as (sum, count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.numbers import money_sum, money_total, money_value, round_money

TOP_CATEGORIES = 5


def category_kpis(fact: DataFrame, dim_product: DataFrame,
                  top: int = TOP_CATEGORIES) -> DataFrame:
    """Top categories by revenue: orders, revenue, mean oil price, profit (rounded to 2)."""
    per_id = (fact.filter(F.col("product_id").isNotNull())
              .groupBy("product_id")
              .agg(F.count("product_id").alias("n"), money_sum("sales").alias("s"),
                   F.sum("daily_oil_price").alias("po"), F.count("daily_oil_price").alias("no"),
                   money_sum("profit").alias("p")))
    # both sides have one row per id, so the planner may choose any join
    by_cat = per_id.join(dim_product.select("product_id", "category"), "product_id").groupBy("category").agg(
        F.sum("n").cast("bigint").alias("total_orders"),
        round_money(money_value(money_total("s"))).alias("total_sales"),
        round_money(F.try_divide(F.sum("po"), F.sum("no"))).alias("avg_oil_price"),
        round_money(money_value(money_total("p"))).alias("total_profit"))
    return by_cat.orderBy(F.col("total_sales").desc_nulls_last(), F.col("category")).limit(top)


def status_counts(fact: DataFrame, dim_logistics: DataFrame) -> DataFrame:
    """Fact rows per delivery status; inner join drops facts with a NULL logistics id."""
    per_id = fact.groupBy("logistics_id").agg(F.count("*").alias("n"))
    return (per_id.join(dim_logistics.select("logistics_id", "delivery_status"), "logistics_id").groupBy("delivery_status")
            .agg(F.sum("n").cast("bigint").alias("total")))
