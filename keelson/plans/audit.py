"""Audit of the star.

Row counts of silver and of every star table, plus checks the reference's text file did
not have: fact rows whose surrogate id stayed NULL, fact timestamps missing from the time
dimension, the NULL-timestamp group of the context dimension, and the fact-minus-silver
row delta (non-zero exactly when the geography join fans out). One aggregate pass over
the fact; the orphan check anti-joins the *distinct* fact timestamps, not the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.numbers import money_sum, money_value
from keelson.plans.star import DIM_NAMES, Star

AUDIT_CHECKS = (
    "rows.silver", *[f"rows.{d}" for d in DIM_NAMES], "rows.fact_sales",
    "null_ids.product_id", "null_ids.customer_geo_id", "null_ids.logistics_id",
    "orphans.time_id", "null_groups.dim_context", "fanout.fact_minus_silver",
)


def _count(df: DataFrame):
    return df.agg(F.count("*").cast("bigint")).scalar()


def audit_star(star: Star, silver: DataFrame) -> DataFrame:
    """``(check, value)`` rows in ``AUDIT_CHECKS`` order."""
    fact = star["fact_sales"]
    fact_row = fact.agg(
        F.count("*").cast("bigint").alias("rows.fact_sales"),
        *[F.count_if(F.col(k).isNull()).cast("bigint").alias(f"null_ids.{k}")
          for k in ("product_id", "customer_geo_id", "logistics_id")])
    fact_ts = fact.select("time_id").filter(F.col("time_id").isNotNull()).distinct()
    orphans = fact_ts.join(star["dim_time"].select("time_id"), "time_id", "left_anti")
    extra = {
        "rows.silver": _count(silver),
        **{f"rows.{d}": _count(star[d]) for d in DIM_NAMES},
        "orphans.time_id": _count(orphans),
        "null_groups.dim_context": _count(star["dim_context"].filter(F.col("ref_ts").isNull())),
    }
    row = fact_row.select("*", *[v.alias(k) for k, v in extra.items()])
    row = row.withColumn("fanout.fact_minus_silver",
                         F.col("`rows.fact_sales`") - F.col("`rows.silver`"))
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("check"), F.col(f"`{k}`").cast("bigint").alias("value"))
        for k in AUDIT_CHECKS])))


def fact_integrity(fact: DataFrame) -> DataFrame:
    """One row: fact rows, total revenue, mean profit (A2)."""
    return fact.agg(F.count("*").cast("bigint").alias("rows"),
                    money_value(money_sum("sales")).alias("total_sales"),
                    F.avg("profit").alias("avg_profit"))
