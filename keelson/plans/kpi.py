"""KPI set of the analysis frame.

``kpi_summary`` returns one row. Its parts:

* one global aggregate (sums, count, mean and sample deviation of the oil price, late
  share); missing columns fall back to the reference's defaults (P9);
* arg-max / arg-min category over the category mart, attached as scalar subqueries;
* the sales trend: rows ordered by date (NULL last), split at ``n // 2``, percent change
  of the second half's revenue over the first's.

The trend needs the revenue of the first ``n // 2`` rows in a global order. A global sort
would be one task; instead the split is found by selection (``half_split``):

1. one pass counts the rows and finds the range of the dates;
2. a histogram of ``SPLIT_BUCKETS`` equal steps over that range (rows and exact revenue of each)
   tells in which bucket row ``n // 2`` falls; what lies before it belongs to the first half. That
   bucket alone is cut again, until it holds a single timestamp: two or three passes, the later
   ones over a narrow range of dates, which is pushed to the scan;
3. only that timestamp's rows need ordering by revenue: they are counted for each value and cut
   at the rank; where it has very many different values, by a distributed prefix sum
   (``take_first``), so a timestamp that holds a third of all rows is still spread over all tasks.

Rows equal in both timestamp and revenue are interchangeable, so the result does not
depend on the order among them.
"""

from __future__ import annotations

import datetime as dt
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.config import LATE_DELIVERY
from keelson.functions.dates import micros_ntz
from keelson.functions.numbers import (
    money_fraction, money_sum, money_total, money_value, safe_ratio,
)
from keelson.operators.ordered import take_first
from keelson.plans.flatten import DIM_ATTRS, by_ids
from keelson.plans.marts import category_mart, has
from keelson.plans.star import Star


#: Steps of a histogram; each comes to the driver as one row.
SPLIT_BUCKETS = 16_384
#: So many different revenues of one timestamp are cut on the driver, more by ``take_first``.
SPLIT_VALUES = 50_000


def _at(micros: int) -> Column | None:
    """A timestamp literal for the scan, where Python's calendar has it."""
    try:
        when = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
    except OverflowError:
        return None
    return F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz")


def _between(rows: DataFrame, low: int, high: int) -> DataFrame:
    first, last = _at(low), _at(high)
    if first is not None and last is not None:  # reaches the Parquet scan
        rows = rows.filter((F.col("full_date") >= first) & (F.col("full_date") <= last))
    return rows.filter((F.col("at") >= low) & (F.col("at") <= high))


def _first_of_values(rows: DataFrame, k: int) -> Fraction | float:
    """Revenue of the ``k`` smallest of ``rows`` (NULLs first)."""
    per_value = rows.groupBy("sales").agg(F.count("*").alias("c"))
    found = per_value.limit(SPLIT_VALUES + 1).collect()
    if len(found) > SPLIT_VALUES or any(v is not None and not math.isfinite(v) for v, _ in found):
        taken = take_first(per_value, [F.col("sales").asc()], "c", F.lit(k))
        return money_fraction(taken.agg(money_sum("sales", F.col("take")).alias("s")).first()["s"])
    head = Fraction(0)
    for value, c in sorted(found, key=lambda r: (r[0] is not None, r[0] or 0.0)):
        take = max(0, min(c, k))
        head += Fraction(value or 0) * take
        k -= take
    return head


def half_split(flat: DataFrame) -> tuple[float, float]:
    """Revenue of the first ``n // 2`` rows (by date, NULL last, then revenue) and of the rest."""
    rows = flat.select("full_date", micros_ntz(F.col("full_date")).alias("at"),
                       F.col("sales").cast("double").alias("sales"))
    n, low, high = rows.agg(F.count("*"), F.min("at"), F.max("at")).first()
    k, before, head, total = n // 2, 0, Fraction(0), None
    within = rows
    while before < k or total is None:
        step = max(1, -(-(high - low + 1) // SPLIT_BUCKETS)) if low is not None else 1
        bucket = F.floor((F.col("at") - F.lit(low)) / step) if step > 1 else F.col("at") - F.lit(low)
        parts = within.groupBy(bucket.cast("bigint").alias("b")).agg(
            F.count("*").alias("c"), F.min("at").alias("low"), F.max("at").alias("high"),
            money_sum("sales").alias("s")).collect()
        parts.sort(key=lambda r: (r["b"] is None, r["b"] or 0))  # NULL dates are last
        if total is None:
            total = sum((money_fraction(r["s"]) for r in parts), Fraction(0))
        for part in parts:
            if before + part["c"] > k:
                break
            before += part["c"]
            head += money_fraction(part["s"])
        if before == k:
            break
        if part["low"] is None:  # the rows without a date
            head += _first_of_values(rows.filter(F.col("at").isNull()), k - before)
            break
        low, high = part["low"], part["high"]
        within = _between(rows, low, high)
        if low == high:
            head += _first_of_values(within, k - before)
            break
    return float(head), float(total - head)


def _trend_pct(first: float, second: float) -> float:
    return (second - first) / first * 100 if first > 0 else 0.0


def sales_trend(flat: DataFrame) -> DataFrame:
    """One row: ``first_half, second_half, trend_pct``."""
    spark = flat.sparkSession
    if not has(flat, "full_date"):
        first, second = 0.0, float(money_fraction(
            flat.agg(money_sum("sales").alias("s")).first()["s"]))
        return spark.range(1).select(F.lit(first).alias("first_half"),
                                     F.lit(second).alias("second_half"),
                                     F.lit(0.0).alias("trend_pct"))
    first, second = half_split(flat)
    return spark.range(1).select(F.lit(first).alias("first_half"),
                                 F.lit(second).alias("second_half"),
                                 F.lit(_trend_pct(first, second)).alias("trend_pct"))


def best_worst(flat: DataFrame, mart: DataFrame | None = None) -> tuple[Column, Column]:
    """Scalar-subquery columns: top category by revenue, bottom one by profit.

    Ties resolve to the alphabetically first category (first in key order). ``mart`` may
    pass an already built category mart of the same frame.
    """
    if mart is None and not has(flat, "category"):
        none = F.lit(None).cast("string")
        return none, none
    mart = mart if mart is not None else category_mart(flat)
    top = mart.agg(F.min_by("category", F.struct(-F.col("total_sales"), F.col("category"))))
    worst = mart.agg(F.min_by("category", F.struct(F.col("total_profit"), F.col("category"))))
    return top.scalar(), worst.scalar()


def _global_columns(flat: DataFrame) -> list[Column]:
    sales = F.coalesce(money_value(money_sum("sales")), F.lit(0.0))
    profit = F.coalesce(money_value(money_sum("profit")), F.lit(0.0))
    cols = [sales.alias("total_sales"), profit.alias("total_profit"),
            F.count("*").cast("bigint").alias("total_orders")]
    if has(flat, "oil_price"):
        cols += [F.avg("oil_price").alias("oil_avg"), F.stddev_samp("oil_price").alias("oil_std")]
    else:
        cols += [F.lit(0.0).alias("oil_avg"), F.lit(0.0).alias("oil_std")]
    if has(flat, "delivery_status"):
        late = F.avg(F.when(F.col("delivery_status") == LATE_DELIVERY, 1.0).otherwise(0.0)) * 100
        cols.append(late.alias("late_rate"))
    else:
        cols.append(F.lit(0.0).alias("late_rate"))
    return cols


def kpi_aggregates(flat: DataFrame) -> DataFrame:
    """Global KPI aggregates and the category arg-max/arg-min from one scan of ``flat``.

    Grouping sets ``((), (category))`` compute the global row and one row per category in
    the same aggregation (map-side partial aggregates, one shuffle of at most one row per
    category and task); a final aggregate over that small result picks the global values
    and the best and worst categories.
    """
    if not has(flat, "category"):
        return flat.agg(*_global_columns(flat)).select(
            "*", F.lit(None).cast("string").alias("top_category"),
            F.lit(None).cast("string").alias("worst_category"))
    parts = flat.groupingSets([[], ["category"]], "category").agg(
        *_global_columns(flat), F.grouping("category").alias("_kpi_global"))
    is_global = F.col("_kpi_global") == 1
    is_cat = (F.col("_kpi_global") == 0) & F.col("category").isNotNull()
    glob = ("total_sales", "total_profit", "total_orders", "oil_avg", "oil_std", "late_rate")
    # ties go to the alphabetically first category (first in key order)
    return parts.agg(
        *[F.max(F.when(is_global, F.col(c))).alias(c) for c in glob],
        F.min_by(F.col("category"), F.when(is_cat, F.struct(
            -F.col("total_sales"), F.col("category")))).alias("top_category"),
        F.min_by(F.col("category"), F.when(is_cat, F.struct(
            F.col("total_profit"), F.col("category")))).alias("worst_category"))


def kpi_summary(flat: DataFrame, trend: DataFrame | None = None,
                parts: DataFrame | None = None) -> DataFrame:
    """The KPI row (C7). Empty input gives ``None`` in the reference; here an error.

    ``trend`` may pass an already computed ``sales_trend`` row of the same frame, and
    ``parts`` an already computed ``kpi_aggregates`` row.
    """
    if flat.isEmpty():
        raise ValueError("no rows: KPIs are undefined")
    trend = (trend if trend is not None else sales_trend(flat)).first()["trend_pct"]
    g = parts if parts is not None else kpi_aggregates(flat)
    s, p = F.col("total_sales"), F.col("total_profit")
    return g.select(
        s.alias("total_sales"), p.alias("total_profit"),
        F.when(s > 0, p / s * 100).otherwise(F.lit(0.0)).alias("margin_pct"),
        F.col("total_orders").cast("bigint").alias("total_orders"),
        safe_ratio(s, F.col("total_orders")).alias("avg_ticket"),
        "oil_avg", "oil_std", "late_rate",
        (F.lit(100.0) - F.col("late_rate")).alias("on_time_rate"),
        F.lit(float(trend)).alias("sales_trend_pct"),
        "top_category", "worst_category",
    )


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """Row count and distinct countries, categories, cities (A14); NULL not counted.

    ``approx=True`` uses HyperLogLog sketches (one fixed-size state per task, no
    distinct shuffle) for very large inputs.
    """
    def n_distinct(c: str):
        return F.approx_count_distinct(c) if approx else F.count_distinct(c)
    return df.agg(F.count("*").cast("bigint").alias("rows"),
                  *[n_distinct(c).cast("bigint").alias(f"n_{c}")
                    for c in ("cust_country", "category", "cust_city") if c in df.columns])


def star_distinct_counts(star: Star) -> DataFrame:
    """``distinct_counts`` of a star: the distinct ids of the fact first, then the distinct
    attributes of those ids; no row of the fact is expanded."""
    fact = star["fact_sales"]
    counts = [fact.agg(F.count("*").cast("bigint")).scalar().alias("rows")]
    for name, cols in (("customer_geo", ("cust_country", "cust_city")), ("product", ("category",))):
        key = DIM_ATTRS[name][1]
        ids = fact.select(key).distinct()
        seen = star[DIM_ATTRS[name][0]].join(ids, key, "left_semi")
        counts += [seen.agg(F.count_distinct(c).cast("bigint")).scalar().alias(f"n_{c}")
                   for c in cols]
    order = ("rows", "n_cust_country", "n_category", "n_cust_city")
    return fact.sparkSession.range(1).select(*counts).select(*order)


def star_kpi_aggregates(star: Star) -> DataFrame:
    """``kpi_aggregates`` of a star with product and logistics: the fact is aggregated by
    the two ids; all figures come from that small table. The price is carried as exact
    decimal sums of itself and its square, so its deviation does not lose digits."""
    price = F.col("daily_oil_price").cast("decimal(18,6)")
    rows = by_ids(star, ["product", "logistics"], {
        "s": money_sum("sales"), "p": money_sum("profit"), "n": F.count("*"),
        "po": F.sum(price), "pp": F.sum((price * price).cast("decimal(28,12)")),
        "np": F.count("daily_oil_price")})
    late = F.when(F.col("delivery_status") == LATE_DELIVERY, F.col("n")).otherwise(F.lit(0))
    whole = rows.agg(
        F.coalesce(money_value(money_total("s")), F.lit(0.0)).alias("total_sales"),
        F.coalesce(money_value(money_total("p")), F.lit(0.0)).alias("total_profit"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_orders"), F.sum("po").alias("po"),
        F.sum("pp").alias("pp"), F.sum("np").alias("np"), F.sum(late).alias("late"))
    mean = F.try_divide(F.col("po"), F.col("np"))
    spread = (F.col("pp") * F.col("np") - F.col("po") * F.col("po")).cast("double")
    pairs = F.col("np").cast("double") * (F.col("np") - 1)
    mart = rows.filter(F.col("category").isNotNull()).groupBy("category").agg(
        money_value(money_total("s")).alias("total_sales"),
        money_value(money_total("p")).alias("total_profit"))
    top, worst = best_worst(rows, mart)
    return whole.select(
        "total_sales", "total_profit", F.col("total_orders").cast("bigint").alias("total_orders"),
        mean.cast("double").alias("oil_avg"),
        F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), pairs)).alias("oil_std"),
        (F.try_divide(F.col("late"), F.col("total_orders")) * 100).alias("late_rate"),
        top.alias("top_category"), worst.alias("worst_category"))
