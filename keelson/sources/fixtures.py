"""Order lines, price quotes and a dated price series derived from the driver's tables.

The reference reads a raw order-line file and a price quote. Here the same inputs are
derived by Spark from the TPC-H-like tables, so that every downstream job grows with
them. The bronze view carries the raw header names and deliberately injected gaps and
dirt (NULL categories, products, cities, states, countries, statuses and dates, and a
few negative sales) so that the cleaning rules have something to act on. No row is
removed here: every line item produces one bronze row.

Money columns are computed in exact decimals and only then cast to double, so that any
engine computing the same expression gets bit-identical values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.config import DEFAULT_STAR
from keelson.operators.joins import UNPACKED, plan_bytes
from keelson.sources.tables import read_table, slice_count

# Fixed values of the derived view: the modulus that blanks each column, and the
# scheduled shipping days per order priority.
NULL_CATEGORY_MOD = 97
NULL_PRODUCT_MOD = 89
NULL_CITY_MOD = 53
NULL_STATE_MOD = 59
NULL_COUNTRY_MOD = 61
NULL_STATUS_MOD = 211
NULL_ORDER_TS_MOD = 401
NEGATIVE_SALES_MOD = 50
NEGATIVE_SALES_LINE = 7
SCHEDULED_DAYS = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
SCHEDULED_DAYS_OTHER = 4
#: Order lines that one task joins and sorts (about 60 MB of rows).
TASK_LINES = 500_000
QUOTE_INDICATOR = "BRENT"
QUOTE_CURRENCY = "USD"


def _blank_if(key: Column, mod: int, value: Column) -> Column:
    return F.when(key % mod != 0, value)


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation joined to region: 25 rows by definition of the schema, safe to broadcast."""
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def _few(table: DataFrame) -> bool:
    """Whether a stored table's rows may be broadcast."""
    return plan_bytes(table) * UNPACKED <= DEFAULT_STAR.broadcast_bytes


def _dealt(df: DataFrame, key: str, tasks: int) -> DataFrame:
    """``df`` by the hash of ``key`` over so many tasks, if the session has fewer."""
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, key) if tasks > default else df.repartition(key)


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw order line per ``lineitem`` row, under the raw file's header names."""
    return _bronze(spark, sf_dir, read_table(spark, sf_dir, "lineitem").count())


def bronze_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The rows of ``bronze_orders`` in slices by a hash of the order key: written one after the
    other, only one slice's shuffles lie on the disks at a time."""
    lines = read_table(spark, sf_dir, "lineitem").count()
    n = slice_count(lines)
    return [_bronze(spark, sf_dir, lines, k, n) for k in range(n)]


def _bronze(spark: SparkSession, sf_dir: str, count: int, k: int = 0, n: int = 1) -> DataFrame:
    """Slice ``k`` of ``n`` of the bronze view over ``count`` lines."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
                    "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                        "o_orderdate", "o_orderpriority")
    if n > 1:
        li, orders = [df.filter(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(n)) == k)
                      for df, key in ((li, "l_orderkey"), (orders, "o_orderkey"))]
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand")
    geo = _geo(spark, sf_dir)
    cust = (read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
            .join(F.broadcast(geo.withColumnRenamed("n_name", "cn_name")
                              .withColumnRenamed("r_name", "cr_name")),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "c_mktsegment", "cn_name", "cr_name"))
    supp = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    few_supp = _few(supp)
    supp = (supp
            .join(F.broadcast(geo.withColumnRenamed("n_name", "sn_name")
                              .withColumnRenamed("r_name", "sr_name")),
                  F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "s_name", "sn_name", "sr_name"))

    # Customers are attached to the orders first (the smaller side), so the line items
    # are shuffled for the order key once. Hash-partitioning both sides on the order key
    # is the exchange a sort-merge join needs anyway; stating it keeps the join
    # co-located and spreads the per-line work over all tasks even when a table is a
    # single file; their number grows with the lines, so that no task's sort spills. Parts
    # and suppliers too many for a broadcast are attached first, while the lines are short;
    # the result stays in the order of the order key, in which an order's lines pack well.
    tasks = -(-count // (n * TASK_LINES))
    few_parts = _few(part)
    lines = li
    if not few_parts:
        part = _dealt(part, "p_partkey", tasks)
        lines = _dealt(li, "l_partkey", tasks).join(part, F.col("l_partkey") == F.col("p_partkey"))
    if not few_supp:
        lines = _dealt(lines, "l_suppkey", tasks).join(
            _dealt(supp, "s_suppkey", tasks), F.col("l_suppkey") == F.col("s_suppkey"))
    orders = orders.join(cust, orders.o_custkey == cust.c_custkey)
    j = _dealt(lines, "l_orderkey", tasks).join(
        _dealt(orders, "o_orderkey", tasks), F.col("l_orderkey") == F.col("o_orderkey"))
    if few_parts:
        j = j.join(F.broadcast(part), F.col("l_partkey") == F.col("p_partkey"))
    if few_supp:
        j = j.join(F.broadcast(supp), F.col("l_suppkey") == F.col("s_suppkey"))

    pk, ck, ok = F.col("l_partkey"), F.col("c_custkey"), F.col("l_orderkey")
    real = F.pmod(F.datediff(F.col("l_shipdate"), F.col("o_orderdate")), F.lit(7))
    prio = F.col("o_orderpriority")
    sched = F.lit(SCHEDULED_DAYS_OTHER)
    for value, days in reversed(list(SCHEDULED_DAYS.items())):
        sched = F.when(prio == value, F.lit(days)).otherwise(sched)
    status = (F.when(ok % NULL_STATUS_MOD == 0, F.lit(None).cast("string"))
              .when((F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "R"),
                    F.lit("Shipping canceled"))
              .when(real > sched, F.lit("Late delivery"))
              .when(real == sched, F.lit("Shipping on time"))
              .otherwise(F.lit("Advance shipping")))
    okey = F.col("o_orderkey")
    base_ts = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), F.lit(0), (okey % 1440).cast("int"), F.lit(0))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    brand_no = F.expr("substring(p_brand, 7)").cast("int")
    bias = (((brand_no % 7) - 3) * 4 / 100).cast("decimal(4,2)")
    one = F.lit(Decimal("1.00"))
    sign = F.when((pk % NEGATIVE_SALES_MOD == 0) & (F.col("l_linenumber") == NEGATIVE_SALES_LINE),
                  F.lit(-1.0)).otherwise(F.lit(1.0))
    margin = (F.lit(Decimal("0.15")) - disc - tax + bias).cast("decimal(6,2)")
    profit = (price * margin).cast("double")

    return j.select(
        _blank_if(pk, NULL_CATEGORY_MOD, F.col("p_brand")).alias("Category Name"),
        _blank_if(pk, NULL_PRODUCT_MOD, F.col("p_name")).alias("Product Name"),
        _blank_if(ck, NULL_CITY_MOD, F.concat(F.col("c_mktsegment"), F.lit("-"),
                                              (ck % 4).cast("string"))).alias("Customer City"),
        _blank_if(ck, NULL_STATE_MOD, F.col("cn_name")).alias("Customer State"),
        _blank_if(ck, NULL_COUNTRY_MOD, F.col("cr_name")).alias("Customer Country"),
        F.col("s_name").alias("Order City"),
        F.col("sn_name").alias("Order State"),
        F.col("sn_name").alias("Order Country"),
        F.col("sr_name").alias("Order Region"),
        status.alias("Delivery Status"),
        prio.alias("Shipping Mode"),
        real.cast("int").alias("Days for shipping (real)"),
        sched.cast("int").alias("Days for shipment (scheduled)"),
        F.when(okey % NULL_ORDER_TS_MOD != 0, base_ts).alias("order date (DateOrders)"),
        (base_ts + F.make_dt_interval(real.cast("int"))).alias("shipping date (DateOrders)"),
        ((price * (one - disc)).cast("double") * sign).alias("Order Item Total"),
        profit.alias("Order Profit Per Order"),
        (price * (one - disc) * (one + tax)).cast("double").alias("Sales per customer"),
        profit.alias("Benefit per order"),
        ok.alias("Order Id"),
        pk.alias("Product Card Id"),
        F.col("o_custkey").alias("Customer Id"),
    )


def quotes_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price ticks of one indicator: every event is a quote at its time and value."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    return ev.select(
        F.col("event_id").alias("quote_id"),
        F.col("ts").alias("quote_ts"),
        F.lit(QUOTE_INDICATOR).alias("indicator"),
        F.col("value").alias("price"),
        F.lit(QUOTE_CURRENCY).alias("currency"),
        F.col("event_type").alias("source"),
    )


def weekly_price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated price series (one point per week) for the as-of lookups."""
    o = read_table(spark, sf_dir, "orders", "o_orderdate", "o_totalprice")
    return (o.groupBy(F.date_trunc("week", F.col("o_orderdate")).cast("timestamp_ntz")
                      .alias("price_day"))
            .agg(F.round(F.avg("o_totalprice") / 1000, 2).alias("price"))
            .withColumn("indicator", F.lit(QUOTE_INDICATOR)))
