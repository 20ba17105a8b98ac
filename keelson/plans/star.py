"""Silver -> star schema: five dimensions and one fact.

Dimensions are distinct projections of silver (shuffle on the natural key with a map-side
partial aggregate). Surrogate ids are dense, 1..n in natural-key order with NULLs last,
computed by ``dense_ids`` (no single-task window), so a rebuild gives the same ids.
Each dimension is written and read back before the fact join, so the fact joins the
ids that were stored; its stored size decides between a broadcast and the skew-safe join. The
time dimension is made from the stored context dimension, which has every timestamp already.

The fact is partitioned by ``order_year`` (NULL dates have a partition of their own) and sorted by
date within its files: a date filter (``since``) leaves out whole folders, then row groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.config import DEFAULT_STAR, STORED, StarConfig
from keelson.functions.dates import date_parts
from keelson.operators.joins import bounded_left_join
from keelson.operators.ordered import dense_ids
from keelson.sources.tables import read_if_present

DIM_NAMES = ("dim_time", "dim_logistics", "dim_product", "dim_customer_geo", "dim_context")

# Sort order of each dimension's files (its id follows the natural key, O1).
DIM_SORT = {"dim_time": ("time_id",), "dim_logistics": ("logistics_id",),
            "dim_product": ("product_id",), "dim_customer_geo": ("customer_geo_id",),
            "dim_context": ("ref_ts",)}

GEO_KEYS_3 = ("cust_city", "cust_state", "cust_country")
GEO_KEYS_2 = ("cust_city", "cust_state")


def dim_time(silver: DataFrame) -> DataFrame:
    """One row per distinct order timestamp (minute grain), NULL excluded (A3)."""
    ts = F.col("order_ts")
    parts = date_parts(ts)
    return (silver.select("order_ts").filter(ts.isNotNull()).distinct()
            .select(ts.alias("time_id"), ts.alias("full_date"),
                    *[c.alias(n) for n, c in parts.items()]))


def dim_logistics(silver: DataFrame) -> DataFrame:
    """(status, mode) with the mean of the *distinct* (real, scheduled) day pairs (A4)."""
    pairs = silver.select("delivery_status", "ship_mode", "ship_days_real",
                          "ship_days_sched").distinct()
    agg = pairs.groupBy("delivery_status", "ship_mode").agg(
        F.avg("ship_days_real").alias("avg_ship_days_real"),
        F.avg("ship_days_sched").alias("avg_ship_days_sched"))
    return dense_ids(agg, [F.col("delivery_status").asc_nulls_last(),
                           F.col("ship_mode").asc_nulls_last()], "logistics_id")


def dim_product(silver: DataFrame) -> DataFrame:
    """Distinct (category, product), category not NULL (A5)."""
    d = silver.select("category", "product").filter(F.col("category").isNotNull()).distinct()
    return dense_ids(d, [F.col("category").asc_nulls_last(), F.col("product").asc_nulls_last()],
                     "product_id")


def dim_customer_geo(silver: DataFrame) -> DataFrame:
    """Distinct (city, state, country), city not NULL (A6); ids in (country, state, city)."""
    d = (silver.select(*GEO_KEYS_3).filter(F.col("cust_city").isNotNull()).distinct())
    return dense_ids(d, [F.col("cust_country").asc_nulls_last(),
                         F.col("cust_state").asc_nulls_last(),
                         F.col("cust_city").asc_nulls_last()], "customer_geo_id")


def dim_context(silver: DataFrame) -> DataFrame:
    """Mean oil price per order timestamp; the NULL timestamp is its own group."""
    return silver.groupBy("order_ts").agg(F.avg("oil_price").alias("oil_price")).select(
        F.col("order_ts").alias("ref_ts"), "oil_price")


#: The fact's partition column, beside FACT_COLUMNS.
FACT_YEAR = "order_year"
#: A year is written in so many files that each holds about this many rows at most.
FACT_FILE_ROWS = 4_000_000
#: Tasks that write the fact, for each ``FACT_FILE_ROWS`` (their sorts stay in memory).
FACT_TASKS = 8

FACT_COLUMNS = ("time_id", "full_date", "product_id", "customer_geo_id", "logistics_id",
                "daily_oil_price", "sales", "profit", "sales_per_customer", "ship_days_real")


def _attach(left: DataFrame, dim: DataFrame, keys: tuple[str, ...], id_col: str,
            cfg: StarConfig) -> DataFrame:
    """``left`` LEFT JOIN ``dim`` on ``keys`` (``=``, not null-safe), adding ``id_col``."""
    dk = [f"_dim_{k}" for k in keys]
    right = dim.select(id_col, *[F.col(k).alias(d) for k, d in zip(keys, dk)])
    return bounded_left_join(left, right, list(keys), dk, cfg.broadcast_bytes).drop(*dk)


def fact_sales(silver: DataFrame, product: DataFrame, geo: DataFrame, logistics: DataFrame,
               cfg: StarConfig = DEFAULT_STAR) -> DataFrame:
    """Silver LEFT JOIN the three keyed dims on their natural keys.

    ``=`` (not null-safe) on every key, as in SQL: a NULL status or city gets a NULL id.
    ``cfg.geo_keys == 2`` joins geography on (city, state) and multiplies a row whose
    (city, state) exists under several countries, as the reference does.
    """
    geo_keys = GEO_KEYS_3 if cfg.geo_keys == 3 else GEO_KEYS_2
    j = _attach(silver, product, ("category", "product"), "product_id", cfg)
    j = _attach(j, geo, geo_keys, "customer_geo_id", cfg)
    j = _attach(j, logistics, ("delivery_status", "ship_mode"), "logistics_id", cfg)
    return j.select(
        F.col("order_ts").alias("time_id"),
        F.col("order_ts").alias("full_date"),
        "product_id", "customer_geo_id", "logistics_id",
        F.col("oil_price").alias("daily_oil_price"),
        "sales", "profit", "sales_per_customer", "ship_days_real",
    )


@dataclass
class Star:
    """Written star tables, read back, with their row counts."""

    root: str
    tables: dict[str, DataFrame]
    rows: dict[str, int] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]


def _write_read(spark: SparkSession, df: DataFrame | Sequence[DataFrame], path: str,
                sort: tuple[str, ...] = (), partition: tuple[str, ...] = ()
                ) -> tuple[DataFrame, int]:
    mode = "overwrite"
    for part in [df] if isinstance(df, DataFrame) else df:
        if sort:  # layout only: sorted files compress better and keep min/max stats tight
            part = part.sortWithinPartitions(*partition, *sort)
        part.write.mode(mode).partitionBy(*partition).parquet(path, compression=STORED)
        mode = "append"
    back = spark.read.parquet(path)
    return back, back.count()


def by_year(fact: DataFrame, rows: int) -> DataFrame:
    """The fact with its year, dealt so that a task writes one file for each of a few years; a
    year that holds most rows is spread over many tasks by a hash of the row."""
    slots = max(1, -(-rows // FACT_FILE_ROWS))
    slot = F.pmod(F.xxhash64(*fact.columns), F.lit(slots))
    deal = (F.col(FACT_YEAR), slot)
    default = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if FACT_TASKS * slots > default:
        deal = (FACT_TASKS * slots, *deal)
    return fact.withColumn(FACT_YEAR, F.year("full_date")).repartition(*deal)


def build_star(silver: DataFrame, root: str, cfg: StarConfig = DEFAULT_STAR,
               rows: int | None = None, slices: Sequence[DataFrame] = ()) -> Star:
    """Build, write and read back the five dims and the fact under ``root``; ``rows`` is the
    number of silver rows, if known. The fact is made of one slice of silver after the other,
    where ``slices`` are given, so that only one slice's shuffle lies on the disks."""
    spark = silver.sparkSession
    star = Star(root=root, tables={})
    builders = {"dim_time": dim_time, "dim_logistics": dim_logistics,
                "dim_product": dim_product, "dim_customer_geo": dim_customer_geo,
                "dim_context": dim_context}
    # The five dimensions are independent: their jobs are submitted from parallel driver
    # threads, so Spark runs their (often small) stages side by side.
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        def build(name: str, fn) -> tuple[DataFrame, int]:
            source = silver
            if name == "dim_time":  # the context has all timestamps
                context, _ = futures["dim_context"].result()
                source = context.select(F.col("ref_ts").alias("order_ts"))
            return _write_read(spark, fn(source), f"{root}/{name}", DIM_SORT[name])
        futures: dict = {}
        for name in sorted(builders, key=lambda n: n != "dim_context"):
            futures[name] = pool.submit(build, name, builders[name])
        for name, fut in futures.items():
            star.tables[name], star.rows[name] = fut.result()
    rows = silver.count() if rows is None else rows
    slices = slices or [silver]
    facts = [fact_sales(part, star["dim_product"], star["dim_customer_geo"],
                        star["dim_logistics"], cfg) for part in slices]
    # Sorted by date inside each file: row groups cover narrow date ranges, so date
    # predicates pushed to the Parquet reader skip most of them.
    dealt = [by_year(fact, -(-rows // len(slices))) for fact in facts]
    star.tables["fact_sales"], star.rows["fact_sales"] = _write_read(
        spark, dealt, f"{root}/fact_sales", ("full_date",), (FACT_YEAR,))
    return star


def since(star: Star, start: str) -> Star:
    """``star`` with the facts from a date on; NULL dates fail. The year reaches the scan as a
    partition filter, the date as a pushed filter."""
    fact, when = star["fact_sales"], F.lit(start).cast("timestamp_ntz")
    if FACT_YEAR in fact.columns:
        fact = fact.filter(F.col(FACT_YEAR) >= int(start[:4]))
    fact = fact.filter(F.col("full_date") >= when)
    return Star(root=star.root, tables={**star.tables, "fact_sales": fact})


def read_star(spark: SparkSession, root: str) -> Star:
    """Open a star written by ``build_star``; absent dimensions are left out.

    The flattening then joins only the dimensions that exist, as the reference does
    when a dimension file is missing. The fact itself must exist.
    """
    tables = {"fact_sales": spark.read.parquet(f"{root}/fact_sales")}
    for name in DIM_NAMES:
        if (found := read_if_present(spark, f"{root}/{name}")) is not None:
            tables[name] = found
    return Star(root=root, tables=tables)
