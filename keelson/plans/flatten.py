"""Star -> one analysis frame.

The fact keeps all its columns; each available dimension adds its descriptive columns
through a LEFT JOIN on the surrogate id, so facts with a NULL id stay (with NULL
attributes). Dimensions are optional, as in the reference, which joins only those whose
files exist; consumers check column presence.

The time dimension only contributes year and month. Its key *is* the order timestamp
and it holds every non-NULL fact timestamp (checked by the audit's orphan count), so the
two parts are derived from the fact's own timestamp instead of shuffling the fact
against a minute-grain table: same values, no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.config import ALL_DIMS, DEFAULT_STAR, Dims, StarConfig
from keelson.operators.joins import bounded_left_join
from keelson.plans.star import FACT_COLUMNS, Star

DIM_ATTRS = {
    "product": ("dim_product", "product_id", ("category", "product")),
    "customer_geo": ("dim_customer_geo", "customer_geo_id",
                     ("cust_city", "cust_state", "cust_country")),
    "logistics": ("dim_logistics", "logistics_id", ("delivery_status", "ship_mode")),
}


def attach_dims(df: DataFrame, star: Star, names: list[str],
                cfg: StarConfig = DEFAULT_STAR) -> tuple[DataFrame, list[str]]:
    """``df``, which carries the surrogate ids, with the attributes of the named dimensions
    that the star has; also the added columns."""
    added: list[str] = []
    for name in names:
        table, key, attrs = DIM_ATTRS[name]
        if table not in star.tables:
            continue
        dkey = f"_{name}_id"
        d = star[table].select(F.col(key).alias(dkey), *attrs)
        df = bounded_left_join(df, d, [key], [dkey], cfg.broadcast_bytes).drop(dkey)
        added += attrs
    return df, added


def flatten_star(star: Star, dims: Dims = ALL_DIMS, cfg: StarConfig = DEFAULT_STAR) -> DataFrame:
    df = star["fact_sales"].select(*FACT_COLUMNS)
    named = dims.names()
    df, added = attach_dims(df, star, [n for n in named if n != "time"], cfg)
    parts = []
    if "time" in named and "dim_time" in star.tables:
        parts = [F.year("full_date").cast("bigint").alias("year"),
                 F.month("full_date").cast("bigint").alias("month")]
    cols = [F.col(c).alias("oil_price" if c == "daily_oil_price" else c) for c in FACT_COLUMNS]
    return df.select(*cols, *added, *parts)


def by_ids(star: Star, names: list[str], sums: dict[str, Column],
           cfg: StarConfig = DEFAULT_STAR) -> DataFrame:
    """``sums`` of the fact per surrogate id of the named dimensions, with their attributes.

    The fact is aggregated before any join: what meets a dimension is one row for each
    combination of ids, not one for each order line.
    """
    keys = [DIM_ATTRS[n][1] for n in names]
    fact = star["fact_sales"].groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()])
    return attach_dims(fact, star, names, cfg)[0]
