"""Bronze -> silver: project, rename, cast, fill and keep the valid rows.

All steps are one narrow projection + filter; Catalyst fuses them into the scan's
whole-stage-codegen span and no shuffle happens. Works for a typed bronze frame (the
derived view) and for an all-text one (the CSV reader).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.config import (DEFAULT_CLEAN, DOUBLE_COLUMNS, INT_COLUMNS, LONG_COLUMNS,
                            RAW_TO_SILVER, SILVER_COLUMNS, TS_COLUMNS, CleanConfig)
from keelson.functions.casts import to_double, to_int_half_even, to_timestamp_ntz
from keelson.sources.csv_bronze import OVERLONG


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def typed_orders(bronze: DataFrame, oil_price: float | Column = 0.0,
                 cfg: CleanConfig = DEFAULT_CLEAN, also: tuple[str, ...] = ()) -> DataFrame:
    """Rename and cast the raw columns; no fill, no filter (input of the quality audit).
    Columns named in ``also`` stay as they are."""
    bronze = trim_headers(bronze)
    types = {f.name: f.dataType for f in bronze.schema.fields}
    out: list[Column] = []
    for raw, name in RAW_TO_SILVER:
        c, t = F.col(f"`{raw}`"), types[raw]
        if name in INT_COLUMNS:
            e = to_int_half_even(c, t)
        elif name in DOUBLE_COLUMNS:
            e = to_double(c, t)
        elif name in TS_COLUMNS:
            e = to_timestamp_ntz(c, cfg.ts_format, t)
        elif name in LONG_COLUMNS:
            e = c.cast("long")
        else:
            e = c.cast("string")
        out.append(e.alias(name))
    price = oil_price if isinstance(oil_price, Column) else F.lit(float(oil_price))
    out.append(price.cast("double").alias("oil_price"))
    return bronze.select(*out, *also).select(*SILVER_COLUMNS, *also)


def fill_orders(typed: DataFrame, cfg: CleanConfig = DEFAULT_CLEAN) -> DataFrame:
    """Fill the critical text columns and the day counts (F8)."""
    return typed.na.fill({
        "category": cfg.fill_category,
        "product": cfg.fill_product,
        "cust_country": cfg.fill_country,
        "cust_state": cfg.fill_state,
    }).na.fill(cfg.fill_days, subset=list(INT_COLUMNS))


def _valid() -> Column:
    return F.col("sales") >= 0


def keep_valid(df: DataFrame) -> DataFrame:
    """Survival filter: ``sales >= 0``; NULL (and former NaN) sales are dropped (P5)."""
    return df.filter(_valid())


#: Columns of the stored lines beside silver's: the fills that were made, one bit for each column
#: of ``FILL_COLUMNS``, and whether silver holds the line (the partition column).
FILLED, KEPT = "filled", "kept"
FILL_COLUMNS = ("category", "product", "cust_country", "cust_state", *INT_COLUMNS)


def stored_orders(bronze: DataFrame, oil_price: float | Column = 0.0,
                  cfg: CleanConfig = DEFAULT_CLEAN) -> DataFrame:
    """Every order line once: as silver has it, with what ``typed_stored`` needs to give it back
    as it was, and the lines that silver leaves out. Raw lines that ``bronze`` marks as over-long
    stay marked; they are in neither table."""
    if OVERLONG not in bronze.columns:
        bronze = bronze.withColumn(OVERLONG, F.lit(False))
    typed = typed_orders(bronze, oil_price, cfg, (OVERLONG,))
    gaps = [F.when(F.col(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0))
            for k, c in enumerate(FILL_COLUMNS)]
    filled = fill_orders(typed.withColumn(FILLED, reduce(lambda a, b: a + b, gaps)), cfg)
    kept = F.coalesce(_valid() & ~F.col(OVERLONG), F.lit(False))
    return filled.withColumn(KEPT, kept.cast("int"))


def silver_stored(stored: DataFrame) -> DataFrame:
    """The silver table of the stored lines."""
    return stored.filter(F.col(KEPT) == 1).select(*SILVER_COLUMNS)


def typed_stored(stored: DataFrame) -> DataFrame:
    """The typed bronze table of the stored lines: without fills, before the filter."""
    bits = {c: 1 << k for k, c in enumerate(FILL_COLUMNS)}
    return stored.filter(~F.col(OVERLONG)).select(*[
        F.when(F.col(FILLED).bitwiseAND(bits[c]) == 0, F.col(c)).alias(c) if c in bits else c
        for c in SILVER_COLUMNS])


def clean_orders(bronze: DataFrame, oil_price: float | Column = 0.0,
                 cfg: CleanConfig = DEFAULT_CLEAN) -> DataFrame:
    """The silver table: 23 typed columns, filled, invalid sales removed."""
    return keep_valid(fill_orders(typed_orders(bronze, oil_price, cfg), cfg))
