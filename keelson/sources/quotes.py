"""Price quotes: the latest quote per indicator and the constant price of a run.

The reference fetches the last close of a market indicator and stamps it, rounded to
two decimals, on every order line (0.0 when no quote is available). Here quotes are a
landed table ``(quote_id, quote_ts, indicator, price, currency, source)``; the latest one
is picked with ``max_by`` — a map-side-combined aggregate, no sort of the quote table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.numbers import round_money
from keelson.sources.tables import read_if_present


def _recency(df: DataFrame) -> Column:
    # Latest time first; among equal times the smallest quote id wins.
    return F.struct(F.col("quote_ts"), -F.col("quote_id"))


def latest_rows(quotes: DataFrame) -> DataFrame:
    """One row per indicator: the most recent quote, with its id."""
    r = _recency(quotes)
    return quotes.groupBy("indicator").agg(
        *[F.max_by(c, r).alias(c) for c in ("quote_id", "quote_ts", "price", "currency", "source")])


def latest_quote(quotes: DataFrame) -> DataFrame:
    """One row per indicator: the most recent quote."""
    return latest_rows(quotes).drop("quote_id")


def oil_price_frame(quotes: DataFrame, default: float = 0.0) -> DataFrame:
    """One row, ``oil_price``: latest quote over the table rounded to 2, or ``default``."""
    r = _recency(quotes)
    return quotes.agg(
        F.coalesce(round_money(F.max_by("price", r)), F.lit(float(default)))
        .cast("double").alias("oil_price"))


def oil_price_value(quotes: DataFrame | None, default: float = 0.0) -> float:
    """The constant as a Python float (a one-row aggregate brought to the driver)."""
    if quotes is None:
        return float(default)
    return float(oil_price_frame(quotes, default).first()["oil_price"])


#: What makes a quote the same quote.
QUOTE_KEY = ("indicator", "quote_ts", "quote_id")


def append_snapshot(latest: DataFrame, path: str) -> bool:
    """Add the latest quotes to a quote table: those whose ``QUOTE_KEY`` (NULLs are equal) it
    does not hold yet, so a batch that is landed again adds nothing. True if any were added.
    """
    known = read_if_present(latest.sparkSession, path)
    keys = [k for k in QUOTE_KEY if k in latest.columns]
    new = latest.dropDuplicates(keys)
    if known is not None:
        old = known.select(*[F.col(k).alias(f"_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        new = new.join(old, reduce(lambda a, b: a & b, same), "left_anti")
    if new.isEmpty():
        return False
    new.write.mode("append").parquet(path)
    return True


def land_quotes(spark: SparkSession, batch_path: str | None, table_path: str) -> DataFrame | None:
    """Land a batch's latest quotes in the quote table and return the table.

    Landing is idempotent (``append_snapshot``). An absent or empty batch writes nothing; None when there is no table either, and the
    run's price is then the default.
    """
    batch = read_if_present(spark, batch_path) if batch_path else None
    if batch is not None:
        append_snapshot(latest_rows(batch), table_path)
    return read_if_present(spark, table_path)
