"""Streaming ingest: two arrivals of raw files, each ingested once."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from keelson.plans.silver import clean_orders
from keelson.sources.csv_bronze import write_bronze_csv
from keelson.sources.fixtures import bronze_orders, quotes_from_events
from keelson.sources.quotes import latest_quote
from keelson.streaming.ingest import (read_ingested, read_quote_snapshot, run_quote_snapshot,
                                      run_silver_ingest)
from tests.conftest import SF_SMALL

ORDER_DATE = "`order date (DateOrders)`"


def test_silver_ingest_is_incremental(spark):
    d = tempfile.mkdtemp(prefix="keelson-stream-")
    bronze = bronze_orders(spark, SF_SMALL)
    early = F.year(F.col(ORDER_DATE)) < 1998
    first = bronze.filter(early)
    second = bronze.filter(~early | F.col(ORDER_DATE).isNull())
    landing, out, ckpt = f"{d}/landing", f"{d}/silver", f"{d}/ckpt"

    write_bronze_csv(first, landing, stray_blank=False)
    run_silver_ingest(spark, landing, out, ckpt, 4.08)
    assert read_ingested(spark, out).count() == clean_orders(first, 4.08).count()

    # a second arrival lands next to the first; only the new files are read
    write_bronze_csv(second, landing, stray_blank=False, mode="append")
    run_silver_ingest(spark, landing, out, ckpt, 4.08)
    got = read_ingested(spark, out)
    want = clean_orders(bronze, 4.08)
    assert got.count() == want.count()
    total = F.round(F.sum("sales"), 4)
    assert got.select(total).first()[0] == want.select(total).first()[0]
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_quote_snapshot_stream(spark):
    d = tempfile.mkdtemp(prefix="keelson-quotes-")
    quotes = quotes_from_events(spark, SF_SMALL)
    quotes.write.parquet(f"{d}/quotes")
    run_quote_snapshot(spark, f"{d}/quotes", quotes.schema, f"{d}/snap",
                       f"{d}/ckpt")
    got = read_quote_snapshot(spark, f"{d}/snap").select(*latest_quote(quotes).columns).collect()
    want = latest_quote(quotes).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_ingest_matches_columns_by_name(spark, tmp_path):
    """A file with an extra column and one with another column order lose nothing."""
    from keelson.config import RAW_TO_SILVER
    names = [raw for raw, _ in RAW_TO_SILVER]
    values = {n: "" for n in names} | {"Category Name": "Toys", "Order Item Total": "12.5",
                                       "Order Id": "7"}
    landing = tmp_path / "landing"
    landing.mkdir()
    for file, order in (("a.csv", [*names, "Extra"]), ("b.csv", names[::-1])):
        rows = [",".join(order), ",".join(values.get(n, "x") for n in order)]
        (landing / file).write_text("\n".join(rows) + "\n")
    for _ in range(2):
        run_silver_ingest(spark, str(landing), str(tmp_path / "silver"), str(tmp_path / "c"), 1.0)
    got = read_ingested(spark, str(tmp_path / "silver")).collect()
    assert [(r.category, r.sales, r.src_order_id) for r in got] == [("Toys", 12.5, 7)] * 2
