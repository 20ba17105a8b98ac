"""Plan-level semantics on tiny literal frames (FIXTURES §5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from keelson.config import Dims, StarConfig
from keelson.plans.job import gold
from keelson.plans.insights import insights, prompt_context
from keelson.plans.kpi import kpi_summary
from keelson.plans.marts import category_mart
from keelson.plans.quality import quality_report
from keelson.plans.rankings import best_ticket_category, lowest_margin_categories
from keelson.plans.reports import status_counts
from keelson.plans.silver import fill_orders, keep_valid
from keelson.plans.star import Star, dim_customer_geo, dim_logistics, dim_product, fact_sales
from keelson.plans.flatten import flatten_star
from tests.conftest import SF_SMALL

FLAT = ("full_date timestamp_ntz, sales double, profit double, oil_price double, "
        "delivery_status string, category string, cust_city string, ship_mode string")


def _flat(spark, rows):
    return spark.createDataFrame(rows, FLAT)


def _kpi(spark, rows):
    return kpi_summary(_flat(spark, rows)).first()


def test_late_rate_counts_null_status_as_not_late(spark):
    t = dt.datetime(2020, 1, 1)
    k = _kpi(spark, [(t, 1.0, 0.1, 5.0, "Late delivery", "A", "x", "m"),
                     (t, 1.0, 0.1, 5.0, None, "A", "x", "m")])
    assert k.late_rate == 50.0 and k.on_time_rate == 50.0


def test_single_row_std_is_null_and_no_volatility_insight(spark):
    k = kpi_summary(_flat(spark, [(dt.datetime(2020, 1, 1), 10.0, 2.0, 80.0, "Late delivery",
                                   "A", "x", "m")]))
    assert k.first().oil_std is None
    titles = [r.title for r in insights(k).collect()]
    assert not any(t.startswith("Oil price deviation") for t in titles)


def test_best_and_worst_category_ties_go_to_first_key(spark):
    t = dt.datetime(2020, 1, 1)
    k = _kpi(spark, [(t, 5.0, 1.0, 1.0, "x", "B", "c", "m"), (t, 5.0, 1.0, 1.0, "x", "A", "c", "m")])
    assert (k.top_category, k.worst_category) == ("A", "A")


def test_zero_sales_margin_is_null_and_last(spark):
    t = dt.datetime(2020, 1, 1)
    f = _flat(spark, [(t, 0.0, 1.0, 1.0, "x", "Z", "c", "m"), (t, 10.0, -1.0, 1.0, "x", "B", "c", "m"),
                      (t, 10.0, 1.0, 1.0, "x", "C", "c", "m")])
    mart = category_mart(f)
    got = [(r.category, r.margin_pct) for r in lowest_margin_categories(mart).collect()]
    assert got == [("B", -10.0), ("C", 10.0), ("Z", None)]
    assert best_ticket_category(mart).first().category in ("B", "C")


def _insight_titles(spark, margin, late, std):
    kpi = spark.createDataFrame([(margin, late, std)], "margin_pct double, late_rate double, oil_std double")
    return [(r.position, r.severity) for r in insights(kpi).orderBy("position").collect()]


def test_insight_thresholds(spark):
    assert _insight_titles(spark, 15.0, 5.0, 10.0) == [(1, "warning")]
    assert _insight_titles(spark, 15.1, 4.9, 10.1) == [(1, "success"), (2, "success"), (3, "warning")]
    assert _insight_titles(spark, 15.0, 10.0, None) == [(1, "warning")]
    assert _insight_titles(spark, 15.0, 10.1, 0.0) == [(1, "warning"), (2, "danger")]


SILVER = ("category string, product string, cust_city string, cust_state string, "
          "cust_country string, delivery_status string, ship_mode string, ship_days_real int, "
          "ship_days_sched int, order_ts timestamp_ntz, sales double, profit double, "
          "sales_per_customer double, oil_price double")


def _star(spark, rows, geo_keys=3):
    s = spark.createDataFrame(rows, SILVER)
    p, g, lg = dim_product(s), dim_customer_geo(s), dim_logistics(s)
    f = fact_sales(s, p, g, lg, StarConfig(geo_keys=geo_keys))
    return s, Star(root="", tables={"dim_product": p, "dim_customer_geo": g, "dim_logistics": lg,
                                    "fact_sales": f})


def test_geo_fan_out_only_with_two_keys(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [("A", "p", "city", "st", "C1", "Late delivery", "m", 1, 2, t, 1.0, 0.0, 1.0, 1.0),
            ("A", "p", "city", "st", "C2", "Late delivery", "m", 1, 2, t, 2.0, 0.0, 1.0, 1.0),
            ("A", "p", "city", "st", "C1", "Late delivery", "m", 1, 2, t, 3.0, 0.0, 1.0, 1.0)]
    assert _star(spark, rows, 3)[1]["fact_sales"].count() == 3
    # every row matches the (city, state) of both countries
    assert _star(spark, rows, 2)[1]["fact_sales"].count() == 6


def test_logistics_mean_is_over_distinct_pairs(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [("A", "p", "c", "s", "k", "Late delivery", "m", r, d, t, 1.0, 0.0, 1.0, 1.0)
            for r, d in ((1, 2), (1, 2), (4, 2))]
    d = dim_logistics(spark.createDataFrame(rows, SILVER)).first()
    assert d.avg_ship_days_real == 2.5 and d.logistics_id == 1


def test_null_status_kept_by_flatten_dropped_by_status_counts(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [("A", "p", "c", "s", "k", None, "m", 1, 2, t, 1.0, 0.0, 1.0, 1.0),
            ("A", "p", "c", "s", "k", "Late delivery", "m", 1, 2, t, 1.0, 0.0, 1.0, 1.0)]
    _, star = _star(spark, rows)
    assert flatten_star(star, Dims(time=False)).count() == 2
    got = [(r.delivery_status, r.total) for r in
           status_counts(star["fact_sales"], star["dim_logistics"]).collect()]
    assert got == [("Late delivery", 1)]


def test_missing_dimensions_use_defaults(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [("A", "p", "c", "s", "k", "Late delivery", "m", 1, 2, t, 4.0, 1.0, 1.0, 1.0)]
    _, star = _star(spark, rows)
    k = kpi_summary(flatten_star(star, Dims(logistics=False, customer_geo=False))).first()
    assert (k.late_rate, k.on_time_rate) == (0.0, 100.0)
    ctx = {(r.section, r.label): r.value for r in prompt_context(
        kpi_summary(flatten_star(star, Dims(product=False, logistics=False)))).collect()}
    assert ctx[("executive", "Top category")] == "N/A"


def test_quality_rules_and_survival_filter(spark):
    t_future = dt.datetime(2030, 1, 1)
    rows = [("A", -1.0, 1, None), (None, None, 1, None), ("B", float("nan"), -1, t_future),
            ("C", 0.0, 0, None)]
    df = spark.createDataFrame(rows, "category string, sales double, ship_days_real int, "
                                     "order_ts timestamp_ntz")
    df = df.withColumn("sales", F.when(~F.isnan("sales"), F.col("sales")))
    got = {r.rule: r.violations for r in quality_report(df, "2025-01-01").collect()}
    assert got == {"future_order_date": 1, "negative_sales": 1, "negative_ship_days": 1,
                   "missing_category": 1}
    kept = keep_valid(df).collect()
    assert [r.category for r in kept] == ["C"]


def test_fill_values(spark):
    schema = ("category string, product string, cust_country string, cust_state string, "
              "ship_days_real int, ship_days_sched int")
    r = fill_orders(spark.createDataFrame([(None,) * 6], schema)).first()
    assert tuple(r) == ("UNCATEGORIZED", "UNKNOWN", "UNKNOWN", "N/A", 0, 0)


def test_empty_inputs_raise(spark, tmp_path):
    import pytest

    from keelson.plans.job import build_gold
    from keelson.sources.fixtures import bronze_orders
    with pytest.raises(ValueError):
        kpi_summary(_flat(spark, []))
    with pytest.raises(ValueError, match="silver is empty"):
        build_gold(spark, bronze_orders(spark, SF_SMALL).limit(0), None, str(tmp_path / "g"))


def test_distinct_counts_exact_and_approx(spark):
    from keelson.plans.kpi import distinct_counts
    t = dt.datetime(2020, 1, 1)
    f = _flat(spark, [(t, 1.0, 0.0, 1.0, "x", c, city, "m")
                      for c, city in (("A", "p"), ("B", "p"), ("B", None))])
    exact = distinct_counts(f).first()
    assert (exact.rows, exact.n_category, exact.n_cust_city) == (3, 2, 1)
    approx = distinct_counts(f, approx=True).first()
    assert (approx.n_category, approx.n_cust_city) == (2, 1)


def test_fact_join_with_hot_key_without_broadcast(spark):
    """A third of the rows on one product; dims joined by sort-merge with AQE skew split."""
    t = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(3000):
        prod = "hot" if i % 3 == 0 else f"p{i % 200}"
        rows.append(("A" if i % 2 else "B", prod, f"c{i % 7}", "s", "k",
                     "Late delivery" if i % 5 else None, "m", i % 4, 2, t, float(i), 1.0, 1.0, 1.0))
    s = spark.createDataFrame(rows, SILVER).repartition(8)
    p, g, lg = dim_product(s), dim_customer_geo(s), dim_logistics(s)
    from collections import Counter
    want = Counter(tuple(r) for r in fact_sales(s, p, g, lg).collect())
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = fact_sales(s, p, g, lg, StarConfig(broadcast_bytes=0))
        got = Counter(tuple(r) for r in joined.collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want and sum(got.values()) == 3000


def test_date_filter_prunes_partitions(spark):
    """The fact is stored by year: a date filter reads the folders of its years only."""
    from keelson.plans.star import FACT_YEAR, since
    star = gold(spark, SF_SMALL).star
    late = since(star, "1998-03-01 00:00:00")
    plan = flatten_star(late)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x and FACT_YEAR in x)
    assert f"({FACT_YEAR}#" in scan.split("PartitionFilters:")[1] and ">= 1998)" in scan
    assert "GreaterThanOrEqual(full_date" in scan
    files = lambda df: {f.split(f"{FACT_YEAR}=")[1].split("/")[0] for f in df.inputFiles()}
    assert len(files(star["fact_sales"])) > len([y for y in files(star["fact_sales"])
                                                if y.isdigit() and int(y) >= 1998]) > 0
    rows = star["fact_sales"].collect()
    want = [r for r in rows if r.full_date is not None and str(r.full_date) >= "1998-03-01"]
    assert late["fact_sales"].count() == len(want)
    assert all((r.full_date.year if r.full_date else None) == r[FACT_YEAR] for r in rows)


def test_a_year_with_most_rows_is_spread(spark):
    from keelson.plans.star import FACT_COLUMNS, by_year
    rows = spark.range(40_000).select(F.col("id").alias("product_id"), F.when(
        F.col("id") % 10 > 0, F.lit("2001-05-01").cast("timestamp_ntz")).alias("full_date"))
    import keelson.plans.star as star
    before, star.FACT_FILE_ROWS = star.FACT_FILE_ROWS, 1000
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = [r[1] for r in by_year(rows, 40_000).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        star.FACT_FILE_ROWS = before
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 2 * 40_000 / 8 and FACT_COLUMNS
