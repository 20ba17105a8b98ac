"""Scalar semantics: casts, date parsing, date parts, number text (FIXTURES §5)."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from keelson.functions.casts import to_double, to_int_half_even, to_timestamp_ntz
from keelson.functions.dates import date_parts
from keelson.functions.numbers import (
    money_fraction, money_sum, money_total, money_value, pct, round_money,
)
from keelson.functions.text import fmt_fixed, fmt_signed


def test_int_cast_rounds_half_even(spark):
    df = spark.createDataFrame([("2.5",), ("3.5",), ("2.7",), ("-2.5",), (None,)], "v string")
    got = [r[0] for r in df.select(to_int_half_even(F.col("v"))).collect()]
    assert got == [2, 4, 3, -2, None]


def test_int_cast_rejects_text(spark):
    df = spark.createDataFrame([("abc",)], "v string")
    with pytest.raises(Exception):
        df.select(to_int_half_even(F.col("v"))).collect()


def test_double_cast_maps_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "v double")
    got = [r[0] for r in df.select(to_double(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [None, 1.5]


def test_timestamp_parse_bad_values_become_null(spark):
    rows = [("1/31/2018 22:56",), ("13/1/2018 10:00",), ("2018-01-05",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(to_timestamp_ntz(F.col("v"), "M/d/yyyy H:mm")).collect()]
    assert got == [dt.datetime(2018, 1, 31, 22, 56), None, None, None]


def test_date_parts_sunday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 3, 10, 0),)], "ts timestamp_ntz")
    row = df.select(*[c.alias(n) for n, c in date_parts(F.col("ts")).items()]).first()
    assert (row.year, row.month, row.day, row.day_of_week, row.quarter) == (2024, 3, 3, 0, 1)


def test_number_text_half_even_and_sign(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-0.04,), (None,)], "v double")
    got = [tuple(r) for r in df.select(fmt_fixed(F.col("v"), 0),
                                       fmt_signed(F.col("v"), 1, "%")).collect()]
    assert got == [("2", "+2.5%"), ("4", "+3.5%"), ("-0", "-0.0%"), ("nan", "nan%")]


def test_pct_never_divides_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(pct(F.col("a"), F.col("b"))).collect()] == [None, 25.0]


def test_round_money_sees_exact_half(spark):
    # 0.1 + 0.2 + 0.005 is 0.30500000000000005 in binary; the exact sum is 0.305.
    df = spark.createDataFrame([(0.1,), (0.2,), (0.005,)], "v double").coalesce(1)
    assert df.agg(round_money(F.sum("v"))).first()[0] == 0.31


def test_timestamp_parse_ignores_session_zone_gaps(spark):
    # 2:30 on 6 April 1997 does not exist in New York (clocks jumped from 2:00 to 3:00)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("4/6/1997 2:30",), ("junk",)], "v string")
        got = [r[0] for r in df.select(to_timestamp_ntz(F.col("v"), "M/d/yyyy H:mm")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(1997, 4, 6, 2, 30), None]


def test_format_ntz_round_trip(spark):
    from keelson.functions.dates import format_ntz
    df = spark.createDataFrame([(dt.datetime(1997, 4, 6, 2, 30),), (None,),
                                (dt.datetime(2018, 1, 31, 22, 5),)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(format_ntz(F.col("ts"), "M/d/yyyy H:mm")).collect()]
    assert got == ["4/6/1997 2:30", None, "1/31/2018 22:05"]
    iso = df.select(format_ntz(F.col("ts"), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert iso == "1997-04-06 02:30:00"


def test_number_text_grouping_only_when_asked(spark):
    df = spark.createDataFrame([(1234.25,)], "v double")
    row = df.select(fmt_fixed(F.col("v"), 1), fmt_fixed(F.col("v"), 1, grouping=False),
                    fmt_signed(F.col("v"), 1)).first()
    assert tuple(row) == ("1,234.2", "1234.2", "+1234.2")


MONEY = {
    "nine": lambda r: [round(r.uniform(-1e6, 1e6), 9) for _ in range(4000)],
    "verdict": lambda r: [314.64004] * 5000 + [0.00004] * 5000,
    "mixed": lambda r: [r.choice([1, -1]) * 10 ** r.uniform(-8, 15) for _ in range(2000)],
    "half": lambda r: [88782.0864, 97904.2086],  # exactly between two doubles
    "cancel": lambda r: [1e16, 1.0, -1e16] * 300 + [0.1] * 10,
    "large": lambda r: [1e17] * 300 + [9e18] * 2000 + [-0.5],
    "negative": lambda r: [-0.1] * 1000 + [-7.0], "zero": lambda r: [0.0, -0.0],
    "inf": lambda r: [1.0, math.inf], "huge": lambda r: [1e300, 5.0], "null": lambda r: [None],
}


def test_money_sums_equal_fsum(spark):
    """Whatever the order, in one step or two: the double nearest to the exact sum."""
    r = random.Random(1)
    cases = {k: f(r) for k, f in MONEY.items()}
    rows = [(k, x) for k, v in cases.items() for x in v]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    direct = {x.k: x for x in df.groupBy("k").agg(
        money_sum("x").alias("s"), money_value(money_sum("x")).alias("v")).collect()}
    staged = {x.k: x.v for x in df.groupBy("k", F.abs(F.hash("x")) % 5).agg(
        money_sum("x").alias("s")).groupBy("k").agg(money_value(money_total("s")).alias("v")).collect()}
    for k, v in cases.items():
        want = None if v == [None] else math.fsum(v)
        assert direct[k].v == want and staged[k] == want, k
        assert float(money_fraction(direct[k].s)) == (want or 0.0), k
    opposite = spark.createDataFrame([(math.inf,), (-math.inf,)], "x double")
    assert math.isnan(opposite.agg(money_value(money_sum("x"))).first()[0])


def test_money_sum_times(spark):
    df = spark.createDataFrame([(0.1, 3), (-2.7, 0), (1e15, 7)], "x double, n long")
    got = df.agg(money_value(money_sum("x", F.col("n")))).first()[0]
    assert got == math.fsum([0.1] * 3 + [1e15] * 7)
