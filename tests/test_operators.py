"""Distributed order operators against brute force, including a hot key."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.operators.ordered import dense_ids, prefix_weights, weighted_split_sum
from keelson.plans.kpi import half_split


def test_dense_ids_equal_row_number(spark):
    rng = random.Random(7)
    keys = {(rng.choice(["a", "b", None, "c"]), rng.randint(0, 300)) for _ in range(900)}
    df = spark.createDataFrame(sorted(keys, key=str), "k1 string, k2 int").repartition(5)
    got = dense_ids(df, [F.col("k1").asc_nulls_last(), F.col("k2").asc_nulls_last()], "id")
    got = sorted((r.id, r.k1, r.k2) for r in got.collect())
    want = sorted(keys, key=lambda t: ((t[0] is None, t[0] or ""), t[1]))
    assert [(k1, k2) for _, k1, k2 in got] == want
    assert [i for i, _, _ in got] == list(range(1, len(keys) + 1))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 5)), min_size=1, max_size=60,
                unique_by=lambda t: t[0]),
       st.integers(0, 400))
def test_weighted_split_sum_matches_expansion(spark, rows, k):
    df = spark.createDataFrame(rows, "v int, w int").withColumn("v", F.col("v").cast("double"))
    got = weighted_split_sum(df, [F.col("v").asc()], "w", "v", F.lit(k), partitions=3).first()
    units = sorted(v for v, w in rows for _ in range(w))
    assert got["head_value"] == sum(units[:k])
    assert got["total_value"] == sum(units)


def test_prefix_weights_offsets(spark):
    df = spark.createDataFrame([(i, i % 3 + 1) for i in range(50)], "k int, w int")
    got = {r.k: r.before for r in prefix_weights(df, [F.col("k")], F.col("w"), "before",
                                                 partitions=4).collect()}
    run = 0
    for i in range(50):
        assert got[i] == run
        run += i % 3 + 1


def _brute_half(pdf: pd.DataFrame) -> tuple[float, float]:
    s = pdf.sort_values(["full_date", "sales"], na_position="last")
    k = len(s) // 2
    return float(s.iloc[:k]["sales"].sum()), float(s.iloc[k:]["sales"].sum())


def test_half_split_with_hot_timestamp(spark):
    rng = random.Random(3)
    hot = dt.datetime(2020, 5, 1, 12, 0)
    rows = []
    for i in range(3000):
        if i % 3 == 0:  # a third of all rows on one timestamp
            ts = hot
        elif i % 97 == 0:
            ts = None
        else:
            ts = dt.datetime(2020, 1, 1) + dt.timedelta(minutes=rng.randint(0, 400000))
        rows.append((ts, float(rng.randint(0, 5000)) / 4))
    df = spark.createDataFrame(rows, "full_date timestamp_ntz, sales double").repartition(6)
    first, second = half_split(df)
    want = _brute_half(pd.DataFrame(rows, columns=["full_date", "sales"]))
    assert abs(first - want[0]) < 1e-6 and abs(second - want[1]) < 1e-6


def test_half_split_odd_count_and_null_last(spark):
    rows = [(None, 100.0), (dt.datetime(2020, 1, 2), 2.0), (dt.datetime(2020, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "full_date timestamp_ntz, sales double")
    assert half_split(df) == (1.0, 102.0)


def test_asof_join_matches_brute_force(spark):
    from keelson.operators.asof import asof_join
    rng = random.Random(11)
    base = dt.datetime(2021, 1, 1)
    quotes = [(g, base + dt.timedelta(days=rng.randint(5, 300)), float(i))
              for i, g in enumerate(rng.choice("xy") for _ in range(40))]
    quotes = list({(g, t): (g, t, v) for g, t, v in quotes}.values())
    left = [(rng.choice("xyz"), base + dt.timedelta(days=rng.randint(0, 330)), i) for i in range(300)]
    left += [(g, t, 1000 + i) for i, (g, t, _) in enumerate(quotes[:5])]  # exact-time hits
    ldf = spark.createDataFrame(left, "g string, t timestamp_ntz, id int")
    rdf = spark.createDataFrame(quotes, "g string, qt timestamp_ntz, v double")
    got = {r.id: (r.match_time, r.v) for r in
           asof_join(ldf, rdf, "t", "qt", ["v"], by=["g"]).collect()}
    for g, t, i in left:
        cands = [(qt, v) for qg, qt, v in quotes if qg == g and qt <= t]
        want = max(cands) if cands else (None, None)
        assert got[i] == want, (g, t, i)


def test_asof_join_right_unit_reduction(spark):
    from keelson.operators.asof import asof_join
    base = dt.datetime(2022, 3, 1)
    # many quotes inside single days; left times are day starts
    quotes = [(base + dt.timedelta(days=d, minutes=m), float(d * 1000 + m))
              for d in (0, 2, 5) for m in range(0, 1440, 37)]
    left = [(base + dt.timedelta(days=d), d) for d in range(8)]
    ldf = spark.createDataFrame(left, "t timestamp_ntz, id int")
    rdf = spark.createDataFrame(quotes, "qt timestamp_ntz, v double")
    got = {r.id: r.v for r in asof_join(ldf, rdf, "t", "qt", ["v"], right_unit="day").collect()}
    for t, i in left:
        cands = [(qt, v) for qt, v in quotes if qt <= t]
        assert got[i] == (max(cands)[1] if cands else None)


def test_hot_key_left_join_equals_left_join(spark, tmp_path):
    from collections import Counter

    from keelson.operators.joins import hot_key_left_join
    rows = [("h" if i % 3 == 0 else "gone" if i % 4 == 0 else
             (None if i % 13 == 0 else f"k{i % 50}"), i) for i in range(5000)]
    spark.createDataFrame(rows, "k string, v int").write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    right = spark.createDataFrame([(f"k{i}", i) for i in range(40)] + [("h", -1), ("h", -2)],
                                  "rk string, id int")
    joined = hot_key_left_join(left, right, ["k"], ["rk"], hot_share=0.05, sample=0.2)
    got = Counter(tuple(r) for r in joined.select("k", "v", "rk", "id").collect())
    want = Counter(tuple(r) for r in left.join(right, left.k == right.rk, "left").collect())
    assert got == want
    # besides the sample of the keys (in the broadcast and its total), ``left`` is read once
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sample") == plan.count("parquet") - 1


def test_hot_key_leaves_no_large_partition(spark, tmp_path):
    """A key with a third of the rows, and NULL keys with a fifth, go to all tasks evenly."""
    from keelson.operators.joins import hot_key_left_join
    n, parts = 120_000, 8
    k = (F.when(F.col("id") % 3 == 0, "h").when(F.col("id") % 5 == 1, F.lit(None))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))))
    spark.range(n).select(k.alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "l"))
    spark.range(5000).select(F.concat(F.lit("k"), "id").alias("rk"), "id").unionByName(
        spark.range(1).select(F.lit("h").alias("rk"), F.lit(-1).alias("id"))).write.parquet(
        str(tmp_path / "r"))
    before = {c: spark.conf.get(c) for c in (
        "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(before, ("false", "-1")):
            spark.conf.set(c, v)
        joined = hot_key_left_join(spark.read.parquet(str(tmp_path / "l")),
                                   spark.read.parquet(str(tmp_path / "r")), ["k"], ["rk"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert sum("salt" in x.split("ENSURE")[0] and "k#" in x for x in exchanges) == 2, plan
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(sizes) == n and len(sizes) == parts
    assert max(sizes) < 2 * n / parts


def test_asof_join_with_a_hot_month(spark):
    """A third of the quotes within one month, one hot key, no unit: the scan's ranges stay
    even, and bursts at one time and NULL times and keys are defined."""
    from keelson.operators import ordered
    from keelson.operators.asof import asof_join, asof_mapping
    rng = random.Random(23)
    base = dt.datetime(2021, 1, 1)
    when = lambda k: base + (dt.timedelta(days=150, minutes=k) if k % 3 == 0
                             else dt.timedelta(minutes=rng.randint(0, 500_000)))
    quotes = [("x" if k % 10 else "y", when(k), float(k)) for k in range(9000)]
    quotes += [("x", base, float(k)) for k in range(500)] + [(None, base, 1.0), ("x", None, 2.0)]
    left = [(rng.choice("xyz"), base + dt.timedelta(minutes=rng.randint(-500, 510_000)), i)
            for i in range(3000)] + [(None, base, 9001), ("x", None, 9002), ("x", base, 9003)]
    ldf = spark.createDataFrame(left, "g string, t timestamp_ntz, id int").repartition(5)
    rdf = spark.createDataFrame(quotes, "g string, qt timestamp_ntz, v double").repartition(5)
    sizes, layout = [], ordered.range_layout

    def watched(df, order, partitions=None):
        laid = layout(df, order, partitions)
        sizes.extend(r[1] for r in laid.groupBy("_kp_part").count().collect())
        return laid

    ordered.range_layout = watched
    try:
        asof_mapping(ldf, rdf, "t", "qt", ["v"], by=["g"], partitions=16).count()
    finally:
        ordered.range_layout = layout
    assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16
    import bisect
    of = {}
    for g, t, v in sorted(q for q in quotes if q[0] and q[1]):
        of.setdefault(g, []).append((t, v))
    for limit in (64 << 20, 0):  # broadcast, and the join beyond the bound
        got = {r.id: (r.match_time, r.v) for r in asof_join(
            ldf, rdf, "t", "qt", ["v"], by=["g"], broadcast_bytes=limit).collect()}
        assert len(got) == len(left)
        for g, t, i in left:
            rows = of.get(g, []) if t else []
            at = bisect.bisect_right(rows, (t, float("inf"))) if rows else 0
            assert got[i] == (rows[at - 1] if at else (None, None)), (g, t, i)


def test_half_split_by_selection(spark, monkeypatch):
    """Steps down to single microseconds, dates before 1970, many values of one timestamp,
    halves that end at a bucket's edge, NULL dates and revenues."""
    from keelson.plans import kpi
    rng = random.Random(3)
    base = dt.datetime(1965, 5, 1)
    monkeypatch.setattr(kpi, "SPLIT_BUCKETS", 7)
    cases = {
        "wide": [(base + dt.timedelta(microseconds=rng.randrange(10 ** 15)), rng.random()) for _ in range(301)],
        "close": [(base + dt.timedelta(microseconds=rng.randrange(40)), float(rng.randrange(9))) for _ in range(300)],
        "one": [(base, rng.random()) for _ in range(99)], "none": [(None, rng.random()) for _ in range(9)],
        "mixed": [(rng.choice([None, base, base + dt.timedelta(days=9000)]),
                   rng.choice([None, 1.5, 2.25])) for _ in range(200)],
        "edge": [(base, 1.0)] * 5 + [(base + dt.timedelta(days=1), 2.0)] * 5, "single": [(base, 3.0)]}
    for many in (50_000, 3):
        monkeypatch.setattr(kpi, "SPLIT_VALUES", many)
        for name, rows in cases.items():
            df = spark.createDataFrame(rows, "full_date timestamp_ntz, sales double").repartition(3)
            order = sorted(rows, key=lambda r: (r[0] is None, r[0] or base, r[1] is not None, r[1] or 0))
            cut = [sum(x or 0 for _, x in part) for part in (order[:len(rows) // 2], order[len(rows) // 2:])]
            assert half_split(df) == (pytest.approx(cut[0], abs=1e-9), pytest.approx(cut[1], abs=1e-9)), name
    assert half_split(spark.createDataFrame([], "full_date timestamp_ntz, sales double")) == (0.0, 0.0)
