"""Sources: the raw CSV edge file (FIXTURES §4) and the quote table."""

from __future__ import annotations

import datetime as dt
import tempfile

from keelson.sources.csv_bronze import land_bronze_csv, read_bronze_csv
from keelson.sources.quotes import latest_quote, oil_price_value

EDGE = (b'A ,B,C\n1,x,1\n2,y,2,z\n3,w\n4,NA,4\n5,q,5,\n6,r,6,,\n7,caf\xe9,7\n8,a,8,b,c\n'
        b'9,"a,b",1\n')


def test_csv_edge_lines(spark):
    d = tempfile.mkdtemp(prefix="keelson-csv-")
    with open(f"{d}/edge.csv", "wb") as fh:
        fh.write(EDGE)
    df = read_bronze_csv(spark, f"{d}/edge.csv")
    assert df.columns == ["A", "B", "C"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", "x", "1"), ("3", "w", None), ("4", None, "4"), ("7", "café", "7"),
                   ("9", "a,b", "1")]
    landed = land_bronze_csv(spark, f"{d}/edge.csv", f"{d}/landed")
    assert landed.count() == 5
    assert landed.select("A").count() == 5


def test_latest_quote_and_default_price(spark):
    t = dt.datetime(2024, 1, 1)
    q = spark.createDataFrame(
        [(1, t, "BRENT", 80.123, "USD", "x"), (2, t, "BRENT", 81.0, "USD", "y"),
         (3, dt.datetime(2023, 1, 1), "BRENT", 70.0, "USD", "z")],
        "quote_id long, quote_ts timestamp_ntz, indicator string, price double, "
        "currency string, source string")
    assert latest_quote(q).first().source == "x"
    assert oil_price_value(q) == 80.12
    assert oil_price_value(q.limit(0)) == 0.0
    assert oil_price_value(None) == 0.0


def test_append_snapshot_skips_empty_batch(spark):
    from keelson.sources.quotes import append_snapshot
    d = tempfile.mkdtemp(prefix="keelson-snap-")
    q = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "BRENT", 80.0, "USD", "x")],
                              "quote_id long, quote_ts timestamp_ntz, indicator string, "
                              "price double, currency string, source string")
    assert append_snapshot(latest_quote(q), f"{d}/t") is True
    assert append_snapshot(latest_quote(q.limit(0)), f"{d}/t") is False
    assert spark.read.parquet(f"{d}/t").count() == 1


def _csv(spark, tmp_path, files: dict[str, str], **options):
    folder = tmp_path / "csv"
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_bytes(text.encode("latin-1"))
    return read_bronze_csv(spark, str(folder), **options)


def test_csv_standard_quoting(spark, tmp_path):
    got = _csv(spark, tmp_path, {"a.csv": (
        'a,b,c\n1,"say ""hi"", ok",x\n5,"end\\",v\n6,"",w\n7,plain"quote,"a,""b"",c"\n'
        '8,"x","y","z"\n9,"a ""q"", b"\n')})
    assert sorted(tuple(r) for r in got.collect()) == [
        ("1", 'say "hi", ok', "x"), ("5", "end\\", "v"), ("6", None, "w"),
        ("7", 'plain"quote', 'a,"b",c'), ("9", 'a "q", b', None)]


def test_csv_long_quoted_field_in_a_malformed_line(spark, tmp_path):
    long = '"' + 'x,""' * 25_000 + '"'
    got = _csv(spark, tmp_path, {"a.csv": f"a,b\n1,{long},extra\n2,{long}\n3\n"}).collect()
    assert sorted((r.a, len(r.b or "")) for r in got) == [("2", 75_000), ("3", 0)]


def test_csv_multi_line_records(spark, tmp_path):
    got = _csv(spark, tmp_path, {"a.csv": 'a,b,c\n1,"two\nlines",x\n2,"p\nq",y,z\n3,s\n'},
               multi_line=True)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "two\nlines", "x"), ("3", "s", None)]


def test_csv_columns_by_name(spark, tmp_path):
    got = _csv(spark, tmp_path, {"a.csv": "a,b \n1,x\n", "b.csv": "b,a\ny,2\n",
                                 "c.csv": "c,a,b\nnew,3,z\n", "d.csv": ""})
    assert sorted((r.a, r.b, r.c or "") for r in got.collect()) == [
        ("1", "x", ""), ("2", "y", ""), ("3", "z", "new")]


def test_csv_round_trip_of_quotes(spark, tmp_path):
    from keelson.sources.csv_bronze import dropped_lines, write_bronze_csv
    rows = [("1", 'say "hi", ok'), ("2", "back\\"), ("3", "a,b")]
    df = spark.createDataFrame(rows, "a string, b string")
    write_bronze_csv(df, str(tmp_path / "w"))
    landed = land_bronze_csv(spark, str(tmp_path / "w"), str(tmp_path / "l"))
    assert sorted(map(tuple, landed.collect())) == rows
    assert dropped_lines(spark, str(tmp_path / "l")).count() == 0


def _jobs(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_cost_a_handful_of_jobs(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    heads = ("a,b,c", "c,a,b", "b,a")
    for k in range(600):
        head = heads[k % 3]
        value = {"a": f"x{k}", "b": f"y{k}", "c": f"z{k}"}
        lines = [head, ",".join(value[h] for h in head.split(","))]
        (folder / f"f {k}.csv").write_text(("\n" if k % 7 == 0 else "") + "\n".join(lines) + "\n")
    df, jobs = _jobs(spark, "headers", lambda: read_bronze_csv(spark, str(folder)))
    assert jobs <= 12  # three headers, and listings of many paths
    got = {(r.a, r.b, r.c) for r in df.collect()}
    assert got == {(f"x{k}", f"y{k}", None if k % 3 == 2 else f"z{k}") for k in range(600)}


def test_one_header_makes_no_list_of_files(spark, tmp_path):
    from keelson.sources.csv_bronze import header_groups
    folder = tmp_path / "same"
    folder.mkdir()
    for k in range(50):
        (folder / f"{k}.csv").write_text("a,b \n1,2\n" if k else "")
    assert header_groups(spark, str(folder)) == [(("a", "b"), [str(folder)])]


def test_header_over_two_lines(spark, tmp_path):
    got = _csv(spark, tmp_path, {"a.csv": 'a,"b\nx",c\n1,2,3\n', "b.csv": 'a,"b\ny",c\n4,5,6\n'},
               multi_line=True)
    assert sorted(tuple(r[c] for c in ("a", "b\nx", "b\ny")) for r in got.collect()) == [
        ("1", "2", None), ("4", None, "5")]


def test_stamp_is_one_listing(spark, tmp_path):
    from keelson.session import input_stamp
    folder = tmp_path / "t"
    spark.range(500).repartition(500).write.parquet(str(folder))
    first, jobs = _jobs(spark, "stamp", lambda: input_stamp(spark, [str(folder), str(tmp_path / "no")]))
    assert jobs <= 3 and first == input_stamp(spark, [str(folder), str(tmp_path / "no")])
    file = sorted(folder.glob("*.parquet"))[0]
    file.write_bytes(file.read_bytes() + b"x")
    assert input_stamp(spark, [str(folder), str(tmp_path / "no")]) != first


def test_landing_quotes_twice_adds_nothing(spark, tmp_path):
    from keelson.sources.quotes import land_quotes
    schema = ("quote_id long, quote_ts timestamp_ntz, indicator string, price double, "
              "currency string, source string")
    t = dt.datetime(2024, 1, 1)
    table = str(tmp_path / "quotes")

    def land(name, rows):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return land_quotes(spark, str(tmp_path / name), table)

    batch = [(1, t, "BRENT", 80.0, "USD", "x"), (None, None, None, 1.0, "USD", "n")]
    assert land("a", batch).count() == 2
    assert land("b", batch).count() == 2
    assert land("c", [(2, t, "BRENT", 81.0, "USD", "x"), (1, t, "WTI", 70.0, "USD", "x")]).count() == 4


def test_bronze_joins_are_dealt_by_the_number_of_lines(spark, monkeypatch):
    """Many tasks for many lines, and parts too many for a broadcast: the same rows."""
    from keelson.sources import fixtures
    from tests.conftest import SF_SMALL
    rows = lambda: sorted(map(str, fixtures.bronze_orders(spark, SF_SMALL).collect()))
    want = rows()
    monkeypatch.setattr(fixtures, "TASK_LINES", 500)
    plan = lambda: fixtures.bronze_orders(
        spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert rows() == want
    assert "RepartitionByExpression [l_orderkey" in plan() and "l_partkey#" in plan()
    monkeypatch.setattr(fixtures, "UNPACKED", 10 ** 12)
    assert rows() == want and "RepartitionByExpression [l_partkey" in plan()
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert fixtures._dealt(lines, "l_orderkey", 12).rdd.getNumPartitions() == 12


def test_raw_file_is_packed_and_landed_once(spark):
    import os

    from keelson.catalog import landed_csv, raw_csv
    from keelson.plans.job import gold
    from tests.conftest import SF_SMALL
    folder = raw_csv(spark, SF_SMALL).removeprefix("file:")
    files = [f for f in os.listdir(folder) if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    landed = landed_csv(spark, SF_SMALL)
    assert landed.count() == gold(spark, SF_SMALL).typed.count()
    scratch = os.listdir(gold(spark, SF_SMALL).scratch.removeprefix("file:"))
    assert "raw_landing" in scratch and "bronze_csv" not in scratch
