"""What lies on the disks: shuffle files, order lines, raw files; the rows stay the same."""

from __future__ import annotations

from functools import reduce

from keelson.catalog import QUERIES, presented
from keelson.plans.job import gold, open_gold, run
from tests.conftest import SF_SMALL
from tests.test_invariants import _small_copy


def _rows(df):
    return sorted(map(str, df.collect()))


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    import os
    import time

    from keelson.session import SHUFFLE_CLEANUP_CONF, freed_shuffles

    def shuffles():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for d in dirs.localDirsString() for _, _, files in os.walk(d)
                for name in files if name.startswith("shuffle_")}

    def left(name):
        before = shuffles()
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / name))
        for _ in range(100):
            if not shuffles() - before:
                return 0
            time.sleep(0.02)
        return len(shuffles() - before)

    assert left("kept") > 0
    old = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    with freed_shuffles(spark), freed_shuffles(spark):
        assert left("freed") == 0
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == old


def test_order_lines_are_stored_once_in_slices(spark, tmp_path, monkeypatch):
    """Typed bronze and silver read from one set of lines, landed and modelled by slices."""
    import os

    from keelson.plans.silver import clean_orders, typed_orders
    from keelson.sources import fixtures, tables
    whole = fixtures.bronze_orders(spark, SF_SMALL)
    monkeypatch.setattr(tables, "SLICE_LINES", 1500)
    slices = fixtures.bronze_slices(spark, SF_SMALL)
    assert len(slices) == 4 and all(s.limit(1).count() for s in slices)
    assert _rows(reduce(lambda a, b: a.union(b), slices)) == _rows(whole)

    root = str(tmp_path / "run")
    run(spark, SF_SMALL, root)
    g = open_gold(spark, root)
    assert sorted(os.listdir(g.root.removeprefix("file:"))) == ["audit", "gold", "orders", "quality"]
    kept = spark.read.parquet(f"{g.root}/orders/kept=1")
    assert kept.count() == g.silver.count() < g.typed.count()
    assert _rows(g.typed) == _rows(typed_orders(whole, g.oil_price))
    assert _rows(g.silver) == _rows(clean_orders(whole, g.oil_price))
    assert g.typed.dtypes == g.silver.dtypes == typed_orders(whole).dtypes
    parts = tables.file_slices(g.silver, 3)
    assert _rows(reduce(lambda a, b: a.union(b), parts)) == _rows(g.silver)
    star = gold(spark, SF_SMALL).star
    for name in star.tables:  # means of doubles differ in their last digits with the order
        assert _rows(presented(g.star[name])) == _rows(presented(star[name]))


def test_runs_that_store_bronze_and_silver_apart_open(spark, tmp_path):
    from keelson.sources.runs import new_run, publish
    g, root = gold(spark, SF_SMALL), str(tmp_path / "old")
    folder = new_run(root)
    g.typed.write.parquet(f"{folder}/bronze_typed")
    g.silver.write.parquet(f"{folder}/silver")
    publish(spark, root, folder, {"star_rows": {}, "silver_rows": g.silver_rows, "oil_price": 1.0})
    old = open_gold(spark, root)
    assert _rows(old.typed) == _rows(g.typed) and _rows(old.silver) == _rows(g.silver)


def test_raw_file_needs_no_gold_tables(spark, tmp_path, monkeypatch):
    import os

    from keelson.catalog import raw_csv
    from keelson.sources import tables
    monkeypatch.setattr(tables, "SLICE_LINES", 1500)
    folder = str(tmp_path / "in")
    _small_copy(spark, folder)
    found = {q: _rows(QUERIES[q](spark, folder))
             for q in ("bronze_csv_scan", "silver_from_csv", "silver_stream", "batch_from_files")}
    shell = gold(spark, folder, tables=False)
    assert shell.star is None and not os.path.exists(shell.root.removeprefix("file:"))
    assert sorted(set(os.listdir(shell.scratch.removeprefix("file:")))) == [
        "raw_csv", "raw_landing", "stream_ckpt", "stream_silver"]
    g = gold(spark, folder)
    assert g is shell and found["silver_stream"] == found["silver_from_csv"] == _rows(g.silver)
    assert found["batch_from_files"] == _rows(QUERIES["gold_audit"](spark, folder))
    before = {*spark.read.text(raw_csv(spark, folder)).collect()}
    g.memo.clear()  # now from the landed lines
    g.scratch += "-again"
    assert {*spark.read.text(raw_csv(spark, folder)).collect()} == before
    assert _rows(QUERIES["bronze_csv_scan"](spark, folder)) == found["bronze_csv_scan"]


def test_a_batch_stores_raw_lines_once(spark, tmp_path):
    """Over-long lines are counted, and in neither typed bronze nor silver."""
    import os

    from keelson.plans.job import run_files
    from keelson.config import RAW_TO_SILVER
    names = [raw for raw, _ in RAW_TO_SILVER]
    line = ["A", "p", "c", "s", "k", "oc", "os", "ok", "or", "Late delivery", "m", "1", "2",
            "1/2/2020 3:04", "1/3/2020 3:04", "5.0", "1.0", "5.0", "1.0", "1", "2", "3"]
    lines = [names, line, [*line, "more"], ["", *line[1:]], [*line[:15], "-1", *line[16:]],
             [*line[:15], "", *line[16:]]]
    (tmp_path / "raw.csv").write_text("\n".join(map(",".join, lines)) + "\n")
    out = run_files(spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"))
    g = open_gold(spark, str(tmp_path / "out"))
    assert {r.rule: r.violations for r in out["quality"].collect()} == {
        "future_order_date": 0, "negative_sales": 1, "negative_ship_days": 0,
        "missing_category": 1, "overlong_line": 1}
    assert g.typed.count() == 4 and g.typed.filter("category IS NULL").count() == 1
    assert sorted(r.category for r in g.silver.collect()) == ["A", "UNCATEGORIZED"]
    assert "bronze_raw" not in os.listdir(g.root.removeprefix("file:"))
