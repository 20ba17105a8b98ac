"""Invariants of the built star at sf0.01 and the end-to-end job."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.catalog import QUERIES, flat
from keelson.plans.job import gold, open_gold, run
from keelson.plans.star import read_star
from tests.conftest import SF_CHECK, SF_SMALL


def test_star_invariants(spark):
    g = gold(spark, SF_CHECK)
    fact, silver = g.star["fact_sales"], g.silver
    assert fact.count() == silver.count()
    money = F.round(F.sum("sales"), 4)
    assert fact.select(money).first()[0] == silver.select(money).first()[0]
    for dim, key in (("dim_product", "product_id"), ("dim_customer_geo", "customer_geo_id"),
                     ("dim_logistics", "logistics_id")):
        d = g.star[dim]
        n = d.count()
        stats = d.agg(F.min(key), F.max(key), F.countDistinct(key)).first()
        assert tuple(stats) == (1, n, n), dim
    t = QUERIES["sales_trend"](spark, SF_CHECK).first()
    total = flat(spark, SF_CHECK, "none").select(F.round(F.sum("sales"), 2)).first()[0]
    assert abs(t.first_half + t.second_half - total) < 0.02
    matrix = QUERIES["status_mode_matrix"](spark, SF_CHECK).agg(F.sum("n")).first()[0]
    both = flat(spark, SF_CHECK, "logistics").filter(
        F.col("delivery_status").isNotNull() & F.col("ship_mode").isNotNull()).count()
    assert matrix == both


def test_run_writes_all_tables(spark, tmp_path):
    out = run(spark, SF_SMALL, str(tmp_path / "run"), as_of="2001-07-01")
    assert set(out) >= {"silver", "dim_time", "dim_logistics", "dim_product",
                        "dim_customer_geo", "dim_context", "fact_sales", "quality", "audit"}
    audit = {r.check: r.value for r in out["audit"].collect()}
    assert audit["fanout.fact_minus_silver"] == 0 and audit["orphans.time_id"] == 0
    assert out["quality"].count() == 4
    reopened = open_gold(spark, str(tmp_path / "run")).star
    assert reopened["fact_sales"].count() == out["fact_sales"].count() == reopened.rows["fact_sales"]


def test_queries_can_read_a_stored_run(spark, tmp_path):
    from keelson.plans.job import GOLD_ROOT_CONF
    root = str(tmp_path / "stored")
    run(spark, SF_SMALL, root)
    spark.conf.set(GOLD_ROOT_CONF, root)
    try:
        got = QUERIES["category_kpis"](spark, SF_SMALL).collect()
        assert QUERIES["gold_audit"](spark, SF_SMALL).count() == 13
    finally:
        spark.conf.unset(GOLD_ROOT_CONF)
    assert got == QUERIES["category_kpis"](spark, SF_SMALL).collect()


def test_absent_dimensions_are_skipped(spark, tmp_path):
    """A star folder without some dimensions flattens with the ones present."""
    from keelson.plans.flatten import flatten_star
    g = gold(spark, SF_SMALL)
    root = str(tmp_path / "partial")
    for name in ("fact_sales", "dim_product"):
        g.star[name].write.parquet(f"{root}/{name}")
    star = read_star(spark, root)
    assert set(star.tables) == {"fact_sales", "dim_product"}
    f = flatten_star(star)
    assert "category" in f.columns and "delivery_status" not in f.columns
    assert "year" not in f.columns
    assert f.count() == g.star["fact_sales"].count()


def test_flatten_beyond_the_broadcast_bound_equals_plain(spark):
    from collections import Counter

    from keelson.config import StarConfig
    from keelson.plans.flatten import flatten_star
    g = gold(spark, SF_SMALL)
    plain = flatten_star(g.star)
    split = flatten_star(g.star, cfg=StarConfig(broadcast_bytes=0))
    assert split.columns == plain.columns
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))


def test_command_line_run(spark, tmp_path, monkeypatch, capsys):
    from keelson.__main__ import main
    out = str(tmp_path / "cli")
    monkeypatch.setattr("sys.argv", ["keelson", "run", SF_SMALL, out, "--as-of", "2001-07-01"])
    main()
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert printed["fanout.fact_minus_silver"] == "0"
    stored = open_gold(spark, out).star["fact_sales"]
    assert stored.count() == int(printed["rows.fact_sales"])


def _small_copy(spark, folder, lines=None):
    """The gold input tables at sf0.001, with ``lineitem`` cut to ``lines`` rows if given."""
    from keelson.plans.job import GOLD_INPUT
    for name in GOLD_INPUT:
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "lineitem" and lines:
            df = df.orderBy("l_orderkey", "l_linenumber").limit(lines)
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def test_changed_input_changes_results(spark, tmp_path):
    folder = str(tmp_path / "in")
    _small_copy(spark, folder)
    before = QUERIES["silver"](spark, folder).count()
    _small_copy(spark, folder, 3000)
    after = QUERIES["silver"](spark, folder).count()
    assert before == QUERIES["silver"](spark, SF_SMALL).count() and after < 3001 < before
    assert QUERIES["gold_audit"](spark, folder).filter("check = 'rows.silver'").first().value == after


def test_remembered_results_expire(spark):
    from keelson.plans.job import MEMO_SECONDS_CONF
    first = gold(spark, SF_SMALL)
    assert gold(spark, SF_SMALL) is first
    spark.conf.set(MEMO_SECONDS_CONF, "0")
    try:
        assert gold(spark, SF_SMALL) is not first
    finally:
        spark.conf.unset(MEMO_SECONDS_CONF)


def test_stored_run_of_another_input_is_refused(spark, tmp_path):
    import pytest

    from keelson.plans.job import GOLD_ROOT_CONF
    root = str(tmp_path / "stored")
    run(spark, SF_SMALL, root)
    spark.conf.set(GOLD_ROOT_CONF, root)
    try:
        with pytest.raises(ValueError, match="not built from"):
            QUERIES["silver"](spark, SF_CHECK)
        # a second session over the stored root: neither writes into it nor doubles rows
        files = sorted(str(p) for p in (tmp_path / "stored").rglob("*"))
        for session in (spark, spark.newSession()):
            session.conf.set(GOLD_ROOT_CONF, root)
            import keelson.plans.job as job
            job._CACHE.clear()
            assert QUERIES["silver_stream"](session, SF_SMALL).count() == 5983
        assert sorted(str(p) for p in (tmp_path / "stored").rglob("*")) == files
    finally:
        spark.conf.unset(GOLD_ROOT_CONF)


def test_cluster_session_needs_a_shared_folder():
    import pytest

    from keelson.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_unreadable_dimension_raises(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    g = gold(spark, SF_SMALL)
    root = str(tmp_path / "broken")
    g.star["fact_sales"].write.parquet(f"{root}/fact_sales")
    (tmp_path / "broken" / "dim_product").mkdir()  # a folder without a readable table
    with pytest.raises(AnalysisException):
        read_star(spark, root)



def test_a_run_that_dies_leaves_the_one_before(spark, tmp_path, monkeypatch):
    import pytest
    from pyspark.errors import AnalysisException

    import keelson.plans.star as star_plan
    root = str(tmp_path / "runs")
    run(spark, SF_SMALL, root)
    before = open_gold(spark, root)
    want = sorted(map(tuple, before.star["dim_product"].collect()))
    write = star_plan._write_read

    def dies(session, df, path, *rest):
        if path.endswith("dim_logistics"):
            raise RuntimeError("killed between two tables")
        return write(session, df, path, *rest)

    monkeypatch.setattr(star_plan, "_write_read", dies)
    with pytest.raises(RuntimeError, match="killed"):
        run(spark, SF_SMALL, root, as_of="2001-07-01")
    monkeypatch.undo()
    again = open_gold(spark, root)
    assert again.root == before.root
    assert sorted(map(tuple, again.star["dim_product"].collect())) == want
    # a committed run lacks a table: an error, not an optional dimension
    (tmp_path / "away").mkdir()
    path = tmp_path / "runs" / "runs" / again.root.rsplit("/", 1)[1] / "gold" / "dim_product"
    path.rename(tmp_path / "away" / "dim_product")
    with pytest.raises(AnalysisException):
        open_gold(spark, root)
    with pytest.raises(ValueError, match="nothing has been published"):
        open_gold(spark, str(tmp_path / "none"))


def test_manifests(spark, tmp_path):
    """The newest whole manifest counts; old runs go, one being written stays."""
    import os

    from keelson.sources.runs import current_run, new_run, publish
    root = str(tmp_path / "p")
    assert current_run(spark, root) is None
    folders = []
    for k in range(4):
        folders.append(new_run(root))
        spark.range(k + 1).write.parquet(f"{folders[-1]}/t")
        assert publish(spark, root, folders[-1], {"rows": k + 1}) == k + 1
    unfinished, dead = new_run(root), new_run(root)
    for f in (unfinished, dead):
        spark.range(1).write.parquet(f"{f}/t")
    os.utime(dead, (1, 1))
    (tmp_path / "p" / "manifests" / "000000000005.json").write_text('{"rows": 5, "run": "cut o')
    found = current_run(spark, root)
    assert found["rows"] == 4 and spark.read.parquet(f"{found['folder']}/t").count() == 4
    assert publish(spark, root, unfinished, {"rows": 1}) == 6
    assert current_run(spark, root)["folder"] == unfinished
    left = {str(p) for p in (tmp_path / "p" / "runs").iterdir()}
    assert left == {folders[-1], unfinished}


def test_replaced_tables_are_freed(spark, tmp_path):
    import os

    import keelson.plans.job as job
    folder = str(tmp_path / "in")
    roots = []
    for lines in (1000, 1100, 1200, 1300):
        _small_copy(spark, folder, lines)
        g = gold(spark, folder)
        QUERIES["category_mix_top5"](spark, folder).count()
        roots.append(g)
    there = lambda path: os.path.exists(path.removeprefix("file:"))
    assert [there(g.root) for g in roots] == [False, False, True, True]
    assert [there(g.scratch) for g in roots] == [False, False, True, True]
    assert len(job._REPLACED) == 1


def test_batch_over_raw_files(spark, tmp_path):
    import pytest

    from keelson.catalog import raw_csv
    from keelson.plans.job import run_files
    from keelson.sources.fixtures import quotes_from_events
    orders, quotes = raw_csv(spark, SF_SMALL), str(tmp_path / "quotes")
    plain = run_files(spark, orders, str(tmp_path / "a"), str(tmp_path / "absent"))
    assert plain["silver"].select("oil_price").distinct().collect()[0][0] == 0.0
    found = {r.rule: r.violations for r in plain["quality"].collect()}
    assert found["overlong_line"] == 0 and len(found) == 5
    rows = quotes_from_events(spark, SF_SMALL)
    rows.limit(0).write.parquet(quotes)
    empty = run_files(spark, orders, str(tmp_path / "b"), quotes)
    assert empty["silver"].first().oil_price == 0.0 and not (tmp_path / "b" / "quotes").exists()
    rows.write.mode("overwrite").parquet(quotes)
    priced = run_files(spark, orders, str(tmp_path / "b"), quotes)
    want = gold(spark, SF_SMALL)
    assert priced["silver"].first().oil_price == want.oil_price
    assert priced["fact_sales"].count() == want.star.rows["fact_sales"]
    with pytest.raises(ValueError, match="no raw file"):
        (tmp_path / "none").mkdir()
        run_files(spark, str(tmp_path / "none"), str(tmp_path / "c"))


def test_aggregates_by_id_equal_those_of_the_flat_frame(spark):
    from keelson.plans import kpi, marts
    star, frame = gold(spark, SF_SMALL).star, flat(spark, SF_SMALL)
    rows = lambda df: sorted(tuple(round(v, 4) if isinstance(v, float) else v for v in r)
                             for r in df.collect())
    for a, b in ((marts.star_category_mart(star), marts.category_mart(frame)),
                 (marts.star_late_city_counts(star), marts.late_city_counts(frame)),
                 (marts.star_status_mode_wide(star), marts.status_mode_wide(frame)),
                 (kpi.star_distinct_counts(star), kpi.distinct_counts(frame)),
                 (kpi.star_kpi_aggregates(star), kpi.kpi_aggregates(frame))):
        assert a.columns == b.columns and rows(a) == rows(b)
