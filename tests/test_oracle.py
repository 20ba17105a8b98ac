"""Every registered query against its DuckDB statement, plus the FIXTURES figures."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from keelson.catalog import QUERIES
from tests.conftest import SF_CHECK, SF_SMALL
from tests.oracle_compare import compare, duck

SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con_small, name):
    assert name in SQL, "every query of the catalog has a statement"
    df = QUERIES[name](spark, SF_SMALL)
    ok, msg = compare(df, con_small, SQL[name], digits=None)  # exact, no float tolerance
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "total_orders", "total_sales", "avg_oil_price",
                          "total_profit"]


def test_fixture_figures(spark):
    """Figures of FIXTURES.md (sf0.01)."""
    q = QUERIES
    audit = {r.check: r.value for r in q["gold_audit"](spark, SF_CHECK).collect()}
    assert audit["rows.silver"] == 59819
    assert audit["rows.dim_time"] == 14666
    assert audit["rows.dim_context"] == 14667
    assert audit["rows.dim_logistics"] == 24
    assert audit["rows.dim_customer_geo"] == 520
    assert audit["rows.dim_product"] == 1153
    assert audit["orphans.time_id"] == 0
    assert q["fact_sales_geo2"](spark, SF_CHECK).count() == 63153
    k = q["kpi_summary"](spark, SF_CHECK).first()
    assert round(k.late_rate, 4) == 47.6905
    assert k.total_sales == 3015086432.57
    t = q["sales_trend"](spark, SF_CHECK).first()
    assert (t.first_half, t.second_half) == (1508690077.08, 1506396355.50)
    assert q["oil_price_constant"](spark, SF_CHECK).first().oil_price == 4.08
    late = [(r.cust_city, r.late_count) for r in q["late_city_top10"](spark, SF_CHECK).collect()]
    assert late[:3] == [("HOUSEHOLD-2", 1621), ("MACHINERY-3", 1621), ("BUILDING-0", 1590)]
