"""Print the physical plans of the headline queries (tree + scan details) as Markdown.

    python tools/explain_plans.py [sf_dir] > docs/PLANS.md.raw
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ("category_kpis", "status_counts", "kpi_summary_filtered", "price_sensitivity")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = buf.getvalue().splitlines()
    tree = []
    for ln in lines:
        if ln.startswith("(") or ln.startswith("==="):
            break
        tree.append(ln)
    details = [ln for ln in lines if ln.startswith(("PushedFilters", "ReadSchema", "Join type",
                                                    "Output", "(")) and "Scan" in ln
               or ln.startswith(("PushedFilters", "ReadSchema"))]
    return "\n".join(tree + details)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from keelson.catalog import QUERIES, flat
    from keelson.plans import marts
    from keelson.plans.job import gold
    from keelson.config import StarConfig
    from keelson.plans.kpi import star_distinct_counts, star_kpi_aggregates
    from keelson.plans.star import dim_product, fact_sales
    from keelson.session import local_session
    spark = local_session(8)
    g = gold(spark, sf)
    s = g.star
    # how the stored tables and the shared marts are built
    built = {
        "fact_sales (build)": fact_sales(g.silver, s["dim_product"], s["dim_customer_geo"],
                                         s["dim_logistics"]),
        "fact_sales (dimensions beyond the broadcast bound)": fact_sales(
            g.silver, s["dim_product"], s["dim_customer_geo"], s["dim_logistics"],
            StarConfig(broadcast_bytes=0)),
        "dim_product (build: distinct + dense ids)": dim_product(g.silver),
        "kpi aggregates": star_kpi_aggregates(s),
        "distinct counts": star_distinct_counts(s),
        "category mart (shared by 5 rankings)": marts.star_category_mart(s),
        "late-city counts (shared by 2 reports)": marts.star_late_city_counts(s),
        "status x mode": marts.star_status_mode_wide(s),
        "daily series (shared by 3 queries)": marts.daily_sales_vs_price(flat(spark, sf, "none")),
    }
    for name, df in built.items():
        print(f"### {name}\n\n```\n{plan_text(df)}\n```\n")
    for name in HEADLINE:
        print(f"### {name}\n\n```\n{plan_text(QUERIES[name](spark, sf))}\n```\n")


if __name__ == "__main__":
    main()
