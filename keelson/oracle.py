"""DuckDB twins of the registered queries (the correctness gate's oracle).

Each statement runs on the driver's tables registered as views (``lineitem``,
``orders``, ...). It rebuilds the bronze view, silver, the star and the flattened frame
as CTEs in plain SQL, following the reference's own SQL: surrogate ids as
``row_number() OVER (ORDER BY natural key NULLS LAST)``, the time attributes by a
LEFT JOIN to the time dimension, the half split by a global ``row_number``. The Spark
side computes the same results with distributed operators; agreement of the two is what
the gate checks.
"""

from __future__ import annotations

AS_OF = "2001-07-01 00:00:00"


def _exact(x: str, where: str = "") -> str:
    """The exact sum of a double column, rounded to a double once: its whole parts and the 84
    bits below 1 are summed as 128-bit integers and all digits of the sum are read as text."""
    one, top = 2 ** 84, 2 ** 63
    sums = (f"{{'w': sum(CAST(trunc({x}) AS HUGEINT)){where}, "
            f"'f': sum(CAST(({x} - trunc({x})) * {2.0 ** 84!r} AS HUGEINT)){where}}}")
    down = f"{{'w': a.w + (a.f - (a.f % {one} + {one}) % {one}) // {one}, 'f': (a.f % {one} + {one}) % {one}}}"
    size = (f"{{'s': CASE WHEN b.w < 0 THEN '-' ELSE '' END, 'w': CASE WHEN b.w < 0 THEN -b.w - "
            f"CASE WHEN b.f > 0 THEN 1 ELSE 0 END ELSE b.w END, "
            f"'f': CASE WHEN b.w < 0 THEN ({one} - b.f) % {one} ELSE b.f END}}")
    rest, digits = f"c.f // {2 ** 21}", ""
    for _ in range(4):
        digits += f" || lpad(CAST(({rest}) * {10 ** 18} // {top} AS VARCHAR), 18, '0')"
        rest = f"({rest}) * {10 ** 18} % {top}"
    text = (f"CAST(c.s || CAST(c.w AS VARCHAR) || '.'{digits} || "
            f"CASE WHEN c.f % {2 ** 21} > 0 THEN '1' ELSE '0' END AS DOUBLE)")
    let = lambda v, n, body: f"list_transform([{v}], lambda {n}: {body})[1]"
    return let(sums, "a", let(down, "b", let(size, "c", text)))


def _cents(x: str) -> str:
    """A double rounded half up to 2 decimals, from its shortest text."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12)), 2) AS DOUBLE)"


_BASE = f"""
geo AS (
  SELECT n.n_nationkey, n.n_name, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
base AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_returnflag,
         o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority,
         p.p_name, p.p_brand, c.c_custkey, c.c_mktsegment,
         cg.n_name AS cn_name, cg.r_name AS cr_name,
         s.s_name, sg.n_name AS sn_name, sg.r_name AS sr_name,
         CAST(((date_diff('day', o.o_orderdate, l.l_shipdate) % 7) + 7) % 7 AS INTEGER) AS real_days,
         CAST(CASE o.o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
              WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS INTEGER) AS sched_days,
         o.o_orderdate + to_minutes(CAST(o.o_orderkey % 1440 AS BIGINT)) AS base_ts,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l.l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l.l_tax AS DECIMAL(4,2)) AS tax,
         CAST(((CAST(substr(p.p_brand, 7) AS INTEGER) % 7) - 3) * 4 / 100 AS DECIMAL(4,2)) AS bias
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN geo sg ON s.s_nationkey = sg.n_nationkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo cg ON c.c_nationkey = cg.n_nationkey
),
bronze AS (
  SELECT
    CASE WHEN l_partkey % 97 <> 0 THEN p_brand END AS category,
    CASE WHEN l_partkey % 89 <> 0 THEN p_name END AS product,
    CASE WHEN c_custkey % 53 <> 0 THEN c_mktsegment || '-' || CAST(c_custkey % 4 AS VARCHAR) END AS cust_city,
    CASE WHEN c_custkey % 59 <> 0 THEN cn_name END AS cust_state,
    CASE WHEN c_custkey % 61 <> 0 THEN cr_name END AS cust_country,
    s_name AS order_city, sn_name AS order_state, sn_name AS order_country, sr_name AS order_region,
    CASE WHEN l_orderkey % 211 = 0 THEN NULL
         WHEN o_orderstatus = 'P' AND l_returnflag = 'R' THEN 'Shipping canceled'
         WHEN real_days > sched_days THEN 'Late delivery'
         WHEN real_days = sched_days THEN 'Shipping on time'
         ELSE 'Advance shipping' END AS delivery_status,
    o_orderpriority AS ship_mode,
    real_days AS ship_days_real,
    sched_days AS ship_days_sched,
    CASE WHEN o_orderkey % 401 <> 0 THEN base_ts END AS order_ts,
    base_ts + to_days(real_days) AS ship_ts,
    CAST(price * (1 - disc) AS DOUBLE)
      * CASE WHEN l_partkey % 50 = 0 AND l_linenumber = 7 THEN -1.0 ELSE 1.0 END AS sales,
    CAST(price * (0.15 - disc - tax + bias) AS DOUBLE) AS profit,
    CAST(price * (1 - disc) * (1 + tax) AS DOUBLE) AS sales_per_customer,
    CAST(price * (0.15 - disc - tax + bias) AS DOUBLE) AS benefit,
    l_orderkey AS src_order_id,
    l_partkey AS src_product_id,
    o_custkey AS src_customer_id
  FROM base
),
quotes AS (
  SELECT event_id AS quote_id, ts AS quote_ts, 'BRENT' AS indicator, value AS price,
         'USD' AS currency, event_type AS source
  FROM events
),
oil AS (
  SELECT CAST(coalesce((SELECT CAST(round(CAST(price AS DECIMAL(38,10)), 2) AS DOUBLE) FROM quotes
                        ORDER BY quote_ts DESC, quote_id ASC LIMIT 1), 0.0) AS DOUBLE) AS oil_price
),
typed AS (
  SELECT b.*, oil.oil_price FROM bronze b, oil
),
silver AS (
  SELECT coalesce(category, 'UNCATEGORIZED') AS category,
         coalesce(product, 'UNKNOWN') AS product,
         cust_city,
         coalesce(cust_state, 'N/A') AS cust_state,
         coalesce(cust_country, 'UNKNOWN') AS cust_country,
         order_city, order_state, order_country, order_region,
         delivery_status, ship_mode,
         coalesce(ship_days_real, 0) AS ship_days_real,
         coalesce(ship_days_sched, 0) AS ship_days_sched,
         order_ts, ship_ts, sales, profit, sales_per_customer, benefit, oil_price,
         src_order_id, src_product_id, src_customer_id
  FROM typed
  WHERE sales >= 0
),
dim_time AS (
  SELECT DISTINCT order_ts AS time_id, order_ts AS full_date,
         CAST(year(order_ts) AS BIGINT) AS year, CAST(month(order_ts) AS BIGINT) AS month,
         CAST(day(order_ts) AS BIGINT) AS day, CAST(dayofweek(order_ts) AS BIGINT) AS day_of_week,
         CAST(quarter(order_ts) AS BIGINT) AS quarter
  FROM silver WHERE order_ts IS NOT NULL
),
dim_logistics AS (
  SELECT CAST(row_number() OVER (ORDER BY delivery_status ASC NULLS LAST, ship_mode ASC NULLS LAST) AS BIGINT) AS logistics_id,
         delivery_status, ship_mode,
         avg(ship_days_real) AS avg_ship_days_real, avg(ship_days_sched) AS avg_ship_days_sched
  FROM (SELECT DISTINCT delivery_status, ship_mode, ship_days_real, ship_days_sched FROM silver)
  GROUP BY delivery_status, ship_mode
),
dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY category ASC NULLS LAST, product ASC NULLS LAST) AS BIGINT) AS product_id,
         category, product
  FROM (SELECT DISTINCT category, product FROM silver WHERE category IS NOT NULL)
),
dim_customer_geo AS (
  SELECT CAST(row_number() OVER (ORDER BY cust_country ASC NULLS LAST, cust_state ASC NULLS LAST,
                                          cust_city ASC NULLS LAST) AS BIGINT) AS customer_geo_id,
         cust_city, cust_state, cust_country
  FROM (SELECT DISTINCT cust_city, cust_state, cust_country FROM silver WHERE cust_city IS NOT NULL)
),
dim_context AS (
  SELECT order_ts AS ref_ts, avg(oil_price) AS oil_price FROM silver GROUP BY order_ts
),
fact_sales AS (
  SELECT s.order_ts AS time_id, s.order_ts AS full_date, p.product_id, g.customer_geo_id,
         l.logistics_id, s.oil_price AS daily_oil_price, s.sales, s.profit,
         s.sales_per_customer, s.ship_days_real
  FROM silver s
  LEFT JOIN dim_product p ON s.category = p.category AND s.product = p.product
  LEFT JOIN dim_customer_geo g ON s.cust_city = g.cust_city AND s.cust_state = g.cust_state
                               AND s.cust_country = g.cust_country
  LEFT JOIN dim_logistics l ON s.delivery_status = l.delivery_status AND s.ship_mode = l.ship_mode
),
fact_sales_geo2 AS (
  SELECT s.order_ts AS time_id, s.order_ts AS full_date, p.product_id, g.customer_geo_id,
         l.logistics_id, s.oil_price AS daily_oil_price, s.sales, s.profit,
         s.sales_per_customer, s.ship_days_real
  FROM silver s
  LEFT JOIN dim_product p ON s.category = p.category AND s.product = p.product
  LEFT JOIN dim_customer_geo g ON s.cust_city = g.cust_city AND s.cust_state = g.cust_state
  LEFT JOIN dim_logistics l ON s.delivery_status = l.delivery_status AND s.ship_mode = l.ship_mode
),
flat AS (
  SELECT f.time_id, f.full_date, f.product_id, f.customer_geo_id, f.logistics_id,
         f.daily_oil_price AS oil_price, f.sales, f.profit, f.sales_per_customer, f.ship_days_real,
         p.category, p.product, g.cust_city, g.cust_state, g.cust_country,
         l.delivery_status, l.ship_mode, t.year, t.month
  FROM fact_sales f
  LEFT JOIN dim_product p ON f.product_id = p.product_id
  LEFT JOIN dim_customer_geo g ON f.customer_geo_id = g.customer_geo_id
  LEFT JOIN dim_logistics l ON f.logistics_id = l.logistics_id
  LEFT JOIN dim_time t ON f.time_id = t.time_id
),
cat AS (
  SELECT category, {_exact('sales')} AS sales, {_exact('profit')} AS profit, count(*) AS n
  FROM flat WHERE category IS NOT NULL GROUP BY category
)"""


def with_base(select: str, ctes: str = "") -> str:
    return "WITH" + _BASE + ctes + "\n" + select.strip()


SQL: dict[str, str] = {}


def q(name: str, select: str, ctes: str = "") -> None:
    SQL[name] = with_base(select, ctes)


q("silver", "SELECT * FROM silver")
q("oil_price_constant", "SELECT oil_price FROM oil")
q("latest_quote", """
SELECT indicator,
       arg_max(quote_ts, (quote_ts, -quote_id)) AS quote_ts,
       arg_max(price, (quote_ts, -quote_id)) AS price,
       arg_max(currency, (quote_ts, -quote_id)) AS currency,
       arg_max(source, (quote_ts, -quote_id)) AS source
FROM quotes GROUP BY indicator""")
q("quality_report", f"""
SELECT rule, severity, violations FROM (
  SELECT 1 AS k, 'future_order_date' AS rule, 'error' AS severity,
         CAST(count(*) FILTER (WHERE order_ts > TIMESTAMP '{AS_OF}') AS BIGINT) AS violations FROM typed
  UNION ALL SELECT 2, 'negative_sales', 'error', CAST(count(*) FILTER (WHERE sales < 0) AS BIGINT) FROM typed
  UNION ALL SELECT 3, 'negative_ship_days', 'error',
         CAST(count(*) FILTER (WHERE ship_days_real < 0) AS BIGINT) FROM typed
  UNION ALL SELECT 4, 'missing_category', 'warning',
         CAST(count(*) FILTER (WHERE category IS NULL) AS BIGINT) FROM typed)""")
q("dim_context", "SELECT ref_ts, round(oil_price, 6) AS oil_price FROM dim_context")
for _t in ("dim_time", "dim_logistics", "dim_product", "dim_customer_geo",
           "fact_sales", "fact_sales_geo2", "flat"):
    q("flatten_star" if _t == "flat" else _t, f"SELECT * FROM {_t}")
q("category_kpis", f"""
SELECT p.category,
       CAST(count(f.product_id) AS BIGINT) AS total_orders,
       {_cents(_exact('f.sales'))} AS total_sales,
       CAST(round(CAST(avg(f.daily_oil_price) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_oil_price,
       {_cents(_exact('f.profit'))} AS total_profit
FROM fact_sales f JOIN dim_product p ON f.product_id = p.product_id
GROUP BY p.category
ORDER BY total_sales DESC, p.category
LIMIT 5""")
q("status_counts", """
SELECT l.delivery_status, CAST(count(*) AS BIGINT) AS total
FROM fact_sales f JOIN dim_logistics l ON f.logistics_id = l.logistics_id
GROUP BY 1""")

q("gold_audit", """
SELECT "check", value FROM (
  SELECT 1 AS k, 'rows.silver' AS "check", CAST(count(*) AS BIGINT) AS value FROM silver
  UNION ALL SELECT 2, 'rows.dim_time', CAST(count(*) AS BIGINT) FROM dim_time
  UNION ALL SELECT 3, 'rows.dim_logistics', CAST(count(*) AS BIGINT) FROM dim_logistics
  UNION ALL SELECT 4, 'rows.dim_product', CAST(count(*) AS BIGINT) FROM dim_product
  UNION ALL SELECT 5, 'rows.dim_customer_geo', CAST(count(*) AS BIGINT) FROM dim_customer_geo
  UNION ALL SELECT 6, 'rows.dim_context', CAST(count(*) AS BIGINT) FROM dim_context
  UNION ALL SELECT 7, 'rows.fact_sales', CAST(count(*) AS BIGINT) FROM fact_sales
  UNION ALL SELECT 8, 'null_ids.product_id', CAST(count(*) FILTER (WHERE product_id IS NULL) AS BIGINT) FROM fact_sales
  UNION ALL SELECT 9, 'null_ids.customer_geo_id', CAST(count(*) FILTER (WHERE customer_geo_id IS NULL) AS BIGINT) FROM fact_sales
  UNION ALL SELECT 10, 'null_ids.logistics_id', CAST(count(*) FILTER (WHERE logistics_id IS NULL) AS BIGINT) FROM fact_sales
  UNION ALL SELECT 11, 'orphans.time_id', CAST(count(*) AS BIGINT) FROM
     (SELECT DISTINCT time_id FROM fact_sales WHERE time_id IS NOT NULL
      AND time_id NOT IN (SELECT time_id FROM dim_time))
  UNION ALL SELECT 12, 'null_groups.dim_context', CAST(count(*) AS BIGINT) FROM dim_context WHERE ref_ts IS NULL
  UNION ALL SELECT 13, 'fanout.fact_minus_silver',
     CAST((SELECT count(*) FROM fact_sales) - (SELECT count(*) FROM silver) AS BIGINT))""")
q("fact_integrity", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, {_cents(_exact('sales'))} AS total_sales,
       round(avg(profit), 6) AS avg_profit FROM fact_sales""")
q("flatten_star_partial", """
SELECT f.time_id, f.full_date, f.product_id, f.customer_geo_id, f.logistics_id,
       f.daily_oil_price AS oil_price, f.sales, f.profit, f.sales_per_customer, f.ship_days_real,
       p.category, p.product
FROM fact_sales f LEFT JOIN dim_product p ON f.product_id = p.product_id""")


def _kpi(rel: str, status: bool = True, category: bool = True) -> tuple[str, str]:
    late = ("avg(CASE WHEN delivery_status = 'Late delivery' THEN 1.0 ELSE 0.0 END) * 100"
            if status else "0.0")
    top = ("(SELECT category FROM kc ORDER BY s DESC, category LIMIT 1)" if category
           else "CAST(NULL AS VARCHAR)")
    worst = ("(SELECT category FROM kc ORDER BY p ASC, category LIMIT 1)" if category
             else "CAST(NULL AS VARCHAR)")
    kc = (f"SELECT category, {_exact('sales')} AS s, {_exact('profit')} AS p FROM k_src "
          "WHERE category IS NOT NULL GROUP BY category") if category else "SELECT 1 AS x"
    ctes = f""",
k_src AS (SELECT * FROM {rel}),
kg AS (SELECT coalesce({_exact('sales')}, 0.0) AS total_sales, coalesce({_exact('profit')}, 0.0) AS total_profit,
              CAST(count(*) AS BIGINT) AS total_orders, avg(oil_price) AS oil_avg,
              stddev_samp(oil_price) AS oil_std, {late} AS late_rate FROM k_src),
kr AS (SELECT sales, row_number() OVER (ORDER BY full_date ASC NULLS LAST, sales ASC) AS rn,
              count(*) OVER () AS n FROM k_src),
kh AS (SELECT coalesce({_exact('sales', ' FILTER (WHERE rn <= n // 2)')}, 0.0) AS first_half,
              coalesce({_exact('sales', ' FILTER (WHERE rn > n // 2)')}, 0.0) AS second_half FROM kr),
kc AS ({kc}),
kpi AS (
  SELECT total_sales, total_profit,
         CASE WHEN total_sales > 0 THEN total_profit / total_sales * 100 ELSE 0.0 END AS margin_pct,
         total_orders, total_sales / total_orders AS avg_ticket, oil_avg, oil_std, late_rate,
         100.0 - late_rate AS on_time_rate,
         CASE WHEN first_half > 0 THEN (second_half - first_half) / first_half * 100 ELSE 0.0 END
           AS sales_trend_pct,
         {top} AS top_category, {worst} AS worst_category,
         first_half, second_half
  FROM kg, kh
)"""
    select = f"""
SELECT {_cents('total_sales')} AS total_sales, {_cents('total_profit')} AS total_profit,
       round(margin_pct, 6) AS margin_pct, total_orders, round(avg_ticket, 6) AS avg_ticket,
       round(oil_avg, 6) AS oil_avg, round(oil_std, 6) AS oil_std, round(late_rate, 6) AS late_rate,
       round(on_time_rate, 6) AS on_time_rate, round(sales_trend_pct, 6) AS sales_trend_pct,
       top_category, worst_category
FROM kpi"""
    return select, ctes


_FLAT_NO_LOGISTICS = "(SELECT * EXCLUDE (delivery_status, ship_mode, cust_city, cust_state, cust_country) FROM flat)"
q("kpi_summary", *_kpi("flat"))
q("kpi_summary_missing_cols", *_kpi(_FLAT_NO_LOGISTICS, status=False))
q("kpi_summary_filtered", *_kpi("(SELECT * FROM flat WHERE year >= 1998)"))
_FLAT_GEO2 = """(SELECT f.*, f.daily_oil_price AS oil_price, p.category, p.product, g.cust_city,
       l.delivery_status, l.ship_mode
FROM fact_sales_geo2 f LEFT JOIN dim_product p ON f.product_id = p.product_id
LEFT JOIN dim_customer_geo g ON f.customer_geo_id = g.customer_geo_id
LEFT JOIN dim_logistics l ON f.logistics_id = l.logistics_id)"""
q("kpi_summary_geo2", *_kpi(_FLAT_GEO2))
q("late_city_top10_geo2", f"""
SELECT cust_city, CAST(count(*) AS BIGINT) AS late_count FROM {_FLAT_GEO2}
WHERE delivery_status = 'Late delivery' AND cust_city IS NOT NULL
GROUP BY cust_city ORDER BY late_count DESC, cust_city LIMIT 10""")
_sel, _ctes = _kpi("flat")
q("sales_trend", f"""
SELECT {_cents('first_half')} AS first_half, {_cents('second_half')} AS second_half,
       round(sales_trend_pct, 6) AS trend_pct FROM kpi""", _ctes)
q("best_worst_category", "SELECT top_category, worst_category FROM kpi", _ctes)
q("distinct_counts", """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT cust_country) AS BIGINT) AS n_cust_country,
       CAST(count(DISTINCT category) AS BIGINT) AS n_category,
       CAST(count(DISTINCT cust_city) AS BIGINT) AS n_cust_city FROM flat""")
q("silver_distinct_counts", """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT cust_country) AS BIGINT) AS n_cust_country,
       CAST(count(DISTINCT category) AS BIGINT) AS n_category,
       CAST(count(DISTINCT cust_city) AS BIGINT) AS n_cust_city FROM silver""")
q("daily_sales_vs_price", f"""
SELECT date_trunc('day', full_date)::TIMESTAMP AS day, {_cents(_exact('sales'))} AS total_sales,
       round(avg(oil_price), 6) AS avg_oil_price
FROM flat WHERE full_date IS NOT NULL GROUP BY 1 ORDER BY 1""")
q("category_mix_top5", f"""
SELECT category, {_cents('sales')} AS total_sales, round(sales / sum(sales) OVER () * 100, 6) AS share_pct
FROM (SELECT category, sales FROM cat ORDER BY sales DESC, category LIMIT 5)""")
_LATE = """late AS (SELECT cust_city, CAST(count(*) AS BIGINT) AS late_count FROM flat
          WHERE delivery_status = 'Late delivery' AND cust_city IS NOT NULL GROUP BY cust_city)"""
q("late_city_top10", "SELECT cust_city, late_count FROM late ORDER BY late_count DESC, cust_city LIMIT 10",
  ",\n" + _LATE)
q("late_city_top3_total", """
SELECT CAST(coalesce(sum(late_count), 0) AS BIGINT) AS late_top_total
FROM (SELECT late_count FROM late ORDER BY late_count DESC, cust_city LIMIT 3)""", ",\n" + _LATE)
q("lowest_margin_categories", f"""
SELECT category, {_cents('sales')} AS total_sales, {_cents('profit')} AS total_profit,
       round(CASE WHEN sales <> 0 THEN profit / sales * 100 END, 6) AS margin_pct
FROM cat ORDER BY CASE WHEN sales <> 0 THEN profit / sales * 100 END ASC NULLS LAST, category LIMIT 8""")
_SM = """sm_src AS (SELECT delivery_status, ship_mode FROM flat
            WHERE delivery_status IS NOT NULL AND ship_mode IS NOT NULL),
sm_s AS (SELECT DISTINCT delivery_status FROM sm_src),
sm_m AS (SELECT DISTINCT ship_mode FROM sm_src),
sm_c AS (SELECT delivery_status, ship_mode, count(*) AS n FROM sm_src GROUP BY 1, 2)"""
q("status_mode_matrix", """
SELECT s.delivery_status, m.ship_mode, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM sm_s s CROSS JOIN sm_m m
LEFT JOIN sm_c c ON c.delivery_status = s.delivery_status AND c.ship_mode = m.ship_mode""",
  ",\n" + _SM)
q("category_quadrants", f"""
SELECT category, {_cents('sales')} AS total_sales, {_cents('profit')} AS total_profit,
       round(margin_pct, 6) AS margin_pct, round(share_pct, 6) AS share_pct,
       round(avg(margin_pct) OVER (), 6) AS avg_margin_pct,
       round(avg(share_pct) OVER (), 6) AS avg_share_pct
FROM (SELECT category, sales, profit,
             CASE WHEN sales <> 0 THEN profit / sales * 100 END AS margin_pct,
             sales / sum(sales) OVER () * 100 AS share_pct
      FROM (SELECT * FROM cat ORDER BY sales DESC, category LIMIT 15))""")
q("champion_categories", f"""
SELECT category, {_cents('sales')} AS total_sales, {_cents('profit')} AS total_profit,
       round(CASE WHEN sales <> 0 THEN profit / sales * 100 END, 6) AS margin_pct,
       CAST(row_number() OVER (ORDER BY profit DESC, category) AS BIGINT) AS rank
FROM (SELECT * FROM cat ORDER BY profit DESC, category LIMIT 5)""")
q("best_ticket_category", """
SELECT category, round(sales / n, 6) AS avg_ticket FROM cat
ORDER BY sales / n DESC NULLS LAST, category LIMIT 1""")


def _fmt(expr: str, spec: str) -> str:
    return f"coalesce(format('{{:{spec}}}', {expr}), 'nan')"


q("insights", f"""
SELECT position, severity, label || ' ' || relation || ' ' || bound AS title,
       label || ': ' || value || ', limit ' || bound AS message
FROM (
  SELECT 1, 'success', 'Profit margin (%)', {_fmt('margin_pct', '.1f')}, 'above', '15',
         coalesce(margin_pct > 15, false) FROM kpi
  UNION ALL SELECT 1, 'warning', 'Profit margin (%)', {_fmt('margin_pct', '.1f')}, 'not above', '15',
         NOT coalesce(margin_pct > 15, false) FROM kpi
  UNION ALL SELECT 2, 'danger', 'Late deliveries (%)', {_fmt('late_rate', '.1f')}, 'above', '10',
         late_rate > 10 FROM kpi
  UNION ALL SELECT 2, 'success', 'Late deliveries (%)', {_fmt('late_rate', '.1f')}, 'below', '5',
         late_rate < 5 FROM kpi
  UNION ALL SELECT 3, 'warning', 'Oil price deviation', {_fmt('oil_std', '.2f')}, 'above', '10',
         oil_std > 10 FROM kpi) AS r(position, severity, label, value, relation, bound, fires)
WHERE fires""", _ctes)
q("prompt_context", f"""
SELECT section, position, label, value FROM (
  SELECT 'executive' AS section, 1 AS position, 'Revenue' AS label, '$ ' || {_fmt('total_sales', ',.0f')} AS value FROM kpi
  UNION ALL SELECT 'executive', 2, 'Margin', {_fmt('margin_pct', '.1f')} || '%' FROM kpi
  UNION ALL SELECT 'executive', 3, 'Profit', '$ ' || {_fmt('total_profit', ',.0f')} FROM kpi
  UNION ALL SELECT 'executive', 4, 'Trend', {_fmt('sales_trend_pct', '+.1f')} || '%' FROM kpi
  UNION ALL SELECT 'executive', 5, 'Top category', coalesce(top_category, 'N/A') FROM kpi
  UNION ALL SELECT 'executive', 6, 'Worst category', coalesce(worst_category, 'N/A') FROM kpi
  UNION ALL SELECT 'logistics', 1, 'Late rate', {_fmt('late_rate', '.1f')} || '%' FROM kpi
  UNION ALL SELECT 'logistics', 2, 'On-time rate', {_fmt('on_time_rate', '.1f')} || '%' FROM kpi
  UNION ALL SELECT 'logistics', 3, 'Oil average', '$ ' || {_fmt('oil_avg', '.2f')} FROM kpi
  UNION ALL SELECT 'logistics', 4, 'Oil volatility', '±' || {_fmt('oil_std', '.1f')} FROM kpi
  UNION ALL SELECT 'commercial', 1, 'Average ticket', '$ ' || {_fmt('avg_ticket', '.2f')} FROM kpi
  UNION ALL SELECT 'commercial', 2, 'Margin', {_fmt('margin_pct', '.1f')} || '%' FROM kpi
  UNION ALL SELECT 'commercial', 3, 'Top product', coalesce(top_category, 'N/A') FROM kpi
  UNION ALL SELECT 'commercial', 4, 'Total orders', {_fmt('total_orders', ',')} FROM kpi)""", _ctes)
SQL["silver_from_csv"] = SQL["silver"]

_PRICES = f"""prices AS (
  SELECT date_trunc('week', o_orderdate)::TIMESTAMP AS price_day,
         round(avg(o_totalprice) / 1000, 2) AS price
  FROM orders GROUP BY 1
),
days AS (
  SELECT date_trunc('day', full_date)::TIMESTAMP AS day, {_exact('sales')} AS total_sales
  FROM flat WHERE full_date IS NOT NULL GROUP BY 1
),
days_px AS (
  SELECT d.day, d.total_sales, p.price_day, p.price
  FROM days d ASOF LEFT JOIN prices p ON d.day >= p.price_day
)"""
q("price_asof_sales", f"""
SELECT day, {_cents('total_sales')} AS total_sales,
       price_day, round(price, 6) AS price FROM days_px""", ",\n" + _PRICES)
q("sales_price_corr", """
SELECT CAST(count(price) AS BIGINT) AS days, round(corr(total_sales, price), 6) AS corr_sales_price
FROM days_px""", ",\n" + _PRICES)
q("price_sensitivity", """
SELECT category, order_region, CAST(count(price) AS BIGINT) AS n,
       round(corr(sales, price), 6) AS corr_sales_price,
       round(regr_slope(sales, price), 6) AS slope_sales_price,
       round(corr(profit, price), 6) AS corr_profit_price
FROM (SELECT s.category, s.order_region, s.sales, s.profit, p.price
      FROM (SELECT *, date_trunc('day', order_ts)::TIMESTAMP AS day FROM silver
            WHERE order_ts IS NOT NULL) s
      ASOF LEFT JOIN prices p ON s.day >= p.price_day)
GROUP BY category, order_region""", ",\n" + _PRICES)
SQL["silver_stream"] = SQL["silver"]
SQL["batch_from_files"] = SQL["gold_audit"]
SQL["landed_quote"] = SQL["latest_quote"]
SQL["quality_report_now"] = SQL["quality_report"].replace(
    f"TIMESTAMP '{AS_OF}'", "current_timestamp::TIMESTAMP")
#: Ship modes of the derived order lines, one column each.
_MODES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
q("status_mode_matrix_wide", "SELECT delivery_status, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE ship_mode = '{m}') AS BIGINT) AS \"{m}\"" for m in _MODES) + """
FROM flat WHERE delivery_status IS NOT NULL AND ship_mode IS NOT NULL
GROUP BY delivery_status""")


# The raw file as landed: every column as text under its raw header name.
_RAW_TEXT = ", ".join(
    f'{expr} AS "{raw}"' for raw, expr in (
        ("Category Name", "category"), ("Product Name", "product"),
        ("Customer City", "cust_city"), ("Customer State", "cust_state"),
        ("Customer Country", "cust_country"), ("Order City", "order_city"),
        ("Order State", "order_state"), ("Order Country", "order_country"),
        ("Order Region", "order_region"), ("Delivery Status", "delivery_status"),
        ("Shipping Mode", "ship_mode"),
        ("Days for shipping (real)", "CAST(ship_days_real AS VARCHAR)"),
        ("Days for shipment (scheduled)", "CAST(ship_days_sched AS VARCHAR)"),
        ("order date (DateOrders)", "strftime(order_ts, '%-m/%-d/%Y %-H:%M')"),
        ("shipping date (DateOrders)", "strftime(ship_ts, '%-m/%-d/%Y %-H:%M')"),
        ("Order Item Total", "CAST(sales AS VARCHAR)"),
        ("Order Profit Per Order", "CAST(profit AS VARCHAR)"),
        ("Sales per customer", "CAST(sales_per_customer AS VARCHAR)"),
        ("Benefit per order", "CAST(benefit AS VARCHAR)"),
        ("Order Id", "CAST(src_order_id AS VARCHAR)"),
        ("Product Card Id", "CAST(src_product_id AS VARCHAR)"),
        ("Customer Id", "CAST(src_customer_id AS VARCHAR)")))
q("bronze_csv_scan", f"SELECT {_RAW_TEXT} FROM bronze")
