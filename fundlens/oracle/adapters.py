"""DuckDB formulation of the test-data adapter (see fundlens.sources.testdata)."""

from .ctes import define

define("funds_master_info", """
SELECT 'F' || c.c_custkey AS fund_code,
       c.c_name AS full_name_th,
       replace(c.c_name, 'Customer#', 'Fund ') AS full_name_en,
       'AMC' || (c.c_custkey % 7) AS amc,
       c.c_mktsegment AS category,
       c.c_custkey % 8 + 1 AS risk_level,
       CASE c.c_nationkey % 6 WHEN 0 THEN 'THB' WHEN 1 THEN 'USD' WHEN 2 THEN ' eur '
            WHEN 3 THEN 'JPY' WHEN 4 THEN 'XXX' END AS currency,
       n.n_name AS country
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")

define("funds_codes", """
SELECT 'F' || c_custkey AS fund_code, 'AIMC' AS type, 'A' || c_custkey AS code FROM customer
UNION ALL
SELECT 'F' || c_custkey, 'ISIN', ' s' || lpad(CAST(c_custkey // 15 - (c_custkey // 15) % 2 AS VARCHAR), 11, '0')
FROM customer WHERE c_custkey % 3 = 0
UNION ALL
SELECT 'F' || c_custkey, 'ISIN', ' ' FROM customer WHERE c_custkey % 3 = 1
UNION ALL
SELECT 'F' || c_custkey, 'ISIN', 'S' || lpad(CAST((c_custkey + 30) // 15 - ((c_custkey + 30) // 15) % 2 AS VARCHAR), 11, '0')
FROM customer WHERE c_custkey % 15 = 0
""")

define("funds_performance", """
SELECT 'F' || c_custkey AS fund_code, c_acctbal / 100 AS total_return_1y FROM customer
""")

define("funds_daily", """
SELECT 'F' || o_custkey AS fund_code,
       CAST(DATE '2023-12-27' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 40 AS INTEGER) AS DATE) AS nav_date,
       o_totalprice / 10000 AS nav_value,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS aum,
       o_orderkey AS daily_id
FROM orders
""")

define("funds_holding", """
SELECT 'F' || o.o_custkey AS fund_code,
       CASE WHEN l.l_returnflag = 'A' OR l.l_partkey % 9 = 0 THEN NULL ELSE 'P' || l.l_partkey END AS symbol,
       CASE WHEN l.l_returnflag = 'A' THEN
              CASE l.l_suppkey % 4
                WHEN 0 THEN 'Supplier ' || l.l_suppkey
                WHEN 1 THEN 'Supplier ' || l.l_suppkey || ' (s' || lpad(CAST(l.l_suppkey - l.l_suppkey % 2 AS VARCHAR), 11, '0') || ')'
                WHEN 2 THEN 'Supplier ' || l.l_suppkey || ' (S ' || lpad(CAST(l.l_suppkey - l.l_suppkey % 2 AS VARCHAR), 11, '0') || ') '
                ELSE 'Supplier ' || l.l_suppkey || ' (x) (S' || lpad(CAST(l.l_suppkey - l.l_suppkey % 2 AS VARCHAR), 11, '0') || ')'
              END
            WHEN l.l_returnflag = 'R' THEN 'BANK ' || upper(p.p_name) || ' (CB' || l.l_partkey || ')'
            WHEN l.l_partkey % 2 = 0 THEN 'Stock ' || p.p_name || ' P' || l.l_partkey
            ELSE p.p_name END AS name,
       CASE l.l_returnflag WHEN 'A' THEN 'Fund' WHEN 'N' THEN 'Equity' ELSE 'Bond' END AS type,
       p.p_type AS sector,
       l.l_quantity AS percent,
       CAST(date_trunc('quarter', o.o_orderdate) AS DATE) AS as_of_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")

define("funds_allocations", """
SELECT 'F' || o.o_custkey AS fund_code,
       CASE WHEN p.p_size = 1 THEN '' WHEN l.l_linenumber % 2 = 1 THEN p.p_type ELSE p.p_brand END AS name,
       CASE WHEN l.l_linenumber = 7 THEN 'asset_alloc'
            WHEN l.l_linenumber % 2 = 1 THEN 'sector_alloc' ELSE 'country_alloc' END AS type,
       l.l_discount * 100 AS percent,
       CAST(date_trunc('quarter', o.o_orderdate) AS DATE) AS as_of_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")

define("ft_static_detail", """
SELECT 'FT' || l_suppkey AS ft_ticker,
       CASE WHEN l_suppkey % 17 <> 0 THEN 'T' || l_suppkey END AS ticker,
       'Master Fund ' || l_suppkey AS name,
       CASE l_suppkey % 3 WHEN 0 THEN 'Fund' WHEN 1 THEN 'ETF' ELSE 'Trust' END AS ticker_type,
       CASE WHEN l_suppkey % 10 <> 9 THEN ' s' || lpad(CAST(l_suppkey - l_suppkey % 2 AS VARCHAR), 11, '0') END AS isin_number,
       sum(l_extendedprice) AS assets_aum_full_value,
       CAST(l_shipdate AS DATE) AS date_scraper,
       max(l_shipdate) AS created_at
FROM lineitem
GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
""")

define("ft_holdings", """
SELECT 'T' || l.l_suppkey AS ticker,
       CASE WHEN l.l_linestatus = 'O' THEN 'top_10_holdings' ELSE 'other_holdings' END AS allocation_type,
       CASE WHEN p.p_partkey % 5 = 0 THEN p.p_name || 'B' || replace(p.p_brand, 'Brand#', '') || ':US' ELSE p.p_name END AS holding_name,
       CASE p.p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ' '
            WHEN 2 THEN ' b' || replace(p.p_brand, 'Brand#', '') || ':us '
            ELSE 'B' || replace(p.p_brand, 'Brand#', '') || ':US' END AS holding_ticker,
       p.p_type AS holding_type,
       l.l_discount * 100 AS portfolio_weight_pct,
       CAST(date_trunc('month', l.l_shipdate) AS DATE) AS date_scraper,
       l.l_shipdate AS created_at
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")

define("ft_sector_allocation", """
SELECT 'FT' || l.l_suppkey AS ft_ticker, 'T' || l.l_suppkey AS ticker,
       p.p_type AS category_name, l.l_discount * 100 AS weight_pct,
       CAST(date_trunc('month', l.l_shipdate) AS DATE) AS date_scraper
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
""")

define("ft_region_allocation", """
SELECT 'FT' || l.l_suppkey AS ft_ticker, 'T' || l.l_suppkey AS ticker,
       CASE WHEN l.l_linenumber = 1 THEN
              CASE r.r_name WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'Americas' WHEN 'ASIA' THEN 'Greater Asia'
                            WHEN 'EUROPE' THEN 'Europe' WHEN 'MIDDLE EAST' THEN 'Middle East' ELSE 'Other' END
            ELSE n.n_name END AS region_name,
       l.l_discount * 100 AS region_weight_pct,
       CAST(date_trunc('month', l.l_shipdate) AS DATE) AS date_scraper
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")

define("ft_avg_fund_return", """
SELECT 'FT' || g.l_suppkey AS ft_ticker,
       CASE WHEN g.l_suppkey % 17 <> 0 THEN 'T' || g.l_suppkey END AS ticker,
       s.s_acctbal / 1000 + g.yr % 10 AS avg_fund_return_1y,
       CASE WHEN g.l_suppkey % 5 <> 0 THEN s.s_acctbal / 2000 END AS avg_fund_return_3y,
       make_date(CAST(g.yr AS BIGINT), 12, 31) AS date_scraper,
       g.created_at
FROM (SELECT l_suppkey, year(l_shipdate) AS yr, max(l_shipdate) AS created_at
      FROM lineitem GROUP BY l_suppkey, year(l_shipdate)) g
LEFT JOIN supplier s ON g.l_suppkey = s.s_suppkey
""")

define("daily_fx_rates", """
SELECT date_rate,
       CASE event_type WHEN 'click' THEN 'USD' WHEN 'view' THEN 'EUR' WHEN 'purchase' THEN 'JPY'
                       WHEN 'signup' THEN 'GBP' ELSE 'THB' END AS from_ccy,
       'THB' AS to_ccy,
       s / n AS rate_to_thb,
       'events' AS source_system,
       updated_at
FROM (SELECT date_rate, event_type,
             CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS s,
             count(*) AS n, max(ts) AS updated_at
      FROM (SELECT *, CAST(ts AS DATE) - (CASE WHEN dayofmonth(CAST(ts AS DATE)) % 4 = 0 THEN 1 ELSE 0 END) AS date_rate FROM events)
      GROUP BY date_rate, event_type) e
""")
