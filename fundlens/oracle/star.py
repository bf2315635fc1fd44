"""DuckDB formulation of the star schema and the contract outputs."""

from . import stages  # noqa: F401
from .ctes import define
from .stages import dsum, latest_snapshot, strip

define("o_dim_funds", """
SELECT row_number() OVER (ORDER BY code NULLS LAST) AS id, * FROM (
  SELECT f.full_name_th AS name_th, f.full_name_en AS name_en, f.amc, f.category, f.fund_code AS code, f.risk_level,
         p.total_return_1y AS return_1y
  FROM (SELECT * FROM (SELECT *, row_number() OVER (
                         PARTITION BY fund_code ORDER BY full_name_th NULLS FIRST, full_name_en NULLS FIRST, amc NULLS FIRST,
                         category NULLS FIRST, risk_level NULLS FIRST) AS rn FROM funds_master_info) WHERE rn = 1) f
  LEFT JOIN (SELECT fund_code, max(total_return_1y) AS total_return_1y FROM funds_performance GROUP BY fund_code) p
    ON f.fund_code = p.fund_code)""")

define("o_thai_holdings", f"""
SELECT h.fund_code, d.id AS fund_id, h.symbol, h.name AS holding_name, h.sector, h.type,
       coalesce(CAST(h.percent AS DOUBLE), 0.0::DOUBLE) AS percent,
       coalesce(CAST(a.aum AS DOUBLE), 0.0::DOUBLE) AS aum,
       (coalesce(CAST(h.percent AS DOUBLE), 0.0::DOUBLE) * coalesce(CAST(a.aum AS DOUBLE), 0.0::DOUBLE)) / 100.0::DOUBLE AS value_thb,
       regexp_matches(upper(coalesce(h.type, '')), 'FUND|UNIT|TRUST') AS is_master,
       CAST(h.as_of_date AS DATE) AS as_of_date, coalesce(CAST(n.aum AS DOUBLE), 0.0::DOUBLE) AS nav_thb,
       (coalesce(CAST(h.percent AS DOUBLE), 0.0::DOUBLE) * coalesce(CAST(n.aum AS DOUBLE), 0.0::DOUBLE)) / 100.0::DOUBLE AS thb_value
FROM ({latest_snapshot('funds_holding', 'fund_code', 'as_of_date', 'h.*')}) h
LEFT JOIN o_thai_nav_aum a ON h.fund_code = a.fund_code
LEFT JOIN o_nav n ON h.fund_code = n.fund_code
JOIN o_dim_funds d ON h.fund_code = d.code""")

define("o_master_rows", f"SELECT *, {strip('holding_name')} AS m_name FROM o_thai_holdings WHERE is_master AND holding_name IS NOT NULL")

define("o_dim_master", """
SELECT row_number() OVER (ORDER BY name_en NULLS LAST) AS id, name_en, 'Global AMC' AS amc, 'Equity' AS category
FROM (SELECT DISTINCT m_name AS name_en FROM o_master_rows)""")

define("o_fact_master", """
SELECT r.fund_id, d.id AS master_fund_id, r.value_thb AS holding_value_thb, r.percent AS percent_nav
FROM o_master_rows r JOIN o_dim_master d ON r.m_name = d.name_en""")


def clean_stock(name: str, sym: str) -> str:
    n, s = strip(name), strip(sym)
    body = f"CASE WHEN {s} = '' THEN '' WHEN ends_with({n}, {s}) THEN {strip(f'left({n}, length({n}) - length({s}))')} ELSE {n} END"
    cleaned = strip(f"regexp_replace({body}, '[^A-Za-z0-9\\s.,&()\\-]', '', 'g')")
    return f"CASE WHEN {name} IS NULL OR {name} = '' OR {sym} IS NULL OR {sym} = '' THEN {name} ELSE {cleaned} END"


define("o_direct_rows", f"""
SELECT *, {clean_stock('holding_name', 'sym')} AS full_name FROM (
  SELECT *, CASE WHEN symbol IS NOT NULL AND trim(symbol) <> '' THEN upper(trim(symbol)) END AS sym
  FROM o_thai_holdings WHERE NOT is_master) WHERE sym IS NOT NULL""")

define("o_fx_holdings", """
SELECT fund_code, holding_name, holding_ticker_norm AS symbol, true_weight_pct AS pct_nav, true_value_thb AS holding_value_thb
FROM o_stock WHERE holding_ticker_norm IS NOT NULL AND holding_ticker_norm <> ''""")

define("o_dim_stocks", f"""
SELECT row_number() OVER (ORDER BY origin, symbol NULLS LAST) AS id, symbol, full_name, sector, stock_type,
       0.0::DOUBLE AS percent_change, country
FROM (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY origin, fund_code NULLS LAST, full_name NULLS LAST,
                                     sector NULLS LAST, stock_type NULLS FIRST, country NULLS FIRST) AS rn
        FROM (SELECT sym AS symbol, full_name, sector, 'TH' AS stock_type, 'Thailand' AS country, 0 AS origin, fund_code
              FROM o_direct_rows
              UNION ALL
              SELECT symbol, {clean_stock('holding_name', 'symbol')}, 'Global Sector', 'FOREIGN', 'USA', 1, fund_code
              FROM o_fx_holdings)) WHERE rn = 1)""")

define("o_fact_direct", """
SELECT r.fund_id, s.id AS stock_id, 1 AS ranking, r.value_thb AS holding_value_thb, r.aum AS nav_thb, r.percent AS percent_nav
FROM o_direct_rows r JOIN o_dim_stocks s ON r.sym = s.symbol""")

define("o_master_fund_holdings", """
SELECT fm.master_fund_id, s.id AS stock_id,
       first(coalesce(CAST(x.pct_nav AS DOUBLE), 0.0::DOUBLE)
             ORDER BY x.fund_code, x.holding_name, coalesce(CAST(x.pct_nav AS DOUBLE), 0.0::DOUBLE)) AS percent_weight
FROM o_fx_holdings x JOIN o_dim_funds f ON x.fund_code = f.code
JOIN (SELECT fund_id, min(master_fund_id) AS master_fund_id FROM o_fact_master GROUP BY fund_id) fm ON f.id = fm.fund_id
JOIN o_dim_stocks s ON x.symbol = s.symbol
GROUP BY fm.master_fund_id, s.id""")

define("o_alloc_latest", """
SELECT a.fund_code, a.type, a.name, a.percent, CAST(a.as_of_date AS DATE) AS as_of_date FROM funds_allocations a
JOIN (SELECT fund_code, type, max(as_of_date) AS d FROM funds_allocations
      WHERE type IN ('sector_alloc', 'country_alloc') AND fund_code IS NOT NULL AND as_of_date IS NOT NULL
      GROUP BY fund_code, type) l
  ON a.fund_code = l.fund_code AND a.type = l.type AND a.as_of_date = l.d
WHERE a.name IS NOT NULL AND trim(a.name) <> ''""")

define("o_alloc_rows", f"""
SELECT a.fund_code, d.id AS fund_id, lower({strip('a.type')}) AS alloc_type, {strip('a.name')} AS alloc_name,
       coalesce(CAST(a.percent AS DOUBLE), 0.0::DOUBLE) AS percentage, a.as_of_date
FROM o_alloc_latest a JOIN o_dim_funds d ON a.fund_code = d.code""")

define("o_top_thai", f"""
SELECT row_number() OVER (ORDER BY total_thai_fund_value DESC NULLS LAST, symbol NULLS LAST) AS rank_no, * FROM (
  SELECT g.sym AS symbol, g.total_thai_fund_value, g.total_weight_pct, g.fund_count, s.full_name, g.holding_type, g.as_of_date
  FROM (SELECT sym, min(type) AS holding_type, max(as_of_date) AS as_of_date, {dsum('thb_value')} AS total_thai_fund_value, {dsum('percent')} AS total_weight_pct,
               count(DISTINCT fund_code) AS fund_count FROM o_direct_rows GROUP BY sym) g
  LEFT JOIN o_dim_stocks s ON g.sym = s.symbol)""")

define("o_scoped_exposure", f"""
WITH th AS (
  SELECT 'TH' AS scope, dimension, name, {dsum('value_thb')} AS total_value_thb, {dsum('weight_pct')} AS total_weight_pct,
         max(as_of_date) AS as_of_date
  FROM (SELECT CASE WHEN a.alloc_type = 'sector_alloc' THEN 'sector' ELSE 'country' END AS dimension, a.alloc_name AS name,
               (a.percentage * coalesce(n.aum, 0.0::DOUBLE)) / 100.0::DOUBLE AS value_thb, a.percentage AS weight_pct, a.as_of_date
        FROM o_alloc_rows a
        LEFT JOIN (SELECT fund_code, coalesce(CAST(aum AS DOUBLE), 0.0::DOUBLE) AS aum FROM o_nav) n
          ON a.fund_code = n.fund_code)
  GROUP BY dimension, name),
nd AS (SELECT CAST(max(nav_as_of_date) AS DATE) AS as_of_date FROM o_stock),
fo AS (
  SELECT 'FOREIGN' AS scope, 'sector' AS dimension, sector_name AS name, total_true_value_thb AS total_value_thb,
         total_true_weight_pct AS total_weight_pct, as_of_date FROM o_sector_agg, nd
  UNION ALL
  SELECT 'FOREIGN', 'country', region_name, total_true_value_thb, total_true_weight_pct, as_of_date FROM o_country_agg, nd),
bo AS (SELECT * FROM th UNION ALL SELECT * FROM fo),
sc AS (SELECT * FROM bo
       UNION ALL
       SELECT 'ALL', dimension, name, {dsum('total_value_thb')}, {dsum('total_weight_pct')}, max(as_of_date) FROM bo GROUP BY dimension, name)
SELECT sc.*, CASE WHEN t.total <> 0 THEN sc.total_value_thb / t.total * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS allocation_share_pct
FROM sc JOIN (SELECT scope, dimension, {dsum('total_value_thb')} AS total FROM sc GROUP BY scope, dimension) t
  ON sc.scope = t.scope AND sc.dimension = t.dimension""")

define("o_scoped_cards", f"""
WITH top AS (
  SELECT scope, dimension, name, allocation_share_pct FROM (
    SELECT *, row_number() OVER (PARTITION BY scope, dimension ORDER BY total_value_thb DESC NULLS LAST, name NULLS LAST) AS rn
    FROM o_scoped_exposure) WHERE rn = 1),
th AS (SELECT fund_code, thb_value AS value_thb, as_of_date FROM o_thai_holdings),
fo AS (SELECT fund_code, true_value_thb AS value_thb, CAST(nav_as_of_date AS DATE) AS as_of_date FROM o_stock),
c AS (
  SELECT 'TH' AS scope, {dsum('value_thb')} AS total_value_thb, count(DISTINCT fund_code) AS fund_count,
         max(as_of_date) AS as_of_date FROM th
  UNION ALL
  SELECT 'FOREIGN', {dsum('value_thb')}, count(DISTINCT fund_code), max(as_of_date) FROM fo
  UNION ALL
  SELECT 'ALL', {dsum('value_thb')}, count(DISTINCT fund_code), max(as_of_date)
  FROM (SELECT * FROM th UNION ALL SELECT * FROM fo))
SELECT c.scope, coalesce(c.total_value_thb, 0.0::DOUBLE) AS total_value_thb, s.name AS top_sector_name,
       s.allocation_share_pct AS top_sector_weight_pct, k.name AS top_country_name,
       k.allocation_share_pct AS top_country_weight_pct, c.fund_count, c.as_of_date,
       CASE WHEN c.scope <> 'TH' THEN r.avg_fund_return_1y END AS avg_fund_return_1y,
       CASE WHEN c.scope <> 'TH' THEN r.avg_fund_return_3y END AS avg_fund_return_3y,
       CASE WHEN c.scope <> 'TH' THEN m.f END AS mapped_fund_count,
       CASE WHEN c.scope <> 'TH' THEN m.t END AS mapped_master_count
FROM c CROSS JOIN o_avg_return r
CROSS JOIN (SELECT count(DISTINCT fund_code) AS f, count(DISTINCT ft_ticker) AS t FROM o_bridge_ok) m
LEFT JOIN (SELECT * FROM top WHERE dimension = 'sector') s ON c.scope = s.scope
LEFT JOIN (SELECT * FROM top WHERE dimension = 'country') k ON c.scope = k.scope""")

SEARCH_COLS = ("min(holding_name) AS holding_name, max(aum) AS nav_thb, max(nav_as_of_date) AS as_of_date, "
               "'Feeder Fund' AS investment_method")
FUND_NAMES = "(SELECT fund_code, min(full_name_en) AS fund_name FROM funds_master_info GROUP BY fund_code)"

define("o_asset_to_funds", f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY holding_key ORDER BY value_thb DESC NULLS LAST, fund_code, map_method NULLS LAST) AS rank_no
  FROM (SELECT holding_key, fund_code, map_method, {dsum('true_value_thb')} AS value_thb, {dsum('true_weight_pct')} AS pct_nav,
               {SEARCH_COLS}
        FROM o_stock GROUP BY holding_key, fund_code, map_method) LEFT JOIN {FUND_NAMES} USING (fund_code))""")

define("o_fund_to_assets", f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY fund_code ORDER BY value_thb DESC NULLS LAST, holding_key) AS rank_no
  FROM (SELECT fund_code, holding_key, {dsum('true_value_thb')} AS value_thb, {dsum('true_weight_pct')} AS pct_nav,
               {SEARCH_COLS}
        FROM o_stock GROUP BY fund_code, holding_key) LEFT JOIN {FUND_NAMES} USING (fund_code))""")

define("o_stock_aggregates", f"""
SELECT symbol, (SELECT min(s.id) FROM o_dim_stocks s
                WHERE s.symbol = g.symbol OR split_part(upper({strip("s.symbol")}), ':', 1) = g.symbol) AS stock_id,
       coalesce(tv, 0.0::DOUBLE) AS thai_value_thb,
       coalesce(gv, 0.0::DOUBLE) AS global_value_thb,
       coalesce(tv, 0.0::DOUBLE) + coalesce(gv, 0.0::DOUBLE) AS total_exposure_thb,
       coalesce(tw, 0.0::DOUBLE) + coalesce(gw, 0.0::DOUBLE) AS total_weight_pct,
       fund_count,
       CASE WHEN tv IS NULL THEN 'GLOBAL' WHEN gv IS NULL THEN 'THAI' ELSE 'BOTH' END AS exposure_type
FROM (
  SELECT symbol, {dsum('CASE WHEN local THEN v END')} AS tv, {dsum('CASE WHEN NOT local THEN v END')} AS gv,
         {dsum('CASE WHEN local THEN w END')} AS tw, {dsum('CASE WHEN NOT local THEN w END')} AS gw,
         count(DISTINCT fund_code) AS fund_count
  FROM (
    SELECT sym AS symbol, fund_code, true AS local, thb_value AS v, percent AS w FROM o_direct_rows
    UNION ALL
    SELECT split_part(upper({strip("coalesce(symbol, '')")}), ':', 1), fund_code, false, holding_value_thb, pct_nav FROM o_fx_holdings)
  WHERE symbol IS NOT NULL
  GROUP BY symbol) g""")

define("o_suggestions", """
SELECT keyword, item_type, item_id, item_code, item_name, 100 AS priority FROM (
  SELECT code AS keyword, 'FUND' AS item_type, id AS item_id, code AS item_code, name_en AS item_name FROM o_dim_funds
  UNION ALL SELECT name_en, 'FUND', id, code, name_en FROM o_dim_funds
  UNION ALL SELECT symbol, 'STOCK', id, symbol, full_name FROM o_dim_stocks
  UNION ALL SELECT full_name, 'STOCK', id, symbol, full_name FROM o_dim_stocks)
WHERE keyword IS NOT NULL AND keyword <> ''""")

define("o_investment_method", f"""
SELECT investment_method, count(*) AS holding_rows, {dsum('thb_value')} AS total_value_thb FROM (
  SELECT CASE WHEN is_master THEN 'Feeder Fund'
              WHEN symbol IS NOT NULL AND trim(symbol) <> '' THEN 'Direct' ELSE 'Other' END AS investment_method,
         thb_value
  FROM o_thai_holdings) GROUP BY investment_method""")

define("o_fund_holdings", """
SELECT h.fund_id, s.id AS stock_id,
       row_number() OVER (PARTITION BY h.fund_id ORDER BY h.thb_value DESC NULLS LAST, h.symbol NULLS LAST,
                          h.holding_name NULLS LAST, h.type NULLS LAST, h.percent NULLS LAST) AS ranking,
       h.investment_method, h.thb_value AS holding_value_thb, h.nav_thb, h.percent AS pct_nav, h.as_of_date
FROM (SELECT *, CASE WHEN is_master THEN 'Feeder Fund'
                     WHEN symbol IS NOT NULL AND trim(symbol) <> '' THEN 'Direct' ELSE 'Other' END AS investment_method
      FROM o_thai_holdings) h
LEFT JOIN o_dim_stocks s ON h.investment_method = 'Direct' AND upper(trim(h.symbol)) = s.symbol""")
