"""DuckDB formulation of the loaders, bridge, NAV/FX and exposure stages.

Conventions shared with the Spark side:
* "first row per key" ties are broken by the remaining columns ascending,
  nulls first (Spark compares the packed row struct that way);
* money / weight sums use exact DECIMAL(38,0) accumulators for whole parts and fractions: dsum(x);
* strip = remove leading/trailing whitespace.
"""

from . import adapters  # noqa: F401  (registers the adapter blocks)
from .ctes import define


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def dsum(x: str) -> str:
    v = f"CAST({x} AS DOUBLE)"
    whole = f"CAST(sum(CAST({v} - {v} % 1.0::DOUBLE AS DECIMAL(38,0))) AS DOUBLE)"
    units = f"CAST(floor(({v} % 1.0::DOUBLE) * 1000000000000.0::DOUBLE + 0.5::DOUBLE) AS DECIMAL(38,0))"
    return f"({whole} + CAST(sum({units}) AS DOUBLE) / 1000000000000.0::DOUBLE)"


def f0(x: str) -> str:
    return f"coalesce(TRY_CAST({x} AS DOUBLE), 0.0::DOUBLE)"


def latest_snapshot(table: str, key: str, date: str, cols: str) -> str:
    return f"""
SELECT {cols} FROM (SELECT * FROM {table} WHERE {key} IS NOT NULL AND {date} IS NOT NULL) h
JOIN (SELECT {key} AS _k, max({date}) AS _d FROM {table} WHERE {key} IS NOT NULL AND {date} IS NOT NULL GROUP BY {key}) l
  ON h.{key} = l._k AND h.{date} = l._d"""


define("o_thai_funds", "SELECT fund_code, full_name_th, full_name_en, amc, category, currency, country FROM funds_master_info")

define("o_thai_isin", """
SELECT fund_code, upper(trim(code)) AS isin_code FROM funds_codes
WHERE upper(type) = 'ISIN' AND code IS NOT NULL AND trim(code) <> ''""")

define("o_thai_nav_aum", """
SELECT fund_code, nav_date AS nav_as_of_date, aum FROM (
  SELECT *, row_number() OVER (PARTITION BY fund_code
      ORDER BY (aum IS NULL), nav_date DESC NULLS LAST, daily_id DESC NULLS LAST) AS rn
  FROM funds_daily) WHERE rn = 1""")

define("o_thai_feeder", latest_snapshot(
    "funds_holding", "fund_code", "as_of_date",
    "h.fund_code, h.name AS feeder_name, h.percent AS feeder_weight_pct, h.as_of_date")
    + "\nWHERE upper(h.type) = 'FUND'")

define("o_ft_static", """
SELECT ft_ticker, ticker, name, ticker_type, isin_number, date_scraper, assets_aum_full_value FROM (
  SELECT ft_ticker, ticker, name, ticker_type, upper(trim(isin_number)) AS isin_number, date_scraper,
         assets_aum_full_value, created_at,
         row_number() OVER (PARTITION BY ft_ticker ORDER BY date_scraper DESC NULLS LAST, created_at DESC NULLS LAST,
             ticker NULLS FIRST, name NULLS FIRST, ticker_type NULLS FIRST) AS rn
  FROM ft_static_detail WHERE ft_ticker IS NOT NULL) WHERE rn = 1""")

define("o_ft_holdings", latest_snapshot(
    "ft_holdings", "ticker", "date_scraper",
    "h.ticker, h.holding_name, h.holding_ticker, h.holding_type, h.portfolio_weight_pct, h.date_scraper")
    + "\nWHERE lower(h.allocation_type) = 'top_10_holdings'")

define("o_ft_sector", latest_snapshot(
    "ft_sector_allocation", "ticker", "date_scraper",
    "h.ticker, h.category_name, h.weight_pct, h.date_scraper"))

define("o_ft_region", latest_snapshot(
    "(SELECT ticker, region_name AS category_name, region_weight_pct AS weight_pct, date_scraper FROM ft_region_allocation)",
    "ticker", "date_scraper", "h.ticker, h.category_name, h.weight_pct, h.date_scraper"))

define("o_ft_return", """
SELECT ft_ticker, ticker, avg_fund_return_1y, avg_fund_return_3y, date_scraper FROM (
  SELECT *, row_number() OVER (PARTITION BY ft_ticker ORDER BY date_scraper DESC NULLS LAST, created_at DESC NULLS LAST,
      ticker NULLS FIRST, avg_fund_return_1y NULLS FIRST, avg_fund_return_3y NULLS FIRST) AS rn
  FROM ft_avg_fund_return) WHERE rn = 1""")

define("o_fx_rates", """
SELECT date_rate, upper(trim(from_ccy)) AS from_ccy, upper(trim(to_ccy)) AS to_ccy, rate_to_thb, source_system
FROM daily_fx_rates WHERE upper(trim(to_ccy)) = 'THB'""")

# ---- bridge ----
TOKEN_RE = "'\\(([^()]*)\\)\\s*$'"
define("o_feeder_tok", f"""
SELECT fund_code, feeder_name, feeder_weight_pct, as_of_date, token,
       CASE WHEN regexp_full_match(coalesce(replace(token, ' ', ''), ''), '[A-Z0-9]{{12}}') THEN replace(token, ' ', '') END AS token_isin
FROM (SELECT *, CASE WHEN regexp_matches(s, {TOKEN_RE})
                     THEN nullif(upper({strip(f"regexp_extract(s, {TOKEN_RE}, 1)")}), '') END AS token
      FROM (SELECT *, {strip('feeder_name')} AS s FROM o_thai_feeder))""")

define("o_static_ready", f"""
SELECT ft_ticker, ticker, name, ticker_type, upper({strip("coalesce(isin_number, '')")}) AS isin_number,
       assets_aum_full_value FROM o_ft_static""")

define("o_bridge_feeder", """
SELECT f.fund_code, f.feeder_name, f.feeder_weight_pct, f.as_of_date, f.token, f.token_isin,
       s.ft_ticker, s.ticker, s.name, s.ticker_type, 'feeder_holding_isin' AS map_method
FROM o_feeder_tok f LEFT JOIN o_static_ready s ON f.token_isin = s.isin_number""")

define("o_bridge_fallback", f"""
SELECT fund_code, name AS feeder_name, 100.0::DOUBLE AS feeder_weight_pct, NULL::DATE AS as_of_date,
       NULL::VARCHAR AS token, isin_code AS token_isin, ft_ticker, ticker, name, ticker_type,
       'thai_fund_isin_fallback' AS map_method
FROM (SELECT m.*, row_number() OVER (PARTITION BY fund_code ORDER BY pref, aum DESC NULLS LAST, ft_ticker NULLS LAST,
             isin_code NULLS FIRST) AS rn
      FROM (SELECT i.fund_code, i.isin_code, s.ft_ticker, s.ticker, s.name, s.ticker_type,
                   {f0('s.assets_aum_full_value')} AS aum,
                   CASE s.ticker_type WHEN 'Fund' THEN 1 WHEN 'ETF' THEN 2 ELSE 9 END AS pref
            FROM o_thai_isin i JOIN o_static_ready s ON i.isin_code = s.isin_number
            WHERE NOT EXISTS (SELECT 1 FROM o_bridge_feeder b WHERE b.ft_ticker IS NOT NULL AND b.fund_code = i.fund_code)) m)
WHERE rn = 1""")

BRIDGE_COLS = ("fund_code, feeder_name, feeder_weight_pct, as_of_date, token, token_isin, ft_ticker, ticker, "
               "name, ticker_type, map_method")
define("o_bridge", f"""
SELECT {BRIDGE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY fund_code, ft_ticker ORDER BY priority,
      feeder_name NULLS FIRST, feeder_weight_pct NULLS FIRST, as_of_date NULLS FIRST, token NULLS FIRST,
      token_isin NULLS FIRST, ticker NULLS FIRST, name NULLS FIRST, ticker_type NULLS FIRST, map_method NULLS FIRST) AS rn
  FROM (SELECT fund_code, feeder_name, {f0('feeder_weight_pct')} AS feeder_weight_pct, as_of_date, token, token_isin,
               ft_ticker, ticker, name, ticker_type, map_method,
               CASE map_method WHEN 'feeder_holding_isin' THEN 1 WHEN 'thai_fund_isin_fallback' THEN 2 ELSE 9 END AS priority
        FROM (SELECT {BRIDGE_COLS} FROM o_bridge_feeder UNION ALL SELECT {BRIDGE_COLS} FROM o_bridge_fallback)))
WHERE rn = 1""")

define("o_bridge_pos", f"""
SELECT fund_code, feeder_name, {f0('feeder_weight_pct')} AS feeder_weight_pct, as_of_date, token, token_isin,
       ft_ticker, ticker, name, ticker_type, map_method
FROM o_bridge WHERE ft_ticker IS NOT NULL AND {f0('feeder_weight_pct')} > 0""")

define("o_bridge_ok", f"""
SELECT b.*, coalesce((b.feeder_weight_pct / nullif(s.sum_w, 0.0::DOUBLE)) * least(s.sum_w, 100.0::DOUBLE), 0.0::DOUBLE)
       AS feeder_weight_pct_norm
FROM o_bridge_pos b
LEFT JOIN (SELECT fund_code, {dsum('feeder_weight_pct')} AS sum_w FROM o_bridge_pos GROUP BY fund_code) s
  ON b.fund_code = s.fund_code""")

# ---- NAV + FX ----
define("o_fund_ccy", f"""
SELECT fund_code, upper({strip("coalesce(currency, 'THB')")}) AS fund_currency FROM (
  SELECT fund_code, currency, row_number() OVER (PARTITION BY fund_code ORDER BY currency NULLS FIRST) AS rn
  FROM o_thai_funds) WHERE rn = 1""")

define("o_fx_clean", f"""
SELECT * FROM (SELECT TRY_CAST(date_rate AS DATE) AS date_rate, upper({strip("coalesce(from_ccy, '')")}) AS from_ccy,
                      TRY_CAST(rate_to_thb AS DOUBLE) AS rate_to_thb FROM o_fx_rates)
WHERE date_rate IS NOT NULL AND from_ccy <> '' AND rate_to_thb IS NOT NULL""")

define("o_fx_latest", """
SELECT from_ccy, date_rate, rate_to_thb FROM (
  SELECT *, row_number() OVER (PARTITION BY from_ccy ORDER BY date_rate DESC, rate_to_thb DESC) AS rn FROM o_fx_clean)
WHERE rn = 1""")

define("o_nav", f"""
SELECT fund_code, nav_as_of_date, coalesce(aum_native * fx_rate_to_thb, 0.0::DOUBLE) AS aum, aum_native, fund_currency,
       fx_rate_to_thb, fx_rate_date, fx_rate_status
FROM (
  SELECT n.fund_code, n.nav_as_of_date, n.aum_native, n.fund_currency,
         CASE WHEN n.fund_currency = 'THB' THEN 1.0::DOUBLE WHEN c.cnt = 0 THEN 1.0::DOUBLE
              ELSE coalesce(x.rate_to_thb, l.rate_to_thb, 1.0::DOUBLE) END AS fx_rate_to_thb,
         CASE WHEN c.cnt = 0 THEN n.nav_as_of_date
              ELSE coalesce(CASE WHEN x.rate_to_thb IS NOT NULL THEN x.date_rate ELSE l.date_rate END, n.nav_as_of_date)
         END AS fx_rate_date,
         CASE WHEN c.cnt = 0 THEN 'default_1_no_fx_table' WHEN n.fund_currency = 'THB' THEN 'base_currency'
              WHEN x.rate_to_thb IS NULL AND l.rate_to_thb IS NULL THEN 'default_1_missing_fx'
              ELSE 'exact_or_latest' END AS fx_rate_status
  FROM (SELECT a.fund_code, TRY_CAST(a.nav_as_of_date AS DATE) AS nav_as_of_date, {f0('a.aum')} AS aum_native,
               coalesce(fc.fund_currency, 'THB') AS fund_currency
        FROM o_thai_nav_aum a LEFT JOIN o_fund_ccy fc ON a.fund_code = fc.fund_code) n
  LEFT JOIN o_fx_clean x ON x.from_ccy = n.fund_currency AND x.date_rate = n.nav_as_of_date
  LEFT JOIN o_fx_latest l ON l.from_ccy = n.fund_currency
  CROSS JOIN (SELECT count(*) AS cnt FROM o_fx_rates) c)""")

define("o_stg_nav", """
SELECT fund_code, nav_as_of_date, aum_native, fund_currency FROM (
  SELECT *, row_number() OVER (PARTITION BY fund_code ORDER BY nav_as_of_date NULLS FIRST, aum_native NULLS FIRST,
                                fund_currency NULLS FIRST) AS rn FROM o_nav) WHERE rn = 1""")

# ---- exposure facts ----
define("o_holdings_dedup", f"""
SELECT ticker, holding_name, holding_ticker, holding_type, date_scraper,
       max({f0('portfolio_weight_pct')}) AS portfolio_weight_pct
FROM o_ft_holdings
WHERE ticker IS NOT NULL AND holding_name IS NOT NULL AND holding_ticker IS NOT NULL AND holding_type IS NOT NULL
  AND date_scraper IS NOT NULL
GROUP BY ticker, holding_name, holding_ticker, holding_type, date_scraper""")

NAV_COLS = "n.aum_native, n.fund_currency, n.fx_rate_to_thb, n.fx_rate_date, n.fx_rate_status, n.nav_as_of_date"
define("o_stock", f"""
SELECT *, CASE WHEN holding_ticker_norm <> '' THEN holding_ticker_norm ELSE holding_name_norm END AS holding_key FROM (
  SELECT b.fund_code, b.ft_ticker, b.ticker, b.map_method, b.feeder_name, b.feeder_weight_pct, b.feeder_weight_pct_norm,
         h.holding_name, h.holding_ticker, h.holding_type, h.portfolio_weight_pct,
         (b.feeder_weight_pct_norm * h.portfolio_weight_pct) / 100.0::DOUBLE AS true_weight_pct,
         {f0('n.aum')} AS aum, {NAV_COLS},
         coalesce(({f0('n.aum')} * ((b.feeder_weight_pct_norm * h.portfolio_weight_pct) / 100.0::DOUBLE)) / 100.0::DOUBLE,
                  0.0::DOUBLE) AS true_value_thb,
         h.date_scraper,
         upper({strip("coalesce(h.holding_ticker, '')")}) AS holding_ticker_norm,
         upper({strip("coalesce(h.holding_name, '')")}) AS holding_name_norm
  FROM o_bridge_ok b JOIN o_holdings_dedup h ON b.ticker = h.ticker
  LEFT JOIN o_nav n ON b.fund_code = n.fund_code)""")


def alloc_fact(name: str, src: str, label: str, weight: str, extra: str = "") -> None:
    define(name, f"""
SELECT b.fund_code, b.ft_ticker, b.ticker, b.map_method, a.category_name AS {label}, a.weight_pct AS {weight},
       b.feeder_weight_pct, b.feeder_weight_pct_norm,
       (b.feeder_weight_pct_norm * a.weight_pct) / 100.0::DOUBLE AS true_weight_pct,
       {f0('n.aum')} AS aum, {NAV_COLS},
       coalesce(({f0('n.aum')} * ((b.feeder_weight_pct_norm * a.weight_pct) / 100.0::DOUBLE)) / 100.0::DOUBLE,
                0.0::DOUBLE) AS true_value_thb,
       a.date_scraper{extra}
FROM o_bridge_ok b
JOIN (SELECT ticker, category_name, date_scraper, max({f0('weight_pct')}) AS weight_pct FROM {src}
      WHERE ticker IS NOT NULL AND category_name IS NOT NULL AND date_scraper IS NOT NULL
      GROUP BY ticker, category_name, date_scraper) a ON b.ticker = a.ticker
LEFT JOIN o_nav n ON b.fund_code = n.fund_code""")


def is_country(x: str) -> str:
    from .. import config

    vals = ", ".join("'" + v + "'" for v in config.REGION_LIKE_VALUES)
    s = strip(x)
    toks = " OR ".join(f"contains({s}, '{t}')" for t in config.REGION_LIKE_TOKENS)
    return (f"CASE WHEN {x} IS NULL OR {s} = '' THEN false "
            f"ELSE NOT ({s} IN ({vals})) AND NOT ({toks}) END")


alloc_fact("o_sector", "o_ft_sector", "sector_name", "sector_weight_pct")
alloc_fact("o_region", "o_ft_region", "region_name", "region_weight_pct",
           ",\n       " + is_country("a.category_name") + " AS is_country_like")

# ---- aggregates ----
define("o_top_unranked", f"""
SELECT holding_key, nullif(holding_ticker_norm, '') AS holding_ticker, holding_type,
       {dsum('true_weight_pct')} AS total_true_weight_pct, {dsum('true_value_thb')} AS total_true_value_thb,
       first(holding_name ORDER BY fund_code, ft_ticker, holding_name) AS holding_name
FROM o_stock WHERE holding_key IS NOT NULL AND holding_ticker_norm IS NOT NULL AND holding_type IS NOT NULL
GROUP BY holding_key, holding_ticker_norm, holding_type""")

HOLDING_ORDER = ("total_true_value_thb DESC NULLS LAST, total_true_weight_pct DESC NULLS LAST, "
                 "holding_key NULLS LAST, holding_ticker NULLS LAST, holding_type NULLS LAST")
define("o_top_holdings", f"""
SELECT *, row_number() OVER (ORDER BY {HOLDING_ORDER}) AS rank_no FROM o_top_unranked""")

define("o_sector_agg", f"""
SELECT g.*, CASE WHEN t.total <> 0 THEN g.total_true_value_thb / t.total * 100.0::DOUBLE ELSE 0.0::DOUBLE END
       AS allocation_share_pct
FROM (SELECT sector_name, {dsum('true_weight_pct')} AS total_true_weight_pct, {dsum('true_value_thb')} AS total_true_value_thb
      FROM o_sector WHERE sector_name IS NOT NULL GROUP BY sector_name) g
CROSS JOIN (SELECT {dsum('total_true_value_thb')} AS total FROM (SELECT sector_name, {dsum('true_value_thb')} AS total_true_value_thb
      FROM o_sector WHERE sector_name IS NOT NULL GROUP BY sector_name)) t""")

define("o_region_agg", f"""
SELECT region_name, is_country_like, {dsum('true_weight_pct')} AS total_true_weight_pct,
       {dsum('true_value_thb')} AS total_true_value_thb
FROM o_region WHERE region_name IS NOT NULL AND is_country_like IS NOT NULL GROUP BY region_name, is_country_like""")

define("o_country_agg", f"""
SELECT g.*, CASE WHEN t.total <> 0 THEN g.total_true_value_thb / t.total * 100.0::DOUBLE ELSE 0.0::DOUBLE END
       AS allocation_share_pct
FROM (SELECT * FROM o_region_agg WHERE is_country_like) g
CROSS JOIN (SELECT {dsum('total_true_value_thb')} AS total FROM o_region_agg WHERE is_country_like) t""")

# ---- serving view with as-of FX (correlated MAX subquery, as written in the view) ----
define("o_vw_nav", """
SELECT n.fund_code, n.nav_as_of_date, n.fund_currency, n.aum_native,
       CASE WHEN n.fund_currency = 'THB' THEN 1.0::DOUBLE
            ELSE coalesce(x.rate_to_thb, a.rate_to_thb, 1.0::DOUBLE) END AS fx_rate_to_thb,
       n.aum_native * (CASE WHEN n.fund_currency = 'THB' THEN 1.0::DOUBLE
            ELSE coalesce(x.rate_to_thb, a.rate_to_thb, 1.0::DOUBLE) END) AS aum_thb,
       CASE WHEN n.fund_currency = 'THB' THEN 'base_currency'
            WHEN x.rate_to_thb IS NOT NULL THEN 'exact'
            WHEN a.rate_to_thb IS NOT NULL THEN 'latest'
            ELSE 'default_1_missing_fx' END AS fx_rate_status
FROM o_stg_nav n
LEFT JOIN o_fx_rates x ON x.from_ccy = n.fund_currency AND x.to_ccy = 'THB' AND x.date_rate = n.nav_as_of_date
LEFT JOIN o_fx_rates a ON a.from_ccy = n.fund_currency AND a.to_ccy = 'THB'
     AND a.date_rate = (SELECT max(f2.date_rate) FROM o_fx_rates f2
                        WHERE f2.from_ccy = n.fund_currency AND f2.to_ccy = 'THB' AND f2.date_rate <= n.nav_as_of_date)""")

define("o_coverage", f"""
SELECT ft.fund_code, ft.raw_total_fund_holdings_pct, ft.total_fund_holdings_pct,
       coalesce(mp.mapped_holdings_pct, 0.0::DOUBLE) AS mapped_holdings_pct,
       CASE WHEN coalesce(mp.mapped_holdings_pct, 0.0::DOUBLE) / nullif(ft.total_fund_holdings_pct, 0.0::DOUBLE) IS NOT NULL
            THEN least(greatest(coalesce(mp.mapped_holdings_pct, 0.0::DOUBLE) / nullif(ft.total_fund_holdings_pct, 0.0::DOUBLE),
                                0.0::DOUBLE), 1.0::DOUBLE) END AS coverage_ratio,
       n.nav_as_of_date, n.aum, n.aum_native, n.fund_currency, n.fx_rate_to_thb, n.fx_rate_date, n.fx_rate_status
FROM (SELECT fund_code, raw_total_fund_holdings_pct, least(raw_total_fund_holdings_pct, 100.0::DOUBLE) AS total_fund_holdings_pct
      FROM (SELECT fund_code, {dsum(f0('feeder_weight_pct'))} AS raw_total_fund_holdings_pct
            FROM o_thai_feeder WHERE fund_code IS NOT NULL GROUP BY fund_code)) ft
LEFT JOIN (SELECT fund_code, {dsum('feeder_weight_pct_norm')} AS mapped_holdings_pct FROM o_bridge_ok GROUP BY fund_code) mp
  ON ft.fund_code = mp.fund_code
LEFT JOIN o_nav n ON ft.fund_code = n.fund_code""")

define("o_fund_ret", """
SELECT p.fund_code, p.ft_ticker, p.ticker, TRY_CAST(r.avg_fund_return_1y AS DOUBLE) AS avg_fund_return_1y,
       TRY_CAST(r.avg_fund_return_3y AS DOUBLE) AS avg_fund_return_3y, n.aum
FROM (SELECT DISTINCT fund_code, ft_ticker, ticker FROM o_bridge_ok) p
LEFT JOIN o_ft_return r ON p.ft_ticker = r.ft_ticker AND p.ticker IS NOT DISTINCT FROM r.ticker
LEFT JOIN o_nav n ON p.fund_code = n.fund_code""")


def wavg(c: str) -> str:
    ok = f"{c} IS NOT NULL AND aum IS NOT NULL AND aum > 0"
    return (f"{dsum(f'CASE WHEN {ok} THEN {c} * aum END')} / "
            f"nullif({dsum(f'CASE WHEN {ok} THEN aum END')}, 0.0::DOUBLE)")


define("o_avg_return", f"""
SELECT {wavg('avg_fund_return_1y')} AS avg_fund_return_1y, {wavg('avg_fund_return_3y')} AS avg_fund_return_3y
FROM o_fund_ret""")

define("o_cards", f"""
SELECT coalesce(t.total, 0.0::DOUBLE) AS total_holdings_value_thb,
       s.sector_name AS top_sector_name, s.allocation_share_pct AS top_sector_weight_pct,
       c.region_name AS top_country_name, c.allocation_share_pct AS top_country_weight_pct,
       r.avg_fund_return_1y, r.avg_fund_return_3y,
       k.mapped_fund_count, k.mapped_master_count
FROM (SELECT {dsum('true_value_thb')} AS total FROM o_stock) t
LEFT JOIN (SELECT * FROM o_sector_agg ORDER BY total_true_value_thb DESC NULLS LAST, sector_name NULLS LAST LIMIT 1) s ON true
LEFT JOIN (SELECT * FROM o_country_agg ORDER BY total_true_value_thb DESC NULLS LAST, region_name NULLS LAST LIMIT 1) c ON true
CROSS JOIN o_avg_return r
CROSS JOIN (SELECT count(DISTINCT fund_code) AS mapped_fund_count, count(DISTINCT ft_ticker) AS mapped_master_count
            FROM o_bridge_ok) k""")

# Same NAV stage with the FX table absent (empty source).
define("o_nofx_rates", "SELECT * FROM o_fx_rates WHERE false")
for _name in ("o_fx_clean", "o_fx_latest", "o_nav"):
    from .ctes import CTE as _C

    _body = _C[_name][0].replace("o_fx_rates", "o_nofx_rates").replace("o_fx_clean", "o_nofx_clean").replace(
        "o_fx_latest", "o_nofx_latest")
    define(_name.replace("o_fx_", "o_nofx_").replace("o_nav", "o_nav_nofx"), _body)
