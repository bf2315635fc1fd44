"""Parameters and fixed values.

Everything here is a plain parameter; jobs take them as keyword arguments so
tests can vary them.
"""

from __future__ import annotations

# --- fixed values that must equal the original tool's for equal results ---
# Base currency of the mart, default Top-N, search payload cap.
BASE_CCY = "THB"
TOP_N = 10
SEARCH_PAYLOAD_LIMIT = 500
SEARCH_UI_LIMIT = 8

# Region-like labels (exact, case-sensitive match => not a country).
REGION_LIKE_VALUES = (
    "Americas",
    "North America",
    "South America",
    "Europe",
    "Asia",
    "Africa",
    "Middle East",
    "Pacific",
    "Global",
    "Other",
    "Others",
    "Greater Asia",
    "Greater China",
    "Developed Markets",
    "Emerging Markets",
)
# Substrings (case-sensitive) that mark a label as region-like.
REGION_LIKE_TOKENS = (
    "Asia",
    "Europe",
    "America",
    "Pacific",
    "Global",
    "World",
    "Emerging",
    "Developed",
    "Middle East",
    "Africa",
    "Greater",
    "Other",
)

# Mapping labels and priorities.
MAP_FEEDER = "feeder_holding_isin"
MAP_FALLBACK = "thai_fund_isin_fallback"
MAP_PRIORITY = {MAP_FEEDER: 1, MAP_FALLBACK: 2}
TICKER_TYPE_PREF = {"Fund": 1, "ETF": 2}
DEFAULT_PRIORITY = 9

# FX status labels.
FX_STATUS_BASE = "base_currency"
FX_STATUS_EXACT_OR_LATEST = "exact_or_latest"
FX_STATUS_MISSING = "default_1_missing_fx"
FX_STATUS_NO_TABLE = "default_1_no_fx_table"
FX_STATUS_EXACT = "exact"
FX_STATUS_LATEST = "latest"
FX_DEFAULT_SYMBOLS = "THB,USD,EUR,JPY,GBP,CHF,AUD,CAD,CNY,HKD,SGD"
FX_DEFAULT_SOURCE = "open.er-api.com"

# Quality thresholds.
WEIGHT_SUM_TOLERANCE = 100.5
CARD_TOTAL_TOLERANCE = 1.0
FX_MISSING_MAX_PCT = 5.0
FX_STALE_MAX_DAYS = 3

# Mart tables the quality gate requires (12 names).
REQUIRED_MART_TABLES = (
    "bridge_thai_master",
    "fact_effective_exposure_stock",
    "fact_effective_exposure_sector",
    "fact_effective_exposure_region",
    "agg_top_holdings",
    "agg_top_holdings_topn",
    "agg_sector_exposure",
    "agg_sector_exposure_topn",
    "agg_country_exposure",
    "agg_country_exposure_topn",
    "agg_region_exposure",
    "agg_dashboard_cards",
)
# Smoke test: table -> minimum row count.
SMOKE_MIN_ROWS = (
    ("bridge_thai_master", 1),
    ("fact_effective_exposure_stock", 1),
    ("fact_effective_exposure_sector", 1),
    ("fact_effective_exposure_region", 1),
    ("agg_top_holdings", 1),
    ("agg_dashboard_cards", 1),
)

# Star-schema constants.
STOCK_TYPE_TH = "TH"
STOCK_TYPE_FOREIGN = "FOREIGN"
STOCK_TYPES = ("TH", "FOREIGN", "GOLD")
SCOPES = ("TH", "FOREIGN", "ALL")
INVESTMENT_METHODS = ("Direct", "Feeder Fund", "Other")
ITEM_TYPES = ("STOCK", "FUND")
ALLOC_TYPES = ("sector", "country", "asset_class", "other")
TH_COUNTRY = "Thailand"
FOREIGN_COUNTRY = "USA"
FOREIGN_SECTOR = "Global Sector"
MASTER_AMC = "Global AMC"
MASTER_CATEGORY = "Equity"
MASTER_KEYWORDS = ("FUND", "UNIT", "TRUST")
