"""API star schema (dimensions + facts) and contract outputs (G*)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.numeric import exact_sum, null_to_zero, share_pct
from ..functions.strings import clean_stock_name, extract_symbol, non_blank, normalize_ticker, strip_ws
from ..operators.distribution import attach_scalars, global_row_number, group_row_number
from ..operators.keys import assign_ids, extended
from ..operators.snapshots import asc, at_newest, desc, first_per_key, latest_snapshot


def latest_allocations(allocations: DataFrame) -> DataFrame:
    """J2 + P8 + P5: newest sector / country allocation per (fund, type);
    the type filter sits inside the latest-date computation."""
    a = allocations.where(F.col("type").isin("sector_alloc", "country_alloc"))
    snap = latest_snapshot(a, ["fund_code", "type"], "as_of_date")
    return snap.where(non_blank("name")).select(
        "fund_code", "type", "name", "percent", F.col("as_of_date").cast("date").alias("as_of_date"))


def classify_instrument(type_col: str = "type"):
    """FUND / UNIT / TRUST in upper(type) -> master-fund holding."""
    return F.upper(F.coalesce(F.col(type_col), F.lit(""))).rlike("|".join(config.MASTER_KEYWORDS))


class StarSchema:
    """3 dimensions + 5 facts from the local source and the mart.

    ``known`` holds the key dictionaries of an earlier build (table name ->
    natural key, id): their ids are kept, new keys continue after them."""

    KEYS = {"funds": "code", "master_funds": "name_en", "stocks": "symbol"}

    def __init__(self, m, known: Mapping[str, DataFrame] | None = None):
        self.m = m
        self.src: Mapping[str, DataFrame] = m.src
        self.known = dict(known or {})

    def _ids(self, table: str, rows: DataFrame, order) -> DataFrame:
        return assign_ids(rows, self.KEYS[table], order, self.known.get(f"{table}_keys"))

    def key_tables(self) -> dict[str, DataFrame]:
        """The key dictionaries after this build, for the next one."""
        dims = {"funds": self.dim_funds, "master_funds": self.dim_master_funds, "stocks": self.dim_stocks}
        return {f"{t}_keys": extended(self.known.get(f"{t}_keys"), d, self.KEYS[t]) for t, d in dims.items()}

    @cached_property
    def dim_funds(self) -> DataFrame:
        """A23 + J19 + W8."""
        fm = self.src["funds_master_info"].select(
            "fund_code", "full_name_th", "full_name_en", "amc", "category", "risk_level")
        perf = self.src["funds_performance"].select("fund_code", "total_return_1y")
        # repeated rows must not multiply funds
        fm = first_per_key(fm, ["fund_code"], [])
        perf = first_per_key(perf, ["fund_code"], [desc("total_return_1y")])
        j = fm.join(perf, "fund_code", "left")
        j = j.select(
            F.col("full_name_th").alias("name_th"), F.col("full_name_en").alias("name_en"), "amc", "category",
            F.col("fund_code").alias("code"), "risk_level", F.col("total_return_1y").alias("return_1y"),
        )
        return self._ids("funds", j, [F.col("code").asc_nulls_last()])

    @cached_property
    def thai_holdings(self) -> DataFrame:
        """J1 + J18 + J20: newest holdings of known funds with AUM and value.
        ``value_thb`` follows the fact's rule (native AUM); ``nav_thb`` and
        ``thb_value`` are converted, for outputs that add several funds."""
        h = at_newest(self.src["funds_holding"], ["fund_code"], "as_of_date", self.m.ds.holding_dates).select(
            "fund_code", "symbol", F.col("name").alias("holding_name"), "sector", "percent", "type",
            F.col("as_of_date").cast("date").alias("as_of_date"))
        aum = self.m.ds.thai_nav_aum.select("fund_code", "aum")
        nav = self.m.nav.select("fund_code", null_to_zero("aum").alias("nav_thb"))
        h = h.join(aum, "fund_code", "left").join(nav, "fund_code", "left")
        funds = self.dim_funds.select(F.col("code").alias("fund_code"), F.col("id").alias("fund_id"))
        h = h.join(funds, "fund_code", "inner")
        pct = null_to_zero("percent")
        aum0 = null_to_zero("aum")
        nav0 = null_to_zero("nav_thb")
        # read by five outputs: shared like the mart's own frames
        return self.m._keep(h.select(
            "fund_code", "fund_id", "symbol", "holding_name", "sector", "type",
            pct.alias("percent"), aum0.alias("aum"), ((pct * aum0) / 100.0).alias("value_thb"),
            classify_instrument("type").alias("is_master"), "as_of_date", nav0.alias("nav_thb"),
            ((pct * nav0) / 100.0).alias("thb_value"),
        ))

    @cached_property
    def master_rows(self) -> DataFrame:
        h = self.thai_holdings.where(F.col("is_master"))
        # Q14: a missing master name is dropped (not turned into text)
        return h.withColumn("m_name", strip_ws("holding_name")).where(F.col("holding_name").isNotNull())

    @cached_property
    def dim_master_funds(self) -> DataFrame:
        """A22 + W8."""
        names = self.master_rows.select(F.col("m_name").alias("name_en")).distinct()
        d = names.select("name_en", F.lit(config.MASTER_AMC).alias("amc"), F.lit(config.MASTER_CATEGORY).alias("category"))
        return self._ids("master_funds", d, [F.col("name_en").asc_nulls_last()])

    @cached_property
    def fact_master_holdings(self) -> DataFrame:
        """A25."""
        d = self.dim_master_funds.select(F.col("name_en").alias("m_name"), F.col("id").alias("master_fund_id"))
        j = self.master_rows.join(d, "m_name", "inner")
        return j.select("fund_id", "master_fund_id", F.col("value_thb").alias("holding_value_thb"),
                        F.col("percent").alias("percent_nav"))

    @cached_property
    def direct_rows(self) -> DataFrame:
        """C4 + C5 on direct holdings; rows without a symbol are skipped."""
        h = self.thai_holdings.where(~F.col("is_master"))
        h = h.withColumn("sym", extract_symbol("symbol", "symbol")).where(F.col("sym").isNotNull())
        return h.withColumn("full_name", clean_stock_name("holding_name", "sym"))

    @cached_property
    def fx_holdings(self) -> DataFrame:
        s = self.m.stock_shared.where(F.col("holding_ticker_norm").isNotNull() & (F.col("holding_ticker_norm") != ""))
        return s.select("fund_code", "holding_name", F.col("holding_ticker_norm").alias("symbol"),
                        F.col("true_weight_pct").alias("pct_nav"), F.col("true_value_thb").alias("holding_value_thb"))

    @cached_property
    def dim_stocks(self) -> DataFrame:
        """A21 + W8: local symbols first, then unseen look-through symbols."""
        th = self.direct_rows.select(
            F.col("sym").alias("symbol"), "full_name", "sector", F.lit(config.STOCK_TYPE_TH).alias("stock_type"),
            F.lit(config.TH_COUNTRY).alias("country"), F.lit(0).alias("origin"), "fund_code")
        fx = self.fx_holdings.select(
            "symbol", clean_stock_name("holding_name", "symbol").alias("full_name"),
            F.lit(config.FOREIGN_SECTOR).alias("sector"), F.lit(config.STOCK_TYPE_FOREIGN).alias("stock_type"),
            F.lit(config.FOREIGN_COUNTRY).alias("country"), F.lit(1).alias("origin"), "fund_code")
        first = first_per_key(th.unionByName(fx), ["symbol"],
                              [asc("origin"), asc("fund_code"), asc("full_name"), asc("sector")])
        d = first.select("symbol", "full_name", "sector", "stock_type", F.lit(0.0).alias("percent_change"),
                         "country", "origin")
        ranked = self._ids("stocks", d, [F.col("origin").asc(), F.col("symbol").asc_nulls_last()])
        return ranked.drop("origin")

    @cached_property
    def fact_direct_holdings(self) -> DataFrame:
        """A24."""
        s = self.dim_stocks.select(F.col("symbol").alias("sym"), F.col("id").alias("stock_id"))
        j = self.direct_rows.join(s, "sym", "inner")
        return j.select("fund_id", "stock_id", F.lit(1).alias("ranking"), F.col("value_thb").alias("holding_value_thb"),
                        F.col("aum").alias("nav_thb"), F.col("percent").alias("percent_nav"))

    @cached_property
    def master_fund_holdings(self) -> DataFrame:
        """Each look-through holding attached to its fund's first master
        (smallest master id); one row per (master, stock), first weight wins."""
        first_master = self.fact_master_holdings.groupBy("fund_id").agg(F.min("master_fund_id").alias("master_fund_id"))
        funds = self.dim_funds.select(F.col("code").alias("fund_code"), F.col("id").alias("fund_id"))
        stocks = self.dim_stocks.select("symbol", F.col("id").alias("stock_id"))
        fx = self.fx_holdings.join(funds, "fund_code", "inner").join(first_master, "fund_id", "inner")
        fx = fx.join(stocks, "symbol", "inner").withColumn("pct", null_to_zero("pct_nav"))
        return fx.groupBy("master_fund_id", "stock_id").agg(
            F.min_by("pct", F.struct("fund_code", "holding_name", "pct")).alias("percent_weight"))

    @cached_property
    def alloc_rows(self) -> DataFrame:
        a = latest_allocations(self.src["funds_allocations"])
        funds = self.dim_funds.select(F.col("code").alias("fund_code"), F.col("id").alias("fund_id"))
        a = a.join(funds, "fund_code", "inner")
        return a.select("fund_code", "fund_id", F.lower(strip_ws("type")).alias("alloc_type"),
                        strip_ws("name").alias("alloc_name"), null_to_zero("percent").alias("percentage"), "as_of_date")

    def breakdown(self, kind: str) -> DataFrame:
        """Sector or country breakdown per fund."""
        label = "sector_name" if kind == "sector" else "country_name"
        a = self.alloc_rows.where(F.col("alloc_type") == f"{kind}_alloc")
        return a.select("fund_id", F.col("alloc_name").alias(label), "percentage")

    def tables(self) -> dict[str, DataFrame]:
        return {
            "stocks": self.dim_stocks,
            "funds": self.dim_funds,
            "master_funds": self.dim_master_funds,
            "fund_direct_holdings": self.fact_direct_holdings,
            "fund_master_holdings": self.fact_master_holdings,
            "master_fund_holdings": self.master_fund_holdings,
            "fund_sector_breakdown": self.breakdown("sector"),
            "fund_country_breakdown": self.breakdown("country"),
        }

    # ---------------- contract outputs (G1-G10) ----------------
    def top_thai_holdings(self) -> DataFrame:
        """G1: direct holdings by symbol, ranked by value."""
        d = self.direct_rows.groupBy("sym").agg(
            exact_sum("thb_value").alias("total_thai_fund_value"),
            exact_sum("percent").alias("total_weight_pct"),
            F.countDistinct("fund_code").cast("long").alias("fund_count"),
            F.min("type").alias("holding_type"), F.max("as_of_date").alias("as_of_date"),
        )
        names = self.dim_stocks.select(F.col("symbol").alias("sym"), "full_name")
        d = d.join(names, "sym", "left").withColumnRenamed("sym", "symbol")
        return global_row_number(
            d, [F.col("total_thai_fund_value").desc_nulls_last(), F.col("symbol").asc_nulls_last()], "rank_no")

    def top_global_traceability(self) -> DataFrame:
        """Look-through top holdings under the payload names."""
        return self.m.top_holdings.select(
            "rank_no", "holding_key", "holding_ticker", "holding_name", "holding_type",
            F.col("total_true_weight_pct").alias("total_weight_pct"),
            F.col("total_true_value_thb").alias("global_fund_value"))

    def thai_alloc_value(self) -> DataFrame:
        aum = self.m.nav.select("fund_code", null_to_zero("aum").alias("aum"))
        a = self.alloc_rows.join(aum, "fund_code", "left")
        return a.select(
            F.when(F.col("alloc_type") == "sector_alloc", "sector").otherwise("country").alias("dimension"),
            F.col("alloc_name").alias("name"),
            ((F.col("percentage") * null_to_zero("aum")) / 100.0).alias("value_thb"),
            F.col("percentage").alias("weight_pct"), "as_of_date")

    def scoped_exposure(self) -> DataFrame:
        return self._scoped

    @cached_property
    def _scoped(self) -> DataFrame:
        """Sector / country exposure for scopes TH, FOREIGN and ALL.
        ``as_of_date``: newest allocation of the label (TH), newest NAV behind
        the look-through (FOREIGN), the later of both (ALL)."""
        th = self.thai_alloc_value().groupBy("dimension", "name").agg(
            exact_sum("value_thb").alias("total_value_thb"), exact_sum("weight_pct").alias("total_weight_pct"),
            F.max("as_of_date").alias("as_of_date"))
        th = th.withColumn("scope", F.lit("TH"))
        fs = self.m.sector_agg.select(F.lit("sector").alias("dimension"), F.col("sector_name").alias("name"),
                                      F.col("total_true_value_thb").alias("total_value_thb"),
                                      F.col("total_true_weight_pct").alias("total_weight_pct"))
        fc = self.m.country_agg.select(F.lit("country").alias("dimension"), F.col("region_name").alias("name"),
                                       F.col("total_true_value_thb").alias("total_value_thb"),
                                       F.col("total_true_weight_pct").alias("total_weight_pct"))
        newest = self.m.stock_shared.agg(F.max("nav_as_of_date").cast("date").alias("as_of_date"))
        foreign = attach_scalars(fs.unionByName(fc), newest).withColumn("scope", F.lit("FOREIGN"))
        # a row for each label; read by the ALL scope, the totals, the cards and the payload
        both = self.m._keep(th.unionByName(foreign))
        al = both.groupBy("dimension", "name").agg(
            exact_sum("total_value_thb").alias("total_value_thb"),
            exact_sum("total_weight_pct").alias("total_weight_pct"),
            F.max("as_of_date").alias("as_of_date")).withColumn("scope", F.lit("ALL"))
        rows = both.unionByName(al)
        totals = rows.groupBy("scope", "dimension").agg(exact_sum("total_value_thb").alias("_total"))
        return rows.join(totals, ["scope", "dimension"]).select(
            "scope", "dimension", "name", "total_value_thb", "total_weight_pct",
            share_pct("total_value_thb", "_total").alias("allocation_share_pct"), "as_of_date")

    def scoped_cards(self) -> DataFrame:
        """One card row per scope (TH, FOREIGN, ALL); returns and mapped
        counts come from the look-through and are null for TH."""
        ex = self.scoped_exposure()
        top = first_per_key(
            ex.select("scope", "dimension", "name", "allocation_share_pct", (-F.col("total_value_thb")).alias("neg")),
            ["scope", "dimension"], [asc("neg"), asc("name")])
        top_sector = top.where(F.col("dimension") == "sector").select(
            "scope", F.col("name").alias("top_sector_name"), F.col("allocation_share_pct").alias("top_sector_weight_pct"))
        top_country = top.where(F.col("dimension") == "country").select(
            "scope", F.col("name").alias("top_country_name"), F.col("allocation_share_pct").alias("top_country_weight_pct"))
        th = self.thai_holdings.select(
            F.lit("TH").alias("scope"), "fund_code", F.col("thb_value").alias("value_thb"), "as_of_date")
        fx = self.m.stock_shared.select(
            F.lit("FOREIGN").alias("scope"), "fund_code", F.col("true_value_thb").alias("value_thb"),
            F.col("nav_as_of_date").cast("date").alias("as_of_date"))
        # one pass over both facts; combined per (scope, fund) before the shuffle
        found = th.unionByName(fx).withColumn("scope", F.explode(F.array("scope", F.lit("ALL")))).groupBy("scope").agg(
            exact_sum("value_thb").alias("total_value_thb"),
            F.countDistinct("fund_code").cast("long").alias("fund_count"), F.max("as_of_date").alias("as_of_date"))
        # every scope has a row, an empty one if nothing was found
        scopes = found.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in config.SCOPES])).alias("scope"))
        cards = scopes.join(found, "scope", "left").withColumn("fund_count", F.coalesce("fund_count", F.lit(0).cast("long")))
        cards = cards.join(top_sector, "scope", "left").join(top_country, "scope", "left")
        counts = self.m.bridge_ok.agg(
            F.countDistinct("fund_code").cast("long").alias("mapped_fund_count"),
            F.countDistinct("ft_ticker").cast("long").alias("mapped_master_count"))
        cards = attach_scalars(attach_scalars(cards, self.m.returns), counts)
        mapped = ["avg_fund_return_1y", "avg_fund_return_3y", "mapped_fund_count", "mapped_master_count"]
        return cards.select("scope", F.coalesce("total_value_thb", F.lit(0.0)).alias("total_value_thb"),
                            "top_sector_name", "top_sector_weight_pct", "top_country_name", "top_country_weight_pct",
                            "fund_count", "as_of_date", *[F.when(F.col("scope") != "TH", F.col(c)).alias(c) for c in mapped])

    def _search_rows(self, keys: list[str]) -> DataFrame:
        s = self.m.stock.groupBy(*keys).agg(
            exact_sum("true_value_thb").alias("value_thb"), exact_sum("true_weight_pct").alias("pct_nav"),
            F.min("holding_name").alias("holding_name"), F.max("aum").alias("nav_thb"),
            F.max("nav_as_of_date").alias("as_of_date"))
        names = self.src["funds_master_info"].groupBy("fund_code").agg(F.min("full_name_en").alias("fund_name"))
        return s.join(names, "fund_code", "left").withColumn("investment_method", F.lit("Feeder Fund"))

    def search_asset_to_funds(self) -> DataFrame:
        """Per asset, all its funds ranked by value (% of fund NAV, method)."""
        s = self._search_rows(["holding_key", "fund_code", "map_method"])
        order = [F.col("value_thb").desc_nulls_last(), F.col("fund_code").asc(), F.col("map_method").asc_nulls_last()]
        return group_row_number(s, ["holding_key"], order)

    def search_fund_to_assets(self) -> DataFrame:
        """Per fund, all its look-through assets ranked by value."""
        s = self._search_rows(["fund_code", "holding_key"])
        order = [F.col("value_thb").desc_nulls_last(), F.col("holding_key").asc()]
        return group_row_number(s, ["fund_code"], order)

    def stock_aggregates(self) -> DataFrame:
        """Local and look-through exposure per symbol; a fund that holds a
        symbol both ways counts once. ``stock_id`` is the smallest id of the
        stocks with that symbol, as written or normalised."""
        th = self.direct_rows.select(F.col("sym").alias("symbol"), "fund_code", F.lit(True).alias("local"),
                                     F.col("thb_value").alias("v"), F.col("percent").alias("w"))
        gl = self.fx_holdings.select(normalize_ticker("symbol").alias("symbol"), "fund_code", F.lit(False).alias("local"),
                                     F.col("holding_value_thb").alias("v"), F.col("pct_nav").alias("w"))
        per_symbol = th.unionByName(gl).where(F.col("symbol").isNotNull()).groupBy("symbol").agg(
            exact_sum(F.when(F.col("local"), F.col("v"))).alias("tv"), exact_sum(F.when(~F.col("local"), F.col("v"))).alias("gv"),
            exact_sum(F.when(F.col("local"), F.col("w"))).alias("tw"), exact_sum(F.when(~F.col("local"), F.col("w"))).alias("gw"),
            F.countDistinct("fund_code").cast("long").alias("fund_count"))
        z = F.lit(0.0)
        named = self.dim_stocks.select("id", F.explode(F.array("symbol", normalize_ticker("symbol"))).alias("symbol"))
        named = named.groupBy("symbol").agg(F.min("id").alias("stock_id"))
        return per_symbol.join(named, "symbol", "left").select(
            "symbol", "stock_id",
            F.coalesce("tv", z).alias("thai_value_thb"),
            F.coalesce("gv", z).alias("global_value_thb"),
            (F.coalesce("tv", z) + F.coalesce("gv", z)).alias("total_exposure_thb"),
            (F.coalesce("tw", z) + F.coalesce("gw", z)).alias("total_weight_pct"),
            "fund_count",
            F.when(F.col("tv").isNull(), "GLOBAL").when(F.col("gv").isNull(), "THAI").otherwise("BOTH").alias("exposure_type"))

    def suggestions(self) -> DataFrame:
        """Search keywords for funds and stocks, default priority 100."""
        f = self.dim_funds.select(F.lit("FUND").alias("item_type"), F.col("id").alias("item_id"),
                                  F.col("code").alias("item_code"), F.col("name_en").alias("item_name"))
        s = self.dim_stocks.select(F.lit("STOCK").alias("item_type"), F.col("id").alias("item_id"),
                                   F.col("symbol").alias("item_code"), F.col("full_name").alias("item_name"))
        items = f.unionByName(s)
        u = items.withColumn("keyword", F.explode(F.array("item_code", "item_name")))
        return u.where(F.col("keyword").isNotNull() & (F.col("keyword") != "")).select(
            "keyword", "item_type", "item_id", "item_code", "item_name", F.lit(100).alias("priority"))

    def investment_method(self) -> DataFrame:
        """Direct / Feeder Fund / Other per holding row, summarised."""
        return self._with_method().groupBy("investment_method").agg(
            F.count(F.lit(1)).alias("holding_rows"), exact_sum("thb_value").alias("total_value_thb"))

    def _with_method(self) -> DataFrame:
        h = self.thai_holdings.withColumn("sym", extract_symbol("symbol", "symbol"))
        method = F.when(F.col("is_master"), "Feeder Fund").when(F.col("sym").isNotNull(), "Direct").otherwise("Other")
        return h.withColumn("investment_method", method)

    def fund_holdings(self) -> DataFrame:
        """Every local holding with its method and rank in its fund; only
        direct holdings have a stock id."""
        h = self._with_method()
        stocks = self.dim_stocks.select(F.col("symbol").alias("sym"), F.col("id").alias("stock_id"))
        direct = F.col("investment_method") == "Direct"
        rows = h.where(direct).join(stocks, "sym").unionByName(
            h.where(~direct).withColumn("stock_id", F.lit(None).cast("long")))
        order = [F.col("thb_value").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ("symbol", "holding_name", "type", "percent")]]
        ranked = group_row_number(rows, ["fund_id"], order)
        return ranked.select(
            "fund_id", "stock_id", F.col("rank_no").alias("ranking"), "investment_method",
            F.col("thb_value").alias("holding_value_thb"), "nav_thb", F.col("percent").alias("pct_nav"), "as_of_date")

    def stock_type_counts(self) -> DataFrame:
        """Stock types emitted (TH / FOREIGN; GOLD stays accepted)."""
        return self.dim_stocks.groupBy("stock_type").agg(F.count(F.lit(1)).alias("stocks")).withColumn(
            "accepted", F.col("stock_type").isin(*config.STOCK_TYPES))
