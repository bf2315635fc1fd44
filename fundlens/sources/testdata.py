"""Adapter: the driver's TPC-H-like tables presented as fund source tables.

Every view is a pure DataFrame derivation of the given parquet tables, so its
size grows with the scale factor. The same rules are written as DuckDB SQL in
``fundlens.oracle.adapters`` and both engines must agree row for row.

Rules (k = l_suppkey, c = c_custkey):
  funds_master_info   customer x nation; currency by c_nationkey % 6
  funds_codes         AIMC code for all, ISIN for c%3=0, blank ISIN for c%3=1,
                      second ISIN for c%15=0
  funds_performance   total_return_1y = c_acctbal / 100
  funds_daily         orders; nav_date folded into 2023-12-27 + (days % 40);
                      aum null when o_orderstatus = 'P'
  funds_holding       lineitem x orders x part; type by l_returnflag,
                      feeder names carry an ISIN token in four shapes
  funds_allocations   lineitem x orders x part; sector/country/asset by line
  ft_static_detail    lineitem x supplier per (k, ship day)
  ft_holdings         lineitem x part; holding ticker shapes by p_partkey % 7
  ft_sector_allocation / ft_region_allocation / ft_avg_fund_return
  daily_fx_rates      events per (day, event_type); days with day%4=0 removed
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SOURCE_VIEWS = (
    "funds_master_info",
    "funds_codes",
    "funds_performance",
    "funds_daily",
    "funds_holding",
    "funds_allocations",
    "ft_static_detail",
    "ft_holdings",
    "ft_sector_allocation",
    "ft_region_allocation",
    "ft_avg_fund_return",
    "daily_fx_rates",
)


# read twice by one loader, or by several
READ_AGAIN = {"funds_allocations", "daily_fx_rates"}


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _isin_no(k: Column) -> Column:
    """Two suppliers share an ISIN, so masters per ISIN stay bounded while the
    number of ISINs grows with the suppliers."""
    return k - k % 2


def _fund_isin_no(custkey: Column) -> Column:
    """A supplier number for each 15 customers (the tables' ratio)."""
    return _isin_no(F.floor(custkey / 15))


def _pad11(c: Column) -> Column:
    return F.lpad(c.cast("string"), 11, "0")


def _quarter(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "quarter")


def _month(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


class TestData:
    """Lazily built adapter views over ``{sf_dir}/{table}.parquet``."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, missing: tuple[str, ...] = (), materialize: bool = False
    ):
        """``materialize=True`` writes the views that loaders read more than once
        (``READ_AGAIN``) as parquet under ``spark.checkpoint.dir`` and reads them
        back, so later plans scan a physical source table (with column pruning
        and filter pushdown) instead of re-running the adapter joins. The loaders
        keep what they make of the other views."""
        self.spark = spark
        self.missing = set(missing)
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        self._cache: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        key = "raw:" + name
        if key not in self._cache:
            self._cache[key] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[key]

    def view(self, name: str) -> DataFrame:
        if name not in self._cache:
            builder: Callable[[TestData], DataFrame] = _BUILDERS[name]
            df = builder(self)
            if self.materialize and name in READ_AGAIN:
                df = self._materialized(name, df)
            self._cache[name] = df
        return self._cache[name]

    def _materialized(self, name: str, df: DataFrame) -> DataFrame:
        import hashlib

        from ..session import ensure_checkpoint_dir

        root = ensure_checkpoint_dir(self.spark).rstrip("/")
        tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:12]
        path = f"{root}/fundlens-sources/{tag}/{name}"
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
        fs = hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(hpath):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.parquet(path)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        return self.view(name) if name in _BUILDERS else self.raw(name)

    def __contains__(self, name: object) -> bool:
        return (name in _BUILDERS or name in RAW_TABLES) and name not in self.missing

    def register_views(self) -> None:
        for name in SOURCE_VIEWS:
            self.view(name).createOrReplaceTempView(name)


def funds_master_info(td: TestData) -> DataFrame:
    c = td.raw("customer")
    n = td.raw("nation")
    ccy = (
        F.when(F.col("c_nationkey") % 6 == 0, "THB")
        .when(F.col("c_nationkey") % 6 == 1, "USD")
        .when(F.col("c_nationkey") % 6 == 2, " eur ")
        .when(F.col("c_nationkey") % 6 == 3, "JPY")
        .when(F.col("c_nationkey") % 6 == 4, "XXX")
    )
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        _cat("F", F.col("c_custkey")).alias("fund_code"),
        F.col("c_name").alias("full_name_th"),
        F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("Fund ")).alias("full_name_en"),
        _cat("AMC", F.col("c_custkey") % 7).alias("amc"),
        F.col("c_mktsegment").alias("category"),
        (F.col("c_custkey") % 8 + 1).alias("risk_level"),
        ccy.alias("currency"),
        F.col("n_name").alias("country"),
    )


def funds_codes(td: TestData) -> DataFrame:
    c = td.raw("customer").select("c_custkey")
    fund = _cat("F", F.col("c_custkey")).alias("fund_code")
    aimc = c.select(fund, F.lit("AIMC").alias("type"), _cat("A", F.col("c_custkey")).alias("code"))
    isin = c.where(F.col("c_custkey") % 3 == 0).select(
        fund, F.lit("ISIN").alias("type"), _cat(" s", _pad11(_fund_isin_no(F.col("c_custkey")))).alias("code")
    )
    blank = c.where(F.col("c_custkey") % 3 == 1).select(fund, F.lit("ISIN").alias("type"), F.lit(" ").alias("code"))
    second = c.where(F.col("c_custkey") % 15 == 0).select(
        fund, F.lit("ISIN").alias("type"), _cat("S", _pad11(_fund_isin_no(F.col("c_custkey") + 30))).alias("code")
    )
    return aimc.unionByName(isin).unionByName(blank).unionByName(second)


def funds_performance(td: TestData) -> DataFrame:
    return td.raw("customer").select(
        _cat("F", F.col("c_custkey")).alias("fund_code"),
        (F.col("c_acctbal") / 100).alias("total_return_1y"),
    )


def funds_daily(td: TestData) -> DataFrame:
    o = td.raw("orders")
    days = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")) % 40
    return o.select(
        _cat("F", F.col("o_custkey")).alias("fund_code"),
        F.date_add(F.lit("2023-12-27").cast("date"), days).alias("nav_date"),
        (F.col("o_totalprice") / 10000).alias("nav_value"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("aum"),
        F.col("o_orderkey").alias("daily_id"),
    )


def _feeder_name(k: Column) -> Column:
    base = _cat("Supplier ", k)
    tok = _pad11(_isin_no(k))
    return (
        F.when(k % 4 == 0, base)
        .when(k % 4 == 1, _cat(base, " (s", tok, ")"))
        .when(k % 4 == 2, _cat(base, " (S ", tok, ") "))
        .otherwise(_cat(base, " (x) (S", tok, ")"))
    )


def funds_holding(td: TestData) -> DataFrame:
    li = td.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    o = td.raw("orders").select("o_orderkey", "o_custkey", _quarter(F.col("o_orderdate")).alias("as_of_date"))
    p = td.raw("part").select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey, "left")
    typ = F.when(F.col("l_returnflag") == "A", "Fund").when(F.col("l_returnflag") == "N", "Equity").otherwise("Bond")
    pk = F.col("l_partkey")
    stock_name = (
        F.when(F.col("l_returnflag") == "R", _cat("BANK ", F.upper("p_name"), " (CB", pk, ")"))
        .when(pk % 2 == 0, _cat("Stock ", F.col("p_name"), " P", pk))
        .otherwise(F.col("p_name"))
    )
    return j.select(
        _cat("F", F.col("o_custkey")).alias("fund_code"),
        F.when((F.col("l_returnflag") == "A") | (pk % 9 == 0), F.lit(None).cast("string"))
        .otherwise(_cat("P", pk))
        .alias("symbol"),
        F.when(F.col("l_returnflag") == "A", _feeder_name(F.col("l_suppkey"))).otherwise(stock_name).alias("name"),
        typ.alias("type"),
        F.col("p_type").alias("sector"),
        F.col("l_quantity").alias("percent"),
        "as_of_date",
    )


def funds_allocations(td: TestData) -> DataFrame:
    li = td.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_discount")
    o = td.raw("orders").select("o_orderkey", "o_custkey", _quarter(F.col("o_orderdate")).alias("as_of_date"))
    p = td.raw("part").select("p_partkey", "p_brand", "p_type", "p_size")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey, "left")
    typ = (
        F.when(F.col("l_linenumber") == 7, "asset_alloc")
        .when(F.col("l_linenumber") % 2 == 1, "sector_alloc")
        .otherwise("country_alloc")
    )
    name = (
        F.when(F.col("p_size") == 1, F.lit(""))
        .when(F.col("l_linenumber") % 2 == 1, F.col("p_type"))
        .otherwise(F.col("p_brand"))
    )
    return j.select(
        _cat("F", F.col("o_custkey")).alias("fund_code"),
        name.alias("name"),
        typ.alias("type"),
        (F.col("l_discount") * 100).alias("percent"),
        "as_of_date",
    )


def _ticker(k: Column) -> Column:
    return F.when(k % 17 != 0, _cat("T", k))


def ft_static_detail(td: TestData) -> DataFrame:
    li = td.raw("lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice")
    g = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date_scraper")).agg(
        F.sum("l_extendedprice").alias("assets_aum_full_value"),
        F.max("l_shipdate").alias("created_at"),
    )
    k = F.col("l_suppkey")
    return g.select(
        _cat("FT", k).alias("ft_ticker"),
        _ticker(k).alias("ticker"),
        _cat("Master Fund ", k).alias("name"),
        F.when(k % 3 == 0, "Fund").when(k % 3 == 1, "ETF").otherwise("Trust").alias("ticker_type"),
        F.when(k % 10 != 9, _cat(" s", _pad11(_isin_no(k)))).alias("isin_number"),
        F.col("assets_aum_full_value"),
        F.col("date_scraper"),
        F.col("created_at"),
    )


def ft_holdings(td: TestData) -> DataFrame:
    li = td.raw("lineitem").select("l_partkey", "l_suppkey", "l_discount", "l_linestatus", "l_shipdate")
    p = td.raw("part").select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    brand_no = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit(""))
    pk = F.col("p_partkey")
    hticker = (
        F.when(pk % 7 == 0, F.lit(None).cast("string"))
        .when(pk % 7 == 1, F.lit(" "))
        .when(pk % 7 == 2, _cat(" b", brand_no, ":us "))
        .otherwise(_cat("B", brand_no, ":US"))
    )
    hname = F.when(pk % 5 == 0, _cat(F.col("p_name"), "B", brand_no, ":US")).otherwise(F.col("p_name"))
    return j.select(
        _cat("T", F.col("l_suppkey")).alias("ticker"),
        F.when(F.col("l_linestatus") == "O", "top_10_holdings").otherwise("other_holdings").alias("allocation_type"),
        hname.alias("holding_name"),
        hticker.alias("holding_ticker"),
        F.col("p_type").alias("holding_type"),
        (F.col("l_discount") * 100).alias("portfolio_weight_pct"),
        _month(F.col("l_shipdate")).alias("date_scraper"),
        F.col("l_shipdate").alias("created_at"),
    )


def ft_sector_allocation(td: TestData) -> DataFrame:
    li = td.raw("lineitem").select("l_partkey", "l_suppkey", "l_discount", "l_shipdate")
    p = td.raw("part").select("p_partkey", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    return j.select(
        _cat("FT", F.col("l_suppkey")).alias("ft_ticker"),
        _cat("T", F.col("l_suppkey")).alias("ticker"),
        F.col("p_type").alias("category_name"),
        (F.col("l_discount") * 100).alias("weight_pct"),
        _month(F.col("l_shipdate")).alias("date_scraper"),
    )


def ft_region_allocation(td: TestData) -> DataFrame:
    """Uses the old column names (region_name, region_weight_pct) on purpose:
    the loader resolves them by probing the schema."""
    # the month is known before the joins: their shuffles carry it instead of the time
    li = td.raw("lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_discount", _month(F.col("l_shipdate")).alias("date_scraper")
    )
    o = td.raw("orders").select("o_orderkey", "o_custkey")
    c = td.raw("customer").select("c_custkey", "c_nationkey")
    n = td.raw("nation")
    r = td.raw("region")
    j = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey, "left")
        .join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(r, n.n_regionkey == r.r_regionkey, "left")
    )
    region_label = (
        F.when(F.col("r_name") == "AFRICA", "Africa")
        .when(F.col("r_name") == "AMERICA", "Americas")
        .when(F.col("r_name") == "ASIA", "Greater Asia")
        .when(F.col("r_name") == "EUROPE", "Europe")
        .when(F.col("r_name") == "MIDDLE EAST", "Middle East")
        .otherwise("Other")
    )
    return j.select(
        _cat("FT", F.col("l_suppkey")).alias("ft_ticker"),
        _cat("T", F.col("l_suppkey")).alias("ticker"),
        F.when(F.col("l_linenumber") == 1, region_label).otherwise(F.col("n_name")).alias("region_name"),
        (F.col("l_discount") * 100).alias("region_weight_pct"),
        "date_scraper",
    )


def ft_avg_fund_return(td: TestData) -> DataFrame:
    li = td.raw("lineitem").select("l_suppkey", "l_shipdate")
    s = td.raw("supplier").select("s_suppkey", "s_acctbal")
    g = li.groupBy("l_suppkey", F.year("l_shipdate").alias("yr")).agg(F.max("l_shipdate").alias("created_at"))
    j = g.join(s, g.l_suppkey == s.s_suppkey, "left")
    k = F.col("l_suppkey")
    return j.select(
        _cat("FT", k).alias("ft_ticker"),
        _ticker(k).alias("ticker"),
        (F.col("s_acctbal") / 1000 + F.col("yr") % 10).alias("avg_fund_return_1y"),
        F.when(k % 5 != 0, F.col("s_acctbal") / 2000).alias("avg_fund_return_3y"),
        F.make_date(F.col("yr"), F.lit(12), F.lit(31)).alias("date_scraper"),
        F.col("created_at"),
    )


def daily_fx_rates(td: TestData) -> DataFrame:
    e = td.raw("events").select("ts", "event_type", "value")
    # days without a rate: each fourth day's events count for the day before
    day = F.to_date("ts")
    day = F.when(F.dayofmonth(day) % 4 == 0, F.date_sub(day, 1)).otherwise(day)
    g = (
        e.groupBy(day.alias("date_rate"), "event_type")
        .agg(
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("s"),
            F.count(F.lit(1)).alias("n"),
            F.max("ts").alias("updated_at"),
        )
    )
    ccy = (
        F.when(F.col("event_type") == "click", "USD")
        .when(F.col("event_type") == "view", "EUR")
        .when(F.col("event_type") == "purchase", "JPY")
        .when(F.col("event_type") == "signup", "GBP")
        .otherwise("THB")
    )
    return g.select(
        F.col("date_rate"),
        ccy.alias("from_ccy"),
        F.lit("THB").alias("to_ccy"),
        (F.col("s") / F.col("n")).alias("rate_to_thb"),
        F.lit("events").alias("source_system"),
        F.col("updated_at"),
    )


_BUILDERS: dict[str, Callable[[TestData], DataFrame]] = {
    "funds_master_info": funds_master_info,
    "funds_codes": funds_codes,
    "funds_performance": funds_performance,
    "funds_daily": funds_daily,
    "funds_holding": funds_holding,
    "funds_allocations": funds_allocations,
    "ft_static_detail": ft_static_detail,
    "ft_holdings": ft_holdings,
    "ft_sector_allocation": ft_sector_allocation,
    "ft_region_allocation": ft_region_allocation,
    "ft_avg_fund_return": ft_avg_fund_return,
    "daily_fx_rates": daily_fx_rates,
}
