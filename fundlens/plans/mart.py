"""X11: the full mart as named DataFrames, built lazily from one source."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import config
from . import exposure as ex
from .bridge import build_bridge
from .loaders import Dataset, load_dataset
from .navfx import nav_with_fx, stg_nav_aum_native, vw_nav_aum_thb


class Mart:
    """All mart tables of one build. Each attribute is a lazy DataFrame.

    Frames read by several outputs (newest rows of the sources, bridge, NAV, small
    aggregates, facts of the builds) are shared through ``reuse``:
      * "files" (default): written once as parquet below ``spark.checkpoint.dir``
        and scanned from there. Plans stay short (the driver plans, and keeps, no
        nested copies of them), readers take only their columns, and a lost
        executor costs nothing. They are written when they are first asked for;
      * "persist": MEMORY_AND_DISK cache; every plan holds the cached plans;
      * None: plain lazy plans.
    """

    def __init__(
        self,
        spark: SparkSession,
        src: Mapping[str, DataFrame],
        base_ccy: str = config.BASE_CCY,
        top_n: int = config.TOP_N,
        reuse: str | None = "files",
    ):
        self.spark = spark
        self.src = src
        self.base_ccy = base_ccy
        self.n = top_n
        self.reuse = reuse

    def _keep(self, df: DataFrame) -> DataFrame:
        if self.reuse == "persist":
            from pyspark import StorageLevel

            return df.persist(StorageLevel.MEMORY_AND_DISK)
        if self.reuse == "files":
            from ..session import written

            return written(df, "mart")
        return df

    @cached_property
    def ds(self) -> Dataset:
        return load_dataset(self.spark, self.src, self._keep)

    @cached_property
    def bridge(self) -> DataFrame:
        return self._keep(build_bridge(self.ds, self._keep))

    @cached_property
    def bridge_ok(self) -> DataFrame:
        return self._keep(ex.bridge_ok(self.bridge))

    @cached_property
    def bridge_nav(self) -> DataFrame:
        """The mapped bridge with its funds' NAV: what the facts fan out from.
        Columns that no fact holds are neither shuffled nor written."""
        return self._keep(ex.with_nav(self.bridge_ok.select(*ex.BRIDGE_FACT_COLS), self.nav))

    @cached_property
    def nav(self) -> DataFrame:
        return self._keep(nav_with_fx(self.ds, self.base_ccy))

    @cached_property
    def stg_nav(self) -> DataFrame:
        return stg_nav_aum_native(self.nav)

    @cached_property
    def stock(self) -> DataFrame:
        return ex.fact_exposure_stock(self.bridge_nav, self.ds.ft_holdings)

    @cached_property
    def sector(self) -> DataFrame:
        return ex.fact_exposure_sector(self.bridge_nav, self.ds.ft_sector)

    @cached_property
    def region(self) -> DataFrame:
        return ex.fact_exposure_region(self.bridge_nav, self.ds.ft_region)

    # Shared copies of the facts for outputs that read them several times
    # (builds, quality report). A single reader uses the plain plan: one join of
    # two kept frames is cheaper than writing the fact.
    @cached_property
    def stock_shared(self) -> DataFrame:
        return self._keep(self.stock)

    @cached_property
    def sector_shared(self) -> DataFrame:
        return self._keep(self.sector)

    @cached_property
    def region_shared(self) -> DataFrame:
        return self._keep(self.region)

    def _fact(self, name: str) -> DataFrame:
        """The fact's shared copy if this build has asked for one, else its plan:
        an output that is asked for alone reads a fact once and writes none."""
        return self.__dict__.get(f"{name}_shared", getattr(self, name))

    @cached_property
    def coverage(self) -> DataFrame:
        return ex.fund_coverage(self.ds.thai_feeder, self.bridge_ok, self.nav)

    @cached_property
    def returns(self) -> DataFrame:
        return self._keep(ex.avg_fund_return(self.bridge_ok, self.ds.ft_return, self.nav))

    @cached_property
    def top_holdings(self) -> DataFrame:
        return ex.agg_top_holdings(self.stock_shared)

    @cached_property
    def top_holdings_topn(self) -> DataFrame:
        return ex.agg_top_holdings_topn(self.stock_shared, self.n)

    @cached_property
    def sector_agg(self) -> DataFrame:
        return self._keep(ex.agg_sector_exposure(self._fact("sector")))

    @cached_property
    def region_agg(self) -> DataFrame:
        return self._keep(ex.agg_region_exposure(self._fact("region")))

    @cached_property
    def country_agg(self) -> DataFrame:
        return ex.agg_country_exposure(self.region_agg)

    @cached_property
    def cards(self) -> DataFrame:
        return self._keep(ex.dashboard_cards(self._fact("stock"), self.sector_agg, self.country_agg, self.returns, self.bridge_ok))

    def sector_topn(self) -> DataFrame:
        return self.sector_agg.orderBy(*ex.alloc_order("sector_name")).limit(self.n)

    def country_topn(self) -> DataFrame:
        return self.country_agg.orderBy(*ex.alloc_order("region_name")).limit(self.n)

    @cached_property
    def vw_nav_aum_thb(self) -> DataFrame:
        return vw_nav_aum_thb(self.stg_nav, self.ds.fx_rates, self.base_ccy)

    def tables(self) -> dict[str, DataFrame]:
        """The 14 mart tables by name."""
        return {
            "stg_nav_aum_native": self.stg_nav,
            "bridge_thai_master": self.bridge,
            "fact_effective_exposure_stock": self.stock_shared,
            "fact_effective_exposure_sector": self.sector_shared,
            "fact_effective_exposure_region": self.region_shared,
            "agg_top_holdings": self.top_holdings,
            "agg_top_holdings_topn": self.top_holdings_topn,
            "agg_sector_exposure": self.sector_agg,
            "agg_sector_exposure_topn": self.sector_topn(),
            "agg_country_exposure": self.country_agg,
            "agg_country_exposure_topn": self.country_topn(),
            "agg_region_exposure": self.region_agg,
            "agg_fund_coverage": self.coverage,
            "agg_dashboard_cards": self.cards,
        }

    def presence(self) -> dict[str, DataFrame]:
        """For each mart table a frame that holds rows exactly if the table
        does: shared facts and unranked aggregates, so that a check for rows
        ranks and sorts nothing."""
        top = ex.top_holdings_unranked(self.stock_shared)
        return {
            "stg_nav_aum_native": self.stg_nav,
            "bridge_thai_master": self.bridge,
            "fact_effective_exposure_stock": self.stock_shared,
            "fact_effective_exposure_sector": self.sector_shared,
            "fact_effective_exposure_region": self.region_shared,
            "agg_top_holdings": top,
            "agg_top_holdings_topn": top,
            "agg_sector_exposure": self.sector_agg,
            "agg_sector_exposure_topn": self.sector_agg,
            "agg_country_exposure": self.country_agg,
            "agg_country_exposure_topn": self.country_agg,
            "agg_region_exposure": self.region_agg,
            "agg_fund_coverage": self.coverage,
            "agg_dashboard_cards": self.cards,
        }

    def register_views(self) -> list[str]:
        """Mart tables and serving views as temp views."""
        from .serving import serving_views

        names = []
        for name, df in {**self.tables(), **serving_views(self)}.items():
            df.createOrReplaceTempView(name)
            names.append(name)
        return names

    @cached_property
    def star(self):
        from .star import StarSchema

        return StarSchema(self)
