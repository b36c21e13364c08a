"""The five logical input tables as DataFrames (SRC1-SRC5)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Columns each logical table must provide (types in FIXTURES.md section 1).
EQUITIES_COLUMNS = ("dataset", "ticker", "date", "close")
PORTFOLIO_COLUMNS = ("dataset", "_user", "ticker", "quantity", "cost_per_share")
MARKETS_COLUMNS = ("dataset", "ticker", "description", "asset_type", "location",
                   "capitalization", "investment_style")
CURRENCY_COLUMNS = ("currency", "date", "rate")
LOG_COLUMNS = ("date", "device")


@dataclass
class Tables:
    """Price fact, holdings, market attributes, FX rates and device log."""

    equities: DataFrame
    portfolio: DataFrame
    markets: DataFrame
    currency: DataFrame
    log: DataFrame | None = None
    totals: DataFrame | None = None  # maintained price totals (totals.py), read instead of the fact

    def check(self) -> "Tables":
        for name, cols in (("equities", EQUITIES_COLUMNS), ("portfolio", PORTFOLIO_COLUMNS),
                           ("markets", MARKETS_COLUMNS), ("currency", CURRENCY_COLUMNS)):
            missing = set(cols) - set(getattr(self, name).columns)
            if missing:
                raise ValueError(f"{name} lacks columns {sorted(missing)}")
        return self

    def prices(self) -> DataFrame:
        """What counts and average prices are read from: the maintained totals if there are any, else the fact."""
        return self.equities if self.totals is None else self.totals

    def register(self, prefix: str = "") -> None:
        """Expose the tables as temp views for ``spark.sql`` users."""
        for name in ("equities", "portfolio", "markets", "currency", "log"):
            df = getattr(self, name)
            if df is not None:
                df.createOrReplaceTempView(prefix + name)


def read_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> Tables:
    """Read the logical tables from files (e.g. Parquet partitioned by ``date``).

    Partitioning the price fact by ``date`` lets the four anchor-date filters
    prune whole directories; the filters are literals, so pruning is static.
    """
    def rd(key):
        return spark.read.format(fmt).load(paths[key]) if key in paths else None

    return Tables(rd("equities"), rd("portfolio"), rd("markets"), rd("currency"), rd("log")).check()


def catalog_tables(spark: SparkSession, names: dict[str, str]) -> Tables:
    """Use catalog tables, e.g. ``{"equities": "dw.equities_fact", ...}``."""
    def tb(key):
        return spark.table(names[key]) if key in names else None

    return Tables(tb("equities"), tb("portfolio"), tb("markets"), tb("currency"), tb("log")).check()


def with_user_column(portfolio: DataFrame) -> DataFrame:
    """The lake layout calls the owner column ``user``; normalise to ``_user``."""
    if "_user" not in portfolio.columns and "user" in portfolio.columns:
        return portfolio.withColumnRenamed("user", "_user")
    return portfolio
