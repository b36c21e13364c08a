"""markbook: holdings valuation and reporting on Spark DataFrames."""

from .config import LAKE_DAILY, LAKE_WEEKLY, PROFILES, WAREHOUSE, Profile, ReportParams, default_as_of
from .operators.lots import precondition_violations
from .plans import portfolio_daily, portfolio_daily_backfill, portfolio_rollup, portfolio_rollups
from .sources import Tables, catalog_tables, read_tables

__all__ = ["LAKE_DAILY", "LAKE_WEEKLY", "PROFILES", "WAREHOUSE", "Profile", "ReportParams", "default_as_of",
           "precondition_violations",
           "portfolio_daily", "portfolio_daily_backfill", "portfolio_rollup", "portfolio_rollups",
           "Tables", "catalog_tables", "read_tables"]
