"""Report plans: daily report, roll-ups, snapshot, log pivot, retired reports."""

from .api import portfolio_daily, portfolio_daily_backfill, portfolio_rollup, portfolio_rollups

__all__ = ["portfolio_daily", "portfolio_daily_backfill", "portfolio_rollup", "portfolio_rollups"]
