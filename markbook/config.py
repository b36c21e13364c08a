"""Report parameters and dialect profiles.

The reference job was written twice, once for a PostgreSQL warehouse and once
for a Presto data lake.  The two versions differ in a handful of choices
(join keys, fallback-date scope, thresholds, casts); here they are named
options of one :class:`Profile` instead of separate code paths.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from decimal import Decimal

# --- Fixed values that must equal the reference's for identical results ---
# Data source whose holdings and market attributes are reported.
DEFAULT_DATASET = "ALPHA-VANTAGE"
# Currency looked up for the pence-quoted ticker, and the rate used when no
# rate exists on the as-of date or the previous weekday.
FX_CURRENCY = "GBP"
FX_DEFAULT_RATE = Decimal("1.30")
# Ticker quoted in pence (price * rate / 100 converts it).
FX_TICKER = "LON:FCH"
# Ticker whose 2 January price is also used as a current price.
YEAR_START_PRICE_TICKER = "VMMXX"
# Ticker reported as the "Benchmark" row in roll-ups.
BENCHMARK_TICKER = "VTSAX"
# Labels written into report rows.
TOTAL_TICKER = "TOTAL"
TOTAL_DESCRIPTION = "Portfolio Total"
BENCHMARK_LABEL = "Benchmark"
MASK = "---"
# Minimum rows per (date, dataset) for a date to qualify as fallback date:
# "count(*) > 40" in the warehouse and daily lake job, "> 30" weekly lake job.
MIN_ROWS_WAREHOUSE = 40
MIN_ROWS_LAKE_WEEKLY = 30
# Output columns of the device log pivot, in order.
LOG_DEVICES = ("firewall", "pfsense", "pfsense2", "router")
# Date range of the device log pivot.
LOG_START = dt.date(2018, 7, 20)
LOG_END = dt.date(2018, 10, 31)
# Zone of the lake job's "now" and the snapshot's fixed-offset "pst".
LAKE_ZONE = "America/Los_Angeles"
SNAPSHOT_ZONE = "-08:00"
# --- end of fixed values ---

DIMENSIONS = ("asset_type", "location", "capitalization", "investment_style")


@dataclass(frozen=True)
class Profile:
    """Dialect deltas of the valuation core."""

    name: str
    # D3: join holdings to markets on (ticker, dataset) or on ticker only.
    markets_on_dataset: bool = True
    # D4: fallback date counted over every user's tickers in the dataset
    # ("all") or over this user's tickers from 2 January on ("user").
    fallback_scope: str = "all"
    # D5: cast quantity / cost_per_share to decimal(10,4) / decimal(6,2).
    cast_lots: bool = False
    # D6: HAVING count(*) > min_rows.
    min_rows: int = MIN_ROWS_WAREHOUSE
    # D7 (weekly lake job): holdings without any price keep a zero row.
    keep_unpriced: bool = False


WAREHOUSE = Profile("warehouse")
LAKE_DAILY = Profile(
    "lake_daily", markets_on_dataset=False, fallback_scope="user", cast_lots=True
)
LAKE_WEEKLY = Profile(
    "lake_weekly",
    markets_on_dataset=False,
    fallback_scope="user",
    cast_lots=True,
    min_rows=MIN_ROWS_LAKE_WEEKLY,
    keep_unpriced=True,
)
PROFILES = {p.name: p for p in (WAREHOUSE, LAKE_DAILY, LAKE_WEEKLY)}


@dataclass(frozen=True)
class ReportParams:
    """Everything a report run depends on besides the tables."""

    as_of: dt.date
    user: str | None = None  # None: every user in one job (EXT1)
    users: tuple[str, ...] | None = None  # with user=None: only these users
    profile: Profile = WAREHOUSE
    dataset: str = DEFAULT_DATASET
    fx_currency: str = FX_CURRENCY
    fx_default: Decimal = FX_DEFAULT_RATE
    fx_ticker: str = FX_TICKER
    year_start_price_ticker: str = YEAR_START_PRICE_TICKER
    benchmark_ticker: str = BENCHMARK_TICKER
    min_rows: int | None = None  # None: the profile's threshold
    # Q5: the reference excludes only the as-of date itself, so a backfill
    # can pick a later fallback date; strict mode uses dates before as-of.
    strict_as_of: bool = False
    # Several markets rows per join key, and descriptions that tickers share, multiply
    # rows in the reference (Q2, Q7), and so in the reports; with this, each
    # ticker counts once instead.
    allow_shared: bool = False

    @property
    def threshold(self) -> int:
        return self.profile.min_rows if self.min_rows is None else self.min_rows

    def with_(self, **kw) -> "ReportParams":
        return replace(self, **kw)


def default_as_of(profile: Profile = WAREHOUSE, now: dt.datetime | None = None, task: str = "daily") -> dt.date:
    """The as-of date a scheduled run uses when none is given (D1): the
    server's date for the warehouse job; for the lake job the server's
    previous calendar day in the daily run (FN6), today in Los Angeles in the
    weekly one."""
    from zoneinfo import ZoneInfo

    now = now or dt.datetime.now(dt.timezone.utc)
    if profile.fallback_scope == "user":
        if task == "daily":
            return previous_day_of(now.astimezone().date())
        return now.astimezone(ZoneInfo(LAKE_ZONE)).date()
    return now.astimezone().date()


def previous_day_of(day: dt.date) -> dt.date:
    """FN6 on a Python date."""
    return day - dt.timedelta(days=1)


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))
