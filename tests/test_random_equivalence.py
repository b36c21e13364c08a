"""Randomised differential test: the one-pass reports against the literal
join-chain SQL (DuckDB) on small random fixtures with the edge cases the
stand-in data may miss: NULL closes, the FX and year-start tickers, blank
tickers, duplicate lots, weekend as-of dates, sparse price dates, two
datasets, rates on some dates only."""

import datetime as dt
import random
from decimal import Decimal as D

import duckdb
import pandas as pd
import pytest

from compare import compare

from markbook import LAKE_DAILY, LAKE_WEEKLY, ReportParams, oracle
from markbook.plans import portfolio_daily, portfolio_rollup
from markbook.sources.tables import Tables

AV = "ALPHA-VANTAGE"
TICKERS = ["AA", "BB", "CC", "DD", "FX", "YS", "BM", ""]
DAYS = [dt.date(2024, 1, 2) + dt.timedelta(days=i) for i in range(32)]


def make_case(seed: int):
    rnd = random.Random(seed)
    prices = []
    for tk in TICKERS:
        for d in DAYS:
            if rnd.random() < 0.45:
                for _ in range(rnd.randint(1, 3)):
                    close = None if rnd.random() < 0.08 else D(f"{rnd.randint(100, 20000) / 100:.2f}")
                    prices.append((rnd.choice([AV, AV, "OTHER"]), tk, d, close))
    lots = []
    for user in ("U", "V"):
        for tk in rnd.sample(TICKERS, rnd.randint(3, len(TICKERS))):
            for _ in range(rnd.randint(1, 3)):
                lot = (AV, user, tk, D(f"{rnd.randint(1, 500) / 10:.4f}"), D(f"{rnd.randint(100, 9000) / 100:.2f}"))
                lots.append(lot)
                if rnd.random() < 0.3:
                    lots.append(lot)  # exact duplicate lot (Q1)
    kinds = ["Stock", "Bond", None]
    # descriptions are unique (the core's precondition) but may be missing
    markets = [(AV, tk, None if rnd.random() < 0.2 else f"{tk or 'blank'} desc", rnd.choice(kinds),
                rnd.choice(["US", "EU"]), rnd.choice(["Small", "Large"]), rnd.choice(["Value", "Growth"]))
               for tk in TICKERS]
    rates = [("GBP", d, D(f"{rnd.randint(11000, 14000) / 10000:.4f}")) for d in DAYS if rnd.random() < 0.5]
    as_of = rnd.choice(DAYS[1:])
    min_rows = rnd.choice([0, 1, 3, 6])
    return prices, lots, markets, rates, as_of, min_rows


def frames(spark, prices, lots, markets, rates):
    eq = spark.createDataFrame(prices, "dataset string, ticker string, date date, close decimal(18,6)")
    pf = spark.createDataFrame(lots, "dataset string, _user string, ticker string, quantity decimal(10,4), "
                                     "cost_per_share decimal(8,2)")
    mk = spark.createDataFrame(markets, "dataset string, ticker string, description string, asset_type string, "
                                        "location string, capitalization string, investment_style string")
    cur = spark.createDataFrame(rates, "currency string, date date, rate decimal(10,4)")
    return Tables(eq, pf, mk, cur)


def duck_con(prices, lots, markets, rates):
    con = duckdb.connect()
    dfs = {
        "equities_fact": pd.DataFrame(prices, columns=["dataset", "ticker", "date", "close"]),
        "portfolio_dim": pd.DataFrame(lots, columns=["dataset", "_user", "ticker", "quantity", "cost_per_share"]),
        "markets_dim": pd.DataFrame(markets, columns=["dataset", "ticker", "description", "asset_type", "location",
                                                      "capitalization", "investment_style"]),
        "currency_fact": pd.DataFrame(rates, columns=["currency", "date", "rate"]),
    }
    types = {"equities_fact": "dataset varchar, ticker varchar, date date, close decimal(18,6)",
             "portfolio_dim": "dataset varchar, _user varchar, ticker varchar, quantity decimal(10,4), "
                              "cost_per_share decimal(8,2)",
             "markets_dim": "dataset varchar, ticker varchar, description varchar, asset_type varchar, "
                            "location varchar, capitalization varchar, investment_style varchar",
             "currency_fact": "currency varchar, date date, rate decimal(10,4)"}
    for name, df in dfs.items():
        con.register(f"{name}_src", df)
        cols = ", ".join(f"cast({c.split()[0]} as {' '.join(c.split()[1:])}) as {c.split()[0]}"
                         for c in types[name].split(", "))
        con.execute(f"create table {name} as select {cols} from {name}_src")
    return con


@pytest.mark.parametrize("seed", range(7))
def test_reports_equal_literal_form(spark, seed):
    prices, lots, markets, rates, as_of, min_rows = make_case(seed)
    t = frames(spark, prices, lots, markets, rates)
    con = duck_con(prices, lots, markets, rates)
    base = ReportParams(as_of=as_of, user="U", min_rows=min_rows, fx_ticker="FX",
                        year_start_price_ticker="YS", benchmark_ticker="BM")
    kw = dict(as_of=as_of, user="U", min_rows=min_rows, fx_ticker="FX", ys_ticker="YS")
    cases = [
        (portfolio_daily(spark, t, base), oracle.daily_select(**kw)),
        (portfolio_daily(spark, t, base.with_(profile=LAKE_DAILY)), oracle.daily_select(lake=True, **kw)),
        (portfolio_rollup(spark, t, base, "asset_type"),
         oracle.rollup_select("asset_type", benchmark="BM", **kw)),
        (portfolio_rollup(spark, t, base.with_(profile=LAKE_WEEKLY), "location"),
         oracle.rollup_select("location", benchmark="BM", lake=True, **kw)),
    ]
    for df, ctes in cases:
        ok, msg = compare(df, con, ctes)
        assert ok, f"seed {seed} as_of {as_of} min_rows {min_rows}: {msg}"


@pytest.mark.parametrize("seed", range(10, 13))
def test_all_user_reports_equal_per_user_literal_forms(spark, seed):
    prices, lots, markets, rates, as_of, min_rows = make_case(seed)
    t = frames(spark, prices, lots, markets, rates)
    con = duck_con(prices, lots, markets, rates)
    base = ReportParams(as_of=as_of, user=None, min_rows=min_rows, fx_ticker="FX",
                        year_start_price_ticker="YS", benchmark_ticker="BM")
    kw = dict(as_of=as_of, min_rows=min_rows, fx_ticker="FX", ys_ticker="YS")
    users = sorted({lot[1] for lot in lots})

    def stacked(make):
        return oracle.stacked([(f"'{u}' as _user", make(u)) for u in users])

    cases = [
        (portfolio_daily(spark, t, base), stacked(lambda u: oracle.daily_select(user=u, **kw))),
        (portfolio_rollup(spark, t, base.with_(profile=LAKE_WEEKLY), "investment_style"),
         stacked(lambda u: oracle.rollup_select("investment_style", benchmark="BM", user=u,
                                              lake=True, **kw))),
    ]
    for df, sql in cases:
        ok, msg = compare(df, con, sql)
        assert ok, f"seed {seed} as_of {as_of} min_rows {min_rows}: {msg}"


def test_null_description_rows_stay_apart_like_the_literal_form(spark):
    # A has no description: priced today (10) and on the fallback date (9);
    # the literal join on description cannot merge the two rows
    T, Y = dt.date(2024, 1, 29), dt.date(2024, 1, 26)
    prices = [(AV, "A", T, D("10")), (AV, "A", Y, D("9")), (AV, "B", T, D("4")), (AV, "B", Y, D("3"))]
    lots = [(AV, "U", "A", D("1"), D("5")), (AV, "U", "B", D("2"), D("1"))]
    markets = [(AV, "A", None, "Stock", "US", "Large", "Value"), (AV, "B", "B desc", "Bond", "US", "Large", "Value")]
    t = frames(spark, prices, lots, markets, [])
    con = duck_con(prices, lots, markets, [])
    p = ReportParams(as_of=T, user="U", min_rows=0)
    kw = dict(as_of=T, user="U", min_rows=0, fx_ticker="LON:FCH", ys_ticker="VMMXX")
    for df, ctes in [(portfolio_daily(spark, t, p), oracle.daily_select(**kw)),
                     (portfolio_rollup(spark, t, p, "asset_type"),
                      oracle.rollup_select("asset_type", benchmark="VTSAX", **kw))]:
        ok, msg = compare(df, con, ctes)
        assert ok, msg
    a = {r["ticker"]: r for r in portfolio_daily(spark, t, p).collect()}["A"]
    assert a["cost_basis"] == 10 and a["market_value"] == 19 and a["today_gain_loss"] == 1
