"""Registered queries (one per SURVEY section 2 ID) and their DuckDB twins.

Every query reads the stand-in tables derived from the driver's Parquet files
(whole tables; no id subsets or row caps).  Report-level IDs run the public
report functions; operator-level IDs run the operator on its own.  Money
columns of operator-level outputs are rounded to ``decimal(18,2)`` so both
engines print the same values.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .config import LAKE_DAILY, LAKE_WEEKLY, ReportParams
from .functions import dates as D
from .functions.money import percent, to_int
from .operators import chains, semi
from .operators import literal as L
from .operators.anchors import compute_anchors, date_row_counts, fx_rates, qualifying_dates
from .operators.lots import held_tickers, user_lots
from .operators.pivot import count_pivot, value_pivot
from .operators.prices import on_dates
from .operators.valuation import valuation
from .plans import other as X
from .plans.api import portfolio_daily, portfolio_daily_backfill, portfolio_rollup, portfolio_rollups
from .plans.backfill import read_backfill, write_backfill
from .plans.sql_functions import create_report_functions
from .session import ensure_checkpoint_dir
from .sources.sinks import write_bucketed, write_csv
from .sources import standin as S
from .sources.totals import add_batch, refresh, with_totals

AS_OF = S.STANDIN_AS_OF
BACKFILL_DATES = [dt.date(2024, 1, d) for d in (2, 3, 15, 26, 27, 28, 29, 30)] + [dt.date(2024, 2, 1)]


def _tables(spark: SparkSession, sf: str):
    return S.load(spark, sf)


def _params(**kw) -> ReportParams:
    return S.standin_params(**kw)


def _money(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _anchors(spark, t, p):
    lots = user_lots(t, p)
    a, _ = compute_anchors(spark, t, p, lots)
    return a, lots


MEASURES5 = ("cost_basis", "market_value", "gain_loss", "ytd_gain_loss", "today_gain_loss")


# ----------------------------------------------------------------- reports
def rpt1(spark, sf):
    return portfolio_daily(spark, _tables(spark, sf), _params())


def rpt2(spark, sf):
    return portfolio_daily(spark, _tables(spark, sf), _params(profile=LAKE_DAILY))


def _rollup(dim, profile=None):
    def q(spark, sf):
        p = _params() if profile is None else _params(profile=profile)
        return portfolio_rollup(spark, _tables(spark, sf), p, dim)
    return q


def _shared_tables(spark, sf):
    t = _tables(spark, sf)
    return replace(t, markets=S.shared_markets(t.markets))


def rpt1_shared(spark, sf):
    """RPT1 over listings that share descriptions (Q7)."""
    return portfolio_daily(spark, _shared_tables(spark, sf), _params())


def rpt2_shared(spark, sf):
    """RPT2 over listings that share descriptions and have several markets rows (Q2, Q7)."""
    return portfolio_daily(spark, _shared_tables(spark, sf), _params(profile=LAKE_DAILY))


def _maintained_tables(spark, sf):
    """Price totals kept in batches: history, then the as-of date and later, then rows of one dataset that come late
    for all dates (sent twice, as after a failure); two dates are taken from the fact anew."""
    t, path = _tables(spark, sf), f"{ensure_checkpoint_dir(spark).rstrip('/')}/totals-{uuid.uuid4().hex}"
    late = F.col("dataset") == "TIINGO"
    recent = F.col("date") >= F.lit(AS_OF)
    for rows, name in ((~late & ~recent, "history"), (~late & recent, "recent"), (late, "late"), (late, "late")):
        add_batch(spark, t.equities.where(rows), path, name)
    refresh(spark, t.equities, path, BACKFILL_DATES[5:7])
    return with_totals(spark, t, path)


def rpt1_maintained(spark, sf):
    """RPT1 whose fallback date and prices come from maintained totals (AGG3, AGG4)."""
    return portfolio_daily(spark, _maintained_tables(spark, sf), _params())


def rpt1_sql(spark, sf):
    """RPT1 as a table function, called with parameters of the session's SQL."""
    create_report_functions(spark, _tables(spark, sf), _params(), "warehouse_")
    return spark.sql("select * from warehouse_portfolio_daily(:who, :day)", {"who": S.STANDIN_USER, "day": AS_OF})


def rpt4_sql(spark, sf):
    """RPT4 as a table function."""
    create_report_functions(spark, _tables(spark, sf), _params(), "warehouse_")
    return spark.sql(f"select * from warehouse_portfolio_rollup('{S.STANDIN_USER}', date '{AS_OF}', 'location')")


def rpt7_location_sql(spark, sf):
    """RPT7 by location as a table function of the weekly lake profile."""
    create_report_functions(spark, _tables(spark, sf), _params(profile=LAKE_WEEKLY), "lake_")
    return spark.sql(f"select * from lake_portfolio_rollup('{S.STANDIN_USER}', date '{AS_OF}', 'location')")


def rpt5_shared(spark, sf):
    return portfolio_rollup(spark, _shared_tables(spark, sf), _params(), "capitalization")


def rpt7_shared(spark, sf):
    return portfolio_rollup(spark, _shared_tables(spark, sf), _params(profile=LAKE_WEEKLY), "capitalization")


def rpt8(spark, sf):
    return X.equities_snapshot(_tables(spark, sf), AS_OF)


def rpt9(spark, sf):
    return X.device_log_pivot(_tables(spark, sf).log, S.STANDIN_LOG_START, S.STANDIN_LOG_END,
                              S.STANDIN_DEVICES)


def rpt10(spark, sf):
    return X.cost_basis_report(_tables(spark, sf), AS_OF)


def rpt11(spark, sf):
    return X.day_change_report(_tables(spark, sf), AS_OF)


def ext1(spark, sf):
    return portfolio_daily(spark, _tables(spark, sf), _params(user=None))


def ext1_lake(spark, sf):
    """EXT1 under the weekly lake profile: the fallback date is per user."""
    return portfolio_rollup(spark, _tables(spark, sf), _params(user=None, profile=LAKE_WEEKLY), "location")


def ext2(spark, sf):
    return portfolio_daily_backfill(spark, _tables(spark, sf), _params(), BACKFILL_DATES)


def ext2_lake(spark, sf):
    """EXT2 under the daily lake profile, every user."""
    return portfolio_daily_backfill(spark, _tables(spark, sf), _params(user=None, profile=LAKE_DAILY), BACKFILL_DATES[2:6])


def ext2_resumed(spark, sf):
    """EXT2 written by date in two runs, the second skipping what the first has done, and read back."""
    t, p, path = _tables(spark, sf), _params(), f"{ensure_checkpoint_dir(spark).rstrip('/')}/backfill-{uuid.uuid4().hex}"
    write_backfill(spark, t, p, BACKFILL_DATES[:4], path)
    write_backfill(spark, t, p, BACKFILL_DATES, path)
    return read_backfill(spark, path)


def ext3(spark, sf):
    return portfolio_rollups(spark, _tables(spark, sf), _params())


# ------------------------------------------------------- sources and sinks
def src1(spark, sf):
    return _tables(spark, sf).equities


def src1_bucketed(spark, sf):
    """Prices and holdings laid out in buckets by ticker, then joined by ticker without an exchange of either:
    price rows and their average beside the lots of every ticker."""
    t, name = _tables(spark, sf), uuid.uuid4().hex
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/buckets-{name}"
    px = write_bucketed(t.equities, f"prices_{name}", f"{root}/prices", buckets=16)
    own = write_bucketed(t.portfolio, f"holdings_{name}", f"{root}/holdings", buckets=16)
    prices = px.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_prices"), _money(F.sum("close")).alias("close_sum"))
    lots = own.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_lots"), F.sum("quantity").cast("decimal(18,4)").alias("quantity"))
    return prices.join(lots, "ticker")


def src2(spark, sf):
    return _tables(spark, sf).portfolio


def src3(spark, sf):
    return _tables(spark, sf).markets


def src4(spark, sf):
    return _tables(spark, sf).currency


def src5(spark, sf):
    return _tables(spark, sf).log


def src6(spark, sf):
    """The one-row constant relations (user, data source, FX default, dates)
    evaluated for every price date."""
    p = _params()
    days = _tables(spark, sf).equities.select(F.col("date").alias("today")).distinct()
    return days.select(F.lit(p.user).alias("_user"), F.lit(p.dataset).alias("datasource"),
                       F.lit(p.fx_currency).alias("currency"),
                       F.lit(p.fx_default).cast("decimal(3,2)").alias("rate"),
                       "today", D.previous_weekday("today").alias("yesterday"))


def _csv_roundtrip(df: DataFrame, spark: SparkSession, path: str | None = None) -> DataFrame:
    """Written to ``path``, by default a new folder in the cluster's shared one."""
    path = path or os.path.join(ensure_checkpoint_dir(spark), "markbook-csv", uuid.uuid4().hex)
    write_csv(df, path)
    return spark.read.option("header", True).schema(", ".join(f"`{c}` string" for c in df.columns)).csv(path)


def snk1(spark, sf, path=None):
    return _csv_roundtrip(rpt1(spark, sf), spark, path)


def snk2(spark, sf, path=None):
    return _csv_roundtrip(rpt2(spark, sf), spark, path)


def par1(spark, sf):
    """Bound parameters: a user name with a quote cannot break the SQL."""
    t = _tables(spark, sf)
    return spark.sql("select _user, ticker, quantity, cost_per_share from {p} "
                     "where dataset = :ds and (_user = :user or _user = :tricky)",
                     args={"ds": "ALPHA-VANTAGE", "user": "R", "tricky": "R' or '1'='1"}, p=t.portfolio)


# ------------------------------------------------- projections and filters
def prj1(spark, sf):
    t = _tables(spark, sf)
    lots = user_lots(t, _params())
    return lots.select("ticker", "description", "quantity", "cost_per_share",
                       _money(F.col("quantity") * F.col("cost_per_share")).alias("cost_basis"))


def prj2(spark, sf):
    return _tables(spark, sf).equities.select("*")


def prj3(spark, sf):
    return portfolio_rollup(spark, _tables(spark, sf), _params(), "investment_style")


def flt1(spark, sf):
    t = _tables(spark, sf)
    return t.portfolio.where((F.col("dataset") == "ALPHA-VANTAGE") & (F.col("_user") == "R"))


def flt2(spark, sf):
    return _tables(spark, sf).equities.where(F.col("date") != F.lit(AS_OF))


def _anchor_dates(spark, sf):
    t = _tables(spark, sf)
    a, _ = _anchors(spark, t, _params())
    return t, a


def flt3(spark, sf):
    t, a = _anchor_dates(spark, sf)
    return t.equities.where(on_dates(a.dates()))


def flt4(spark, sf):
    t, a = _anchor_dates(spark, sf)
    return t.equities.where(on_dates(a.dates()) | F.col("date").isNull())


def _block_inputs(spark, sf, lake_weekly=False):
    t = _tables(spark, sf)
    p = _params(profile=LAKE_WEEKLY) if lake_weekly else _params()
    a, lots = _anchors(spark, t, p)
    return L.anchor_price_rows(t, p, a), lots, p, a, lake_weekly


def _blocks(spark, sf, lake_weekly=False):
    inputs = _block_inputs(spark, sf, lake_weekly)
    return L.blocks(*inputs), inputs[2]


def _fmt_block(df: DataFrame) -> DataFrame:
    return df.select(*[_money(c).alias(c) if c in MEASURES5 or c == "yesterday" else F.col(c)
                       for c in df.columns])


def flt5(spark, sf):
    (_, yesterday, _, _), _ = _blocks(spark, sf, lake_weekly=True)
    return _fmt_block(yesterday)


def flt6(spark, sf):
    t = _tables(spark, sf)
    p = _params()
    return t.equities.where(F.col("ticker").isin(p.fx_ticker, p.year_start_price_ticker, p.benchmark_ticker))


def flt7(spark, sf):
    (today, _, _, _), _ = _blocks(spark, sf)
    return _fmt_block(today)


def flt8(spark, sf):
    t = _tables(spark, sf)
    core = valuation(spark, t, _params())
    return _fmt_block(core.where(F.col("ticker") != "").drop("_user"))


def flt9(spark, sf):
    return rpt9(spark, sf)


def flt10(spark, sf):
    return _tables(spark, sf).equities.where(F.col("date") >= F.lit(D_BOY))


D_BOY = dt.date(AS_OF.year, 1, 2)


def sub1(spark, sf):
    """Scalar subquery: price rows on the fallback date.  The rows counted per date are those that pass the
    held tickers' filter and semi join; the date reaches the outer scan as a scalar subquery."""
    t = _tables(spark, sf)
    held = semi.semi_join(t.equities, held_tickers(t, _params()), "ticker")
    return spark.sql(
        "with full_days as (select date from {e} group by date, dataset having count(*) > 40) "
        "select q.* from {q} q where q.date = (select max(date) from full_days where date <> :d)",
        args={"d": AS_OF}, e=held, q=t.equities)


# ----------------------------------------------------------------- joins
def jn1(spark, sf):
    t = _tables(spark, sf)
    p = t.portfolio.where((F.col("dataset") == "ALPHA-VANTAGE") & (F.col("_user") == "R"))
    return p.join(t.markets, ["ticker", "dataset"]).select("ticker", "description", "asset_type", "quantity",
                                                           "cost_per_share")


def jn2(spark, sf):
    t = _tables(spark, sf)
    p = t.portfolio.where((F.col("dataset") == "ALPHA-VANTAGE") & (F.col("_user") == "R"))
    return p.join(t.markets.drop("dataset"), "ticker").select("ticker", "description", "asset_type",
                                                              "quantity", "cost_per_share")


def jn3(spark, sf):
    (today, _, ytd, _), _ = _blocks(spark, sf)
    return _fmt_block(ytd)


def jn4(spark, sf):
    return flt5(spark, sf)


def jn5(spark, sf):
    """Default-row fallback per price date: the latest rate on the date or its
    previous weekday, else the default."""
    t = _tables(spark, sf)
    asof = t.equities.select(F.col("date").alias("as_of")).where(F.col("as_of").isNotNull()).distinct() \
        .select("as_of", F.col("as_of").alias("today"), D.previous_weekday("as_of").alias("yesterday"))
    return fx_rates(t, _params(), asof)


def jn6(spark, sf):
    return _fmt_block(chains.ticker_chain(L.wide_blocks(*_block_inputs(spark, sf))))


def jn7(spark, sf):
    return chains.description_chain(L.wide_blocks(*_block_inputs(spark, sf)), "decimal(18,2)")


def jn6_shared(spark, sf):
    """JN6 where tickers have several markets rows: rows multiply."""
    return _fmt_block(chains.ticker_chain(L.wide_blocks(*_shared_inputs(spark, sf))))


def jn7_shared(spark, sf):
    """JN7 where tickers share descriptions as well."""
    return chains.description_chain(L.wide_blocks(*_shared_inputs(spark, sf)), "decimal(18,2)")


def _shared_inputs(spark, sf):
    t, p = _shared_tables(spark, sf), _params(profile=LAKE_WEEKLY)
    a, lots = _anchors(spark, t, p)
    return L.anchor_price_rows(t, p, a), lots, p, a, True


def jn8(spark, sf):
    """Price rows of tickers that anyone holds; a Bloom filter of the set is applied where they are read."""
    t = _tables(spark, sf)
    return semi.semi_join(t.equities, held_tickers(t, _params()), "ticker")


def jn9(spark, sf):
    """Price rows of the user's listed tickers: only ticker names are joined, and only price rows
    that pass the set's filter move (JN8 alike)."""
    t, p = _tables(spark, sf), _params(profile=LAKE_DAILY)
    own = t.portfolio.where((F.col("dataset") == p.dataset) & (F.col("_user") == p.user)).select("ticker").distinct()
    return semi.semi_join(t.equities, own.join(t.markets, "ticker", "left_semi"), "ticker")


def jn10(spark, sf):
    """Three-table join prices x holdings x markets on (dataset, ticker), at the
    (description, ticker, date) grain; pairs are counted, never materialised."""
    ph = X.priced_holdings(_tables(spark, sf), [AS_OF])
    return ph.groupBy("description", "ticker", "date").agg(
        *[_money(F.sum(c)).alias(c) for c in ("cost_basis", "market_value", "gain_loss")],
        F.sum("n_pairs").alias("n_pairs"))


def jn11(spark, sf):
    return rpt11(spark, sf)


# ----------------------------------------------------------- aggregation
def agg1(spark, sf):
    return user_lots(_tables(spark, sf), _params()).drop("_user")


def agg2(spark, sf):
    (_, _, _, backup), _ = _blocks(spark, sf)
    return _fmt_block(backup)


def agg3(spark, sf):
    t, a = _anchor_dates(spark, sf)
    return L.anchor_price_rows(t, _params(), a)


def agg4(spark, sf):
    t = _tables(spark, sf)
    counts = date_row_counts(t, held_tickers(t, _params()), F.col("date") != F.lit(AS_OF))
    return qualifying_dates(counts, 40)


def agg4_maintained(spark, sf):
    """AGG4 from the maintained totals: no price row is counted anew."""
    t = _maintained_tables(spark, sf)
    return qualifying_dates(date_row_counts(t, held_tickers(t, _params()), F.col("date") != F.lit(AS_OF)), 40)


def _core(spark, sf, **kw):
    return valuation(spark, _tables(spark, sf), _params(**kw))


def agg5(spark, sf):
    core = _core(spark, sf)
    return core.agg(*[_money(F.sum(m)).alias(m) for m in MEASURES5])


def agg6(spark, sf):
    core = _core(spark, sf)
    p = _params()
    return (core.where(F.col("ticker") == p.benchmark_ticker).groupBy(F.lit("Benchmark").alias("asset_type"))
            .agg(*[_money(F.sum(m)).alias(m) for m in MEASURES5]))


def agg7(spark, sf):
    core = _core(spark, sf)
    return (core.where(F.col("ticker") != "").groupBy("ticker", "description")
            .agg(*[_money(F.sum(m)).alias(m) for m in MEASURES5]))


def _dim_agg(dim):
    def q(spark, sf):
        core = _core(spark, sf)
        return (core.where(F.col("ticker") != "").groupBy(F.col(dim).alias("asset_type"))
                .agg(*[_money(F.sum(m)).alias(m) for m in MEASURES5]))
    return q


def agg12(spark, sf):
    return held_tickers(_tables(spark, sf), _params())


def agg13(spark, sf):
    return _tables(spark, sf).log.groupBy("date", "device").agg(F.count(F.lit(1)).alias("n"))


def agg14(spark, sf):
    t = _tables(spark, sf)
    return spark.sql(
        "select asset_type, location, capitalization, investment_style, description, ticker, quantity, "
        "cost_per_share from {p} join {m} using (ticker, dataset) "
        "where dataset = 'ALPHA-VANTAGE' and _user = :u group by 1, 2, 3, 4, 5, 6, 7, 8",
        args={"u": "R"}, p=t.portfolio, m=t.markets)


def agg15(spark, sf):
    t = _tables(spark, sf)
    d = (X.priced_holdings(t, [AS_OF]).groupBy("description")
         .agg(*[_money(F.sum(c)).alias(c) for c in ("cost_basis", "market_value", "gain_loss")]))
    return d


def pvt1(spark, sf):
    return count_pivot(_tables(spark, sf).log, "date", "device", S.STANDIN_DEVICES)


def pvt1_discovered(spark, sf):
    """PVT1 with the categories read from the data."""
    return count_pivot(_tables(spark, sf).log, "date", "device")


def rpt9_positional(spark, sf):
    """RPT9 with the devices read from the log, mapped to columns by sorted position (Q20)."""
    return X.device_log_pivot(_tables(spark, sf).log, S.STANDIN_LOG_START, S.STANDIN_LOG_END, None,
                              names=[f"device_{i}" for i in range(1, len(S.STANDIN_DEVICES) + 1)])


def pvt2(spark, sf):
    t = _tables(spark, sf)
    yday = D.previous_weekday_of(AS_OF)
    ph = X.priced_holdings(t, [AS_OF, yday])
    return value_pivot(ph, "description", "date", "market_value", [yday, AS_OF], ["yesterday", "today"],
                       "decimal(18,2)")


# ------------------------------------------------------- sort, top, sets
def srt1(spark, sf):
    return rpt1(spark, sf)


def srt2(spark, sf):
    return X.device_log_pivot(_tables(spark, sf).log, dt.date(2024, 1, 1), dt.date(2024, 12, 31),
                              S.STANDIN_DEVICES)


def srt3(spark, sf):
    return agg13(spark, sf).orderBy("date", "device")


def top1(spark, sf):
    return jn5(spark, sf)


def set1(spark, sf):
    return rpt1(spark, sf)


def set2(spark, sf):
    return portfolio_rollup(spark, _tables(spark, sf), _params(), "capitalization")


def set3(spark, sf):
    return rpt10(spark, sf)


# -------------------------------------------------------- scalar functions
def _dates(spark, sf):
    return _tables(spark, sf).equities.select("date").where(F.col("date").isNotNull()).distinct()


def fn1(spark, sf):
    ev = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    return ev.select("event_id", D.local_date("ts", "America/Los_Angeles").alias("local_date"))


def fn2(spark, sf):
    ev = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    return ev.select("event_id", D.local_date("ts", "America/Los_Angeles").alias("dst_date"),
                     D.local_date("ts", "-08:00").alias("fixed_date"))


def fn3(spark, sf):
    return _dates(spark, sf).select("date", D.previous_weekday("date").alias("yesterday"))


def fn4(spark, sf):
    return _dates(spark, sf).select("date", D.beginning_of_year("date").alias("beginning_of_year"))


def fn5(spark, sf):
    return _dates(spark, sf).select("date", F.date_sub("date", 3).alias("minus_3"),
                                    (F.col("date") - F.expr("interval 1 day")).cast("date").alias("minus_1d"))


def fn6(spark, sf):
    return _dates(spark, sf).select("date", D.previous_day("date").alias("previous_day"))


def fn7(spark, sf):
    """The coalesced keys and measures of the merged valuation rows."""
    return _fmt_block(_core(spark, sf).where(F.col("ticker").isNotNull()).drop("_user"))


def fn8(spark, sf):
    wd = F.weekday("date")
    return _dates(spark, sf).select(
        "date", F.when(wd == 0, "monday").when(wd == 6, "sunday").otherwise("other").alias("rule"))


def fn9(spark, sf):
    t, a = _anchor_dates(spark, sf)
    p = _params()
    conv = F.when(F.col("ticker") == p.fx_ticker,
                  F.col("close") * F.lit(a.rate).cast("decimal(10,4)") / 100).otherwise(F.col("close"))
    return t.equities.select("ticker", "date", F.round(conv, 6).cast("decimal(18,6)").alias("close"))


def fn10(spark, sf):
    return prj1(spark, sf)


def fn11(spark, sf):
    core = _core(spark, sf)
    return core.where(F.col("ticker") != "").select("ticker", percent("gain_loss", "cost_basis").alias("pct"))


def fn12(spark, sf):
    core = _core(spark, sf)
    return core.where(F.col("ticker") != "").select("ticker", *[to_int(m).alias(m) for m in MEASURES5])


def fn13(spark, sf):
    t = _tables(spark, sf)
    return t.portfolio.select("ticker", F.col("quantity").cast("decimal(10,4)").alias("quantity"),
                              F.col("cost_per_share").cast("decimal(6,2)").alias("cost_per_share"),
                              F.col("quantity").cast("string").alias("quantity_text"))


def fn14(spark, sf):
    out = ext3(spark, sf)
    return out.where(F.col("asset_type").isin("TOTAL", "Benchmark"))


def fn15(spark, sf):
    t = _tables(spark, sf)
    d = (X.priced_holdings(t, [AS_OF]).groupBy("description")
         .agg(*[F.sum(c).alias(c) for c in ("cost_basis", "market_value", "gain_loss")]))
    return d.select("description", percent("gain_loss", "market_value").alias("of_market_value"),
                    percent("gain_loss", "cost_basis").alias("of_cost_basis"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "rpt1": rpt1, "rpt2": rpt2,
        "rpt3": _rollup("asset_type"), "rpt4": _rollup("location"),
        "rpt5": _rollup("capitalization"), "rpt6": _rollup("investment_style"),
        "rpt7_asset_type": _rollup("asset_type", LAKE_WEEKLY),
        "rpt7_location": _rollup("location", LAKE_WEEKLY),
        "rpt7_capitalization": _rollup("capitalization", LAKE_WEEKLY),
        "rpt7_investment_style": _rollup("investment_style", LAKE_WEEKLY),
        "rpt1_shared": rpt1_shared, "rpt2_shared": rpt2_shared, "rpt5_shared": rpt5_shared, "rpt7_shared": rpt7_shared,
        "rpt1_sql": rpt1_sql, "rpt4_sql": rpt4_sql, "rpt7_location_sql": rpt7_location_sql, "rpt1_maintained": rpt1_maintained, "agg4_maintained": agg4_maintained,
        "rpt8": rpt8, "rpt9": rpt9, "rpt10": rpt10, "rpt11": rpt11,
        "ext1": ext1, "ext1_lake": ext1_lake, "ext2": ext2, "ext2_lake": ext2_lake, "ext2_resumed": ext2_resumed, "ext3": ext3,
        "src1": src1, "src1_bucketed": src1_bucketed, "src2": src2, "src3": src3, "src4": src4, "src5": src5, "src6": src6,
        "snk1": snk1, "snk2": snk2, "par1": par1,
        "prj1": prj1, "prj2": prj2, "prj3": prj3,
        "flt1": flt1, "flt2": flt2, "flt3": flt3, "flt4": flt4, "flt5": flt5, "flt6": flt6,
        "flt7": flt7, "flt8": flt8, "flt9": flt9, "flt10": flt10, "sub1": sub1,
        "jn1": jn1, "jn2": jn2, "jn3": jn3, "jn4": jn4, "jn5": jn5, "jn6": jn6, "jn7": jn7, "jn6_shared": jn6_shared, "jn7_shared": jn7_shared,
        "jn8": jn8, "jn9": jn9, "jn10": jn10, "jn11": jn11,
        "agg1": agg1, "agg2": agg2, "agg3": agg3, "agg4": agg4, "agg5": agg5, "agg6": agg6,
        "agg7": agg7, "agg8": _dim_agg("asset_type"), "agg9": _dim_agg("location"),
        "agg10": _dim_agg("capitalization"), "agg11": _dim_agg("investment_style"),
        "agg12": agg12, "agg13": agg13, "agg14": agg14, "agg15": agg15, "pvt1": pvt1, "pvt1_discovered": pvt1_discovered, "rpt9_positional": rpt9_positional, "pvt2": pvt2,
        "srt1": srt1, "srt2": srt2, "srt3": srt3, "top1": top1,
        "set1": set1, "set2": set2, "set3": set3,
        "fn1": fn1, "fn2": fn2, "fn3": fn3, "fn4": fn4, "fn5": fn5, "fn6": fn6, "fn7": fn7, "fn8": fn8,
        "fn9": fn9, "fn10": fn10, "fn11": fn11, "fn12": fn12, "fn13": fn13, "fn14": fn14, "fn15": fn15,
    }
    return q


def oracle_sql() -> dict[str, str]:
    return O.registered_sql()
