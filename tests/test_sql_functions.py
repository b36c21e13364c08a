"""Reports as SQL table functions equal the oracle and the DataFrame reports."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF001
from markbook import LAKE_DAILY, LAKE_WEEKLY, ReportParams, oracle
from markbook.plans import portfolio_daily, portfolio_rollup
from markbook.plans.sql_functions import create_report_functions
from markbook.sources import standin
from markbook.sources.totals import add_batch, with_totals
from test_random_equivalence import AV, duck_con, frames, make_case


def rows(df):
    return sorted(map(str, df.collect()))


def names(df):
    return [f"{f.name} {f.dataType.simpleString()}" for f in df.schema]


@pytest.mark.parametrize("seed", range(20, 24))
def test_functions_equal_the_rules_on_random_tables(spark, seed):
    prices, lots, markets, rates, as_of, min_rows = make_case(seed)
    t, con = frames(spark, prices, lots, markets, rates), duck_con(prices, lots, markets, rates)
    p = ReportParams(as_of=dt.date(1999, 1, 1), min_rows=min_rows, fx_ticker="FX", year_start_price_ticker="YS", benchmark_ticker="BM")
    kw = dict(as_of=as_of, user="U", min_rows=min_rows, fx_ticker="FX", ys_ticker="YS")
    for name, prof in (("w_", p), ("l_", p.with_(profile=LAKE_DAILY)), ("k_", p.with_(profile=LAKE_WEEKLY))):
        create_report_functions(spark, t, prof, name)
    args = {"who": "U", "day": as_of}
    for call, sql in (("w_portfolio_daily(:who, :day)", oracle.daily_select(**kw)),
                      ("l_portfolio_daily(:who, :day)", oracle.daily_select(lake=True, **kw)),
                      ("w_portfolio_rollup(:who, :day, 'asset_type')", oracle.rollup_select("asset_type", benchmark="BM", **kw)),
                      ("k_portfolio_rollup(:who, :day, 'location')", oracle.rollup_select("location", benchmark="BM", lake=True, **kw))):
        ok, msg = compare(spark.sql(f"select * from {call}", args), con, sql)
        assert ok, f"{call} seed {seed}: {msg}"


def test_columns_dimensions_and_users_without_holdings(spark):
    t, p = standin.load(spark, SF001), standin.standin_params()
    create_report_functions(spark, t, p)
    con = duck(SF001)
    daily = spark.sql("select * from portfolio_daily('R', date '2024-01-29')")
    assert names(daily) == names(portfolio_daily(spark, t, p))
    for dim in ("capitalization", "investment_style"):
        got = spark.sql("select * from portfolio_rollup('R', date '2024-01-29', :dim)", {"dim": dim})
        assert names(got) == names(portfolio_rollup(spark, t, p, dim))
        ok, msg = compare(got, con, oracle.rollup_sql(dim))
        assert ok, msg
    nobody = spark.sql("select * from portfolio_daily('nobody', date '2024-01-29')")
    assert rows(nobody) == rows(portfolio_daily(spark, t, p.with_(user="nobody"))) and nobody.count() == 1
    snapshot = spark.sql("select count(*) as n from equities_snapshot(date '2024-01-29')").first()["n"]
    assert snapshot == t.equities.where(F.col("date") == dt.date(2024, 1, 29)).count() > 0
    with pytest.raises(Exception, match="unknown dimension"):
        spark.sql("select * from portfolio_rollup('R', date '2024-01-29', 'colour')").collect()


def test_rows_join_with_other_tables(spark):
    t, p = standin.load(spark, SF001), standin.standin_params()
    create_report_functions(spark, t, p)
    got = spark.sql("""select m.location, sum(r.market_value) as v from portfolio_daily('R', date '2024-01-29') r
                       join markets m on m.ticker = r.ticker where r.ticker <> 'TOTAL' group by m.location order by v desc""").collect()
    one = portfolio_daily(spark, t, p).where("ticker <> 'TOTAL'").agg(F.sum("market_value").alias("v")).first()["v"]
    assert len(got) > 1 and sum(r["v"] or 0 for r in got) == one


def test_shared_listings_end_with_an_error(spark):
    day = dt.date(2024, 1, 29)
    prices = [(AV, "A", day, D("10")), (AV, "B", day, D("4"))]
    lots = [(AV, "U", "A", D("1"), D("5")), (AV, "U", "B", D("2"), D("1"))]
    same = [(AV, tk, "one name", "Stock", "US", "Large", "Value") for tk in "AB"]
    twice = [(AV, "A", "a", "Stock", "US", "Large", "Value"), (AV, "A", "a", "Bond", "US", "Large", "Value")]
    p = ReportParams(as_of=day, user="U", min_rows=0)
    for markets in (same, twice):
        t = frames(spark, prices, lots, markets, [])
        create_report_functions(spark, t, p, "s_")
        with pytest.raises(Exception, match="shared listings"):
            spark.sql("select * from s_portfolio_daily('U', date '2024-01-29')").collect()
        once = p.with_(allow_shared=True)
        create_report_functions(spark, t, once, "s_")
        assert rows(spark.sql("select * from s_portfolio_daily('U', date '2024-01-29')")) == rows(portfolio_daily(spark, t, once))
    unnamed = [(AV, tk, None, "Stock", "US", "Large", "Value") for tk in "AB"]  # missing names are not shared ones
    t = frames(spark, prices, lots, unnamed, [])
    create_report_functions(spark, t, p, "s_")
    assert rows(spark.sql("select * from s_portfolio_daily('U', date '2024-01-29')")) == rows(portfolio_daily(spark, t, p))


def test_strict_mode_quoted_names_and_empty_tables(spark):
    p = ReportParams(as_of=dt.date(2024, 1, 29), user="U", min_rows=0, strict_as_of=True, benchmark_ticker="it's", dataset="a'b\\c")
    prices, lots, markets, rates, *_ = make_case(31)
    t = frames(spark, prices, lots, markets, rates)
    create_report_functions(spark, t, p.with_(dataset=AV), "q_")
    assert rows(spark.sql("select * from q_portfolio_daily('U', date '2024-01-20')")) == \
        rows(portfolio_daily(spark, t, p.with_(dataset=AV, as_of=dt.date(2024, 1, 20))))
    create_report_functions(spark, t, p, "q_")
    assert [r["ticker"] for r in spark.sql("select * from q_portfolio_daily('U', date '2024-01-20')").collect()] == ["TOTAL"]
    create_report_functions(spark, frames(spark, [], [], [], []), p, "q_")
    assert [r["asset_type"] for r in spark.sql("select * from q_portfolio_rollup('U', date '2024-01-20', 'location')").collect()] == ["TOTAL"]


def test_prices_prune_to_the_anchor_dates_and_totals_are_read(spark, tmp_path):
    t, p, path = standin.load(spark, SF001), standin.standin_params(), str(tmp_path / "t")
    add_batch(spark, t.equities, path, "all")
    kept = with_totals(spark, t, path)
    create_report_functions(spark, kept, p, "m_")
    report = spark.sql("select * from m_portfolio_daily('R', date '2024-01-29')")
    ok, msg = compare(report, duck(SF001), oracle.daily_sql())
    assert ok, msg
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert any("2024-01-26" in f.split("]")[0] for f in plan.split("PartitionFilters: [")[1:])  # only the totals have partitions
