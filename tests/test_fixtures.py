"""Hand-computed micro-fixtures, one per semantic quirk.

As-of date Monday 2024-01-29: yesterday is Friday 2024-01-26, the year
anchor is 2024-01-02.
"""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from markbook import LAKE_WEEKLY, ReportParams
from markbook.functions.money import percent, to_int
from markbook.operators.pivot import count_pivot
from markbook.plans import portfolio_daily, portfolio_rollup
from markbook.sources.tables import Tables

T, Y, B = dt.date(2024, 1, 29), dt.date(2024, 1, 26), dt.date(2024, 1, 2)
AV = "ALPHA-VANTAGE"


def tables(spark, prices, lots, markets=None, rates=()):
    eq = spark.createDataFrame([(AV, tk, d, None if c is None else D(str(c))) for tk, d, c in prices],
                               "dataset string, ticker string, date date, close decimal(18,6)")
    pf = spark.createDataFrame([(AV, u, tk, D(str(q)), D(str(c))) for u, tk, q, c in lots],
                               "dataset string, _user string, ticker string, quantity decimal(10,4), "
                               "cost_per_share decimal(8,2)")
    tickers = sorted({tk for _, tk, _, _ in lots} | {tk for tk, _, _ in prices})
    markets = markets or [(tk, f"{tk} Inc", "Stock", "US", "Large", "Blend") for tk in tickers]
    mk = spark.createDataFrame([(AV, *m) for m in markets],
                               "dataset string, ticker string, description string, asset_type string, "
                               "location string, capitalization string, investment_style string")
    cur = spark.createDataFrame([("GBP", d, D(str(r))) for d, r in rates], "currency string, date date, rate decimal(10,4)")
    return Tables(eq, pf, mk, cur)


def params(**kw):
    base = dict(as_of=T, user="U", min_rows=0)
    base.update(kw)
    return ReportParams(**base)


def rows_by_ticker(df):
    return {r["ticker"]: r for r in df.collect()}


def test_q1_identical_lots_count_once(spark):
    t = tables(spark, [("A", T, 7)], [("U", "A", 10, 5), ("U", "A", 10, 5), ("U", "A", 5, 6)])
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert r["A"]["cost_basis"] == 80 and r["A"]["market_value"] == 105
    assert r["TOTAL"]["market_value"] == 105 and r["A"]["mix_%"] == "100.00%"


def test_q6_year_start_ticker_counts_twice(spark):
    t = tables(spark, [("VMMXX", T, 1), ("VMMXX", B, 1)], [("U", "VMMXX", 100, 1)])
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert r["VMMXX"]["market_value"] == 200 and r["VMMXX"]["cost_basis"] == 200


def test_q6_year_start_ticker_once_on_2_january(spark):
    t = tables(spark, [("VMMXX", B, 1)], [("U", "VMMXX", 100, 1)])
    r = rows_by_ticker(portfolio_daily(spark, t, params(as_of=B)))
    assert r["VMMXX"]["market_value"] == 100


def test_q3_weekend_2_january_gives_zero_ytd(spark):
    # 2021-01-02 is a Saturday: no price on the year anchor, so YTD is 0
    as_of = dt.date(2021, 1, 5)
    t = tables(spark, [("A", as_of, 10), ("A", dt.date(2021, 1, 4), 9)], [("U", "A", 1, 5)])
    r = rows_by_ticker(portfolio_daily(spark, t, params(as_of=as_of)))
    assert r["A"]["ytd_gain_loss"] == 0 and r["A"]["today_gain_loss"] == 1


def test_q8_integer_cast_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(D("2.5"),), (D("-2.5"),), (D("2.4999"),)], "x decimal(10,4)")
    assert [r[0] for r in df.select(to_int("x")).collect()] == [3, -3, 2]


def test_q9_ytd_from_fallback_else_zero(spark):
    # B priced today and on 2 January, not yesterday; the fallback date
    # (latest other date) is yesterday, where B has no price -> YTD 0
    prices = [("A", T, 10), ("A", Y, 9), ("A", B, 8), ("B", T, 10), ("B", B, 8)]
    t = tables(spark, prices, [("U", "A", 1, 5), ("U", "B", 1, 5)])
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert r["B"]["ytd_gain_loss"] == 0 and r["B"]["today_gain_loss"] == 0
    assert r["A"]["ytd_gain_loss"] == 2 and r["A"]["today_gain_loss"] == 1
    # now give B a price on the fallback date: YTD = backup value - 2 January value
    t2 = tables(spark, prices + [("B", Y, 9.5)], [("U", "A", 1, 5), ("U", "B", 1, 5)])
    r2 = rows_by_ticker(portfolio_daily(spark, t2, params()))
    assert r2["B"]["today_gain_loss"] == 1 and r2["B"]["ytd_gain_loss"] == 2


def test_q9_backup_only_ticker(spark):
    # C is priced only on the fallback date: valued there, no day change
    prices = [("A", T, 10), ("C", dt.date(2024, 1, 25), 4)]
    t = tables(spark, prices, [("U", "A", 1, 5), ("U", "C", 2, 3)])
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert r["C"]["market_value"] == 8 and r["C"]["cost_basis"] == 6 and r["C"]["today_gain_loss"] == 0


def test_q12_zero_denominators_give_null_percent(spark):
    df = spark.createDataFrame([(D("0"), D("0"))], "a decimal(10,2), b decimal(10,2)")
    assert df.select(percent("a", "b")).collect()[0][0] is None


def test_fn11_large_percent_is_printed(spark):
    df = spark.createDataFrame([(D("99999999"), D("0.01"))], "a decimal(18,4), b decimal(18,4)")
    assert df.select(percent("a", "b")).collect()[0][0] == "999999990000.00%"


def test_totals_beyond_32_bits(spark):
    t = tables(spark, [("A", T, 90000)], [("U", "A", 99999, 9999)])
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert r["TOTAL"]["market_value"] == 8_999_910_000 and r["A"]["cost_basis"] == 999_890_001


def test_shared_descriptions_multiply_like_the_joins(spark):
    """Two tickers, one description, both priced today and on the fallback date (yesterday): each
    of the two rows meets two fallback rows."""
    mk = [("A", "Same", "Stock", "US", "Large", "Blend"), ("B", "Same", "Stock", "US", "Large", "Blend")]
    t = tables(spark, [("A", T, 10), ("B", T, 20), ("A", Y, 9), ("B", Y, 19)], [("U", "A", 1, 5), ("U", "B", 1, 5)], markets=mk)
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert (r["A"]["cost_basis"], r["A"]["market_value"], r["A"]["today_gain_loss"]) == (10, 20, 2)
    assert (r["TOTAL"]["cost_basis"], r["TOTAL"]["market_value"]) == (20, 60)
    r = rows_by_ticker(portfolio_daily(spark, t, params(allow_shared=True)))
    assert (r["TOTAL"]["cost_basis"], r["TOTAL"]["market_value"]) == (10, 30)


def test_several_markets_rows_multiply_by_ticker_and_description(spark):
    """Lake profile, one ticker with two markets rows: 2 today rows x 2 yesterday rows x 2 fallback rows,
    and the 2 January rows twice, once by ticker and once by description."""
    from markbook import LAKE_DAILY
    t = tables(spark, [("A", T, 10), ("A", Y, 9), ("A", B, 4)], [("U", "A", 1, 5)], markets=[("A", "A Inc", "Stock", "US", "Large", "Blend")])
    t.markets = t.markets.unionByName(spark.createDataFrame([("OTHER", "A", "A Inc", "Bond", "US", "Large", "Blend")], t.markets.schema))
    r = rows_by_ticker(portfolio_daily(spark, t, params(profile=LAKE_DAILY)))
    assert r["A"]["market_value"] == 10 * 32 and r["A"]["today_gain_loss"] == 32 and r["A"]["ytd_gain_loss"] == 6 * 32


def test_requested_user_without_holdings_gets_a_total(spark):
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5)])
    rows = portfolio_daily(spark, t, params(user=None, users=("U", "ZZZ"))).collect()
    assert {(r["_user"], r["ticker"]) for r in rows} == {("U", "TOTAL"), ("U", "A"), ("ZZZ", "TOTAL")}


def test_default_dates_per_profile_and_task():
    from markbook import LAKE_DAILY, WAREHOUSE
    from markbook.config import default_as_of
    now = dt.datetime(2024, 1, 30, 20, tzinfo=dt.timezone.utc)
    here = now.astimezone().date()
    assert default_as_of(WAREHOUSE, now) == here
    assert default_as_of(LAKE_DAILY, now) == here - dt.timedelta(days=1)
    assert default_as_of(LAKE_WEEKLY, now, task="weekly") == dt.date(2024, 1, 30)


@pytest.mark.parametrize("rates,expect", [([(Y, 1.5)], 15), ([(T, 1.21), (Y, 1.5)], 12), ([], 13)])
def test_q14_fx_rate_today_then_yesterday_then_default(spark, rates, expect):
    t = tables(spark, [("LON:FCH", T, 100)], [("U", "LON:FCH", 10, 1)], rates=rates)
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert r["LON:FCH"]["market_value"] == expect


def test_q15_benchmark_row_only_when_held(spark):
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5)])
    labels = [r["asset_type"] for r in portfolio_rollup(spark, t, params(), "asset_type").collect()]
    assert labels == ["TOTAL", "Stock"]
    t2 = tables(spark, [("A", T, 10), ("VTSAX", T, 3)], [("U", "A", 1, 5), ("U", "VTSAX", 2, 1)])
    rows = portfolio_rollup(spark, t2, params(), "asset_type").collect()
    assert [r["asset_type"] for r in rows] == ["Benchmark", "TOTAL", "Stock"]
    bench = rows[0]
    assert bench["market_value"] == "---" and bench["mix_%"] == "---" and bench["total_gain_loss_%"] == "200.00%"
    assert rows[1]["market_value"] == "16"


def test_q17_blank_ticker_in_total_not_in_detail(spark):
    t = tables(spark, [("A", T, 10), ("", T, 2)], [("U", "A", 1, 5), ("U", "", 3, 1)])
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert "" not in r and r["TOTAL"]["market_value"] == 16 and r["A"]["mix_%"] == "62.50%"


def test_q19_null_close_valued_at_cost(spark):
    t = tables(spark, [("A", T, None)], [("U", "A", 4, 2.5)])
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert r["A"]["market_value"] == 10 and r["A"]["total_gain_loss"] == 0


def test_nothing_priced_gives_one_total_row(spark):
    t = tables(spark, [("A", dt.date(2020, 1, 1), 1)], [("U", "A", 1, 5)])
    rows = portfolio_daily(spark, t, params(min_rows=10 ** 9)).collect()
    assert len(rows) == 1 and rows[0]["ticker"] == "TOTAL" and rows[0]["market_value"] is None


def test_flt5_unpriced_holding_changes_nothing(spark):
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5), ("U", "Z", 1, 5)])
    a = portfolio_rollup(spark, t, params(profile=LAKE_WEEKLY), "asset_type").collect()
    b = portfolio_rollup(spark, t, params(), "asset_type").collect()
    assert a == b


def test_pvt1_missing_cell_null_and_unknown_device_ignored(spark):
    log = spark.createDataFrame([(T, "router"), (T, "router"), (T, "firewall"), (Y, "router"), (Y, "toaster")],
                                "date date, device string")
    out = {r["date"]: r for r in count_pivot(log, "date", "device", ["firewall", "router"]).collect()}
    assert out[T]["router"] == 2 and out[T]["firewall"] == 1
    assert out[Y]["firewall"] is None and out[Y]["router"] == 1


def test_par1_quote_in_user_is_bound_safely(spark):
    t = tables(spark, [("A", T, 10)], [("O'Brien", "A", 1, 5), ("U", "A", 2, 5)])
    df = spark.sql("select * from {p} where _user = :u", args={"u": "O'Brien"}, p=t.portfolio)
    assert df.count() == 1
    r = rows_by_ticker(portfolio_daily(spark, t, params(user="O'Brien")))
    assert r["A"]["market_value"] == 10


def test_total_equals_sum_of_detail(spark):
    prices = [("A", T, 10), ("A", Y, 9), ("A", B, 8), ("B", Y, 4), ("C", T, 3), ("C", B, 2)]
    t = tables(spark, prices, [("U", "A", 3, 5), ("U", "B", 2, 1), ("U", "C", 7, 2)])
    from markbook.operators.valuation import valuation
    core = valuation(spark, t, params())
    total = core.agg(*[F.sum(c).alias(c) for c in ("cost_basis", "market_value", "ytd_gain_loss")]).collect()[0]
    detail = core.where(F.col("ticker") != "").agg(
        *[F.sum(c).alias(c) for c in ("cost_basis", "market_value", "ytd_gain_loss")]).collect()[0]
    assert total == detail


def test_report_column_layouts(spark):
    from markbook.plans.reports import DAILY_COLUMNS, ROLLUP_COLUMNS
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5)])
    assert tuple(portfolio_daily(spark, t, params()).columns) == DAILY_COLUMNS
    assert tuple(portfolio_rollup(spark, t, params(), "location").columns) == ROLLUP_COLUMNS


def test_precondition_violations(spark):
    from markbook.operators.lots import precondition_violations
    mk = [("A", "Same", "Stock", "US", "Large", "Blend"), ("B", "Same", "Stock", "US", "Large", "Blend"),
          ("C", "C Inc", "Stock", "US", "Large", "Blend"), ("C", "C Inc", "Bond", "US", "Large", "Blend")]
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5), ("U", "B", 1, 5), ("U", "C", 1, 5)], markets=mk)
    got = sorted((r["kind"], r["key"], r["n"]) for r in precondition_violations(t, params()).collect())
    assert got == [("description", "Same", 2), ("markets_key", "C|ALPHA-VANTAGE", 2)]


def test_fallback_search_widens_to_old_history(spark):
    from markbook import LAKE_DAILY
    from markbook.operators.anchors import compute_anchors
    from markbook.operators.lots import user_positions
    old = dt.date(2022, 6, 1)
    t = tables(spark, [("A", old, 10), ("A", T, 11)], [("U", "A", 1, 5)])
    p = params()
    a, _ = compute_anchors(spark, t, p, user_positions(t, p))
    assert a.max_known == old          # only found once all history is read
    t2 = tables(spark, [("A", old, 10), ("A", dt.date(2024, 3, 1), 9), ("A", T, 11)], [("U", "A", 1, 5)])
    a2, _ = compute_anchors(spark, t2, p, user_positions(t2, p))
    assert a2.max_known == dt.date(2024, 3, 1)   # later dates always count (Q5)
    # lake profile: nothing before 2 January counts
    pl = params(profile=LAKE_DAILY)
    a3, _ = compute_anchors(spark, t, pl, user_positions(t, pl))
    assert a3.max_known is None
    r = rows_by_ticker(portfolio_daily(spark, t, p))
    assert r["A"]["market_value"] == 11


def test_q18_prices_average_over_datasets(spark):
    t = tables(spark, [("A", T, 10)], [("U", "A", 2, 5)])
    other = spark.createDataFrame([("OTHER", "A", T, D("20"))], t.equities.schema)
    t.equities = t.equities.unionByName(other)
    r = rows_by_ticker(portfolio_daily(spark, t, params()))
    assert r["A"]["market_value"] == 30


def test_q7_literal_description_chain_multiplies_rows(spark):
    from markbook.operators import literal as L
    from markbook.operators.anchors import Anchors
    from markbook.operators.lots import user_lots
    mk = [("A", "Same", "Stock", "US", "Large", "Blend"), ("B", "Same", "Stock", "US", "Large", "Blend")]
    t = tables(spark, [("A", T, 10), ("B", T, 20), ("A", Y, 9), ("B", Y, 19)],
               [("U", "A", 1, 5), ("U", "B", 1, 5)], markets=mk)
    p = params()
    a = Anchors(T, T, Y, B, D("1.30"), Y)
    px = L.anchor_price_rows(t, p, a)
    today, yesterday, ytd, backup = L.blocks(px, user_lots(t, p), p, a)
    merged = L.description_chain(L.ticker_chain(today, yesterday, ytd), backup, ytd)
    assert merged.count() == 4          # 2 detail rows x 2 backup rows sharing "Same"


def test_q2_ticker_only_join_fans_out_and_is_reported(spark):
    from markbook import LAKE_DAILY
    from markbook.operators.lots import precondition_violations, user_positions
    mk = [("A", "A Inc", "Stock", "US", "Large", "Blend")]
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5)], markets=mk)
    extra = spark.createDataFrame([("OTHER", "A", "A Inc", "Bond", "US", "Large", "Blend")], t.markets.schema)
    t.markets = t.markets.unionByName(extra)
    assert user_positions(t, params()).count() == 1                      # (ticker, dataset) join
    assert user_positions(t, params(profile=LAKE_DAILY)).count() == 2    # ticker-only join fans out
    kinds = [r["kind"] for r in precondition_violations(t, params(profile=LAKE_DAILY)).collect()]
    assert kinds == ["markets_key"]


def test_pivot_categories_from_the_data(spark):
    from markbook.operators.pivot import discover_categories
    from markbook.plans.other import device_log_pivot
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(d1, "router"), (d1, "router"), (d1, "a.b`c"), (d2, "date"), (d2, None), (dt.date(2024, 3, 1), "new device")]
    log = spark.createDataFrame(rows, "date date, device string")
    assert discover_categories(log, "device") == ["a.b`c", "date", "new device", "router"]
    by_name = count_pivot(log.withColumnRenamed("date", "day"), "day", "device")
    assert by_name.columns == ["day", "a.b`c", "date", "new device", "router"]
    assert sorted(map(tuple, by_name.collect()))[:2] == [(d1, 1, None, None, 2), (d2, None, 1, None, None)]
    # by position; the new device has a column although its only row is outside the range
    out = device_log_pivot(log, d1, d2, None, names=["w", "x", "y", "z"])
    assert out.columns == ["date", "w", "x", "y", "z"]
    assert [tuple(r) for r in out.collect()] == [(d2, None, 1, None, None), (d1, 1, None, None, 2)]
    with pytest.raises(ValueError, match="3 columns for 4"):
        device_log_pivot(log, d1, d2, None, names=["w", "x", "y"])
    with pytest.raises(ValueError, match="more than 3"):
        discover_categories(log, "device", most=3)
    empty = count_pivot(log.limit(0), "date", "device")
    assert empty.columns == ["date"] and empty.collect() == []
