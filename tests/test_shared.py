"""Shared descriptions and several markets rows per ticker (Q2, Q7): the reports, which multiply by counts and
sums, against the join chains row by row, in DuckDB and as Spark operators."""

import random
import re
from dataclasses import replace

import pytest
from compare import compare
from pyspark.sql import functions as F
from test_random_equivalence import AV, TICKERS, duck_con, frames, make_case

from markbook import LAKE_DAILY, LAKE_WEEKLY, WAREHOUSE, ReportParams, oracle
from markbook.operators import chains, factorised, valuation
from markbook.operators import literal as L
from markbook.operators.anchors import compute_anchors
from markbook.operators.factorised import shares_markets
from markbook.operators.lots import user_lots, user_positions
from markbook.plans import portfolio_daily, portfolio_rollup
from markbook.plans.api import portfolio_daily_backfill
from markbook.plans.reports import daily_report, rollup_report


def shared_case(seed):
    prices, lots, _, rates, as_of, min_rows = make_case(seed)
    rnd = random.Random(1000 + seed)
    names = [None, "one", "one", "two", "three"]

    def row(dataset, tk):
        pick = [rnd.choice(x) for x in (["Stock", "Bond", None], ["US", "EU", None], ["Small", "Large"], ["Value", None])]
        return (dataset, tk, rnd.choice(names), *pick)

    markets = [row(d, tk) for tk in TICKERS for d in (AV, "OTHER") for _ in range(rnd.choice([0, 1, 1, 2]))]
    return prices, lots, markets, rates, as_of, min_rows


def parameters(as_of, min_rows, **kw):
    return ReportParams(as_of=as_of, min_rows=min_rows, fx_ticker="FX", year_start_price_ticker="YS", benchmark_ticker="BM", **kw)


@pytest.mark.parametrize("seed", range(4))
def test_reports_equal_joined_rows(spark, seed):
    prices, lots, markets, rates, as_of, min_rows = shared_case(seed)
    t, con = frames(spark, prices, lots, markets, rates), duck_con(prices, lots, markets, rates)
    kw = dict(as_of=as_of, user="U", min_rows=min_rows, fx_ticker="FX", ys_ticker="YS", joined=True)
    base = parameters(as_of, min_rows, user="U")
    cases = [(portfolio_daily(spark, t, base), oracle.daily_select(**kw)),
             (portfolio_daily(spark, t, base.with_(profile=LAKE_DAILY)), oracle.daily_select(lake=True, **kw)),
             (portfolio_rollup(spark, t, base, "asset_type"), oracle.rollup_select("asset_type", benchmark="BM", **kw)),
             (portfolio_rollup(spark, t, base.with_(profile=LAKE_WEEKLY), "location"),
              oracle.rollup_select("location", benchmark="BM", lake=True, **kw)),
             (portfolio_rollup(spark, t, base.with_(profile=LAKE_WEEKLY), "investment_style"),
              oracle.rollup_select("investment_style", benchmark="BM", lake=True, **kw))]
    for df, sql in cases:
        ok, msg = compare(df, con, sql)
        assert ok, f"seed {seed} as_of {as_of} min_rows {min_rows}: {msg}"


@pytest.mark.parametrize("seed", [40, 41, 42])
def test_one_pass_chains_equal_the_joins_row_by_row(spark, seed):
    prices, lots, markets, rates, as_of, min_rows = shared_case(seed)
    t = frames(spark, prices, lots, markets, rates)
    for profile in (WAREHOUSE, LAKE_WEEKLY):
        p = parameters(as_of, min_rows, user="U", profile=profile)
        a, _ = compute_anchors(spark, t, p, user_positions(t, p))
        inputs = L.anchor_price_rows(t, p, a), user_lots(t, p), p, a, profile.keep_unpriced
        today, yesterday, ytd, backup = L.blocks(*inputs)
        by_ticker = L.ticker_chain(today, yesterday, ytd)
        for got, want in ((chains.ticker_chain(L.wide_blocks(*inputs)), by_ticker),
                          (chains.description_chain(L.wide_blocks(*inputs)), L.description_chain(by_ticker, backup, ytd))):
            assert got.columns == want.columns
            rows = sorted([str(None if v is None else f"{v:.6f}" if hasattr(v, "quantize") else v) for v in r] for r in got.collect())
            assert rows == sorted([str(None if v is None else f"{v:.6f}" if hasattr(v, "quantize") else v) for v in r] for r in want.collect())


@pytest.mark.parametrize("seed", [20])
@pytest.mark.parametrize("profile", [WAREHOUSE, LAKE_DAILY, LAKE_WEEKLY], ids=lambda p: p.name)
def test_reports_equal_the_chain_operators(spark, seed, profile):
    prices, lots, markets, rates, as_of, min_rows = shared_case(seed)
    t = frames(spark, prices, lots, markets, rates)
    p = parameters(as_of, min_rows, user="U", profile=profile)
    a, _ = compute_anchors(spark, t, p, user_positions(t, p))
    today, yesterday, ytd, backup = L.blocks(L.anchor_price_rows(t, p, a), user_lots(t, p), p, a, profile.keep_unpriced)
    core = L.description_chain(L.ticker_chain(today, yesterday, ytd), backup, ytd).withColumn("_user", F.lit("U"))
    key = spark.range(1).select(F.lit("U").alias("_user"))
    for got, want in ((portfolio_daily(spark, t, p), daily_report(core, ["_user"], key_frame=key)),
                      (portfolio_rollup(spark, t, p, "asset_type"), rollup_report(core, "asset_type", p, ["_user"], key_frame=key))):
        assert sorted(map(str, got.collect())) == sorted(map(str, want.drop("_user").collect()))


def test_every_user_and_every_date_at_once(spark):
    prices, lots, markets, rates, as_of, min_rows = shared_case(30)
    t = frames(spark, prices, lots, markets, rates)
    for profile in (WAREHOUSE, LAKE_DAILY):
        p = parameters(as_of, min_rows, profile=profile)
        want = sorted(str(r) for u in ("U", "V") for r in portfolio_daily(spark, t, p.with_(user=u)).withColumn("_user", F.lit(u)).collect())
        every = portfolio_daily(spark, t, p)
        assert sorted(map(str, every.select(*[c for c in every.columns if c != "_user"], "_user").collect())) == want
        filled = portfolio_daily_backfill(spark, t, p, [as_of])
        assert sorted(map(str, filled.select(*[c for c in every.columns if c != "_user"], "_user").collect())) == want


def test_listing_probe(spark):
    prices, lots, markets, rates, as_of, min_rows = make_case(1)
    t = frames(spark, prices, lots, markets, rates)
    p = parameters(as_of, min_rows, user="U")
    assert not shares_markets(t, p) and not shares_markets(t, p.with_(profile=LAKE_DAILY))
    other = t.markets.where("ticker = 'AA'").withColumns({"dataset": F.lit("OTHER"), "location": F.lit("elsewhere")})
    t2 = replace(t, markets=t.markets.unionByName(other))
    assert not shares_markets(t2, p) and shares_markets(t2, p.with_(profile=LAKE_DAILY))
    assert not shares_markets(replace(t, markets=t.markets.unionByName(t.markets)), p)  # equal rows are one


def test_no_pairs_are_formed(spark):
    """800 tickers of one description: 512 million joined rows, summed from 800."""
    n = 800
    from decimal import Decimal as D
    import datetime as dt
    T, Y, B = dt.date(2024, 1, 29), dt.date(2024, 1, 26), dt.date(2024, 1, 2)
    prices = [(AV, f"K{i}", d, D(str(10 + k))) for i in range(n) for k, d in enumerate((B, Y, T))]
    lots = [(AV, "U", f"K{i}", D("1"), D("5")) for i in range(n)]
    markets = [(AV, f"K{i}", "same", "Stock", "US", "Large", "Value") for i in range(n)]
    r = portfolio_daily(spark, frames(spark, prices, lots, markets, []), ReportParams(as_of=T, user="U", min_rows=0)).where("ticker = 'TOTAL'").first()
    assert r["market_value"] == 12 * n ** 3 and r["ytd_gain_loss"] == 2 * n ** 3 and r["today_gain_loss"] == n ** 3


def one_description(spark, n, **attributes):
    """``n`` tickers of one description, priced on the three dates."""
    import datetime as dt
    from decimal import Decimal as D
    T, Y, B = dt.date(2024, 1, 29), dt.date(2024, 1, 26), dt.date(2024, 1, 2)
    prices = [(AV, f"K{i}", d, D(str(10 + k + i))) for i in range(n) for k, d in enumerate((B, Y, T))]
    lots = [(AV, "U", f"K{i}", D("1"), D("5")) for i in range(n)]
    cap = attributes.get("capitalization", lambda i: "Large")
    markets = [(AV, f"K{i}", "same", "Stock", "US", cap(i), "Value") for i in range(n)]
    return frames(spark, prices, lots, markets, []), ReportParams(as_of=T, user="U", min_rows=0)


def test_a_description_is_unfolded_in_chunks_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(chains, "CHUNK", 4, raising=False)
    t, p = one_description(spark, 14)
    a, _ = compute_anchors(spark, t, p, user_positions(t, p))
    inputs = L.anchor_price_rows(t, p, a), user_lots(t, p), p, a, False
    today, yesterday, ytd, backup = L.blocks(*inputs)
    want = L.description_chain(L.ticker_chain(today, yesterday, ytd), backup, ytd)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        got = chains.description_chain(L.wide_blocks(*inputs)).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert len({r["part"] for r in got}) > 1
    assert sorted(str(tuple(r)[:-1]) for r in got) == sorted(str(tuple(r)) for r in want.collect())


def test_small_cells_are_not_put_together_in_one_task(spark, monkeypatch):
    """Cells are small beside what they unfold to: joining small partitions by their bytes would leave it all to one task."""
    monkeypatch.setattr(chains, "CHUNK", 4)
    t, p = one_description(spark, 14)
    a, _ = compute_anchors(spark, t, p, user_positions(t, p))
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    got = chains.description_chain(L.wide_blocks(L.anchor_price_rows(t, p, a), user_lots(t, p), p, a))
    tasks = dict(got.groupBy(F.spark_partition_id()).count().collect())
    assert sum(tasks.values()) == 14 ** 3 and len(tasks) > 1


@pytest.mark.parametrize("seed", range(4))
def test_amounts_of_the_chain_are_cast_before_the_last_rows_are_formed(spark, monkeypatch, seed):
    monkeypatch.setattr(chains, "CHUNK", 2)
    prices, lots, markets, rates, as_of, min_rows = shared_case(seed)
    t, p = frames(spark, prices, lots, markets, rates), parameters(as_of, min_rows, user="U", profile=LAKE_WEEKLY)
    a, _ = compute_anchors(spark, t, p, user_positions(t, p))
    inputs = L.anchor_price_rows(t, p, a), user_lots(t, p), p, a, True
    today, yesterday, ytd, backup = L.blocks(*inputs)
    want = L.description_chain(L.ticker_chain(today, yesterday, ytd), backup, ytd)
    got = chains.description_chain(L.wide_blocks(*inputs), "decimal(18,2)")
    money = got.columns[-5:]
    want = want.select(*got.columns[:-5], *[F.col(c).cast("decimal(18,2)").alias(c) for c in money])
    assert got.dtypes == want.dtypes
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str(tuple(r)) for r in want.collect())
    # nothing is computed for the single row
    assert got._jdf.queryExecution().optimizedPlan().toString().startswith("Generate inline")


def test_missing_attributes_form_no_pairs_of_rows(spark, monkeypatch):
    """Rows that lack an attribute meet sums of the fallback rows, one per value of what they lack."""
    n, seen = 60, []
    own = factorised.multiplied_rows

    def counted(*args, **kw):
        rows = own(*args, **kw)
        seen.append(rows.count())
        return rows

    monkeypatch.setattr(valuation, "multiplied_rows", counted)
    t, p = one_description(spark, n, capitalization=lambda i: None if i % 2 else "Small" if i % 4 else "Large")
    portfolio_rollup(spark, t, p, "capitalization").collect()
    assert seen and max(seen) <= 6 * n  # 30 rows that lack it, 60 fallback rows: 1,800 pairs


def test_unpriced_holdings_are_not_gathered(spark):
    """Holdings without a price have no ticker; the rows alike that a window gathers are those of a ticker."""
    t, p = one_description(spark, 30)
    none = t.equities.where("ticker in ('K0', 'K1')")
    p = p.with_(profile=LAKE_WEEKLY)
    plan = portfolio_rollup(spark, replace(t, equities=none), p, "location")._jdf.queryExecution().optimizedPlan().toString()
    gathered = re.findall(r"collect_list\(.*?windowspecdefinition\(([^)]*?), specifiedwindowframe", plan)
    assert gathered and all(len(spec.split(", ")) >= 4 for spec in gathered), gathered  # user, ticker, unpriced or not, and its attributes
