"""Maintained price totals equal the fact they are kept from, whatever the order rows arrive in."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from markbook.config import LAKE_DAILY
from markbook.operators.anchors import date_row_counts, qualifying_dates
from markbook.operators.lots import held_tickers
from markbook.plans import portfolio_daily, portfolio_daily_backfill
from markbook.sources import standin, totals
from markbook.sources.sinks import write_partitioned
from markbook.sources.totals import SCHEMA, add_batch, refresh, stored_totals, totals_of, with_totals

D1, D2, D3 = (dt.date(2024, 1, d) for d in (2, 3, 4))
FACT = "dataset string, ticker string, date date, close decimal(18,6)"
ROWS = [("A", "x", D1, 1), ("A", "x", D1, 2), ("A", "x", D1, None), ("B", "x", D1, 5), ("A", "y", D2, None),
        ("A", None, D2, 7), (None, "x", D2, 3), ("A", "x", None, 9), ("A", "y", D3, 4)]


def fact(spark, rows):
    return spark.createDataFrame([(a, b, d, None if c is None else float(c)) for a, b, d, c in rows],
                                 FACT.replace("decimal(18,6)", "double")).withColumn("close", F.col("close").cast("decimal(18,6)"))


def kept(spark, path):
    rows = stored_totals(spark, path).groupBy("date", "dataset", "ticker").agg(
        F.sum("close_sum"), F.sum("close_n"), F.sum("n_rows")).where("`sum(n_rows)` > 0")
    return sorted(map(str, (tuple(r) for r in rows.collect())))


def direct(rows):
    want = {}
    for ds, tk, d, c in rows:
        if d is not None:
            s, n, m = want.get((d, ds, tk), (None, 0, 0))
            want[d, ds, tk] = ((s or 0) + c if c is not None else s, n + (c is not None), m + 1)
    from decimal import Decimal
    return sorted(str((*k, None if s is None else Decimal(s).quantize(Decimal("0.000001")), n, m)) for k, (s, n, m) in want.items())


def test_batches_in_any_order_and_twice(spark, tmp_path):
    for order in ((0, 1, 2), (2, 0, 1), (1, 0, 1, 2, 2, 0)):
        path = str(tmp_path / "-".join(map(str, order)))
        for i in order:
            add_batch(spark, fact(spark, ROWS[i::3]), path, f"b{i}")
        assert kept(spark, path) == direct(ROWS)


def test_a_late_row_rewrites_its_date_only(spark, tmp_path):
    path = tmp_path / "t"
    assert add_batch(spark, fact(spark, ROWS), str(path), "first") == [D1, D2, D3]
    files = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    late = [("A", "z", D2, 8), ("A", "y", D2, 1)]
    assert add_batch(spark, fact(spark, late), str(path), "late") == [D2]
    now = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    other = {f for f in files if f"date={D2}" not in str(f)}
    assert len(other) and all(now.get(f) == files[f] for f in other)
    assert kept(spark, str(path)) == direct(ROWS + late)


def test_refresh_takes_whole_dates_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    add_batch(spark, fact(spark, ROWS), path, "first")
    add_batch(spark, fact(spark, [("A", "gone", D1, 8)]), path, "second")
    fixed = [r for r in ROWS if r[:2] != ("B", "x")] + [("A", "x", D1, 10)]
    assert refresh(spark, fact(spark, fixed), path, [D1]) == [D1]
    assert kept(spark, path) == direct(fixed)
    refresh(spark, fact(spark, [r for r in fixed if r[2] != D3]), path, [D3])  # the fact lost a date
    assert kept(spark, path) == direct([r for r in fixed if r[2] != D3])
    assert refresh(spark, fact(spark, fixed), path, []) == []


def test_nothing_yet_empty_batches_and_names(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored_totals(spark, path).collect() == []
    assert add_batch(spark, fact(spark, []), path, "none") == [] and stored_totals(spark, path).collect() == []
    assert add_batch(spark, fact(spark, [("A", "x", None, 1)]), path, "undated") == []
    with pytest.raises(ValueError):
        add_batch(spark, fact(spark, ROWS), path, totals.FACT)
    assert totals_of(fact(spark, ROWS), "b").schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()


def test_reports_read_the_totals(spark, tmp_path):
    """Daily (both profiles) and backfill equal the runs over the fact; a late batch changes them as the fact would."""
    t, path = standin.load(spark, SF001), str(tmp_path / "t")
    late = (F.col("dataset") == "TIINGO") & (F.col("date") == dt.date(2024, 1, 30))
    add_batch(spark, t.equities.where(~late), path, "first")
    add_batch(spark, t.equities.where(late), path, "late")
    kept_tables = with_totals(spark, t, path)
    for p in (standin.standin_params(), standin.standin_params(profile=LAKE_DAILY, user=None)):
        assert sorted(map(str, portfolio_daily(spark, kept_tables, p).collect())) == sorted(map(str, portfolio_daily(spark, t, p).collect()))
    p, dates = standin.standin_params(), [dt.date(2024, 1, 29), dt.date(2024, 1, 30)]
    assert sorted(map(str, portfolio_daily_backfill(spark, kept_tables, p, dates).collect())) == \
        sorted(map(str, portfolio_daily_backfill(spark, t, p, dates).collect()))


def test_plans_read_totals_and_one_date(spark, tmp_path):
    t, path, px = standin.load(spark, SF001), str(tmp_path / "t"), str(tmp_path / "px")
    write_partitioned(t.equities.where(F.col("date") >= dt.date(2024, 1, 25)), px)
    by_date = spark.read.parquet(px)
    night = [dt.date(2024, 1, 30)]
    plan = totals_of(by_date.where(totals._on(night)), "")._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-30" in plan.split("PartitionFilters: [")[1].split("]")[0]
    refresh(spark, by_date, path, night)
    assert [r["date"] for r in stored_totals(spark, path).select("date").distinct().collect()] == night
    from dataclasses import replace
    unread = replace(t, equities=t.equities.withColumn("close", F.raise_error(F.lit("the fact is read")).cast("decimal(18,6)")))
    add_batch(spark, t.equities, path, "all but the night")
    p = standin.standin_params()
    refresh(spark, t.equities, path, night)
    kept_tables = with_totals(spark, unread, path)
    counts = date_row_counts(kept_tables, held_tickers(t, p))
    want = date_row_counts(t, held_tickers(t, p)).where("date is not null")
    assert sorted(map(str, qualifying_dates(counts, 40).collect())) == sorted(map(str, qualifying_dates(want, 40).collect()))
    assert str(portfolio_daily(spark, kept_tables, p).collect()) == str(portfolio_daily(spark, t, p).collect())
