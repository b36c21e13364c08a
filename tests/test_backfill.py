"""Backfill (EXT2) equals one run per as-of date, also in strict mode (Q5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001

from markbook.plans import portfolio_daily, portfolio_daily_backfill
from markbook.sources import standin

DATES = [dt.date(2024, 1, 26), dt.date(2024, 1, 29), dt.date(2024, 1, 30), dt.date(2024, 2, 1)]


@pytest.mark.parametrize("strict", [False, True])
def test_backfill_equals_single_runs(spark, strict):
    t = standin.load(spark, SF001)
    p = standin.standin_params(strict_as_of=strict)
    many = portfolio_daily_backfill(spark, t, p, DATES)
    for d in DATES:
        single = sorted(map(tuple, portfolio_daily(spark, t, p.with_(as_of=d)).collect()))
        part = sorted(map(tuple, many.where(F.col("as_of") == F.lit(d)).drop("as_of").collect()))
        assert part == single, d


@pytest.mark.parametrize("profile,strict", [("lake_daily", False), ("lake_daily", True), ("lake_weekly", False)])
def test_lake_backfill_equals_single_runs(spark, profile, strict):
    from markbook.config import PROFILES
    t = standin.load(spark, SF001)
    p = standin.standin_params(strict_as_of=strict, profile=PROFILES[profile], user=None)
    many = portfolio_daily_backfill(spark, t, p, DATES)
    for d in DATES[:3]:
        single = sorted(map(tuple, portfolio_daily(spark, t, p.with_(as_of=d)).collect()), key=str)
        part = sorted(map(tuple, many.where(F.col("as_of") == F.lit(d)).drop("as_of").collect()), key=str)
        assert part == single, d


def test_strict_mode_never_looks_ahead(spark):
    t = standin.load(spark, SF001)
    from markbook.operators.anchors import compute_anchors
    from markbook.operators.lots import user_positions
    p = standin.standin_params(strict_as_of=True)
    a, _ = compute_anchors(spark, t, p, user_positions(t, p))
    assert a.max_known is not None and a.max_known < p.as_of
    a2, _ = compute_anchors(spark, t, p.with_(strict_as_of=False), user_positions(t, p))
    assert a2.max_known == dt.date(2024, 1, 30)   # Q5: a later date is allowed by default


def test_backfill_is_taken_up_where_it_ended(spark, monkeypatch, tmp_path):
    """The second batch fails: the first stays, the next run writes the rest only, and a run after that nothing."""
    from markbook.plans import backfill

    t, p, path = standin.load(spark, SF001), standin.standin_params(), str(tmp_path / "reports")
    whole, runs = backfill.portfolio_daily_backfill, []

    def failing(spark, tables, params, dates):
        runs.append(list(dates))
        if len(runs) == 2:
            broken = F.udf(lambda x: 1 // 0, "int")
            return whole(spark, tables, params, dates).withColumn("cost_basis", broken("cost_basis").cast("bigint"))
        return whole(spark, tables, params, dates)

    monkeypatch.setattr(backfill, "portfolio_daily_backfill", failing)
    assert backfill.written_dates(spark, path) == set()
    with pytest.raises(Exception, match="division"):
        backfill.write_backfill(spark, t, p, DATES, path, dates_per_job=2)
    assert backfill.written_dates(spark, path) == set(DATES[:2])
    assert backfill.write_backfill(spark, t, p, DATES, path, dates_per_job=2) == DATES[2:]
    assert runs == [DATES[:2], DATES[2:], DATES[2:]]
    assert backfill.write_backfill(spark, t, p, DATES, path) == [] and len(runs) == 3
    want = whole(spark, t, p, DATES)
    back = backfill.read_backfill(spark, path).select(*[f"`{c}`" for c in want.columns])
    assert back.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))
    # one date again: the others' files stay
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "reports").rglob("*.parquet")}
    assert backfill.write_backfill(spark, t, p, DATES[:1], path, redo=True) == DATES[:1]
    kept = {f: f.stat().st_mtime_ns for f in (tmp_path / "reports").rglob("*.parquet")}
    assert {f: m for f, m in files.items() if "as_of=2024-01-26" not in str(f)} == {f: m for f, m in kept.items() if "as_of=2024-01-26" not in str(f)}
