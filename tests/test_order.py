"""Row order of the sorted outputs, and special branches the stand-in data does not reach."""

import datetime as dt
from decimal import Decimal as D

from conftest import SF001
from test_fixtures import AV, T, Y, params, tables

import __spark_entry__ as E
from markbook import LAKE_DAILY
from markbook.operators.anchors import Anchors, as_of_frame, fx_rates
from markbook.operators.literal import anchor_price_rows
from markbook.operators.lots import user_lots


def test_daily_report_has_total_first_then_falling_value(spark):
    for name in ("srt1", "rpt1"):
        rows = E.queries()[name](spark, SF001).collect()
        assert rows[0]["ticker"] == "TOTAL"
        values = [r["market_value"] for r in rows[1:] if r["market_value"] is not None]
        assert values == sorted(values, reverse=True)


def test_pivot_is_newest_first(spark):
    for name in ("srt2", "rpt9"):
        days = [r["date"] for r in E.queries()[name](spark, SF001).collect()]
        assert days == sorted(days, reverse=True)


def test_counts_are_sorted_by_date_and_device(spark):
    rows = [(r["date"], r["device"]) for r in E.queries()["srt3"](spark, SF001).collect()]
    assert rows == sorted(rows)


def test_ticker_only_join_meets_other_datasets(spark):  # JN2
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5)])
    t.markets = t.markets.unionByName(spark.createDataFrame([("OTHER", "A", "A elsewhere", "Bond", "US", "Large", "Blend")], t.markets.schema))
    assert user_lots(t, params()).count() == 1
    assert user_lots(t, params(profile=LAKE_DAILY)).count() == 2


def test_default_rate_without_a_quote(spark):  # JN5 / TOP1
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5)], rates=[(Y, 1.25)])
    days = as_of_frame(spark, [T, dt.date(2024, 2, 20)])
    assert {r["as_of"]: r["rate"] for r in fx_rates(t, params(), days).collect()} == {T: D("1.2500"), dt.date(2024, 2, 20): D("1.3000")}


def test_prices_without_a_date_are_kept_on_request(spark):  # FLT4
    t = tables(spark, [("A", T, 10)], [("U", "A", 1, 5)])
    t.equities = t.equities.unionByName(spark.createDataFrame([(AV, "A", None, D("3"))], t.equities.schema))
    a = Anchors(T, T, Y, dt.date(2024, 1, 2), D("1.30"), None)
    assert anchor_price_rows(t, params(), a).count() == 1
    kept = anchor_price_rows(t, params(), a, keep_null_dates=True).collect()
    assert {(r["date"], r["close"]) for r in kept} == {(T, D("10.000000")), (None, D("3.000000"))}


def test_cluster_without_a_shared_folder_is_an_error():
    import pytest
    from markbook.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
