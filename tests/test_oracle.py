"""Every registered query against its DuckDB twin (the driver's check), and
the reports against the literal form over the as-of cases of FIXTURES.md."""

import datetime as dt

import pytest

from compare import compare, duck
from conftest import SF0001, SF001

from markbook import LAKE_DAILY, LAKE_WEEKLY, oracle, registry
from markbook.plans import portfolio_daily, portfolio_rollup
from markbook.sources import standin

QUERIES = registry.queries()
SQL = registry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con_small():
    return duck(SF0001)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_small(spark, con_small, name):
    ok, msg = compare(QUERIES[name](spark, SF0001), con_small, SQL[name])
    assert ok, msg


AS_OF_CASES = [dt.date(2024, 1, 29), dt.date(2024, 1, 30), dt.date(2024, 1, 28), dt.date(2024, 1, 27),
               dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 2, 1)]


@pytest.mark.parametrize("as_of", AS_OF_CASES, ids=str)
def test_daily_matches_literal_form(spark, con, as_of):
    t = standin.load(spark, SF001)
    p = standin.standin_params(as_of=as_of)
    ok, msg = compare(portfolio_daily(spark, t, p), con, oracle.daily_sql(as_of=as_of))
    assert ok, msg
    ok, msg = compare(portfolio_daily(spark, t, p.with_(profile=LAKE_DAILY)), con,
                      oracle.daily_sql(as_of=as_of, lake=True))
    assert ok, msg


@pytest.mark.parametrize("as_of,min_rows", [(dt.date(2024, 1, 29), 10 ** 9), (dt.date(2023, 6, 5), 10 ** 9)],
                         ids=str)
def test_no_fallback_date(spark, con, as_of, min_rows):
    t = standin.load(spark, SF001)
    p = standin.standin_params(as_of=as_of, min_rows=min_rows)
    df = portfolio_daily(spark, t, p)
    ok, msg = compare(df, con, oracle.daily_sql(as_of=as_of, min_rows=min_rows))
    assert ok, msg


@pytest.mark.parametrize("dim", ["capitalization", "investment_style"])
def test_rollups_other_dates(spark, con, dim):
    t = standin.load(spark, SF001)
    for as_of in (dt.date(2024, 1, 30), dt.date(2024, 2, 1)):
        p = standin.standin_params(as_of=as_of)
        ok, msg = compare(portfolio_rollup(spark, t, p, dim), con, oracle.rollup_sql(dim, as_of=as_of))
        assert ok, msg
        ok, msg = compare(portfolio_rollup(spark, t, p.with_(profile=LAKE_WEEKLY), dim), con,
                          oracle.rollup_sql(dim, as_of=as_of, lake=True))
        assert ok, msg
