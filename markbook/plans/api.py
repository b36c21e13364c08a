"""Public report entry points (what users call, SURVEY 2.10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ReportParams
from ..operators.valuation import backfill_valuation, valuation
from ..sources.tables import Tables, with_user_column
from .reports import all_rollups, daily_report, rollup_report


# Reports are always keyed by user internally, so every window and sort is
# per report; a single-user report drops the key column at the end.
KEYS = ["_user"]


def _users(spark: SparkSession, tables: Tables, params: ReportParams) -> DataFrame:
    """Report keys: the one user, or every user with lots in the dataset (each
    gets a report, and so a TOTAL row, as a per-user run would)."""
    if params.user is not None:
        return spark.range(1).select(F.lit(params.user).alias("_user"))
    if params.users:  # every requested user gets a report, holdings or not
        return spark.createDataFrame([(u,) for u in sorted(set(params.users))], "_user string")
    port = with_user_column(tables.portfolio).where(F.col("dataset") == params.dataset)
    return port.select("_user").distinct()


def _out(df: DataFrame, params: ReportParams) -> DataFrame:
    return df.drop("_user") if params.user is not None else df


def portfolio_daily(spark: SparkSession, tables: Tables, params: ReportParams,
                    order: bool = True) -> DataFrame:
    """RPT1 (warehouse profile) / RPT2 (lake profile); every user when
    ``params.user`` is None (EXT1, report keyed by ``_user``)."""
    return _out(daily_report(valuation(spark, tables, params), KEYS, order, _users(spark, tables, params)), params)


def portfolio_rollup(spark: SparkSession, tables: Tables, params: ReportParams, dimension: str,
                     order: bool = True) -> DataFrame:
    """RPT3-RPT7: roll-up by ``asset_type``, ``location``, ``capitalization`` or
    ``investment_style``."""
    return _out(rollup_report(valuation(spark, tables, params), dimension, params, KEYS, order,
                              _users(spark, tables, params)), params)


def portfolio_rollups(spark: SparkSession, tables: Tables, params: ReportParams,
                      order: bool = True) -> DataFrame:
    """EXT3: all four roll-ups from one valuation and one aggregate."""
    return _out(all_rollups(valuation(spark, tables, params), params, KEYS, order,
                            _users(spark, tables, params)), params)


def portfolio_daily_backfill(spark: SparkSession, tables: Tables, params: ReportParams, as_of_dates,
                             order: bool = True) -> DataFrame:
    """EXT2: daily reports for many as-of dates in one job, keyed by ``as_of``
    (and ``_user`` when ``params.user`` is None)."""
    core = backfill_valuation(spark, tables, params, as_of_dates)
    dates = F.array(*[F.lit(d).cast("date") for d in sorted(set(as_of_dates))])
    # every (as_of, user): the array of requested dates is bounded
    keys_df = _users(spark, tables, params).select(F.explode(dates).alias("as_of"), "_user")
    return _out(daily_report(core, ["as_of", *KEYS], order, keys_df), params)
