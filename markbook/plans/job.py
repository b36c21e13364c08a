"""The nightly / weekly report job (what the reference's cron runs), as one
Spark application per run.

* ``daily``: the daily report for the given users (all users when none are
  given) in ONE job keyed by user, instead of one query per user in series;
* ``weekly``: the four roll-ups from one valuation and one aggregate.

Reports are written as header CSV under ``out``, one directory per user
(``_user=<name>``), and in the weekly task one per user and dimension
(``_user=<name>/dimension=<name>``).  Usage::

    python -m markbook.plans.job --task daily --as-of 2024-01-29 \\
        --tables equities=/data/equities,portfolio=/data/portfolio,markets=/data/markets,currency=/data/currency \\
        --users A,B --out /shared/reports/2024-01-29
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..config import PROFILES, ReportParams, as_date, default_as_of
from ..sources.tables import Tables, read_tables
from .api import portfolio_daily, portfolio_rollups


def daily(spark: SparkSession, tables: Tables, params: ReportParams) -> DataFrame:
    return portfolio_daily(spark, tables, params.with_(user=None))


def weekly(spark: SparkSession, tables: Tables, params: ReportParams) -> DataFrame:
    return portfolio_rollups(spark, tables, params.with_(user=None))


def run(spark: SparkSession, tables: Tables, params: ReportParams, task: str, out: str) -> None:
    report = {"daily": daily, "weekly": weekly}[task](spark, tables, params)
    # one directory per report; a report's rows are already in one partition
    keys = ["_user", "dimension"] if task == "weekly" else ["_user"]
    report.write.mode("overwrite").option("header", True).partitionBy(*keys).csv(out)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--task", choices=["daily", "weekly"], required=True)
    ap.add_argument("--as-of", default=None, help="default: today (D1)")
    ap.add_argument("--tables", required=True, help="name=path pairs, comma separated")
    ap.add_argument("--users", default="", help="comma separated; empty = every user")
    ap.add_argument("--profile", default="warehouse", choices=sorted(PROFILES))
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--fx-ticker", default=None, help="pence-quoted ticker")
    ap.add_argument("--year-start-ticker", default=None, help="ticker also valued at its 2 January price")
    ap.add_argument("--benchmark-ticker", default=None)
    ap.add_argument("--min-rows", type=int, default=None, help="fallback-date threshold")
    ap.add_argument("--allow-shared", action="store_true", help="go on when tickers share a description")
    ap.add_argument("--shuffle-gb", type=float, default=None, help="expected largest shuffle, sets partition counts")
    ap.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    from ..session import apply_scale_conf, get_session

    spark = get_session(app_name=f"markbook-{a.task}")
    if a.shuffle_gb:
        apply_scale_conf(spark, int(a.shuffle_gb * (1 << 30)))
    paths = dict(kv.split("=", 1) for kv in a.tables.split(","))
    tables = read_tables(spark, paths, a.format)
    users = tuple(u for u in a.users.split(",") if u) or None
    profile = PROFILES[a.profile]
    as_of = as_date(a.as_of) if a.as_of else default_as_of(profile, task=a.task)
    params = ReportParams(as_of=as_of, users=users, profile=profile, min_rows=a.min_rows,
                          allow_shared=a.allow_shared)
    overrides = {"fx_ticker": a.fx_ticker, "year_start_price_ticker": a.year_start_ticker,
                 "benchmark_ticker": a.benchmark_ticker}
    params = params.with_(**{k: v for k, v in overrides.items() if v})
    run(spark, tables, params, a.task, a.out)


if __name__ == "__main__":
    main()
