"""Stand-in logical tables derived from the driver's TPC-H-like Parquet files.

The reference ships no data.  These views map the test tables onto its five
logical tables (FIXTURES.md section 3) so that every report reads real rows
whose volume grows with the scale factor.  The same mapping is written in
DuckDB SQL in :mod:`markbook.oracle` for the correctness check.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables

# --- Stand-in parameters (the stand-in tickers that play the reference's
# special tickers, and the as-of date the tests use) ---
STANDIN_USER = "R"
STANDIN_FX_TICKER = "T7"
STANDIN_YEAR_START_TICKER = "T11"
STANDIN_BENCHMARK_TICKER = "T3"
STANDIN_AS_OF = dt.date(2024, 1, 29)
STANDIN_LOG_START = dt.date(2024, 1, 5)
STANDIN_LOG_END = dt.date(2024, 1, 25)
# device values present in the stand-in log (event types)
STANDIN_DEVICES = ("click", "error", "purchase", "signup", "view")


# columns used, with their stored types: given to the reader, so that opening a table reads nothing
SCHEMAS = {
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def equities(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    ev = _read(spark, sf_dir, "events") if ev is None else ev
    return ev.select(
        F.when(F.col("event_type").isin("click", "view", "purchase"), F.lit("ALPHA-VANTAGE"))
        .otherwise(F.lit("TIINGO")).alias("dataset"),
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("ticker"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").cast("decimal(18,6)").alias("close"),
    )


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    return part.join(geo, (part.p_partkey % 25) == geo.n_nationkey).select(
        F.lit("ALPHA-VANTAGE").alias("dataset"),
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("ticker"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("description"),
        F.col("p_type").alias("asset_type"),
        F.col("r_name").alias("location"),
        F.when(F.col("p_size") < 17, "Small").when(F.col("p_size") < 34, "Mid")
        .otherwise("Large").alias("capitalization"),
        F.when(F.col("p_retailprice") < 930, "Value").when(F.col("p_retailprice") < 960, "Blend")
        .otherwise("Growth").alias("investment_style"),
    )


def shared_markets(mk: DataFrame) -> DataFrame:
    """Stand-in listings that share names: tickers of one part name and type have one description, every
    seventh ticker has a second row in another dataset, every eleventh no capitalization."""
    number = F.substring("ticker", 2, 20).cast("bigint")
    rows = mk.select(
        "dataset", "ticker", F.concat(F.regexp_replace("description", " #.*", ""), F.lit(" "), F.col("asset_type")).alias("description"),
        "asset_type", "location", F.when(number % 11 != 0, F.col("capitalization")).alias("capitalization"), "investment_style")
    second = rows.where(number % 7 == 0).withColumns({"dataset": F.lit("TIINGO"), "asset_type": F.lit("Fund")})
    return rows.unionByName(second)


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    lots = li.select(
        F.lit("ALPHA-VANTAGE").alias("dataset"),
        F.col("l_returnflag").alias("_user"),
        F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("ticker"),
        F.col("l_quantity").cast("decimal(10,4)").alias("quantity"),
        (F.floor(F.col("l_extendedprice") * 2).cast("decimal(12,2)")
         * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(8,2)").alias("cost_per_share"),
        F.col("l_linenumber"),
    )
    # exact duplicate lots (quirk Q1): every first line is listed twice
    dup = lots.where(F.col("l_linenumber") == 1)
    return lots.unionAll(dup).drop("l_linenumber")


def currency(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    ev = _read(spark, sf_dir, "events") if ev is None else ev
    return (ev.where(F.col("event_type") == "view")
            .groupBy(F.col("ts").cast("date").alias("date"))
            .agg(F.round(F.lit(1.2) + F.avg("value") / 1000, 4).cast("decimal(10,4)").alias("rate"))
            .select(F.lit("GBP").alias("currency"), "date", "rate"))


def log(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    ev = _read(spark, sf_dir, "events") if ev is None else ev
    return ev.select(F.col("ts").cast("date").alias("date"), F.col("event_type").alias("device"))


def load(spark: SparkSession, sf_dir: str) -> Tables:
    """The five stand-in tables (lazy DataFrames; nothing is read yet).  ``events`` feeds
    three of them and is opened once."""
    ev = _read(spark, sf_dir, "events")
    return Tables(
        equities=equities(spark, sf_dir, ev),
        portfolio=portfolio(spark, sf_dir),
        markets=markets(spark, sf_dir),
        currency=currency(spark, sf_dir, ev),
        log=log(spark, sf_dir, ev),
    ).check()


def standin_params(**kw):
    """ReportParams with the stand-in tickers, user and as-of date."""
    from ..config import ReportParams

    base = dict(
        as_of=STANDIN_AS_OF,
        user=STANDIN_USER,
        fx_ticker=STANDIN_FX_TICKER,
        year_start_price_ticker=STANDIN_YEAR_START_TICKER,
        benchmark_ticker=STANDIN_BENCHMARK_TICKER,
    )
    base.update(kw)
    return ReportParams(**base)
