"""Maintained price totals: counts and sums per (date, dataset, ticker), kept beside the price fact.

The fallback date (AGG4) counts price rows and the anchor prices (AGG3) average them, so both can be read from
stored totals, one row per listed ticker and date, instead of the fact.  The table is partitioned by ``date``, and
every change rewrites the partitions of the dates that it touches and no others:

* :func:`add_batch` adds the totals of newly arrived rows.  Each batch keeps rows of its own under its name, so a
  batch that is sent again after a failure replaces itself and is never counted twice; rows that come late for an
  old date rewrite that date only.
* :func:`refresh` takes whole dates from the fact anew (one date in a nightly run), after corrections or deletions;
  it also folds the batches of a date into one row per key.  Such a date holds all that the fact held, so a batch
  that was in the fact by then is not sent for it again.

``Tables.totals`` (see :func:`with_totals`) makes the reports read the totals.  Rows without a date are left out: no
anchor date selects them.  A date's partition is replaced when its job commits; if the driver is lost during that
commit, ``refresh`` the dates of the run.  One writer at a time, as for any Parquet folder.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .tables import Tables

KEYS = ("date", "dataset", "ticker")
SCHEMA = "dataset string, ticker string, batch string, close_sum decimal(24,6), close_n bigint, n_rows bigint, date date"
FACT = ""  # the batch name of totals taken from the fact itself


def _on(dates) -> Column:
    return F.col("date").isin(sorted(dates)) if dates else F.lit(False)


def totals_of(equities: DataFrame, batch: str) -> DataFrame:
    """Totals of price rows, reduced by every task before the shuffle."""
    sums = equities.where(F.col("date").isNotNull()).groupBy(*KEYS).agg(
        F.sum(F.col("close").cast("decimal(18,6)")).cast("decimal(24,6)").alias("close_sum"),
        F.count("close").alias("close_n"), F.count(F.lit(1)).alias("n_rows"))
    return sums.select("dataset", "ticker", F.lit(batch).alias("batch"), "close_sum", "close_n", "n_rows", "date")


def _exists(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)


def stored_totals(spark: SparkSession, path: str) -> DataFrame:
    """The rows under ``path`` by batch; no row if nothing was written yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def _replace(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def add_batch(spark: SparkSession, arrived: DataFrame, path: str, batch: str) -> list[dt.date]:
    """Adds the rows of ``arrived`` under the name ``batch`` and returns the dates rewritten.

    A batch names the same rows whenever it is sent: a second time replaces the first.  The dates of an earlier
    attempt that are not among the new rows keep that attempt's totals, so send a changed batch by ``refresh``."""
    if batch == FACT:
        raise ValueError("a batch needs a name")
    ensure_checkpoint_dir(spark)
    new = totals_of(arrived, batch).checkpoint(eager=True)  # read twice: for its dates, then for its rows
    dates = sorted(r["date"] for r in new.select("date").distinct().collect())  # calendar-bounded
    if dates:
        old = stored_totals(spark, path).where(_on(dates) & (F.col("batch") != batch))
        _replace(old.unionByName(new), path)
    return dates


def refresh(spark: SparkSession, equities: DataFrame, path: str, dates) -> list[dt.date]:
    """Takes the totals of ``dates`` from the fact anew; only these dates of it are read.  A date that the fact no
    longer has keeps one row per dataset and ticker with zero counts, which no report sees."""
    dates = sorted(set(dates))
    if not dates:
        return dates
    gone = stored_totals(spark, path).where(_on(dates)).select(
        "dataset", "ticker", F.lit(FACT).alias("batch"), F.lit(None).cast("decimal(24,6)").alias("close_sum"),
        F.lit(0).cast("bigint").alias("close_n"), F.lit(0).cast("bigint").alias("n_rows"), "date")
    rows = totals_of(equities.where(_on(dates)), FACT).unionByName(gone)
    one = rows.groupBy("dataset", "ticker", "batch", "date").agg(
        F.sum("close_sum").cast("decimal(24,6)").alias("close_sum"), F.sum("close_n").alias("close_n"), F.sum("n_rows").alias("n_rows"))
    _replace(one.select("dataset", "ticker", "batch", "close_sum", "close_n", "n_rows", "date"), path)
    return dates


def with_totals(spark: SparkSession, tables: Tables, path: str) -> Tables:
    """``tables`` whose reports read counts and prices from the totals under ``path``."""
    return replace(tables, totals=stored_totals(spark, path).where(F.col("n_rows") > 0))
