"""EXT2 as a job that can be taken up again: daily reports of many as-of dates, one partition per date.

The dates are written in batches, each batch one Spark job (:func:`.api.portfolio_daily_backfill`) that
replaces exactly the partitions of its dates.  A date's folder appears when its batch commits, so the folders
say what is done: a run skips those dates, and a run that ended half way is simply started again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..config import ReportParams
from ..sources.tables import Tables
from .api import portfolio_daily_backfill

DATES_PER_JOB = 32


def written_dates(spark: SparkSession, path: str) -> set[dt.date]:
    """The as-of dates that are complete under ``path`` (none if there is nothing yet)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    return {dt.date.fromisoformat(n.removeprefix("as_of=")) for n in names if n.startswith("as_of=")}


def write_backfill(spark: SparkSession, tables: Tables, params: ReportParams, as_of_dates, path: str,
                   redo: bool = False, dates_per_job: int = DATES_PER_JOB) -> list[dt.date]:
    """Writes the reports that are not there yet (all of them with ``redo``) and returns their dates.  ``path`` holds
    the reports of one set of parameters; other partitions stay as they are."""
    dates = sorted(set(as_of_dates))
    todo = dates if redo else [d for d in dates if d not in written_dates(spark, path)]
    for i in range(0, len(todo), dates_per_job):
        report = portfolio_daily_backfill(spark, tables, params, todo[i:i + dates_per_job])
        # rows of a date are in few partitions already (one per report), so each writes few files
        report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(path)
    return todo


def read_backfill(spark: SparkSession, path: str) -> DataFrame:
    """The reports under ``path``, keyed by ``as_of``; a date filter reads that date's folder only."""
    out = spark.read.option("basePath", path).parquet(path)
    return out.select(out["as_of"].cast("date").alias("as_of"), *[f"`{c}`" for c in out.columns if c != "as_of"])
