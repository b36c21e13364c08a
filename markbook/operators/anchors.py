"""Anchor values of a report run: dates, fallback date and FX rate.

* today / yesterday / 2 January: FN3-FN5 on the as-of date.
* fallback ("max known") date, AGG4: the latest date other than today on which
  some dataset has more than ``min_rows`` price rows for held tickers
  (the JN8 / JN9 ticker filter, written as an inner join on a distinct set; FLT10
  in the lake profile). The search reads recent dates first and widens.
* FX rate, TOP1 + JN5: the latest rate on today or yesterday, else 1.30.

The anchors are small (one row per as-of date, or per user in the lake
profile).  For one as-of date they are collected to the driver once and used
as literals, so the price scan gets ``date IN (...)`` pushed into Parquet.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Decimal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import ReportParams
from ..functions.dates import (beginning_of_year, beginning_of_year_of, previous_weekday,
                               previous_weekday_of)
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables
from .factorised import shares_markets
from .lots import held_tickers


@dataclass(frozen=True)
class Anchors:
    as_of: dt.date
    today: dt.date
    yesterday: dt.date
    boy: dt.date
    rate: Decimal
    max_known: dt.date | None = None  # warehouse profile / a single lake user
    shared: bool = False  # markets rows or descriptions are shared (Q2, Q7)

    def dates(self) -> list[dt.date]:
        ds = {self.today, self.yesterday, self.boy}
        if self.max_known is not None:
            ds.add(self.max_known)
        return sorted(ds)


def calendar_anchors(as_of):
    """today / yesterday / 2 January columns for an ``as_of`` date column."""
    return (F.col(as_of).alias("today"), previous_weekday(as_of).alias("yesterday"),
            beginning_of_year(as_of).alias("boy"))


def as_of_frame(spark: SparkSession, as_of_dates) -> DataFrame:
    """Parameter frame: one row per requested as-of date with its calendar anchors."""
    rows = [(d,) for d in as_of_dates]
    base = spark.createDataFrame(rows, "as_of date")
    return base.select("as_of", *calendar_anchors("as_of"))


def _date_literals(spark: SparkSession, as_of: dt.date) -> tuple[dt.date, dt.date, dt.date]:
    return as_of, previous_weekday_of(as_of), beginning_of_year_of(as_of)


def date_row_counts(tables: Tables, tickers: DataFrame, date_filter=None, by_user: bool = False) -> DataFrame:
    """AGG4 inner block: ``count(*)`` of price rows by (date, dataset) for the
    given (distinct) tickers (JN8/JN9).  With ``by_user`` the ticker set carries
    ``_user`` and the counts are per user: prices are first reduced to one row
    per (ticker, date, dataset) so a popular ticker is not replicated row by
    row across its holders."""
    px = tables.prices()
    n = F.count(F.lit(1)) if tables.totals is None else F.sum("n_rows")
    if date_filter is not None:
        px = px.where(date_filter)
    # map-side combine first: the join then sees one row per
    # (ticker, date, dataset), never the raw price rows.  ``tickers`` is a
    # distinct set, so an inner join equals the reference's semi join; it is
    # written as an inner join because Catalyst would push a semi join below
    # the aggregate, back onto raw rows (a shuffle of the whole price table
    # by ticker whenever the ticker set is not broadcast).
    per_ticker = px.groupBy("ticker", "date", "dataset").agg(n.alias("n"))
    if not by_user:
        return (per_ticker.join(tickers.select("ticker"), "ticker")
                .groupBy("date", "dataset").agg(F.sum("n").alias("n")))
    return (per_ticker.join(tickers.select("_user", "ticker"), "ticker")
            .groupBy("_user", "date", "dataset").agg(F.sum("n").alias("n")))


def qualifying_dates(counts: DataFrame, min_rows: int, by_user: bool = False) -> DataFrame:
    """HAVING count(*) > min_rows, then the distinct dates (per user)."""
    keys = ["_user", "date"] if by_user else ["date"]
    return counts.where(F.col("n") > min_rows).select(*keys).distinct()


# Lower bounds of the widening search for the fallback date, in days before
# the as-of date (None = no bound).  Dates after the as-of date are always
# included, so each step is exact; it only decides how much history to read.
LOOKBACK_DAYS = (7, 31, 366, None)


def _latest_qualifying(count_for, as_of: dt.date, floor: dt.date | None = None):
    """Latest qualifying date, reading as little history as possible.

    Whether a date qualifies depends on that date's rows only, so if some
    date at or above a lower bound qualifies, the latest of them is the
    answer over all dates; otherwise the bound widens.  With a
    date-partitioned fact a nightly run reads about a week of partitions
    instead of the whole history."""
    for days in LOOKBACK_DAYS:
        lower = None if days is None else as_of - dt.timedelta(days=days)
        if floor is not None and (lower is None or lower < floor):
            lower = floor
        found = count_for(lower)
        if found is not None or days is None or (floor is not None and lower == floor):
            return found
    return None


def fallback_date(tables: Tables, params: ReportParams, as_of: dt.date,
                  lots: DataFrame | None = None):
    """Fallback date for one as-of date.

    Warehouse profile: a single date (Python value, or None).
    Lake profile: per user (``_user, max_known`` DataFrame) when no single user
    is given, else a single date.
    """
    prof = params.profile
    thr = params.threshold
    not_today = (F.col("date") < F.lit(as_of)) if params.strict_as_of else (F.col("date") != F.lit(as_of))

    def since(lower):
        return not_today if lower is None else not_today & (F.col("date") >= F.lit(lower))

    if prof.fallback_scope == "all":
        held = held_tickers(tables, params)

        def count_for(lower):
            counts = date_row_counts(tables, held, since(lower))
            return qualifying_dates(counts, thr).agg(F.max("date").alias("d")).collect()[0]["d"]

        return _latest_qualifying(count_for, as_of)
    # lake: this user's tickers (after the markets join), from 2 January on
    boy = beginning_of_year_of(as_of)
    if lots is None:
        raise ValueError("lake profile needs the user's positions")
    lots = lots.select("_user", "ticker").distinct()
    if params.user is not None:
        tickers = lots.select("ticker")

        def count_for(lower):
            counts = date_row_counts(tables, tickers, since(lower))
            return qualifying_dates(counts, thr).agg(F.max("date").alias("d")).collect()[0]["d"]

        return _latest_qualifying(count_for, as_of, floor=boy)
    return user_fallbacks(tables, params, [as_of], lots).select("_user", "max_known")


def user_fallbacks(tables: Tables, params: ReportParams, as_of_dates, lots: DataFrame) -> DataFrame:
    """Lake profile: (_user, as_of, max_known) for every user with a fallback date on
    some of the as-of dates.

    Only the as-of date itself is excluded, so a user's two latest qualifying dates answer
    every as-of date (in strict mode, the two latest before each).  The search widens like
    :func:`_latest_qualifying`, and each step counts only for the users that are still
    without an answer; users x trading days is read for those alone."""
    spark = lots.sparkSession
    as_of_dates = sorted(set(as_of_dates))
    floor = min(beginning_of_year_of(d) for d in as_of_dates)
    asof = spark.createDataFrame([(d, beginning_of_year_of(d)) for d in as_of_dates], "as_of date, boy date")
    open_users = lots.select("_user", "ticker").distinct()
    found = None
    for days in LOOKBACK_DAYS:
        lower = floor if days is None else max(floor, as_of_dates[0] - dt.timedelta(days=days))
        counts = date_row_counts(tables, open_users, F.col("date") >= F.lit(lower), by_user=True)
        days_of = qualifying_dates(counts, params.threshold, by_user=True)
        if params.strict_as_of:
            # calendar-bounded per user: the dates since ``lower`` against the requested dates
            pairs = days_of.join(F.broadcast(asof), (F.col("date") < F.col("as_of")) & (F.col("date") >= F.col("boy")))
            step = pairs.groupBy("_user", "as_of").agg(F.max("date").alias("max_known"))
        else:
            latest = days_of.groupBy("_user").agg(F.max("date").alias("d1"))
            second = days_of.join(latest, "_user").where("date < d1").groupBy("_user").agg(F.max("date").alias("d2"))
            best = F.when(F.col("d1") != F.col("as_of"), F.col("d1")).otherwise(F.col("d2"))
            step = (latest.join(second, "_user", "left").join(F.broadcast(asof))
                    .select("_user", "as_of", best.alias("max_known"), "boy").where("max_known >= boy").drop("boy"))
        ensure_checkpoint_dir(spark)
        step = step.checkpoint(eager=True)  # read by the next step and by the report
        last = days is None or lower == floor
        if not last:
            done = step.groupBy("_user").agg(F.count("*").alias("n")).where(F.col("n") == len(as_of_dates)).select("_user")
            step = step.join(done, "_user", "left_semi")
            open_users = open_users.join(done, "_user", "left_anti")
        found = step if found is None else found.unionByName(step)
        if last or open_users.isEmpty():
            return found
    return found


def fx_rate(tables: Tables, params: ReportParams, today: dt.date, yesterday: dt.date) -> Decimal:
    """TOP1 + JN5: the latest rate of the currency on today or yesterday, else
    the default.  Ties on one date are broken by the larger rate (Q14)."""
    row = (tables.currency
           .where((F.col("currency") == params.fx_currency) & F.col("date").isin(today, yesterday))
           .agg(F.max_by("rate", F.struct("date", "rate")).alias("rate"))
           .collect()[0])
    return params.fx_default if row["rate"] is None else row["rate"]


def fx_rates(tables: Tables, params: ReportParams, asof: DataFrame) -> DataFrame:
    """TOP1 + JN5 for a frame of as-of dates: (as_of, rate)."""
    cur = tables.currency.where(F.col("currency") == params.fx_currency).select("date", "rate")
    days = asof.select("as_of", F.explode(F.array("today", "yesterday")).alias("date"))
    latest = (days.join(cur, "date").groupBy("as_of")
              .agg(F.max_by("rate", F.struct("date", "rate")).alias("rate")))
    return (asof.select("as_of").join(latest, "as_of", "left")
            .select("as_of", F.coalesce("rate", F.lit(params.fx_default).cast("decimal(10,4)"))
                    .alias("rate")))


def compute_anchors(spark: SparkSession, tables: Tables, params: ReportParams,
                    lots: DataFrame | None = None) -> tuple[Anchors, DataFrame | None]:
    """Anchors of one run.  Returns the literal anchors and, for the lake
    profile over many users, the per-user fallback frame."""
    as_of, yesterday, boy = _date_literals(spark, params.as_of)
    # the lookups are independent jobs: submit them together so the
    # scheduler runs them side by side instead of one after the other
    # (job group and local properties go along)
    own = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=3) as pool:
        rate_f = pool.submit(own(fx_rate), tables, params, as_of, yesterday)
        fb_f = pool.submit(own(fallback_date), tables, params, as_of, lots)
        shared_f = None if params.allow_shared else pool.submit(own(shares_markets), tables, params)
        rate, fb = rate_f.result(), fb_f.result()
        shared = bool(shared_f and shared_f.result())
    if isinstance(fb, DataFrame):
        # one row per user, read twice downstream (its distinct dates, then
        # the join): write it once to the shared checkpoint folder, which also
        # cuts the long lineage of the per-user counts
        ensure_checkpoint_dir(spark)
        fb = fb.checkpoint(eager=True)
        return Anchors(as_of, as_of, yesterday, boy, rate, None, shared), fb
    return Anchors(as_of, as_of, yesterday, boy, rate, fb, shared), None


def backfill_anchors(spark: SparkSession, tables: Tables, params: ReportParams, as_of_dates) -> DataFrame:
    """EXT2: anchors for many as-of dates in one frame (as_of, today, yesterday, boy,
    max_known, rate); in the lake profile max_known is NULL here.

    The qualifying dates do not depend on the as-of date except that the
    as-of date itself is excluded, so the fallback is the latest qualifying
    date, or the second latest when the latest is the as-of date; only those
    two dates reach the driver.  The history read widens like
    :func:`_latest_qualifying` until every as-of date has its answer (or all
    history has been read).  The frame has one row per requested date.
    """
    as_of_dates = sorted(set(as_of_dates))
    if params.profile.fallback_scope != "all":  # the fallback is per user, see user_fallbacks
        asof = as_of_frame(spark, as_of_dates)
        return asof.withColumn("max_known", F.lit(None).cast("date")).join(fx_rates(tables, params, asof), "as_of")
    asof = as_of_frame(spark, as_of_dates)
    held = held_tickers(tables, params)
    earliest = as_of_dates[0]
    for days in LOOKBACK_DAYS:
        lower = None if days is None else earliest - dt.timedelta(days=days)
        flt = F.col("date").isNotNull() if lower is None else F.col("date") >= F.lit(lower)
        qual = qualifying_dates(date_row_counts(tables, held, flt), params.threshold)
        if params.strict_as_of:
            # latest qualifying date strictly before each as-of date: both
            # sides are calendar-sized, one row per date
            marks = (qual.select("date", F.lit(True).alias("q"))
                     .unionByName(asof.select(F.col("as_of").alias("date"),
                                              F.lit(None).cast("boolean").alias("q")))
                     .groupBy("date").agg(F.max("q").alias("q")))
            w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
            prior = marks.select(F.col("date").alias("as_of"),
                                 F.max(F.when(F.col("q"), F.col("date"))).over(w).alias("max_known"))
            found = {r["as_of"]: r["max_known"] for r in asof.join(prior, "as_of", "left").collect()}
            if days is None or all(v is not None for v in found.values()):
                break
        else:
            top = [r["date"] for r in qual.orderBy(F.col("date").desc()).limit(2).collect()]
            d1 = top[0] if top else None
            d2 = top[1] if len(top) > 1 else None
            found = {d: (d1 if d1 != d else d2) for d in as_of_dates}
            if days is None or all(v is not None for v in found.values()):
                break
    fb = asof.join(F.broadcast(spark.createDataFrame(list(found.items()), "as_of date, max_known date")),
                   "as_of")  # bounded: one row per requested as-of date
    return fb.join(fx_rates(tables, params, asof), "as_of")
