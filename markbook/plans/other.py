"""Price snapshot (RPT8), device log pivot (RPT9) and the two retired reports
(RPT10 cost basis, RPT11 day change)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LOG_DEVICES, LOG_END, LOG_START, SNAPSHOT_ZONE, TOTAL_DESCRIPTION
from ..functions.dates import previous_weekday_of, today_in
from ..functions.money import percent, to_int
from ..operators.pivot import count_pivot, discover_categories
from ..operators.prices import on_dates
from ..sources.tables import Tables


def equities_snapshot(tables: Tables, as_of: dt.date | None = None) -> DataFrame:
    """RPT8: every price column on the as-of date (filter pushed to the scan);
    without one, today in the fixed -08:00 offset, like the reference's
    ``now() at time zone 'pst'``."""
    day = F.lit(as_of) if as_of is not None else today_in(SNAPSHOT_ZONE)
    return tables.equities.where(F.col("date") == day)


def device_log_pivot(log: DataFrame, start: dt.date = LOG_START, end: dt.date = LOG_END,
                     devices=LOG_DEVICES, order: bool = True, names=None) -> DataFrame:
    """RPT9: date x device row counts between two dates, newest first.

    One output column per declared device, matched by value (Q20); a date
    missing a device has NULL there, devices outside the list are ignored.  With ``devices=None`` the
    devices of the whole log are the columns, also those without a row between the dates; ``names``
    then maps them to columns by sorted position, as the reference's pivot does.
    The date range is filtered before the pivot, which Spark would do anyway.
    """
    devices = discover_categories(log, "device") if devices is None else devices
    out = count_pivot(log.where(F.col("date").between(F.lit(start), F.lit(end))), "date", "device", devices, names=names)
    return out.orderBy(F.col("date").desc()) if order else out


def _lot_sums(tables: Tables) -> DataFrame:
    """Holdings of every user reduced to one row per (dataset, ticker) before
    the join, so a heavily held ticker is one row, not one per lot."""
    return tables.portfolio.groupBy("dataset", "ticker").agg(
        F.sum("quantity").cast("decimal(18,4)").alias("qty"),
        F.sum(F.col("quantity") * F.col("cost_per_share")).alias("cost"),
        F.count(F.lit(1)).alias("n_lots"))


def _price_sums(tables: Tables, dates) -> DataFrame:
    return (tables.equities.where(on_dates(dates))
            .groupBy("dataset", "ticker", "date")
            .agg(F.sum("close").cast("decimal(24,6)").alias("close_sum"),
                 F.count("close").alias("close_n"),
                 F.count(F.lit(1)).alias("n_rows")))


def priced_holdings(tables: Tables, dates) -> DataFrame:
    """JN10: prices x holdings x markets on (dataset, ticker), at the grain the
    reports aggregate it to: sums over all (price row, lot) pairs and the number of
    pairs per (description, ticker, date), without producing the pairs.

    sum over (price row, lot) pairs of ``q * close`` equals
    ``sum(q) * sum(close)``; of ``q * cost`` equals ``rows * sum(q * cost)``,
    so both sides are pre-aggregated and the join is one-to-one per key."""
    mk = tables.markets.select("dataset", "ticker", "description")
    j = _price_sums(tables, dates).join(_lot_sums(tables), ["dataset", "ticker"]).join(mk, ["dataset", "ticker"])
    mv = F.col("qty") * F.col("close_sum")
    return j.select(
        "description", "ticker", "date",
        (F.col("cost") * F.col("n_rows")).alias("cost_basis"),
        F.when(F.col("close_n") > 0, mv).alias("market_value"),
        F.when(F.col("close_n") > 0, mv - F.col("cost") * F.col("close_n")).alias("gain_loss"),
        (F.col("n_lots") * F.col("n_rows")).alias("n_pairs"))


def _with_total(detail: DataFrame, measures) -> DataFrame:
    """TOTAL and the detail rows from one grouping, so the detail is planned once.  An
    all-NULL row stands in where nothing is priced: TOTAL always exists."""
    pad = detail.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in detail.schema], F.lit(True).alias("pad"))
    rows = detail.withColumn("pad", F.lit(False)).unionByName(pad)
    g = rows.groupingSets([["pad", "description"], []], "pad", "description").agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping_id().alias("gid"))
    total = F.col("gid") != 0
    return g.where(total | ~F.col("pad")).select(
        F.when(total, F.lit(TOTAL_DESCRIPTION)).otherwise(F.col("description")).alias("description"), *measures)


def cost_basis_report(tables: Tables, as_of: dt.date) -> DataFrame:
    """RPT10 (retired): cost basis, value and gain by description on one day,
    all users, plus a 'Portfolio Total' row (AGG15, SET3, FN15: gain as a
    share of market value)."""
    measures = ("cost_basis", "market_value", "gain_loss")
    detail = priced_holdings(tables, [as_of]).groupBy("description").agg(*[F.sum(c).alias(c) for c in measures])
    return _with_total(detail, measures).select(
        "description", to_int("cost_basis").alias("cost_basis"), to_int("market_value").alias("market_value"),
        to_int("gain_loss").alias("gain_loss"), percent("gain_loss", "market_value").alias("gain_loss_%"))


def day_change_report(tables: Tables, as_of: dt.date) -> DataFrame:
    """RPT11 (retired): RPT10 plus the change since the previous weekday.

    One pass over both days: the previous day's value by description (PVT2) is a conditional
    sum beside today's sums, and the inner join of the two (JN11) is the condition that the
    description has a row today."""
    yday = previous_weekday_of(as_of)
    today, before = F.col("date") == F.lit(as_of), F.col("date") == F.lit(yday)
    base = ("cost_basis", "market_value", "gain_loss")
    detail = priced_holdings(tables, [as_of, yday]).groupBy("description").agg(
        *[F.sum(F.when(today, F.col(c))).alias(c) for c in base],
        F.sum(F.when(before, F.col("market_value"))).cast("decimal(18,2)").alias("yesterday"),
        F.count(F.when(today, 1)).alias("n_today"))
    detail = detail.where("n_today > 0 and description is not null").select(
        "description", *base, (F.col("market_value") - F.col("yesterday")).alias("today_gain_loss"))
    return _with_total(detail, (*base, "today_gain_loss")).select(
        "description", to_int("cost_basis").alias("cost_basis"), to_int("market_value").alias("market_value"),
        to_int("gain_loss").alias("total_gain_loss"), percent("gain_loss", "market_value").alias("total_gain_loss_%"),
        to_int("today_gain_loss").alias("today_gain_loss"), percent("today_gain_loss", "market_value").alias("today_gain_loss_%"))


__all__ = ["equities_snapshot", "device_log_pivot", "priced_holdings", "cost_basis_report", "day_change_report"]
