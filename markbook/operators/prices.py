"""Prices at the anchor dates (AGG3, FLT3, FN9).

The reference averages ``close`` by (ticker, date) over the four anchor dates,
merging datasets (Q18) and converting the pence-quoted ticker with the FX rate.
Here the price fact is scanned once for the anchor dates and reduced with a
map-side partial aggregate, so a hot ticker never reaches one task as raw rows.
A stored or partition ``date`` column prunes to the anchor dates themselves; where
``date`` is a cast of a timestamp, the range from the first to the last anchor
reaches the reader (see :func:`on_dates`):

* one as-of date (:func:`anchor_prices_at`): conditional sums per anchor role,
  grouped by ticker, one wide row per ticker, no join;
* many as-of dates (:func:`anchor_prices`): one row per (ticker, date), tagged
  with the roles that use the date (broadcast parameter frame), then pivoted
  per (as_of, ticker).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import price_average

ROLES = ("t", "y", "b", "m")  # today, yesterday, 2 January, fallback date


def on_dates(dates, column: str = "date") -> F.Column:
    """``column`` is one of ``dates``.  The range around them is stated too, because the
    optimizer turns a range over ``cast(ts as date)`` into a range over ``ts`` that the
    reader can use, which it does not do for a list."""
    days = sorted({d for d in dates if d is not None})
    c = F.col(column)
    if not days:
        return F.lit(False)
    return c.between(F.lit(days[0]), F.lit(days[-1])) & c.isin(days)


def daily_prices(equities: DataFrame, dates) -> DataFrame:
    """(ticker, date, close_sum, close_n, n_rows) for the given dates, from price rows or from totals of them."""
    if "close_sum" in equities.columns:
        return (equities.where(on_dates(dates)).groupBy("ticker", "date")
                .agg(F.sum("close_sum").cast("decimal(24,6)").alias("close_sum"),
                     F.sum("close_n").alias("close_n"), F.sum("n_rows").alias("n_rows")))
    return (equities.where(on_dates(dates))
            .groupBy("ticker", "date")
            .agg(F.sum(F.col("close").cast("decimal(18,6)")).cast("decimal(24,6)").alias("close_sum"),
                 F.count("close").alias("close_n"),
                 F.count(F.lit(1)).alias("n_rows")))


def anchor_prices_at(equities: DataFrame, role_dates: dict, rate: Decimal, fx_ticker: str) -> DataFrame:
    """Wide prices for ONE as-of date in a single aggregation, no join:
    conditional sums per role over ``date IN (anchor dates)``, grouped by
    ticker with a map-side partial aggregate and one shuffle.  ``equities`` may be totals of price rows."""
    dates = sorted({d for d in role_dates.values() if d is not None})
    totals = "close_sum" in equities.columns
    close = F.col("close_sum") if totals else F.col("close").cast("decimal(18,6)")
    aggs = []
    for r in ROLES:
        d = role_dates.get(r)
        if d is None:
            continue
        on = F.col("date") == F.lit(d)
        aggs += [F.sum(F.when(on, close)).cast("decimal(24,6)").alias(f"s_{r}"),
                 (F.sum(F.when(on, F.col("close_n"))) if totals else F.count(F.when(on, close))).alias(f"n_{r}"),
                 F.max(F.when(on, F.lit(True))).alias(f"h_{r}")]
    if not aggs:
        raise ValueError("no anchor dates")
    wide = equities.where(on_dates(dates)).groupBy("ticker").agg(*aggs)
    rate_lit = F.lit(rate).cast("decimal(10,4)")
    cols = ["ticker"]
    for r in ROLES:
        if role_dates.get(r) is None:
            cols += [F.lit(None).cast("decimal(18,6)").alias(f"p_{r}"), F.lit(None).cast("boolean").alias(f"h_{r}")]
            continue
        total = F.when(F.col("ticker") == fx_ticker, F.col(f"s_{r}") * rate_lit / 100).otherwise(F.col(f"s_{r}"))
        cols += [price_average(total, F.nullif(F.col(f"n_{r}"), F.lit(0))).alias(f"p_{r}"), F.col(f"h_{r}")]
    return wide.select(*cols)


def roles_of(anchors: DataFrame, roles=ROLES) -> DataFrame:
    """Long (as_of, role, date, rate) from a wide anchors frame (backfill)."""
    names = {"t": "today", "y": "yesterday", "b": "boy", "m": "max_known"}
    arr = F.array(*[F.struct(F.lit(r).alias("role"), F.col(names[r]).alias("date")) for r in roles])
    return (anchors.select("as_of", "rate", F.explode(arr).alias("r"))
            .select("as_of", "r.role", "r.date", "rate").where(F.col("date").isNotNull()))


def converted_price(fx_ticker: str) -> F.Column:
    """Average close; the pence-quoted ticker is ``close * rate / 100``."""
    total = F.when(F.col("ticker") == fx_ticker, F.col("close_sum") * F.col("rate") / 100) \
        .otherwise(F.col("close_sum"))
    return price_average(total, F.nullif(F.col("close_n"), F.lit(0)))


def anchor_prices(daily: DataFrame, roles: DataFrame, fx_ticker: str, keys=()) -> DataFrame:
    """Wide prices: (keys..., ticker, p_t, h_t, p_y, h_y, p_b, h_b, p_m, h_m).

    ``h_r`` says a price row exists on that role's date; ``p_r`` is its average
    close (NULL when every close is NULL: valued at cost, Q19).  Anchors that
    coincide are each filled independently.  ``roles`` is a parameter frame
    of at most four rows per requested as-of date, so it is broadcast.
    """
    tagged = daily.join(F.broadcast(roles), "date").withColumn("price", converted_price(fx_ticker))
    aggs = []
    for r in ROLES:
        is_r = F.col("role") == r
        aggs.append(F.max(F.when(is_r, F.col("price"))).alias(f"p_{r}"))
        aggs.append(F.max(F.when(is_r, F.lit(True))).alias(f"h_{r}"))
    return tagged.groupBy(*keys, "ticker").agg(*aggs)


def prices_on(daily: DataFrame, rate: Decimal, fx_ticker: str) -> DataFrame:
    """(ticker, date, price) for per-user fallback dates (lake profile)."""
    return (daily.withColumn("rate", F.lit(rate).cast("decimal(10,4)"))
            .select("ticker", "date", converted_price(fx_ticker).alias("price")))
