"""The valuation core: every held ticker valued at the four anchor dates.

The reference computes four grouped right joins (today, yesterday, 2 January,
fallback date), then merges them with two chains of full outer joins, first
on ticker (JN6), then on description (JN7).  With one price row per (ticker,
date), one markets row per ticker and one ticker per description, that whole chain is a
per-ticker formula over the wide anchor prices, so it is expressed as one join of the
position sums with the wide prices plus column arithmetic (SURVEY 7.2); where markets
rows or descriptions are shared, :mod:`.factorised` multiplies by counts and sums:

* ``v_d = coalesce(qty * p_d, cost)`` when a price row exists on date d;
* today ``T`` also counts the 2 January value for the year-start-price
  ticker when 2 January is priced and is not today (Q6), likewise the
  fallback value ``B``;
* ``ytd = coalesce(T - v_b if priced yesterday, B - v_b, 0)`` (Q9),
  ``today = coalesce(T - v_y, 0)``.

Rows that the reference keeps with NULL ticker (priced on 2 January only, or
unpriced holdings in the weekly lake job) stay as rows with NULL ticker and
zero gains: they change nothing in any report except that TOTAL gains are 0
rather than NULL when they are the only rows, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DIMENSIONS, ReportParams
from ..sources.tables import Tables
from .anchors import Anchors, backfill_anchors, compute_anchors, user_fallbacks
from .factorised import multiplied_rows, shares_markets
from .lots import user_positions
from .prices import ROLES, anchor_prices, anchor_prices_at, converted_price, daily_prices, prices_on, roles_of

MEASURES = ("cost_basis", "market_value", "gain_loss", "ytd_gain_loss", "today_gain_loss")


def _lit_date(d) -> Column:
    return F.lit(d).cast("date")


def legs(j: DataFrame, params: ReportParams, today: Column, boy: Column, max_known: Column, keys=()) -> DataFrame:
    """Joined positions x wide prices as one row per position: price flags ``h_*``, values ``v_y`` and ``v_b``, and the
    current (``on_t``, T, Tc) and fallback (``on_m``, B, Bc) value and cost.

    Projections that name their intermediate values once keep the expression trees small
    (Catalyst collapses them into one projection)."""
    h = {r: F.coalesce(F.col(f"h_{r}"), F.lit(False)) for r in ROLES}
    qty, cost = F.col("qty"), F.col("cost")
    is_ys = F.coalesce(F.col("ticker") == F.lit(params.year_start_price_ticker), F.lit(False))
    base = [*[F.col(k) for k in keys], "_user", "ticker", "description", *DIMENSIONS, "cost"]
    step1 = j.select(
        *base,
        *[h[r].alias(f"h_{r}") for r in ROLES],
        *[F.when(h[r], F.coalesce(F.col(f"p_{r}") * qty, cost)).alias(f"v_{r}") for r in ROLES],
        (is_ys & h["b"] & (today != boy)).alias("x_t"),
        (is_ys & h["b"] & (max_known.isNull() | (max_known != boy))).alias("x_m"))
    zero = F.lit(0)

    def leg(hd, xd, vd):
        hd, xd = F.col(hd), F.col(xd)
        val = F.when(hd | xd, F.when(hd, F.col(vd)).otherwise(zero) + F.when(xd, F.col("v_b")).otherwise(zero))
        basis = F.when(hd | xd, F.col("cost") * (hd.cast("int") + xd.cast("int")))
        return val, basis

    T, Tc = leg("h_t", "x_t", "v_t")
    B, Bc = leg("h_m", "x_m", "v_m")
    return step1.select(*base, *[f"h_{r}" for r in ROLES], "v_y", "v_b", (F.col("h_t") | F.col("x_t")).alias("on_t"),
                        (F.col("h_m") | F.col("x_m")).alias("on_m"), T.alias("T"), Tc.alias("Tc"), B.alias("B"), Bc.alias("Bc"))


def value_rows(j: DataFrame, params: ReportParams, today: Column, boy: Column,
               max_known: Column, keys=(), shared: bool = False) -> DataFrame:
    """Core rows from joined positions x wide prices: by the per-ticker formula, or where markets rows or
    descriptions are ``shared`` by counts and sums (:func:`.factorised.multiplied_rows`)."""
    rows = legs(j, params, today, boy, max_known, keys)
    if shared:
        return multiplied_rows(rows, params, keys)
    zero = F.lit(0)
    T, Tc, B, Bc, v_b = F.col("T"), F.col("Tc"), F.col("B"), F.col("Bc"), F.col("v_b")
    present = T.isNotNull() | F.col("h_y") | B.isNotNull()

    def keep(c):
        return F.when(present, F.col(c)).alias(c)

    # A NULL description never matches in the reference's join on
    # description: the today/yesterday row and the fallback row stay two rows
    # of the same ticker, which every report sums.  Their sum is used here;
    # the fallback part then adds no YTD or day change.
    no_desc = F.col("description").isNull()

    def both(a, b):
        return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, zero) + F.coalesce(b, zero))

    ytd_today_part = F.when(F.col("h_y"), T - v_b)
    return rows.select(
        *[F.col(k) for k in keys], "_user", keep("ticker"), keep("description"),
        *[keep(d) for d in DIMENSIONS],
        F.when(no_desc, both(Tc, Bc)).otherwise(F.coalesce(Tc, Bc)).alias("cost_basis"),
        F.when(no_desc, both(T, B)).otherwise(F.coalesce(T, B)).alias("market_value"),
        F.when(no_desc, both(T - Tc, B - Bc)).otherwise(F.coalesce(T - Tc, B - Bc)).alias("gain_loss"),
        F.when(no_desc, F.coalesce(ytd_today_part, zero))
        .otherwise(F.coalesce(ytd_today_part, B - v_b, zero)).alias("ytd_gain_loss"),
        F.coalesce(T - F.col("v_y"), zero).alias("today_gain_loss"))


def valuation(spark: SparkSession, tables: Tables, params: ReportParams,
              anchors: Anchors | None = None) -> DataFrame:
    """Core rows for one as-of date: (_user, ticker, description, dimensions,
    five measures).  One user (``params.user``) or every user (EXT1)."""
    prof = params.profile
    pos = user_positions(tables, params)
    per_user_fb = None
    if anchors is None:
        anchors, per_user_fb = compute_anchors(spark, tables, params, pos)
    role_dates = {"t": anchors.today, "y": anchors.yesterday, "b": anchors.boy,
                  "m": anchors.max_known if per_user_fb is None else None}
    px = anchor_prices_at(tables.prices(), role_dates, anchors.rate, params.fx_ticker)
    how = "left" if prof.keep_unpriced else "inner"
    if per_user_fb is None:
        j = pos.join(px, "ticker", how)
        max_known = _lit_date(anchors.max_known)
    else:
        # bounded by the calendar: the distinct fallback dates across users
        mdates = sorted(r["max_known"] for r in per_user_fb.select("max_known").distinct().collect()
                        if r["max_known"] is not None)
        pm = (prices_on(daily_prices(tables.prices(), mdates), anchors.rate, params.fx_ticker)
              .select("ticker", F.col("date").alias("max_known"),
                      F.col("price").alias("p_m_"), F.lit(True).alias("h_m_")))
        j = (pos.join(per_user_fb, "_user", "left")
             .join(pm, ["ticker", "max_known"], "left")
             .join(px.drop("p_m", "h_m"), "ticker", "left")
             .withColumnRenamed("p_m_", "p_m").withColumnRenamed("h_m_", "h_m"))
        if not prof.keep_unpriced:
            j = j.where(F.coalesce(F.col("h_t") | F.col("h_y") | F.col("h_b"), F.lit(False))
                        | F.coalesce(F.col("h_m"), F.lit(False)))
        max_known = F.col("max_known")
    return value_rows(j, params, _lit_date(anchors.today), _lit_date(anchors.boy), max_known, shared=anchors.shared)


def backfill_valuation(spark: SparkSession, tables: Tables, params: ReportParams, as_of_dates) -> DataFrame:
    """EXT2: core rows for many as-of dates in one job, keyed by ``as_of``.

    The anchors frame (one row per as-of date) is collected once and rebuilt
    as a local relation; the price scan reads only the union of anchor dates.
    """
    anchors = backfill_anchors(spark, tables, params, as_of_dates)
    rows = anchors.collect()  # one row per requested as-of date
    local = F.broadcast(spark.createDataFrame(rows, anchors.schema))  # bounded: one row per as-of date
    dates = sorted({r[c] for r in rows for c in ("today", "yesterday", "boy", "max_known") if r[c]})
    daily = daily_prices(tables.prices(), dates)
    px = anchor_prices(daily, roles_of(local), params.fx_ticker, keys=("as_of",))
    px = px.join(local.select("as_of", "today", "boy", "max_known"), "as_of")
    pos = user_positions(tables, params)
    shared = not params.allow_shared and shares_markets(tables, params)
    if params.profile.fallback_scope != "all":
        return _lake_backfill(tables, params, as_of_dates, local, px, pos, shared)
    j = pos.join(px, "ticker")
    return value_rows(j, params, F.col("today"), F.col("boy"), F.col("max_known"), keys=("as_of",), shared=shared)


def _lake_backfill(tables: Tables, params: ReportParams, as_of_dates, local: DataFrame, px: DataFrame,
                   pos: DataFrame, shared: bool) -> DataFrame:
    """Core rows of many as-of dates where every user has a fallback date of their own:
    each position meets its (as_of, ticker) prices and its user's fallback price."""
    fb = user_fallbacks(tables, params, as_of_dates, pos)
    known = sorted(r["max_known"] for r in fb.select("max_known").distinct().collect())  # calendar-bounded
    pm = daily_prices(tables.prices(), known).select("ticker", F.col("date").alias("max_known"), "close_sum", "close_n")
    wide = px.select("as_of", "ticker", *[c for r in ROLES if r != "m" for c in (f"p_{r}", f"h_{r}")])
    j = (pos.join(local.select("as_of", "today", "boy", "rate"))  # bounded: one row per requested date
         .join(wide, ["as_of", "ticker"], "left").join(fb, ["_user", "as_of"], "left").join(pm, ["ticker", "max_known"], "left"))
    j = j.withColumn("h_m", F.col("close_n").isNotNull()).withColumn("p_m", converted_price(params.fx_ticker))
    if not params.profile.keep_unpriced:
        priced = [F.coalesce(F.col(f"h_{r}"), F.lit(False)) for r in ROLES]
        j = j.where(priced[0] | priced[1] | priced[2] | priced[3])
    return value_rows(j, params, F.col("today"), F.col("boy"), F.col("max_known"), keys=("as_of",), shared=shared)
