"""The valuation core where markets rows or descriptions are shared (Q2, Q7).

A ticker with several markets rows has one position row per attribute set, and the
reference joins today, yesterday and 2 January on the ticker: every row of one meets every row of
the other.  Its second chain joins those rows with the fallback and 2 January rows on the description,
so tickers that share one multiply again.  Reports only sum the joined rows, and sums over such
products follow from counts and sums of each side:

* the rows of a ticker all have the same values, so a today row stands for ``m`` yesterday rows
  times ``m`` 2 January rows (``m``: markets rows of the ticker) as far as these are priced;
* each of those rows meets every fallback row and 2 January row of its description: its own values count
  (fallback rows) x (2 January rows) times; values it lacks come from the fallback rows' sums.

No pair of rows is formed; the reference fills *missing* attributes of a row from the
row that it meets.  So a today row with a missing attribute becomes one row per markets row of its ticker, and
rows with a missing dimension, or without ticker, and with a shared description are joined to counts and sums of
the fallback rows of that description, one per value of what they lack.

Counts and sums come from windows over (user, description) and (user, ticker): as for the share of total in
the reports, such a group is bounded by the listing, not by prices or lots.  Rows without a description
meet nothing and are dealt by ticker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DIMENSIONS, ReportParams
from ..sources.tables import Tables

ATTRIBUTES = ("description", *DIMENSIONS)


def shares_markets(tables: Tables, params: ReportParams) -> bool:
    """Whether some markets key has several rows or some description several keys, so that the
    reference's joins multiply rows.  Reads the markets table only."""
    keys = ["ticker", "dataset"] if params.profile.markets_on_dataset else ["ticker"]
    mk = tables.markets
    if params.profile.markets_on_dataset:
        mk = mk.where(F.col("dataset") == params.dataset)
    rows = mk.select(*keys, *ATTRIBUTES).distinct()
    # one aggregate over both kinds of name: a key or a description met twice
    names = F.array(F.struct(F.lit("key").alias("kind"), F.concat_ws("\0", *keys).alias("name")),
                    F.struct(F.lit("description").alias("kind"), F.col("description").alias("name")))
    met = rows.select(F.explode(names).alias("x")).where("x.name is not null").groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    return bool(met.where("n > 1").limit(1).collect())


def _times(value: Column, count: Column) -> Column:
    """An exact product: 10 decimals stay, and what does not fit is an error."""
    return value.cast("decimal(26,10)") * count.cast("decimal(11,0)")


def _plus(a: Column, b: Column) -> Column:
    """Sum in which a missing side counts nothing; missing if both are."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def multiplied_rows(legs: DataFrame, params: ReportParams, keys=()) -> DataFrame:
    """Core rows whose sums equal those of the reference's joined rows; ``legs``: one row per
    position with its legs (:func:`.valuation.legs`)."""
    own = [*keys, "_user"]
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    w = legs.withColumn("unpriced", ~(F.col("h_t") | F.col("h_y") | F.col("h_b") | F.col("h_m")))
    if params.profile.keep_unpriced:
        # holdings without a price have no ticker on the price side: equal attributes are one row
        alike = Window.partitionBy(*own, *ATTRIBUTES, "unpriced").orderBy("ticker")
        w = (w.withColumn("nth", F.row_number().over(alike)).where(~F.col("unpriced") | (F.col("nth") == 1))
             .withColumn("ticker", F.when(~F.col("unpriced"), F.col("ticker"))))
    else:
        w = w.where(~F.col("unpriced"))

    # rows of the first chain ("d", each standing for n) beside the fallback and 2 January rows ("k")
    # (an unpriced row has no ticker and meets none: each is a group of its own, or all of a user would be gathered)
    per_ticker = Window.partitionBy(*own, "ticker", "unpriced", F.when(F.col("unpriced"), F.struct(*ATTRIBUTES)))
    attributes = [F.col(c).alias(c) for c in ATTRIBUTES]
    w = w.withColumns({"m": F.count(F.lit(1)).over(per_ticker), "alike": F.collect_list(F.struct(*attributes)).over(per_ticker)})
    on_both, gap = F.col("on_t") & F.col("h_y"), F.lit(False)
    for c in ATTRIBUTES:
        gap = gap | F.col(c).isNull()
    by_january = F.when(F.col("h_y") & F.col("h_b"), F.col("m")).otherwise(one)
    single = F.array(F.struct(F.lit(True).alias("d"), *attributes, (F.when(on_both, F.col("m")).otherwise(one) * by_january).alias("n")))
    filled_in = F.transform("alike", lambda o: F.struct(F.lit(True).alias("d"), *[F.coalesce(F.col(c), o[c]).alias(c) for c in ATTRIBUTES], by_january.alias("n")))
    later = F.array(F.struct(F.lit(False).alias("d"), *attributes, one.alias("n")))
    none = F.slice(later, 1, 0)
    firsts = F.when(on_both & gap & (F.col("m") > 1), filled_in).when(F.col("on_t") | F.col("h_y") | F.col("unpriced"), single).otherwise(none)
    said = F.explode(F.concat(firsts, F.when(F.col("on_m") | F.col("h_b"), later).otherwise(none)))
    w = w.select(*own, "ticker", "on_t", "on_m", "h_y", "h_b", "v_y", "v_b", "T", "Tc", "B", "Bc", said.alias("x")).select("*", "x.*").drop("x")
    k = ~F.col("d")

    # counts and sums of a description's rows
    alone = F.when(F.col("description").isNull(), F.coalesce("ticker", F.lit("")))
    per_description = Window.partitionBy(*own, "description", alone)
    last, january = k & F.col("on_m"), k & F.col("h_b")
    k_cost, k_value, b_value = F.when(last, F.col("Bc")), F.when(last, F.col("B")), F.when(january, F.col("v_b"))
    counts = {"n_d": F.count(F.when(F.col("d"), 1)), "n_k": F.count(F.when(last, 1)), "n_b": F.count(F.when(january, 1)),
              "n_k_value": F.count(k_value), "n_b_value": F.count(b_value)}
    sums = {"k_cost": F.sum(k_cost), "k_value": F.sum(k_value), "k_gain": F.sum(k_value - k_cost), "b_value": F.sum(b_value)}
    # which of ticker and dimensions a row lacks, as bits, and what the rows of its description lack
    lack = F.lit(0)
    for i, c in enumerate(("ticker", *DIMENSIONS)):
        lack = lack + F.when(F.col(c).isNull(), 1 << i).otherwise(0)
    lacks = {"lacks": F.collect_set(F.when(F.col("d") & (lack > 0), lack))}
    w = w.withColumns({c: x.over(per_description) for c, x in (counts | sums | lacks).items()})
    named = F.col("description").isNotNull()
    w = w.withColumns({c: F.when(named, F.col(c)).otherwise(zero) for c in counts} | {c: F.when(named, F.col(c)) for c in sums})
    w = w.withColumns({
        "d_cost": F.when(F.col("on_t"), F.col("Tc")), "d_value": F.when(F.col("on_t"), F.col("T")),
        "d_ytd": F.when(on_both & F.col("h_b"), F.col("T") - F.col("v_b")), "d_today": F.when(on_both, F.col("T") - F.col("v_y")),
        "b_times": F.when(F.col("n_k") > 0, F.greatest("n_b", one)).otherwise(one)})
    fills = F.col("d") & (F.col("n_k") > 0) & (lack > 0)
    d_gain = F.col("d_value") - F.col("d_cost")

    def row(cols, cost, value, gain, ytd, today):
        return [*[F.col(k) for k in own], *cols, cost.alias("cost_basis"), value.alias("market_value"), gain.alias("gain_loss"),
                ytd.alias("ytd_gain_loss"), today.alias("today_gain_loss")]

    # rows with a full key: their own values times what they meet, or the sums of that
    times = F.col("n") * F.when(F.col("n_k") > 0, F.col("n_k") * F.col("b_times")).otherwise(one)

    def own_or_sum(value, total):
        return F.when(F.col("d"), F.when(value.isNotNull(), _times(value, times)).otherwise(_times(F.col(total), F.col("n") * F.col("b_times"))))

    pairs = _times(F.coalesce("k_value", zero), F.col("n_b_value")) - _times(F.coalesce("b_value", zero), F.col("n_k_value"))
    changes = F.when((F.col("n_k") > 0) & (F.col("n_b") > 0), _times(pairs, F.col("n"))).otherwise(zero)
    d_part = [own_or_sum(F.col("d_cost"), "k_cost"), own_or_sum(F.col("d_value"), "k_value"), own_or_sum(d_gain, "k_gain"),
              F.when(F.col("d"), F.coalesce(_times(F.col("d_ytd"), times), changes)), F.when(F.col("d"), F.coalesce(_times(F.col("d_today"), times), zero))]
    # fallback rows that meet no row of the first chain
    k_on = last & (~named | (F.col("n_d") == 0))
    k_times = F.greatest("n_b", one)
    k_ytd = F.when(named & (F.col("n_b") > 0), F.coalesce(_times(F.col("B"), F.col("n_b_value")) - F.coalesce("b_value", zero), zero)).otherwise(zero)
    k_part = [F.when(k_on, x) for x in (_times(F.col("Bc"), k_times), _times(F.col("B"), k_times), _times(F.col("B") - F.col("Bc"), k_times), k_ytd, zero)]
    kept = F.col("d") | k_on
    cols = [F.when(kept, F.col(c)).alias(c) for c in ("ticker", *ATTRIBUTES)]
    # what is left (priced on 2 January only, or merged into other rows) has no key and no change
    measures = [_plus(a, b) for a, b in zip(d_part, k_part)]
    measures[3:] = [F.coalesce(x, zero) for x in measures[3:]]
    plain = w.where(~fills).select(*row(cols, *measures))

    # rows with a missing attribute meet the fallback rows of their description, summed by the attributes that they lack
    left = w.where(fills).select(*own, "description", "ticker", *DIMENSIONS, "n", "b_times", "n_b", "n_b_value", "b_value",
                                 "d_cost", "d_value", "d_ytd", "d_today", lack.alias("lack")).alias("d")
    right = w.where(last & named).select(*own, "description", "ticker", *DIMENSIONS, "B", "Bc", F.explode("lacks").alias("lack"))
    taken = [F.when(F.col("lack").bitwiseAND(1 << i) != 0, F.col(c)).alias(c) for i, c in enumerate(("ticker", *DIMENSIONS))]
    right = right.select(*own, "description", "lack", *taken, "B", "Bc").groupBy(*own, "description", "lack", "ticker", *DIMENSIONS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("B").alias("n_value"), F.sum("B").alias("B"), F.sum("Bc").alias("Bc"),
        F.sum(F.col("B") - F.col("Bc")).alias("gain")).alias("k")
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"k.{c}")) for c in own] + [F.col(f"d.{c}") == F.col(f"k.{c}") for c in ("description", "lack")]
    j = left.join(right, on)
    each = F.col("d.n") * F.col("d.b_times")
    every = each * F.col("k.n_rows")
    met = [F.coalesce(_times(x, every), _times(F.col(y), each)) for x, y in (
        (F.col("d.d_cost"), "k.Bc"), (F.col("d.d_value"), "k.B"), (F.col("d.d_value") - F.col("d.d_cost"), "k.gain"))]
    moved = _times(F.col("k.B"), F.col("d.n_b_value")) - _times(F.coalesce("d.b_value", zero), F.col("k.n_value"))
    change = F.when(F.col("d.n_b") > 0, F.coalesce(_times(moved, F.col("d.n")), zero))
    filled = j.select(
        *[F.col(f"d.{c}").alias(c) for c in own], F.coalesce("d.ticker", "k.ticker").alias("ticker"), F.col("d.description").alias("description"),
        *[F.coalesce(f"d.{c}", f"k.{c}").alias(c) for c in DIMENSIONS], met[0].alias("cost_basis"), met[1].alias("market_value"),
        met[2].alias("gain_loss"), F.coalesce(_times(F.col("d.d_ytd"), every), change, zero).alias("ytd_gain_loss"),
        F.coalesce(_times(F.col("d.d_today"), every), zero).alias("today_gain_loss"))
    names = [*own, "ticker", *ATTRIBUTES, "cost_basis", "market_value", "gain_loss", "ytd_gain_loss", "today_gain_loss"]
    money = names[-5:]
    return plain.select(*names[:-5], *[F.col(c).cast("decimal(38,10)").alias(c) for c in money]).unionByName(
        filled.select(*names[:-5], *[F.col(c).cast("decimal(38,10)").alias(c) for c in money]))
