"""Holdings: lots joined to market attributes, de-duplicated, aggregated.

JN1 / JN2 (markets join on (ticker, dataset) or ticker only), FLT1 (dataset
and user filter), AGG1 (group by all lot columns = DISTINCT, quirk Q1) and the
per-ticker position sums the valuation needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DIMENSIONS, ReportParams
from ..sources.tables import Tables, with_user_column

LOT_COLUMNS = ("_user", *DIMENSIONS, "description", "ticker", "quantity", "cost_per_share")


def user_lots(tables: Tables, params: ReportParams, users: list[str] | None = None) -> DataFrame:
    """Distinct lots of one user (``params.user``), of ``users``, or of everyone.

    The markets side is a dimension (one row per listed ticker); AQE turns the
    join into a broadcast when its measured size is under the threshold and
    keeps a shuffled join otherwise.  DISTINCT runs as a partial + final hash
    aggregate, so duplicated lots collapse before the shuffle.
    """
    prof = params.profile
    port = with_user_column(tables.portfolio).where(F.col("dataset") == params.dataset)
    if params.user is not None:
        port = port.where(F.col("_user") == params.user)
    elif users or params.users:
        port = port.where(F.col("_user").isin(list(users or params.users)))
    mk = tables.markets
    if prof.markets_on_dataset:
        mk = mk.where(F.col("dataset") == params.dataset)
        keys = ["ticker", "dataset"]
    else:
        keys = ["ticker"]
    mk = mk.select(*keys, "description", *DIMENSIONS)
    qty, cost = F.col("quantity"), F.col("cost_per_share")
    if prof.cast_lots:  # D5
        qty, cost = qty.cast("decimal(10,4)"), cost.cast("decimal(6,2)")
    joined = port.select(*keys, "_user", qty.alias("quantity"), cost.alias("cost_per_share")).join(mk, keys)
    return joined.select(*LOT_COLUMNS).dropDuplicates()


def user_positions(tables: Tables, params: ReportParams) -> DataFrame:
    """Positions for the valuation, aggregated *before* the markets join.

    The reference de-duplicates (attributes, ticker, quantity, cost) after
    joining markets.  With the markets rows themselves de-duplicated on
    (join key, attributes), de-duplicating the lots on (user, key, quantity,
    cost) first and joining afterwards yields the same rows, so the lots are
    reduced with map-side partial aggregates (a lot copied many times, or a
    ticker held in a third of all lots, never lands whole in one task) and
    the join sees one row per (user, ticker).
    """
    prof = params.profile
    port = with_user_column(tables.portfolio).where(F.col("dataset") == params.dataset)
    if params.user is not None:
        port = port.where(F.col("_user") == params.user)
    elif params.users:
        port = port.where(F.col("_user").isin(list(params.users)))
    keys = ["ticker", "dataset"] if prof.markets_on_dataset else ["ticker"]
    qty, cost = F.col("quantity"), F.col("cost_per_share")
    if prof.cast_lots:  # D5
        qty, cost = qty.cast("decimal(10,4)"), cost.cast("decimal(6,2)")
    lots = port.select("_user", *keys, qty.alias("quantity"), cost.alias("cost_per_share")).dropDuplicates()
    sums = lots.groupBy("_user", *keys).agg(
        F.sum("quantity").cast("decimal(18,4)").alias("qty"),
        F.sum(F.col("quantity") * F.col("cost_per_share")).alias("cost"))
    mk = tables.markets
    if prof.markets_on_dataset:
        mk = mk.where(F.col("dataset") == params.dataset)
    mk = mk.select(*keys, "description", *DIMENSIONS).dropDuplicates()
    return sums.join(mk, keys).select("_user", "ticker", "description", *DIMENSIONS, "qty", "cost")


def held_tickers(tables: Tables, params: ReportParams) -> DataFrame:
    """JN8 source: distinct tickers any user holds in the dataset (AGG12)."""
    return (tables.portfolio.where(F.col("dataset") == params.dataset)
            .select("ticker").distinct())


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``keys`` that occur more than once (Q2 / Q7 precondition check)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def precondition_violations(tables: Tables, params: ReportParams) -> DataFrame:
    """(kind, key, n) rows for which the reference's joins multiply rows:
    several markets rows per join key (Q2), or one description shared by
    several held tickers (Q7).  A report for people, to see which listings are meant; runs
    ask :func:`.factorised.shares_markets`.  A missing description is not a shared one."""
    prof = params.profile
    keys = ["ticker", "dataset"] if prof.markets_on_dataset else ["ticker"]
    mk = tables.markets
    if prof.markets_on_dataset:
        mk = mk.where(F.col("dataset") == params.dataset)
    attributes = mk.select(*keys, "description", *DIMENSIONS).distinct()
    dup_keys = duplicate_keys(attributes.select(*keys), keys).select(
        F.lit("markets_key").alias("kind"), F.concat_ws("|", *keys).alias("key"), "n")
    held = held_tickers(tables, params)
    descs = mk.where(F.col("description").isNotNull()).join(held, "ticker").select("ticker", "description").distinct()
    dup_desc = duplicate_keys(descs.select("description"), ["description"]).select(
        F.lit("description").alias("kind"), F.col("description").alias("key"), "n")
    return dup_keys.unionByName(dup_desc)
