"""Report layer over the valuation core.

* daily report (RPT1/RPT2): TOTAL + one row per (ticker, description);
* roll-up (RPT3-RPT7): Benchmark + TOTAL + one row per value of a dimension,
  amounts masked on the Benchmark row;
* all four roll-ups in one pass (EXT3).

TOTAL and the detail rows come from one aggregate with GROUPING SETS, so the
core is planned once; the share of total (``mix_%``) takes TOTAL's market
value through a window partitioned by the report keys (one row per report
for a single run; per user / as-of date for batch runs, never one global
partition of batch rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (BENCHMARK_LABEL, DIMENSIONS, TOTAL_DESCRIPTION, TOTAL_TICKER,
                      ReportParams)
from ..functions.money import mask_if, percent, to_int
from ..operators.valuation import MEASURES

DAILY_COLUMNS = ("ticker", "mix_%", "description", "cost_basis", "market_value", "today_gain_loss",
                 "today_gain_loss_%", "ytd_gain_loss", "ytd_gain_loss_%", "total_gain_loss",
                 "total_gain_loss_%")
ROLLUP_COLUMNS = ("mix_%", "asset_type", "cost_basis", "market_value", "today_gain_loss",
                  "today_gain_loss_%", "ytd_gain_loss", "ytd_gain_loss_%", "total_gain_loss",
                  "total_gain_loss_%")


def _sums(cond: Column | None = None, prefix: str = "") -> list[Column]:
    out = []
    for m in MEASURES:
        c = F.col(m) if cond is None else F.when(cond, F.col(m))
        out.append(F.sum(c).alias(prefix + m))
    return out


def _formatted(label_cols: list[Column], total_mv: Column) -> list[Column]:
    mv = F.col("market_value")
    return [
        *label_cols[:1],
        percent(mv, total_mv).alias("mix_%"),
        *label_cols[1:],
        to_int("cost_basis").alias("cost_basis"),
        to_int(mv).alias("market_value"),
        to_int("today_gain_loss").alias("today_gain_loss"),
        percent("today_gain_loss", mv).alias("today_gain_loss_%"),
        to_int("ytd_gain_loss").alias("ytd_gain_loss"),
        percent("ytd_gain_loss", mv).alias("ytd_gain_loss_%"),
        to_int("gain_loss").alias("total_gain_loss"),
        percent("gain_loss", "cost_basis").alias("total_gain_loss_%"),
    ]


def with_total_anchor(core: DataFrame, keys: list[str], key_frame: DataFrame | None = None) -> DataFrame:
    """Add one all-NULL row per report key so every report has its TOTAL row.

    The reference's TOTAL is a global aggregate: one row even when nothing
    is priced.  GROUPING SETS over empty input yields no row, so a NULL row
    (ignored by every sum, dropped by the ``ticker <> ''`` filter) is added
    for each key in ``key_frame`` (one row when there are no keys)."""
    if key_frame is None:
        if keys:
            return core
        key_frame = core.sparkSession.range(1).select()
    fill = [F.lit(None).cast(f.dataType).alias(f.name) for f in core.schema.fields if f.name not in keys]
    return core.unionByName(key_frame.select(*keys, *fill))


def daily_report(core: DataFrame, keys=(), order: bool = True, key_frame: DataFrame | None = None) -> DataFrame:
    """RPT1: TOTAL (over every core row, Q17) + detail for non-blank tickers."""
    keys = list(keys)
    core = with_total_anchor(core, keys, key_frame)
    g = (core.groupingSets([[*keys, "ticker", "description"], keys], *keys, "ticker", "description")
         .agg(*_sums(), F.grouping_id().alias("gid")))
    is_total = F.col("gid") != 0
    g = g.where(is_total | (F.col("ticker") != ""))  # FLT8: also drops NULL tickers
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    total_mv = F.max(F.when(is_total, F.col("market_value"))).over(w)
    ticker = F.when(is_total, F.lit(TOTAL_TICKER)).otherwise(F.col("ticker")).alias("ticker")
    desc = F.when(is_total, F.lit(TOTAL_DESCRIPTION)).otherwise(F.col("description")).alias("description")
    out = g.select(*keys, *_formatted([ticker, desc], total_mv), is_total.alias("_total"))
    if order:
        # the window already put each report in one partition: sorting
        # within partitions orders every report without another shuffle
        out = out.sortWithinPartitions(*keys, F.col("_total").desc(), F.col("market_value").desc_nulls_last(),
                                       F.col("ticker"))
    return out.drop("_total")


def _rollup_rows(core: DataFrame, dims: list[str], params: ReportParams, keys: list[str],
                 key_frame: DataFrame | None = None) -> DataFrame:
    """Long rows (keys..., dimension, label, kind, five measures) for the
    roll-ups of ``dims``: one GROUPING SETS aggregate, then each TOTAL group
    row becomes TOTAL and (when held) Benchmark rows for every dimension."""
    tk_ok = F.col("ticker") != ""
    is_bm = F.col("ticker") == F.lit(params.benchmark_ticker)
    core = with_total_anchor(core, keys, key_frame)
    sets = [[*keys, d] for d in dims] + [keys]
    g = core.groupingSets(sets, *keys, *dims).agg(
        *_sums(tk_ok, "f_"), F.count(F.when(tk_ok, F.lit(1))).alias("f_n"),
        *_sums(None, "a_"),
        *_sums(is_bm, "b_"), F.count(F.when(is_bm, F.lit(1))).alias("b_n"),
        F.grouping_id().alias("gid"))  # key columns are in every set: their bits are 0
    full = (1 << len(dims)) - 1

    def entry(dim, label, kind, prefix):
        return F.struct(F.lit(dim).alias("dimension"), label.alias("label"), F.lit(kind).alias("kind"),
                        *[F.col(prefix + m).alias(m) for m in MEASURES])

    arrays = []
    for i, d in enumerate(dims):
        bit = 1 << (len(dims) - 1 - i)
        # grouping set of dimension d: every other dimension bit is set
        is_d = F.col("gid") == F.lit(full ^ bit)
        arrays.append(F.when(is_d & (F.col("f_n") > 0),
                             F.array(entry(d, F.col(d), "dim", "f_"))))
    total_entries = []
    for d in dims:
        total_entries.append(F.when(F.col("b_n") > 0, entry(d, F.lit(BENCHMARK_LABEL), "benchmark", "b_")))
        total_entries.append(entry(d, F.lit(TOTAL_TICKER), "total", "a_"))
    arrays.append(F.when(F.col("gid") == F.lit(full),
                         F.filter(F.array(*total_entries), lambda e: e.isNotNull())))
    rows = g.select(*keys, F.explode(F.coalesce(*arrays)).alias("e"))
    return rows.select(*keys, "e.*")


def rollup_report(core: DataFrame, dimension: str, params: ReportParams, keys=(),
                  order: bool = True, key_frame: DataFrame | None = None) -> DataFrame:
    """RPT3-RPT7: roll-up by one dimension; the label column is named
    ``asset_type`` whatever the dimension (Q10)."""
    if dimension not in DIMENSIONS:
        raise ValueError(f"unknown dimension {dimension!r}")
    return _format_rollup(_rollup_rows(core, [dimension], params, list(keys), key_frame), list(keys), order,
                          with_dimension=False)


def all_rollups(core: DataFrame, params: ReportParams, keys=(), order: bool = True,
                key_frame: DataFrame | None = None) -> DataFrame:
    """EXT3: the four roll-ups from one aggregate, with a ``dimension`` column."""
    return _format_rollup(_rollup_rows(core, list(DIMENSIONS), params, list(keys), key_frame), list(keys),
                          order, with_dimension=True)


def _format_rollup(rows: DataFrame, keys: list[str], order: bool, with_dimension: bool) -> DataFrame:
    part = [*keys, "dimension"]
    total_mv = F.max(F.when(F.col("kind") == "total", F.col("market_value"))).over(Window.partitionBy(*part))
    label = F.col("label").alias("asset_type")
    pre = rows.select(*part, "kind", *_formatted([label], total_mv))
    masked = F.col("asset_type") == F.lit(BENCHMARK_LABEL)  # the reference tests the label
    cols = [
        mask_if(masked, F.col("mix_%")).alias("mix_%"),
        F.col("asset_type"),
        mask_if(masked, F.col("cost_basis")).alias("cost_basis"),
        mask_if(masked, F.col("market_value")).alias("market_value"),
        mask_if(masked, F.col("today_gain_loss")).alias("today_gain_loss"),
        F.col("today_gain_loss_%"),
        mask_if(masked, F.col("ytd_gain_loss")).alias("ytd_gain_loss"),
        F.col("ytd_gain_loss_%"),
        mask_if(masked, F.col("total_gain_loss")).alias("total_gain_loss"),
        F.col("total_gain_loss_%"),
    ]
    sort_key = F.when(F.col("kind") == "benchmark", 0).when(F.col("kind") == "total", 1).otherwise(2)
    out = pre.select(*keys, *(["dimension"] if with_dimension else []), *cols,
                     sort_key.alias("_k"), F.col("market_value").alias("_mv"))
    if order:
        out = out.sortWithinPartitions(*keys, *(["dimension"] if with_dimension else []), "_k",
                                       F.col("_mv").desc_nulls_last(), "asset_type")
    return out.drop("_k", "_mv")
