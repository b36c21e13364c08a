"""PAR1, RPT1-8 for people who write SQL: reports as table functions over registered tables.

``create_report_functions(spark, tables, params)`` registers the tables as views and defines temporary SQL table
functions, planned by Spark like any other query, so their rows can be joined, filtered and ordered:

    select * from portfolio_daily('R', date '2024-01-29') order by market_value desc
    select * from portfolio_rollup('R', date '2024-01-29', 'location')
    select * from equities_snapshot(date '2024-01-29')

User, date and dimension are constants or ``:name`` parameters of ``spark.sql(text, args=...)``; the profile, the dataset, the
special tickers and the threshold are those of ``params`` when the functions were made (``params.user`` and ``as_of`` play no
part).  A function has no place to look first, so the fallback date is found over the whole history (lake profile: from
2 January on); tables with maintained totals (:func:`..sources.totals.with_totals`) keep that to one row per ticker and date.

Several markets rows per key, or a description that tickers share, multiply rows in the reference (Q2, Q7).  The functions do
not: they end with an error that names the DataFrame report, which does, unless ``params.allow_shared``.  Rows have no order.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import BENCHMARK_LABEL, DIMENSIONS, MASK, TOTAL_DESCRIPTION, TOTAL_TICKER, ReportParams
from ..operators.valuation import MEASURES
from ..sources.tables import Tables, with_user_column

ATTRIBUTES = ", ".join(("description", *DIMENSIONS))
ROLE_DATES = {
    "t": "report_date",
    "y": "date_sub(report_date, case weekday(report_date) when 0 then 3 when 6 then 2 else 1 end)",
    "b": "date_add(trunc(report_date, 'year'), 1)",
    "m": "(select max(date) from full_dates)",
}
MONEY = ("cost_basis", "market_value", "today_gain_loss", "ytd_gain_loss", "total_gain_loss")
SHARED = "shared listings multiply rows here: use the DataFrame report, or allow_shared"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _register(tables: Tables, prefix: str) -> None:
    """The views the functions read.  Prices have the columns of totals; a price row is a total of itself."""
    px = tables.prices()
    if tables.totals is None:
        px = px.select("dataset", "ticker", "date", F.col("close").cast("decimal(18,6)").cast("decimal(24,6)").alias("close_sum"),
                       F.when(F.col("close").isNotNull(), 1).otherwise(0).cast("bigint").alias("close_n"), F.lit(1).cast("bigint").alias("n_rows"))
    px.createOrReplaceTempView(f"{prefix}price_rows")
    with_user_column(tables.portfolio).createOrReplaceTempView(f"{prefix}portfolio")
    tables.equities.createOrReplaceTempView(f"{prefix}equities")
    tables.markets.createOrReplaceTempView(f"{prefix}markets")
    tables.currency.createOrReplaceTempView(f"{prefix}currency")


def valued_sql(params: ReportParams, prefix: str = "") -> str:
    """CTEs ending in ``valued``: one row per valued position of ``report_user`` on ``report_date``."""
    prof, dataset = params.profile, _text(params.dataset)
    lake = prof.fallback_scope != "all"
    lot = ("cast(quantity as decimal(10,4)) as quantity, cast(cost_per_share as decimal(6,2)) as cost_per_share"
           if prof.cast_lots else "quantity, cost_per_share")
    listed = f" where dataset = {dataset}" if prof.markets_on_dataset else ""
    counted = ("select distinct ticker from positions" if lake
               else f"select distinct ticker from {prefix}portfolio where dataset = {dataset}")
    since = f" and date >= {ROLE_DATES['b']}" if lake else ""
    other = "<" if params.strict_as_of else "<>"
    wide = ",\n         ".join(
        f"sum(close_sum) filter (where is_{r}) as s_{r}, sum(close_n) filter (where is_{r}) as n_{r}, count_if(is_{r}) > 0 as h_{r}"
        for r in ROLE_DATES)
    tagged = ", ".join(f"date = {d} as is_{r}" for r, d in ROLE_DATES.items())  # parameters stay out of the aggregates
    average = ", ".join(
        f"cast(round(if(ticker = {_text(params.fx_ticker)}, cast(s_{r} as decimal(24,6)) * (select rate from fx) / 100, "
        f"cast(s_{r} as decimal(24,6))) / nullif(n_{r}, 0), 6) as decimal(18,6)) as p_{r}, h_{r}" for r in ROLE_DATES)
    priced = ", ".join(f"coalesce(h_{r}, false) as on_{r}" for r in ROLE_DATES)
    worth = ", ".join(f"if(on_{r}, coalesce(p_{r} * qty, cost), null) as v_{r}" for r in ROLE_DATES)
    is_ys = f"coalesce(ticker = {_text(params.year_start_price_ticker)}, false) and on_b"
    if params.allow_shared:
        checked = "listed"
    else:
        name = "concat_ws('\\0', ticker, dataset)" if prof.markets_on_dataset else "ticker"
        checked = f"""(
    select l.* from listed l where 0 = (
      select if(max(n) > 1, raise_error({_text(SHARED)}), 0L)
      from (select count(*) as n from (select explode(array(struct('key' as kind, {name} as name), struct('description' as kind, description as name))) as x
                                       from (select distinct {"dataset, " if prof.markets_on_dataset else ""}ticker, {ATTRIBUTES} from {prefix}markets{listed}))
            where x.name is not null group by x)))"""
    return f"""lots as (
  select distinct ticker, {lot} from {prefix}portfolio where dataset = {dataset} and _user = report_user
), held as (
  select ticker, cast(sum(quantity) as decimal(18,4)) as qty, sum(quantity * cost_per_share) as cost from lots group by ticker
), listed as (
  select distinct ticker, {ATTRIBUTES} from {prefix}markets{listed}
), positions as (
  select h.ticker, h.qty, h.cost, {", ".join(f"l.{c}" for c in ATTRIBUTES.split(", "))} from held h join {checked} l on l.ticker = h.ticker
), full_dates as (
  select c.date
  from (select date, dataset, ticker, sum(n_rows) as n from {prefix}price_rows where date {other} report_date{since} group by all) c
  join ({counted}) o on o.ticker = c.ticker
  group by c.date, c.dataset having sum(c.n) > {params.threshold}
), fx as (
  select coalesce(max_by(rate, struct(date, rate)), {params.fx_default}) as rate from {prefix}currency
  where currency = {_text(params.fx_currency)} and date in ({ROLE_DATES["t"]}, {ROLE_DATES["y"]})
), wide as (
  select ticker, {wide}
  from (select ticker, close_sum, close_n, {tagged} from {prefix}price_rows where date in ({", ".join(ROLE_DATES.values())}))
  group by ticker
), quotes as (
  select ticker, {average} from wide
), worth as (
  select p.*, {", ".join(f"q.p_{r}" for r in ROLE_DATES)}, {priced}
  from positions p {"left" if prof.keep_unpriced else "inner"} join quotes q on q.ticker = p.ticker
), legs as (
  select *, {worth},
         {is_ys} and {ROLE_DATES["t"]} <> {ROLE_DATES["b"]} as x_t, {is_ys} and not ({ROLE_DATES["m"]} <=> {ROLE_DATES["b"]}) as x_m
  from worth
), sides as (
  select *, if(on_t or x_t, if(on_t, v_t, 0) + if(x_t, v_b, 0), null) as now_value, if(on_t or x_t, cost * (int(on_t) + int(x_t)), null) as now_cost,
         if(on_m or x_m, if(on_m, v_m, 0) + if(x_m, v_b, 0), null) as then_value, if(on_m or x_m, cost * (int(on_m) + int(x_m)), null) as then_cost
  from legs
), valued as (
  select if(now_value is not null or on_y or then_value is not null, ticker, null) as ticker,
         {", ".join(f"if(now_value is not null or on_y or then_value is not null, {c}, null) as {c}" for c in ATTRIBUTES.split(", "))},
         {_either("now_cost", "then_cost")} as cost_basis, {_either("now_value", "then_value")} as market_value,
         {_either("now_value - now_cost", "then_value - then_cost")} as gain_loss,
         coalesce(if(on_y, now_value - v_b, null), if(description is null, null, then_value - v_b), 0) as ytd_gain_loss,
         coalesce(now_value - v_y, 0) as today_gain_loss
  from sides
)"""


def _either(now: str, then: str) -> str:
    """The current side first; without a description both are rows of their own, and summed."""
    both = f"if({now} is null and {then} is null, null, coalesce({now}, 0) + coalesce({then}, 0))"
    return f"if(description is null, {both}, coalesce({now}, {then}))"


def _percent(num: str, den: str) -> str:
    return f"concat(cast(cast(cast({num} as double) / nullif(cast({den} as double), 0) * 100 as decimal(18,2)) as string), '%')"


def _columns() -> dict[str, str]:
    """Printed columns after the labels, from summed measures and TOTAL's value."""
    def whole(c):
        return f"cast(round({c}) as bigint)"

    return {"mix_%": _percent("market_value", "max(if(kind = 'total', market_value, null)) over ()"),
            "cost_basis": whole("cost_basis"), "market_value": whole("market_value"),
            "today_gain_loss": whole("today_gain_loss"), "today_gain_loss_%": _percent("today_gain_loss", "market_value"),
            "ytd_gain_loss": whole("ytd_gain_loss"), "ytd_gain_loss_%": _percent("ytd_gain_loss", "market_value"),
            "total_gain_loss": whole("gain_loss"), "total_gain_loss_%": _percent("gain_loss", "cost_basis")}


SUMS = ", ".join(f"sum({m}) as {m}" for m in MEASURES)


def daily_body(params: ReportParams, prefix: str = "") -> str:
    """TOTAL (also over nothing) and one row per ticker with a name, from one grouping."""
    cols = ", ".join(f"{x} as `{c}`" for c, x in _columns().items())
    return f"""with {valued_sql(params, prefix)}, summed as (
  select ticker, description, if(grouping(ticker) = 1, 'total', 'row') as kind, {SUMS}
  from (select ticker, description, {", ".join(MEASURES)} from valued union all select null, null, null, null, null, null, null)
  group by grouping sets ((ticker, description), ())
), printed as (
  select if(kind = 'total', {_text(TOTAL_TICKER)}, ticker) as ticker, if(kind = 'total', {_text(TOTAL_DESCRIPTION)}, description) as description, {cols}
  from summed where kind = 'total' or ticker <> ''
)
select ticker, `mix_%`, description, {", ".join(f"`{c}`" for c in _columns() if c != "mix_%")} from printed"""


def rollup_body(params: ReportParams, prefix: str = "") -> str:
    """Benchmark, TOTAL and one row per value of ``report_dimension``; a name that is no dimension is an error."""
    label = " ".join(f"when '{d}' then {d}" for d in DIMENSIONS)
    cols = ", ".join(f"if(asset_type = {_text(BENCHMARK_LABEL)}, {_text(MASK)}, cast({x} as string)) as `{c}`" if c == "mix_%" or c in MONEY
                     else f"{x} as `{c}`" for c, x in _columns().items())
    kinds = f"""array_compact(array(struct('total' as kind, {_text(TOTAL_TICKER)} as label),
           if(ticker <> '', struct('row' as kind, case report_dimension {label} else raise_error('unknown dimension') end as label), null),
           if(ticker = {_text(params.benchmark_ticker)}, struct('benchmark' as kind, {_text(BENCHMARK_LABEL)} as label), null)))"""
    nulls = ", ".join(["null"] * (1 + len(DIMENSIONS) + len(MEASURES)))
    return f"""with {valued_sql(params, prefix)}, counted as (
  select explode({kinds}) as k, {", ".join(MEASURES)}
  from (select ticker, {", ".join(DIMENSIONS)}, {", ".join(MEASURES)} from valued union all select {nulls})
), summed as (
  select k.kind as kind, k.label as asset_type, {SUMS} from counted group by k.kind, k.label
), printed as (
  select asset_type, {cols} from summed
)
select `mix_%`, asset_type, {", ".join(f"`{c}`" for c in _columns() if c != "mix_%")} from printed"""


def create_report_functions(spark: SparkSession, tables: Tables, params: ReportParams, prefix: str = "") -> None:
    """Defines ``{prefix}portfolio_daily``, ``{prefix}portfolio_rollup`` and ``{prefix}equities_snapshot`` in the session."""
    _register(tables, prefix)
    rest = ", ".join(f"`{c}` {'bigint' if c in MONEY else 'string'}" for c in _columns() if c != "mix_%")
    texts = ", ".join(f"`{c}` string" for c in _columns() if c != "mix_%")
    spark.sql(f"""create or replace temporary function {prefix}portfolio_daily(report_user string, report_date date)
returns table (ticker string, `mix_%` string, description string, {rest}) return {daily_body(params, prefix)}""")
    spark.sql(f"""create or replace temporary function {prefix}portfolio_rollup(report_user string, report_date date, report_dimension string)
returns table (`mix_%` string, asset_type string, {texts}) return {rollup_body(params, prefix)}""")
    prices = tables.equities.select("dataset", "ticker", "date", "close").dtypes
    spark.sql(f"""create or replace temporary function {prefix}equities_snapshot(report_date date)
returns table ({", ".join(f"{c} {t}" for c, t in prices)}) return select dataset, ticker, date, close from {prefix}equities where date = report_date""")
