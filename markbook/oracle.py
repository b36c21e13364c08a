"""DuckDB SQL twins of the registered queries (the correctness oracle).

The valuation is written from its rules: role-tagged prices spread over
positions, two legs per position, explicit rows for what has no counterpart,
TOTAL by grouping.  The operators that pair rows (JN3-JN7) are also held
against small hand-computed cases in the tests.  Stand-in views (FIXTURES.md
section 3) are prepended as CTEs over the driver's pre-registered tables.
"""

from __future__ import annotations

import datetime as dt

from .config import BENCHMARK_LABEL, MIN_ROWS_LAKE_WEEKLY, MIN_ROWS_WAREHOUSE
from .functions.dates import previous_weekday_of
from .sources.standin import (STANDIN_AS_OF, STANDIN_BENCHMARK_TICKER, STANDIN_FX_TICKER,
                              STANDIN_USER, STANDIN_YEAR_START_TICKER)

STANDIN_CTES = """
equities_fact as (
  select case when event_type in ('click', 'view', 'purchase') then 'ALPHA-VANTAGE' else 'TIINGO' end as dataset,
         'T' || cast(user_id as varchar) as ticker,
         cast(ts as date) as date,
         cast(value as decimal(18,6)) as close
  from events
), markets_dim as (
  select 'ALPHA-VANTAGE' as dataset,
         'T' || cast(p_partkey as varchar) as ticker,
         p_name || ' #' || cast(p_partkey as varchar) as description,
         p_type as asset_type,
         r_name as location,
         case when p_size < 17 then 'Small' when p_size < 34 then 'Mid' else 'Large' end as capitalization,
         case when p_retailprice < 930 then 'Value' when p_retailprice < 960 then 'Blend' else 'Growth' end
           as investment_style
  from part
  join nation on n_nationkey = p_partkey % 25
  join region on n_regionkey = r_regionkey
), lot_rows as (
  select 'ALPHA-VANTAGE' as dataset, l_returnflag as _user, 'T' || cast(l_partkey as varchar) as ticker,
         cast(l_quantity as decimal(10,4)) as quantity,
         cast(cast(floor(l_extendedprice * 2) as decimal(12,2)) * cast(0.01 as decimal(3,2)) as decimal(8,2))
           as cost_per_share,
         l_linenumber
  from lineitem
), portfolio_dim as (
  select dataset, _user, ticker, quantity, cost_per_share from lot_rows
  union all
  select dataset, _user, ticker, quantity, cost_per_share from lot_rows where l_linenumber = 1
), currency_fact as (
  select 'GBP' as currency, cast(ts as date) as date,
         cast(round(1.2 + avg(value) / 1000, 4) as decimal(10,4)) as rate
  from events where event_type = 'view' group by cast(ts as date)
), log as (
  select cast(ts as date) as date, event_type as device from events
)"""


# listings that share names (sources.standin.shared_markets)
SHARED_MARKETS = """
named_markets as (
  select dataset, ticker, regexp_replace(description, ' #.*', '') || ' ' || asset_type as description, asset_type, location,
         case when cast(substr(ticker, 2) as bigint) % 11 <> 0 then capitalization end as capitalization, investment_style,
         cast(substr(ticker, 2) as bigint) as number
  from unique_markets
), markets_dim as (
  select * exclude (number) from named_markets
  union all
  select * exclude (number) replace ('TIINGO' as dataset, 'Fund' as asset_type) from named_markets where number % 7 = 0
)"""


def with_standins(body: str, shared: bool = False) -> str:
    views = STANDIN_CTES.strip()
    if shared:
        views = views.replace("markets_dim as (", "unique_markets as (") + ",\n" + SHARED_MARKETS.strip()
    return "with " + views + ",\n" + body.strip()


def _pct(num: str, den: str) -> str:
    return (f"cast(cast({num} as double) / nullif(cast({den} as double), 0) * 100 as decimal(18,2))"
            f" || '%'")


def _int(x: str) -> str:
    return f"cast(round({x}) as bigint)"


_MEAS = ("cost_basis", "market_value", "gain_loss", "ytd_gain_loss", "today_gain_loss")
_DIM_COLS = ("asset_type", "location", "capitalization", "investment_style")
_DIMS = ", ".join((*_DIM_COLS, "description"))


def core_ctes(*, as_of: dt.date = STANDIN_AS_OF, user: str = STANDIN_USER, lake: bool = False,
              weekly: bool = False, min_rows: int | None = None, fx_ticker: str = STANDIN_FX_TICKER,
              ys_ticker: str = STANDIN_YEAR_START_TICKER, joined: bool = False) -> str:
    """CTEs of one run, ending in ``valued``: one row per valued position, or with ``joined`` one
    per joined row (:func:`_joined_rows`).

    Every anchor date gets a role (t today, y previous weekday, b 2 January, m fallback); prices
    are tagged with the roles their date plays and spread into one row per position.  A
    position has a *current* leg (priced today) and a *fallback* leg (priced on the fallback
    date); the year-start ticker adds its 2 January value to either leg when that date is
    priced and is not the leg's own date.  The rules for what has no counterpart are spelled out:

    * with a description, the current leg wins over the fallback leg, measure by measure;
    * without one the two legs are separate rows;
    * a 2 January price that meets no previous-weekday price, or no fallback leg, leaves a row
      without any key and with zero changes;
    * in the weekly lake run, a position without any anchor price leaves a row without ticker.
    """
    if min_rows is None:
        min_rows = MIN_ROWS_LAKE_WEEKLY if (lake and weekly) else MIN_ROWS_WAREHOUSE
    day = f"date '{as_of.isoformat()}'"
    if lake:
        lot, same = "cast(w.quantity as decimal(10,4)) as quantity, cast(w.cost_per_share as decimal(6,2)) as cost_per_share", ""
        counted = "e.ticker in (select ticker from lots) and e.date >= (select day from calendar where role = 'b')"
    else:
        lot, same = "w.quantity, w.cost_per_share", " and a.dataset = w.dataset"
        counted = "exists (from portfolio_dim o where o.dataset = 'ALPHA-VANTAGE' and o.ticker = e.ticker)"
    null_quotes = " or e.date is null" if weekly and not lake else ""
    spread = ",\n         ".join(
        f"max(q.close) filter (where c.role = '{r}') as p_{r}, count(c.role) filter (where c.role = '{r}') > 0 as h_{r}"
        for r in "tybm")
    worth = ", ".join(f"case when h_{r} then coalesce(qty * p_{r}, cost) end as v_{r}" for r in "tybm")
    unpriced = f"""
  union all
  select {_DIMS}, null, null, null, null, 0, 0 from positions
  where not (h_t or h_y or h_b or h_m)""" if lake and weekly else ""
    nothing = ", ".join(["null"] * (len(_DIM_COLS) + 5)) + ", 0, 0"
    return f"""
calendar as (
  select 't' as role, {day} as day
  union all select 'y', {day} - case dayname({day}) when 'Monday' then 3 when 'Sunday' then 2 else 1 end
  union all select 'b', make_date(year({day}), 1, 2)
), lots as (
  select distinct {", ".join(f"a.{c}" for c in (*_DIM_COLS, "description"))}, w.ticker, {lot}
  from (from portfolio_dim where _user = '{user}' and dataset = 'ALPHA-VANTAGE') w
  join markets_dim a on a.ticker = w.ticker{same}
), last_full as (
  select max(date) as day
  from (select e.date from equities_fact e where e.date <> {day} and {counted}
        group by e.date, e.dataset having count(*) > {min_rows})
), roles as (
  from calendar union all select 'm', day from last_full where day is not null
), rate as (
  select coalesce(max_by(f.rate, (f.date, f.rate)), 1.30) as rate
  from currency_fact f where f.currency = 'GBP' and f.date in (select day from calendar where role in ('t', 'y'))
), quotes as (
  select e.ticker, e.date,
         cast(round(avg(e.close * if(e.ticker = '{fx_ticker}', r.rate, 100) / 100), 6) as decimal(18,6)) as close
  from equities_fact e, rate r
  where e.date in (select day from roles){null_quotes}
  group by all
), {_joined_rows(ys_ticker, lake and weekly) if joined else f"""spread as (
  select q.ticker, {spread}
  from quotes q join roles c on c.day = q.date group by q.ticker
), held as (
  select {_DIMS}, ticker, sum(quantity) as qty, sum(quantity * cost_per_share) as cost from lots group by all
), positions as (
  select h.*, {", ".join(f"s.p_{r}, coalesce(s.h_{r}, false) as h_{r}" for r in "tybm")}
  from held h left join spread s using (ticker)
), worth as (
  select *, {worth},
         (ticker is not distinct from '{ys_ticker}') and h_b and (select max(day) from roles where role = 't') <> (select day from roles where role = 'b') as x_t,
         (ticker is not distinct from '{ys_ticker}') and h_b and (select max(day) from roles where role = 'm') is distinct from (select day from roles where role = 'b') as x_m
  from positions
), legs as (
  select *,
         case when h_t or x_t then cost * (h_t::int + x_t::int) end as cost_now,
         case when h_t or x_t then if(h_t, v_t, 0) + if(x_t, v_b, 0) end as value_now,
         case when h_m or x_m then cost * (h_m::int + x_m::int) end as cost_then,
         case when h_m or x_m then if(h_m, v_m, 0) + if(x_m, v_b, 0) end as value_then
  from worth
), valued as (
  select {_DIMS}, ticker, coalesce(cost_now, cost_then) as cost_basis, coalesce(value_now, value_then) as market_value,
         coalesce(value_now - cost_now, value_then - cost_then) as gain_loss,
         coalesce(if(h_y, value_now - v_b, null), value_then - v_b, 0) as ytd_gain_loss,
         coalesce(value_now - v_y, 0) as today_gain_loss
  from legs where description is not null and (value_now is not null or h_y or value_then is not null)
  union all
  select {_DIMS}, ticker, cost_now, value_now, value_now - cost_now,
         coalesce(if(h_y, value_now - v_b, null), 0), coalesce(value_now - v_y, 0)
  from legs where description is null and (value_now is not null or h_y)
  union all
  select {_DIMS}, ticker, cost_then, value_then, value_then - cost_then, 0, 0
  from legs where description is null and value_then is not null
  union all
  select {nothing} from legs where h_b and not h_y
  union all
  select {nothing} from legs where h_b and (value_then is null or description is null){unpriced}
)"""}"""


def _joined_rows(ys_ticker: str, keep_unpriced: bool) -> str:
    """``valued`` as rows joined to rows: what each date says about a lot group, put side by side by ticker,
    then by description.  Holds also where tickers share a description or have several markets rows."""
    def day(role):
        return f"(select day from roles where role = '{role}')"

    def said(name, role, extra="", values=True):
        cols = "sum(quantity * cost_per_share) as cost, " if values else ""
        return f"""{name} as (
  select {_DIMS}, q.ticker as tk, {cols}sum(quantity * coalesce(q.close, cost_per_share)) as worth
  from lots l left join quotes q on q.ticker = l.ticker
  where q.date = {day(role)}{extra} group by all
)"""

    again = f" or (q.ticker = '{ys_ticker}' and q.date = {day('b')})"
    both = ", ".join(f"coalesce(now.{c}, prior.{c}) as {c}" for c in (*_DIM_COLS, "description", "tk"))
    either = ", ".join(f"coalesce(f.{c}, x.{c}) as {c}" for c in (*_DIM_COLS, "description"))
    return f"""{said("now", "t", again)}, {said("prior", "y", " or q.date is null" if keep_unpriced else "", False)}, {said("january", "b", values=False)}, {said("last", "m", again)}, by_ticker as (
  select {both}, now.cost, now.worth, now.worth - now.cost as gain, now.worth - january.worth as ytd, now.worth - prior.worth as day_change
  from now full join prior on prior.tk = now.tk full join january on january.tk = prior.tk
), valued as (
  select {either}, coalesce(f.tk, x.tk) as ticker, coalesce(f.cost, x.cost) as cost_basis, coalesce(f.worth, x.worth) as market_value,
         coalesce(f.gain, x.worth - x.cost) as gain_loss, coalesce(f.ytd, x.worth - january.worth, 0) as ytd_gain_loss,
         coalesce(f.day_change, 0) as today_gain_loss
  from by_ticker f full join last x on x.description = f.description full join january on january.description = x.description
)"""


def _measures(cond: str = "") -> str:
    return ", ".join(f"sum({m}){cond} as {m}" for m in _MEAS)


def _printed(total: str) -> dict[str, str]:
    """Report columns from summed measures; ``total``: TOTAL's market value."""
    return {'"mix_%"': _pct("market_value", total), "cost_basis": _int("cost_basis"), "market_value": _int("market_value"),
            "today_gain_loss": _int("today_gain_loss"), '"today_gain_loss_%"': _pct("today_gain_loss", "market_value"),
            "ytd_gain_loss": _int("ytd_gain_loss"), '"ytd_gain_loss_%"': _pct("ytd_gain_loss", "market_value"),
            "total_gain_loss": _int("gain_loss"), '"total_gain_loss_%"': _pct("gain_loss", "cost_basis")}


_TOTAL_VALUE = "max(market_value) filter (where kind = 'total') over ()"


def daily_select(**kw) -> str:
    """RPT1 / RPT2 over the base tables: TOTAL and detail from one grouping."""
    cols = ", ".join(f"{x} as {c}" for c, x in _printed(_TOTAL_VALUE).items())
    return "with " + core_ctes(**kw).strip() + f""", grouped as (
  select ticker, description, if(grouping(ticker) = 1, 'total', 'row') as kind, {_measures()}
  from valued group by grouping sets ((ticker, description), ())
)
select if(kind = 'total', 'TOTAL', ticker) as ticker, if(kind = 'total', 'Portfolio Total', description) as description, {cols}
from (from grouped where kind = 'total' or ticker <> '')"""


def daily_sql(shared: bool = False, **kw) -> str:
    return with_standins(f"one as ({daily_select(**kw)})\nselect * from one", shared)


def rollup_select(dimension: str, benchmark: str = STANDIN_BENCHMARK_TICKER, **kw) -> str:
    """RPT3-RPT7: each valued row goes to the groups it counts in (TOTAL always, its own group
    with a ticker, the benchmark for that ticker), then one aggregate."""
    kw.setdefault("weekly", True)
    text = {"cost_basis", "market_value", "today_gain_loss", "ytd_gain_loss", "total_gain_loss"}
    cols = ", ".join(
        f"case when asset_type = '{BENCHMARK_LABEL}' then '---' else cast({x} as varchar) end as {c}"
        if c in text or "mix" in c else f"{x} as {c}" for c, x in _printed(_TOTAL_VALUE).items())
    return "with " + core_ctes(**kw).strip() + f""", counted as (
  select 'total' as kind, 'TOTAL' as label, * from valued
  union all select 'row', {dimension}, * from valued where ticker <> ''
  union all select 'benchmark', '{BENCHMARK_LABEL}', * from valued where ticker = '{benchmark}'
), grouped as (
  select kind, label as asset_type, {_measures()} from counted group by all
  union all  -- TOTAL exists even without a row
  select 'total', 'TOTAL', null, null, null, null, null where not exists (from valued)
)
select asset_type, {cols} from grouped"""


def rollup_sql(dimension: str, shared: bool = False, **kw) -> str:
    return with_standins(f"one as ({rollup_select(dimension, **kw)})\nselect * from one", shared)


def stacked(parts: list[tuple[str, str]]) -> str:
    """Several runs in one statement; ``parts``: (leading column, select text)."""
    return "\nunion all\n".join(f"select {lead}, * from ({text})" for lead, text in parts)


def union_of(parts: list[tuple[str, str]]) -> str:
    return with_standins("every_run as (\n" + stacked(parts) + "\n)\nselect * from every_run")


# ------------------------------------------------------------ registry SQL
def _m(c: str) -> str:
    return f"cast({c} as decimal(18,2))"


def _money_sums() -> str:
    return ", ".join(f"{_m(f'sum({c})')} as {c}" for c in _MEAS)


def _on_core(select: str, shared: bool = False, **kw) -> str:
    return with_standins(core_ctes(**kw) + "\n" + select, shared)


def _count_pivot(devices, where: str = "") -> str:
    cols = ", ".join(f"cast(nullif(count(*) filter (where device = '{d}'), 0) as integer) as \"{d}\""
                     for d in devices)
    return with_standins(f"select date, {cols} from log {where} group by date")


def _priced_holdings(dates_sql: str) -> str:
    return f"""priced as (
  select m.description, e.date,
         p.quantity * p.cost_per_share as cb, p.quantity * e.close as mv,
         p.quantity * e.close - p.quantity * p.cost_per_share as gl
  from equities_fact e
  join portfolio_dim p on e.dataset = p.dataset and e.ticker = p.ticker
  join markets_dim m on e.dataset = m.dataset and e.ticker = m.ticker
  where e.date in ({dates_sql})
), cb as (
  select description, sum(cb) as cost_basis, sum(mv) as market_value, sum(gl) as gain_loss
  from priced where date = date '{STANDIN_AS_OF.isoformat()}' group by 1
)"""


def _retired_cost_basis() -> str:
    d = STANDIN_AS_OF.isoformat()
    return with_standins(_priced_holdings(f"date '{d}'") + f""", u as (
  select 'Portfolio Total' as description, sum(cost_basis) as cost_basis, sum(market_value) as market_value,
         sum(gain_loss) as gain_loss from cb
  union all select * from cb)
select description, {_int('cost_basis')} as cost_basis, {_int('market_value')} as market_value,
       {_int('gain_loss')} as gain_loss, {_pct('gain_loss', 'market_value')} as "gain_loss_%"
from u""")


def _pvt2_ctes() -> str:
    d, y = STANDIN_AS_OF.isoformat(), previous_weekday_of(STANDIN_AS_OF).isoformat()
    return _priced_holdings(f"date '{d}', date '{y}'") + f""", result as (
  select description, date, sum(mv) as market_value from priced group by 1, 2
), pv as (
  select description,
         cast(sum(case when date = date '{y}' then market_value end) as decimal(18,2)) as yesterday,
         cast(sum(case when date = date '{d}' then market_value end) as decimal(18,2)) as today
  from result group by 1
)"""


def _retired_day_change() -> str:
    return with_standins(_pvt2_ctes() + f""", detail as (
  select cb.*, cb.market_value - pv.yesterday as today_gain_loss
  from cb join pv on cb.description = pv.description
), u as (
  select 'Portfolio Total' as description, sum(cost_basis) as cost_basis, sum(market_value) as market_value,
         sum(gain_loss) as gain_loss, sum(today_gain_loss) as today_gain_loss from detail
  union all select * from detail)
select description, {_int('cost_basis')} as cost_basis, {_int('market_value')} as market_value,
       {_int('gain_loss')} as total_gain_loss, {_pct('gain_loss', 'market_value')} as "total_gain_loss_%",
       {_int('today_gain_loss')} as today_gain_loss,
       {_pct('today_gain_loss', 'market_value')} as "today_gain_loss_%"
from u""")


def _fx_per_date() -> str:
    return with_standins("""days as (
  select distinct date as as_of from equities_fact where date is not null
), a as (
  select as_of, as_of as today,
         case isodow(as_of) % 7 when 1 then as_of - 3 when 0 then as_of - 2 else as_of - 1 end as yesterday
  from days
), ranked as (
  select a.as_of, c.rate,
         row_number() over (partition by a.as_of order by c.date desc, c.rate desc) as rn
  from a join currency_fact c on c.currency = 'GBP' and (c.date = a.today or c.date = a.yesterday)
)
select a.as_of, coalesce(r.rate, cast(1.30 as decimal(10,4))) as rate
from a left join (select as_of, rate from ranked where rn = 1) r on a.as_of = r.as_of""")


def _distinct_dates(select: str) -> str:
    return with_standins(f"d as (select distinct date from equities_fact where date is not null)\n"
                         f"select {select} from d")


def registered_sql() -> dict[str, str]:
    from .registry import BACKFILL_DATES
    from .sources.standin import STANDIN_DEVICES, STANDIN_LOG_END, STANDIN_LOG_START

    d = STANDIN_AS_OF.isoformat()
    dims = ("asset_type", "location", "capitalization", "investment_style")
    daily_cols = ("ticker", '"mix_%"', "description", "cost_basis", "market_value", "today_gain_loss",
                  '"today_gain_loss_%"', "ytd_gain_loss", '"ytd_gain_loss_%"', "total_gain_loss",
                  '"total_gain_loss_%"')
    block_cols = f"{_DIMS}, ticker"
    anchors_in = "select day from roles"
    now_leg = ("select " + block_cols + ", {cost} as cost_basis, {value} as market_value, {gain} as gain_loss "
               "from legs where value_{leg} is not null")
    yesterday_leg = (f"select {block_cols}, {_m('v_y')} as yesterday from legs where h_y union all "
                     f"select {_DIMS}, null, {_m('sum(cost)')} from positions "
                     f"where not (h_t or h_y or h_b or h_m) group by all")

    def leg(name: str) -> str:
        return now_leg.format(leg=name, cost=_m(f"cost_{name}"), value=_m(f"value_{name}"),
                              gain=_m(f"value_{name} - cost_{name}"))

    joins = (("", {}), ("_shared", {"shared": True, "lake": True, "weekly": True}))
    log_between = f"where date between date '{STANDIN_LOG_START}' and date '{STANDIN_LOG_END}'"
    sql = {
        "rpt1": daily_sql(),
        "rpt2": daily_sql(lake=True),
        "rpt3": rollup_sql("asset_type"), "rpt4": rollup_sql("location"),
        "rpt5": rollup_sql("capitalization"), "rpt6": rollup_sql("investment_style"),
        **{f"rpt7_{x}": rollup_sql(x, lake=True) for x in dims},
        "rpt1_shared": daily_sql(shared=True, joined=True), "rpt2_shared": daily_sql(shared=True, lake=True, joined=True),
        "rpt5_shared": rollup_sql("capitalization", shared=True, joined=True),
        "rpt7_shared": rollup_sql("capitalization", shared=True, lake=True, joined=True),
        "rpt8": with_standins(f"select * from equities_fact where date = date '{d}'"),
        "rpt9": _count_pivot(STANDIN_DEVICES, log_between),
        "rpt10": _retired_cost_basis(),
        "rpt11": _retired_day_change(),
        "ext1": union_of([(f"'{u}' as _user", daily_select(user=u)) for u in "ANR"]),
        "ext1_lake": union_of([(f"'{u}' as _user", rollup_select("location", user=u, lake=True)) for u in "ANR"]),
        **{name: union_of([(f"date '{x}' as as_of", daily_select(as_of=x)) for x in BACKFILL_DATES]) for name in ("ext2", "ext2_resumed")},
        "ext2_lake": union_of([(f"date '{x}' as as_of, '{u}' as _user", daily_select(as_of=x, user=u, lake=True))
                               for x in BACKFILL_DATES[2:6] for u in "ANR"]),
        "ext3": union_of([(f"'{x}' as dimension", rollup_select(x)) for x in dims]),
        "src1": with_standins("select * from equities_fact"),
        "src1_bucketed": with_standins(
            "p as (select ticker, count(*) as n_prices, " + _m("sum(close)") + " as close_sum from equities_fact group by ticker),\n"
            "l as (select ticker, count(*) as n_lots, cast(sum(quantity) as decimal(18,4)) as quantity from portfolio_dim group by ticker)\n"
            "select * from p join l using (ticker)"),
        "src2": with_standins("select * from portfolio_dim"),
        "src3": with_standins("select * from markets_dim"),
        "src4": with_standins("select * from currency_fact"),
        "src5": with_standins("select * from log"),
        "src6": with_standins(
            "d as (select distinct date as today from equities_fact)\n"
            "select 'R' as _user, 'ALPHA-VANTAGE' as datasource, 'GBP' as currency, "
            "cast(1.30 as decimal(3,2)) as rate, today, case isodow(today) % 7 when 1 then today - 3 "
            "when 0 then today - 2 else today - 1 end as yesterday from d"),
        **{name: with_standins(f"one as ({daily_select(lake=lake)})\nselect " + ", ".join(
            f"cast({c} as varchar) as {c}" for c in daily_cols) + " from one")
           for name, lake in (("snk1", False), ("snk2", True))},
        "par1": with_standins("select _user, ticker, quantity, cost_per_share from portfolio_dim "
                              "where dataset = 'ALPHA-VANTAGE' and (_user = 'R' or _user = 'R'' or ''1''=''1')"),
        "prj1": _on_core(f"select ticker, description, quantity, cost_per_share, "
                         f"{_m('quantity * cost_per_share')} as cost_basis from lots"),
        "prj2": with_standins("select * from equities_fact"),
        "prj3": rollup_sql("investment_style"),
        "flt1": with_standins("select * from portfolio_dim where dataset = 'ALPHA-VANTAGE' and _user = 'R'"),
        "flt2": with_standins(f"select * from equities_fact where date <> date '{d}'"),
        "flt3": _on_core(f"select * from equities_fact where date in ({anchors_in})"),
        "flt4": _on_core(f"select * from equities_fact where date in ({anchors_in}) or date is null"),
        "flt5": _on_core(yesterday_leg, lake=True, weekly=True),
        "flt6": with_standins(f"select * from equities_fact where ticker in "
                              f"('{STANDIN_FX_TICKER}', '{STANDIN_YEAR_START_TICKER}', '{STANDIN_BENCHMARK_TICKER}')"),
        "flt7": _on_core(leg("now")),
        "flt8": _on_core(f"select {block_cols}, " + ", ".join(f"{_m(c)} as {c}" for c in _MEAS)
                         + " from valued where ticker <> ''"),
        "flt9": _count_pivot(STANDIN_DEVICES, log_between),
        "flt10": with_standins("select * from equities_fact where date >= date '2024-01-02'"),
        "sub1": with_standins(
            "select * from equities_fact where date = (select max(date) from (select date, dataset "
            "from equities_fact where ticker in (select ticker from portfolio_dim where dataset = "
            f"'ALPHA-VANTAGE') and date <> date '{d}' group by date, dataset having count(*) > 40) q)"),
        "jn1": with_standins(
            "select p.ticker, m.description, m.asset_type, p.quantity, p.cost_per_share from portfolio_dim p "
            "join markets_dim m on m.ticker = p.ticker and m.dataset = p.dataset "
            "where p.dataset = 'ALPHA-VANTAGE' and p._user = 'R'"),
        "jn2": with_standins(
            "select p.ticker, m.description, m.asset_type, p.quantity, p.cost_per_share from portfolio_dim p "
            "join markets_dim m on m.ticker = p.ticker where p.dataset = 'ALPHA-VANTAGE' and p._user = 'R'"),
        "jn3": _on_core(f"select {block_cols}, {_m('v_b')} as market_value from legs where h_b"),
        "jn4": _on_core(yesterday_leg, lake=True, weekly=True),
        "jn5": _fx_per_date(),
        **{f"jn6{end}": _on_core(
            f"select {_DIMS}, tk as ticker, {_m('cost')} as cost_basis, {_m('worth')} as market_value, {_m('gain')} as gain_loss, "
            f"{_m('ytd')} as ytd_gain_loss, {_m('day_change')} as today_gain_loss from by_ticker", joined=True, **kw) for end, kw in joins},
        **{f"jn7{end}": _on_core(f"select {block_cols}, " + ", ".join(f"{_m(c)} as {c}" for c in _MEAS) + " from valued",
                                 joined=True, **kw) for end, kw in joins},
        "jn8": with_standins("select * from equities_fact where ticker in "
                             "(select distinct ticker from portfolio_dim where dataset = 'ALPHA-VANTAGE')"),
        "jn9": _on_core("select * from equities_fact where ticker in (select ticker from lots)", lake=True),
        "jn10": with_standins(
            f"select m.description, e.ticker, e.date, {_m('sum(p.quantity * p.cost_per_share)')} as cost_basis, "
            f"{_m('sum(p.quantity * e.close)')} as market_value, "
            f"{_m('sum(p.quantity * e.close - p.quantity * p.cost_per_share)')} as gain_loss, "
            "count(*) as n_pairs "
            "from equities_fact e join portfolio_dim p on e.dataset = p.dataset and e.ticker = p.ticker "
            f"join markets_dim m on e.dataset = m.dataset and e.ticker = m.ticker where e.date = date '{d}' "
            "group by 1, 2, 3"),
        "jn11": _retired_day_change(),
        "agg1": _on_core("select * from lots"),
        "agg2": _on_core(leg("then")),
        "agg3": _on_core("select * from quotes"),
        "agg4": with_standins(
            "select distinct date from (select date, dataset from equities_fact where ticker in "
            "(select distinct ticker from portfolio_dim where dataset = 'ALPHA-VANTAGE') "
            f"and date <> date '{d}' group by 1, 2 having count(*) > 40) q"),
        "agg5": _on_core(f"select {_money_sums()} from valued"),
        "agg6": _on_core(f"select 'Benchmark' as asset_type, {_money_sums()} from valued "
                         f"where ticker = '{STANDIN_BENCHMARK_TICKER}' group by 1"),
        "agg7": _on_core(f"select ticker, description, {_money_sums()} from valued "
                         f"where ticker <> '' group by 1, 2"),
        **{f"agg{8 + i}": _on_core(f"select {x} as asset_type, {_money_sums()} from valued "
                                   f"where ticker <> '' group by 1") for i, x in enumerate(dims)},
        "agg12": with_standins("select distinct ticker from portfolio_dim where dataset = 'ALPHA-VANTAGE'"),
        "agg13": with_standins("select date, device, count(*) as n from log group by 1, 2"),
        "agg14": _on_core("select * from lots"),
        "agg15": with_standins(_priced_holdings(f"date '{d}'") + "\nselect description, "
                               + ", ".join(f"{_m(c)} as {c}" for c in ("cost_basis", "market_value", "gain_loss"))
                               + " from cb"),
        "pvt1": _count_pivot(STANDIN_DEVICES), "pvt1_discovered": _count_pivot(STANDIN_DEVICES),
        "rpt9_positional": with_standins(
            "devices as (select device, row_number() over (order by device) as place from (select distinct device from log))\n"
            "select date, " + ", ".join(f"cast(nullif(count(*) filter (where place = {i}), 0) as integer) as device_{i}"
                                        for i in range(1, len(STANDIN_DEVICES) + 1))
            + f" from log join devices using (device) {log_between} group by date"),
        "pvt2": with_standins(_pvt2_ctes() + "\nselect * from pv"),
        "srt1": daily_sql(),
        "srt2": _count_pivot(STANDIN_DEVICES, "where date between date '2024-01-01' and date '2024-12-31'"),
        "srt3": with_standins("select date, device, count(*) as n from log group by 1, 2"),
        "top1": _fx_per_date(),
        "set1": daily_sql(),
        "set2": rollup_sql("capitalization"),
        "set3": _retired_cost_basis(),
        "fn1": "select event_id, cast(timezone('America/Los_Angeles', ts at time zone 'UTC') as date) "
               "as local_date from events",
        "fn2": "select event_id, cast(timezone('America/Los_Angeles', ts at time zone 'UTC') as date) as dst_date, "
               "cast(timezone('Etc/GMT+8', ts at time zone 'UTC') as date) as fixed_date from events",
        "fn3": _distinct_dates("date, case isodow(date) % 7 when 1 then date - 3 when 0 then date - 2 "
                               "else date - 1 end as yesterday"),
        "fn4": _distinct_dates("date, cast(date_trunc('year', date) + interval '1 day' as date) "
                               "as beginning_of_year"),
        "fn5": _distinct_dates("date, date - 3 as minus_3, cast(date - interval '1' day as date) as minus_1d"),
        "fn6": _distinct_dates("date, date - 1 as previous_day"),
        "fn7": _on_core(f"select {block_cols}, " + ", ".join(f"{_m(c)} as {c}" for c in _MEAS)
                        + " from valued where ticker is not null"),
        "fn8": _distinct_dates("date, case isodow(date) when 1 then 'monday' when 7 then 'sunday' "
                               "else 'other' end as rule"),
        "fn9": _on_core(f"select ticker, date, cast(round(case when ticker = '{STANDIN_FX_TICKER}' then "
                        "close * (select rate from rate) * 0.01 else close end, 6) as decimal(18,6)) "
                        "as close from equities_fact"),
        "fn10": _on_core(f"select ticker, description, quantity, cost_per_share, "
                         f"{_m('quantity * cost_per_share')} as cost_basis from lots"),
        "fn11": _on_core(f"select ticker, {_pct('gain_loss', 'cost_basis')} as pct from valued "
                         "where ticker <> ''"),
        "fn12": _on_core("select ticker, " + ", ".join(f"{_int(c)} as {c}" for c in _MEAS)
                         + " from valued where ticker <> ''"),
        "fn13": with_standins("select ticker, cast(quantity as decimal(10,4)) as quantity, "
                              "cast(cost_per_share as decimal(6,2)) as cost_per_share, "
                              "cast(quantity as varchar) as quantity_text from portfolio_dim"),
        "fn14": "select * from (" + union_of([(f"'{x}' as dimension", rollup_select(x)) for x in dims])
                + ") where asset_type in ('TOTAL', 'Benchmark')",
        "fn15": with_standins(_priced_holdings(f"date '{d}'") + "\nselect description, "
                              f"{_pct('gain_loss', 'market_value')} as of_market_value, "
                              f"{_pct('gain_loss', 'cost_basis')} as of_cost_basis from cb"),
    }
    sql |= {f"{name}_maintained": sql[name] for name in ("rpt1", "agg4")}  # however the totals were kept
    sql |= {f"{name}_sql": sql[name] for name in ("rpt1", "rpt4", "rpt7_location")}
    return sql
