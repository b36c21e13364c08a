"""Money and percent formatting rules (FN10-FN12, PRJ3), written once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MASK


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(x) -> Column:
    """FN12/Q8: integer cast that rounds half away from zero like PostgreSQL and
    Presto (a bare Spark cast truncates).  64 bits: a report's total outgrows
    32 bits at a few billion."""
    return F.round(_col(x)).cast("bigint")


def ratio(num, den) -> Column:
    """num / den as a double; a zero denominator gives NULL (Q12 deviation:
    the reference raises a division-by-zero error)."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def percent(num, den) -> Column:
    """FN11: the ratio in per cent with two decimals and a percent sign; NULL stays
    NULL.  Sixteen digits before the point, so one row with a tiny
    denominator does not end the report."""
    return F.concat((ratio(num, den) * 100).cast("decimal(18,2)").cast("string"), F.lit("%"))


def mask_if(cond: Column, value) -> Column:
    """PRJ3: the masked text when ``cond`` holds, else the value as text."""
    return F.when(cond, F.lit(MASK)).otherwise(_col(value).cast("string"))


def price_average(close_sum, close_count) -> Column:
    """Average close rounded to ``decimal(18,6)`` (see SURVEY 7.4)."""
    return F.round(_col(close_sum) / _col(close_count), 6).cast("decimal(18,6)")
