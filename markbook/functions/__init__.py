"""Column-expression helpers: date anchors, money and percent formatting."""

from .dates import beginning_of_year, local_date, previous_day, previous_weekday, today_in
from .money import mask_if, percent, price_average, ratio, to_int

__all__ = ["beginning_of_year", "local_date", "previous_day", "previous_weekday", "today_in",
           "mask_if", "percent", "price_average", "ratio", "to_int"]
