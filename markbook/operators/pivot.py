"""Pivots, the reference's two ``crosstab`` uses (PVT1, PVT2).

``crosstab(source, categories)`` returns one row per row key and one column
per category; a missing cell is NULL.  Spark's ``pivot`` with an explicit value
list has the same shape.  The list is either declared, which needs no extra pass, or
read from the data (:func:`discover_categories`), as the reference does.  Columns are matched to
categories by name, or by sorted position like ``crosstab``'s (Q20).  Rows are aggregated
per (row key, category) before pivoting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MOST_CATEGORIES = 1000


def discover_categories(df: DataFrame, category: str, most: int = MOST_CATEGORIES) -> list[str]:
    """The distinct values of ``category``, in byte order; NULL is no category.  More than ``most`` are an
    error: no more than that many rows reach the driver, and a result has no more columns."""
    found = [str(r[0]) for r in df.select(category).where(F.col(category).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{category} has more than {most} values; declare the columns wanted")
    return sorted(found, key=str.encode)


def count_pivot(df: DataFrame, row_key: str, category: str, values=None, out_type: str = "int", names=None) -> DataFrame:
    """PVT1: ``count(*)`` by (row_key, category), one column per value.

    ``values``: the categories, read from the data if None.  ``names``: the columns' names by position (as many as
    there are categories, otherwise an error); without, columns are named after the values."""
    values = discover_categories(df, category) if values is None else list(values)
    names = [str(v) for v in values] if names is None else list(names)
    if len(names) != len(values):
        raise ValueError(f"{len(names)} columns for {len(values)} categories: {', '.join(map(str, values))}")
    counted = df.groupBy(row_key, category).agg(F.count(F.lit(1)).alias("n"))
    if not values:
        return counted.select(row_key).distinct()
    wide = counted.groupBy(row_key).pivot(category, values).agg(F.first("n"))
    # by position: a category may hold any character, or be named like the row key
    wide = wide.toDF("key", *[f"c{i}" for i in range(len(values))])
    return wide.select(F.col("key").alias(row_key), *[F.col(f"c{i}").cast(out_type).alias(n) for i, n in enumerate(names)])


def value_pivot(df: DataFrame, row_key: str, category: str, value: str, values, names,
                out_type: str | None = None) -> DataFrame:
    """PVT2: ``sum(value)`` by (row_key, category) with output columns ``names``
    (category values matched in order)."""
    values = list(values)
    summed = df.groupBy(row_key, category).agg(F.sum(value).alias("v"))
    wide = summed.groupBy(row_key).pivot(category, values).agg(F.first("v"))
    cols = []
    for v, n in zip(values, names):
        c = F.col(f"`{v}`")
        cols.append((c.cast(out_type) if out_type else c).alias(n))
    return wide.select(row_key, *cols)
