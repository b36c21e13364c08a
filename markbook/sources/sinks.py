"""Report sinks (SNK1, SNK2): header CSV, the reference's mailed format."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite",
              unquoted: bool = False) -> None:
    """Write a report as CSV with a header row.

    By default fields that contain the separator are quoted (a deliberate
    deviation from ``psql -A -F','``); ``unquoted=True`` writes fields as they
    are, like the reference's unaligned output.  ``single_file`` merges the
    output into one part file; use it only for single-report outputs, whose
    size is bounded by the number of tickers, never for batch reports.
    """
    if unquoted:
        # Spark's CSV writer always quotes values holding the separator, so
        # write text lines: header first, NULL as an empty field (psql -A)
        sep = ","
        lines = df.select(F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
                                             for c in df.columns]).alias("value"))
        lines = lines.coalesce(1) if single_file else lines
        head = sep.join(df.columns)

        def with_header(batches):
            """Every part file begins with the header, as the quoted form's do."""
            yield pa.RecordBatch.from_pydict({"value": [head]})
            yield from (pa.RecordBatch.from_arrays(b.columns, names=["value"]) for b in batches)

        lines.mapInArrow(with_header, "value string").write.mode(mode).text(path)
        return
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, column: str = "date", mode: str = "overwrite") -> None:
    """Lay a fact table out as Parquet partitioned by ``column``.

    Every report touches at most four price dates; with this layout the
    literal anchor dates prune whole directories instead of filtering rows.
    Rows are clustered by the partition column first so each task writes few
    files; the rebalance hint lets AQE split a date that is too large for one task."""
    df.hint("rebalance", column).write.mode(mode).partitionBy(column).parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, column: str = "ticker", buckets: int = 64) -> DataFrame:
    """Lay a table out in ``buckets`` files by hash of ``column``, each sorted by it, as the catalog table
    ``table`` with its files under ``path``, and return it.

    Aggregates and joins by ``column`` then read a bucket per task and need no exchange on this side; two
    tables with the same number of buckets join without any.  The layout is made once, when rows
    arrive; rows are dealt to the buckets' tasks before writing, so there is one file per bucket.
    A bucket holds all rows of its tickers: choose ``buckets`` so that it suits a task, and keep
    the date layout (:func:`write_partitioned`) for reports, which read four dates."""
    (df.repartition(buckets, column).write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, column).sortBy(column).saveAsTable(table))
    return df.sparkSession.table(table)
