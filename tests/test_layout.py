"""Date-partitioned price fact: same report, and the scan prunes partitions."""

import tempfile

from conftest import SF001

from markbook.plans import portfolio_daily
from markbook.sources import standin
from markbook.sources.sinks import write_partitioned
from markbook.sources.tables import Tables


def test_partitioned_price_fact_prunes_and_matches(spark):
    t = standin.load(spark, SF001)
    p = standin.standin_params()
    path = tempfile.mkdtemp(prefix="markbook-layout-") + "/equities"
    write_partitioned(t.equities, path)
    eq = spark.read.parquet(path).select("dataset", "ticker", "date", "close")
    t2 = Tables(eq, t.portfolio, t.markets, t.currency, t.log)
    a = portfolio_daily(spark, t, p).collect()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    report = portfolio_daily(spark, t2, p)
    b = report.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    plan = report._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    # the price scan reads only the four anchor-date partitions
    import re
    filters = re.findall(r"PartitionFilters: \[[^\]]*(date#\d+ IN \([^)]*\))\]", plan)
    assert filters, plan
    assert all(d in filters[0] for d in ("2024-01-02", "2024-01-26", "2024-01-29", "2024-01-30"))
