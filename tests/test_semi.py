"""The Bloom-filtered semi join: exact, few rows pass by mistake, and only passing rows move."""

import re

import pytest
from conftest import SF001
from pyspark.sql import functions as F

import __spark_entry__ as E
from markbook.operators import semi


def numbers(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("T"), F.col("id")).alias("ticker"), "id")


@pytest.mark.parametrize("words", [1, 64, semi.WORDS])
def test_semi_join_is_exact_at_any_size(spark, words):
    rows = numbers(spark, 0, 20_000).unionByName(spark.createDataFrame([(None, 1), ("", 2)], "ticker string, id long"))
    keys = numbers(spark, 19_000, 30_000).select("ticker").unionByName(spark.createDataFrame([(None,), ("",)], "ticker string"))
    got = semi.semi_join(rows, keys, "ticker", words)
    assert got.columns == rows.columns
    assert sorted(r["id"] for r in got.collect()) == [2, *range(19_000, 20_000)]
    assert semi.bloom_filter(keys, "ticker", words).count() <= words


def test_few_rows_pass_by_mistake(spark):
    keys = numbers(spark, 0, 100_000).select("ticker")
    passed = semi.may_be_in(numbers(spark, 100_000, 300_000), keys, "ticker").count()
    assert passed < 200  # a thousandth
    assert semi.may_be_in(numbers(spark, 0, 100_000), keys, "ticker").count() == 100_000


def test_empty_sides(spark):
    none = numbers(spark, 0, 0)
    assert semi.semi_join(numbers(spark, 0, 50), none.select("ticker"), "ticker").count() == 0
    assert semi.semi_join(none, numbers(spark, 0, 50).select("ticker"), "ticker").count() == 0


def test_only_passing_price_rows_move(spark):
    """With broadcasts off the price side's exchange writes little more than the result's rows."""
    q = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("jn8", "jn9"):
            df = E.queries()[name](spark, SF001)
            n = len(df.collect())
            plan = df._jdf.queryExecution().executedPlan()
            assert re.search(r"BroadcastHashJoin.*LeftSemi", plan.toString().split("== Initial Plan ==")[0])
            moved = [v for label, v in exchanged(plan) if "close" in label]
            assert moved and n <= moved[0] <= 1.01 * n + 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", q)


def exchanged(plan):
    """(output columns, rows written) of every exchange of an executed plan."""
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        if p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
        if p.nodeName() == "Exchange":
            out.append((p.output().mkString(","), p.metrics().apply("shuffleRecordsWritten").value()))
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out
