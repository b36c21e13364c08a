"""Plan shape: no hash shuffle of raw rows in the reports.

Every hash exchange must sit on an aggregate (map-side partial aggregate, or
an already aggregated result), so a ticker or lot holding a third of all
rows is combined before it moves."""

import re

import pytest

from conftest import SF001

import __spark_entry__ as E

PASS_THROUGH = ("Project", "Filter", "AQEShuffleRead", "ShuffleQueryStage", "InputAdapter",
                "WholeStageCodegen", "ColumnarToRow", "Sort ", "Generate", "BroadcastHashJoin",
                "BroadcastQueryStage", "BroadcastExchange")


def exchange_children(plan: str):
    lines = [l for l in plan.split("\n") if l.strip()]
    for i, l in enumerate(lines):
        if "Exchange hashpartitioning" not in l:
            continue
        for nxt in lines[i + 1:]:
            op = re.sub(r"^[\s:+\-|]*(\*\(\d+\)\s*)?", "", nxt)
            if op.startswith(PASS_THROUGH):
                continue
            yield l.strip(), op
            break


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["rpt1", "rpt2", "ext2", "flt3", "agg3", "rpt10", "rpt11"])
def test_anchor_dates_reach_the_price_scan(spark, name):
    """``date`` is a cast of ``ts`` in the stand-in tables: the range around the anchor dates
    is pushed as a range over ``ts``."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = final_plan(E.queries()[name](spark, SF001))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x for x in plan.split("\n") if "FileScan parquet" in x and "events.parquet" in x]
    assert any("GreaterThanOrEqual(ts" in x and "LessThan(ts" in x for x in scans), scans


def test_retired_report_reads_each_table_once(spark):
    q = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert final_plan(E.queries()["rpt11"](spark, SF001)).count("FileScan parquet") <= 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", q)


@pytest.mark.parametrize("name", ["rpt1", "rpt3", "ext1", "ext2", "ext3", "rpt7_location", "ext1_lake"])
def test_hash_exchanges_move_aggregated_rows(spark, name):
    df = E.queries()[name](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    checked = list(exchange_children(final))
    assert checked
    for ex, child in checked:
        # a checkpointed frame (Scan ExistingRDD) is the per-user fallback
        # table: one row per user, already aggregated
        assert child.startswith(("HashAggregate", "Scan ExistingRDD")), f"{ex}\n  over {child[:200]}"


@pytest.mark.parametrize("name", ["jn6", "jn7"])
def test_outer_chains_run_in_one_pass(spark, name):
    """With broadcasts off: every table is read for the wide rows once, and no full join is left."""
    q = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(E.queries()[name](spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", q)
    assert plan.count("FileScan parquet") <= 8 and plan.count(" Exchange ") <= 12 and "FullOuter" not in plan


def test_bucketed_tables_join_without_an_exchange(spark):
    q = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(E.queries()["src1_bucketed"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", q)
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2 and "Join" in plan
