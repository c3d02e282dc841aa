"""The shape of the plans: nothing that would stop working on large tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import suite
from conftest import SMALL, rows
from suite.apply_queries import LINE_KEY, NEW_LINES, OLD_LINES
from suite.registry import rows_of
from tidemark.functions.clean import clean
from tidemark.operators import modes

PURE = [n for n in sorted(suite.QUERIES) if not n.startswith(("publish_", "stream_", "run_"))]


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", PURE)
def test_no_plan_crosses_or_gathers(spark, name):
    text = plan(contract.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text, name
    # Only a total over a whole table meets in one task, after partial aggregates.
    if "SinglePartition" in text:
        assert "partial_" in text, name


def test_merge_broadcasts_only_measured_keys(spark):
    t, s = rows_of(spark, SMALL, OLD_LINES), rows_of(spark, SMALL, NEW_LINES)
    assert "BroadcastHashJoin LeftAnti" in plan(modes.merge(t, s, LINE_KEY, small=True)).replace("\n", " ")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(modes.merge(t, s, LINE_KEY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftAnti" in text and "Broadcast" not in text


def test_key_side_reads_key_columns_only(spark):
    t, s = rows_of(spark, SMALL, OLD_LINES), rows_of(spark, SMALL, NEW_LINES)
    text = plan(modes.merge_counts(t, s, LINE_KEY))
    assert "l_extendedprice" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in text


def test_target_is_counted_per_key_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(modes.merge_counts(rows_of(spark, SMALL, OLD_LINES), rows_of(spark, SMALL, NEW_LINES), LINE_KEY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text.index("SortMergeJoin Inner")
    target_side = text[join : text.index("Scan parquet", join)]
    assert target_side.count("HashAggregate") == 2 and "LeftSemi" not in text


def test_cleaning_keeps_filters_and_columns_at_the_scan(spark):
    df = clean(spark.read.parquet(f"{SMALL}/orders.parquet")).where("o_totalprice > 1000").select("o_orderkey", "o_orderstatus")
    text = plan(df)
    assert "GreaterThan(o_totalprice,1000.0)" in text and "o_orderpriority" not in text.split("ReadSchema")[1].split("\n")[0]


def test_merge_reads_only_keys_in_reach(spark, store):
    table = store("id long, v string")
    table.load(spark.range(100).select("id", F.lit("a").alias("v")), "initial")
    staged = table.stage(spark.range(5, 8).select("id", F.lit("b").alias("v")), pk=["id"])
    assert (staged.low, staged.high, staged.part.rows) == ("5", "7", 3)
    assert table.load(spark.range(5, 8).select("id", F.lit("b").alias("v")), "merge", pk=["id"]).deleted == 3
    assert len(rows(table.read())) == 100
