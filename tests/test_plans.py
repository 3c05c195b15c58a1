"""Plan properties that matter at scale, read from the physical plans."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
import __spark_entry__ as E
from lakeload.operators.keys import check_key
from lakeload.operators.profile import profile_numbers
from lakeload.sinks.load import merge_frames
from lakeload.sinks.table import read_version


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_key_check_aggregates_partially(spark):
    plan = _plan(check_key(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"), ["l_orderkey", "l_linenumber"]))
    assert "partial_count" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_profile_reads_only_numeric_columns_and_aggregates_partially(spark):
    plan = _plan(profile_numbers(spark.read.parquet(f"{SF_SMALL}/orders.parquet")))
    assert "partial_count" in plan
    assert "o_orderstatus" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_merge_broadcasts_source_keys_only(spark, scratch):
    from lakeload.sinks.load import load
    t = scratch("plan_merge")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    load(o, t, "full")
    changes = o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    plan = _plan(merge_frames(read_version(spark, t), changes, ["o_orderkey"]))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
