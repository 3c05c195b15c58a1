"""Incremental loads with Structured Streaming: each arrived file is loaded exactly once."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeload.operators.profile import profile_numbers
from lakeload.sinks.table import read_version
from lakeload.streaming.incremental import loaded_profile, stream_load


def test_only_new_files_are_loaded(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src, tgt, prof = scratch("src"), scratch("tgt"), scratch("prof")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    ev.where(F.col("ts") <= cut).write.parquet(src)
    assert stream_load(spark, src, tgt, profile_target=prof, table="events") == 1
    assert stream_load(spark, src, tgt, profile_target=prof, table="events") == 0     # nothing new
    ev.where(F.col("ts") > cut).write.mode("append").parquet(src)
    assert stream_load(spark, src, tgt, profile_target=prof, table="events") == 1
    out = read_version(spark, tgt)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ev.select(*out.columns).collect()))
    full = {r["column_name"]: r.asDict() for r in profile_numbers(ev, table="events").collect()}
    merged = {r["column_name"]: r.asDict() for r in loaded_profile(spark, prof).collect()}
    assert merged == full


def test_streaming_merge(spark, scratch):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    src, tgt = scratch("msrc"), scratch("mtgt")
    o.write.parquet(src)
    stream_load(spark, src, tgt, mode="merge", key=["o_orderkey"])
    o.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).withColumn(
        "o_orderstatus", F.lit("U")).write.mode("append").parquet(src)
    stream_load(spark, src, tgt, mode="merge", key=["o_orderkey"])
    out = read_version(spark, tgt)
    assert out.count() == o.count()
    assert out.where("o_orderstatus = 'U'").count() == o.where(
        F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).count()


def test_streams_with_checkpoints_of_their_own_and_replayed_batches(spark, scratch):
    import os
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a, b, tgt, prof = scratch("a"), scratch("b"), scratch("tgt2"), scratch("prof2")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    ev.where(F.col("ts") <= cut).write.parquet(a)
    ev.where(F.col("ts") > cut).write.parquet(b)
    ca, cb = scratch("ca"), scratch("cb")
    assert stream_load(spark, a, tgt, profile_target=prof, table="events", checkpoint=ca) == 1
    assert stream_load(spark, b, tgt, profile_target=prof, table="events", checkpoint=cb) == 1
    # the commit of the last batch is lost, so the stream runs it again
    commits = f"{cb}/commits"
    os.rename(f"{commits}/0", f"{commits}/lost")
    if os.path.exists(f"{commits}/.0.crc"):
        os.rename(f"{commits}/.0.crc", f"{commits}/.lost.crc")
    os.mkdir(f"{cb}/aside")
    os.rename(f"{commits}/lost", f"{cb}/aside/0")
    assert stream_load(spark, b, tgt, profile_target=prof, table="events", checkpoint=cb) == 0
    out = read_version(spark, tgt)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ev.select(*out.columns).collect()))
    full = {r["column_name"]: r.asDict() for r in profile_numbers(ev, table="events").collect()}
    assert {r["column_name"]: r.asDict() for r in loaded_profile(spark, prof).collect()} == full


def test_two_updates_of_one_key_in_a_batch(spark, scratch):
    src, tgt = scratch("usrc"), scratch("utgt")
    spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "x", None)], "k int, v string, n int").write.parquet(src)
    stream_load(spark, src, tgt, mode="merge", key=["k"], order_by="n")
    assert sorted((r.k, r.v) for r in read_version(spark, tgt).collect()) == [(1, "b"), (2, "x")]


def test_failed_append_is_not_seen(spark, scratch):
    from lakeload.sinks.load import load
    from lakeload.sinks.table import committed_versions
    tgt = scratch("atomic")
    load(spark.range(10), tgt)
    try:
        load(spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("bigint").alias("id")),
             tgt, mode="incremental")
        raise AssertionError("the load should fail")
    except Exception as e:
        assert "stop" in str(e)
    assert read_version(spark, tgt).count() == 10 and committed_versions(spark, tgt) == [1]
    load(spark.range(3), tgt, mode="incremental", keep_versions=1)
    # a failed write has claimed no number
    assert read_version(spark, tgt).count() == 13 and committed_versions(spark, tgt)[-1] == 2
