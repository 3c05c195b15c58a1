"""Writers at the same time, reject tables, and merges that leave partitions alone."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lakeload.plans.apply import cast_rejects
from lakeload.sinks import load as loads
from lakeload.sinks import table as tbl
from lakeload.sinks.load import load
from lakeload.sinks.table import committed_versions, read_rejects, read_version
from lakeload.streaming.incremental import stream_load


def test_two_appends_at_once_keep_all_rows(spark, scratch):
    t = scratch("both")
    load(spark.range(10), t)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: load(spark.range(k * 200_000 + 10, (k + 1) * 200_000 + 10), t, "incremental"), range(2)))
    assert read_version(spark, t).count() == 400_010 == read_version(spark, t).distinct().count()


def test_first_appends_at_once(spark, scratch):
    t = scratch("first")
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: load(spark.range(k * 100, k * 100 + 100), t, "incremental"), range(3)))
    assert read_version(spark, t).count() == 300


def test_merges_at_once_see_each_other(spark, scratch):
    t = scratch("merges")
    load(spark.range(10).withColumn("v", F.lit(0)), t)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: load(spark.range(k, 20, 2).withColumn("v", F.lit(k + 1)), t, "merge", key=["id"]), range(2)))
    assert {r.id: r.v for r in read_version(spark, t).collect()} == {i: i % 2 + 1 for i in range(20)}


def test_two_streams_into_one_table_keep_both_notes(spark, scratch):
    t, sources = scratch("streams"), [scratch("sa"), scratch("sb")]
    for k, s in enumerate(sources):
        spark.range(k * 1000, k * 1000 + 1000).write.parquet(s)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda s: stream_load(spark, s, t, checkpoint=s + "-ckpt"), sources))
    assert read_version(spark, t).count() == 2000
    assert len(tbl.meta_of(spark, t, tbl.current_version(spark, t))["batches"]) == 2


def test_a_lost_writer_holds_nobody_up(spark, scratch, monkeypatch):
    t = scratch("stale")
    load(spark.range(5), t)
    tbl.make_dir(spark, tbl.version_dir(t, 2))
    assert tbl._create(spark, f"{tbl.version_dir(t, 2)}/{tbl.CLAIM}", "{}")  # claimed, then lost
    assert not tbl._create(spark, f"{tbl.version_dir(t, 2)}/{tbl.CLAIM}", "{}")
    monkeypatch.setattr(tbl, "CLAIM_SECONDS", 1)
    assert load(spark.range(3), t, "incremental").first()["version"] == 3
    assert read_version(spark, t).count() == 8
    # the lost writer comes back: its number is void, it publishes under another, on top of what is there
    assert not tbl._create(spark, f"{tbl.version_dir(t, 2)}/{tbl.DECISION}", tbl.KEPT)


def test_a_writer_waits_for_an_earlier_claim(spark, scratch):
    t = scratch("wait")
    load(spark.range(5), t)
    inside, go, done = threading.Event(), threading.Event(), []

    def slow(current):
        inside.set()
        go.wait(30)
        return {"segments": [], "batches": {"slow": 1}, "data": tbl.meta_of(spark, t, 1)["data"], "schema": tbl.meta_of(spark, t, 1)["schema"]}

    first = threading.Thread(target=lambda: done.append(tbl.publish(spark, t, slow)))
    first.start()
    inside.wait(30)
    second = threading.Thread(target=lambda: done.append(load(spark.range(3), t, "incremental").first()["version"]))
    second.start()
    second.join(5)
    assert second.is_alive() and committed_versions(spark, t) == [1]
    go.set()
    first.join(60)
    second.join(60)
    # the first one replaced the table, so the append that had read version 1 was made again, under the next number
    assert done == [2, 4] and tbl.meta_of(spark, t, 4)["batches"] == {"slow": 1} and read_version(spark, t).count() == 8


def test_rejects_are_written_in_the_same_job(spark, scratch):
    t = scratch("rejects")
    rows = [(1, "5", 1.5), (2, "x", 3e10), (3, None, None), (4, "99999999999", 2.0)]
    df = spark.createDataFrame(rows, "k int, a string, b double")
    calls = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: calls.add(1) or x, "int")
    counted = df.withColumn("k", seen("k").alias("k"))
    targets = {"a": "int", "b": "int"}
    s = load(counted, t, targets=targets, rejects=["k"]).first()
    assert calls.value == len(rows)  # the source is evaluated once
    assert (s["rows_written"], s["rejected_values"]) == (4, 3)
    expected = sorted(map(tuple, cast_rejects(df, targets, key=["k"]).collect()))
    assert sorted(map(tuple, read_rejects(spark, t).collect())) == expected and len(expected) == 3
    assert sorted(map(tuple, read_version(spark, t).select("k", "a", "b").collect()), key=lambda r: r[0]) == [(1, 5, 1), (2, None, None), (3, None, None), (4, None, 2)]
    load(df.where("k = 2"), t, "incremental", targets=targets, rejects=["k"])
    load(df.where("k = 1"), t, "incremental", targets=targets)
    assert read_rejects(spark, t).count() == 5 and read_version(spark, t).count() == 6
    load(df.where("k = 9"), t, "full", targets=targets, rejects=["k"])
    assert read_version(spark, t).count() == 0 and read_rejects(spark, t) is None


def test_rejects_of_a_partitioned_load(spark, scratch):
    t = scratch("parted")
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("p"), F.when(F.col("id") % 10 == 0, F.lit("bad")).otherwise("7").alias("n"))
    load(df, t, targets={"n": "int"}, rejects=["id"], partitions=["p=IDENTITY"])
    assert read_version(spark, t).count() == 100 and read_rejects(spark, t).count() == 10
    assert read_version(spark, t).where("p = '1'").count() == 33


@pytest.mark.parametrize("kind", ["string", "int"])
def test_merge_writes_only_partitions_with_a_key(spark, scratch, kind):
    t = scratch("part")
    base = spark.range(60).select("id", (F.col("id") % 6).cast(kind).alias("p"), F.lit("old").alias("v"))
    base = base.unionByName(spark.createDataFrame([(100, None, "old")], base.schema))
    spec = ["p=IDENTITY"]
    load(base, t, partitions=spec)
    before = {f for f, _ in tbl.files_of(spark, t, 1)}
    change = spark.createDataFrame([(2, 2, "new"), (14, 3, "moved"), (200, 5, "added"), (100, None, "none")], base.schema) if kind == "int" else \
        spark.createDataFrame([(2, "2", "new"), (14, "3", "moved"), (200, "5", "added"), (100, None, "none")], base.schema)
    load(change, t, "merge", key=["id"], partitions=spec)
    rows = {r["id"]: (None if r["p"] is None else int(r["p"]), r["v"]) for r in read_version(spark, t).collect()}
    expected = {i: (i % 6, "old") for i in range(60)} | {2: (2, "new"), 14: (3, "moved"), 200: (5, "added"), 100: (None, "none")}
    assert rows == expected and read_version(spark, t).count() == len(expected)
    meta = tbl.meta_of(spark, t, 2)
    assert sorted(meta["without"]["1"], key=str) == [["2"], [None]]  # ids 2 and 14 lay in partition 2, 100 in the NULL one
    # only rows of these partitions and the source were written; the other folders are kept as they are
    assert load(change, scratch("x")).first()["rows_written"] + 8 == sum(1 for _ in spark.read.parquet(tbl.data_dir(spark, t, 2)).collect())
    assert {f for f, _ in tbl.files_of(spark, t, 1)} == before
    plan = read_version(spark, t)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Union" not in plan
    load(spark.createDataFrame([(2, 0, "again")] if kind == "int" else [(2, "0", "again")], base.schema), t, "merge", key=["id"], partitions=spec)
    expected[2] = (0, "again")
    assert {r["id"]: (None if r["p"] is None else int(r["p"]), r["v"]) for r in read_version(spark, t).collect()} == expected
    load(base.limit(0), t, "incremental", partitions=spec)
    load(spark.createDataFrame([(300, 2, "late")] if kind == "int" else [(300, "2", "late")], base.schema), t, "incremental", partitions=spec)
    assert read_version(spark, t).count() == len(expected) + 1
    assert loads.partition_columns_of(spark, t, tbl.current_version(spark, t)) == ["p"]
