"""Compaction, reads by time and added rows of versioned tables."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from lakeload.sinks import compaction as C
from lakeload.sinks import table as tbl
from lakeload.sinks.load import load


def counts(spark, t):
    return C.file_counts(spark, t, tbl.current_version(spark, t))


def test_small_appends_become_files_of_the_target_size(spark, scratch):
    t = scratch("small")
    for k in range(4):
        load(spark.range(k * 1000, (k + 1) * 1000).repartition(10), t, "incremental", batch=("s", k))
    got = C.compact(spark, t).first()
    assert (got.loads_before, got.loads_after, got.files_before, got.files_after) == (4, 1, 40, 1)
    assert sorted(r.id for r in tbl.read_version(spark, t).collect()) == list(range(4000))
    assert counts(spark, t).first().files == 1
    assert tbl.meta_of(spark, t, got.version)["batches"] == {"s": 3}
    assert C.compact(spark, t).first().version == got.version  # nothing left to do
    tbl.remove_versions_before(spark, t, got.version)
    assert tbl.read_version(spark, t).count() == 4000 and tbl.committed_versions(spark, t) == [got.version]


def test_large_loads_and_other_partitions_stay(spark, scratch):
    t = scratch("large")
    df = spark.range(40_000).select(F.col("id"), (F.col("id") % 2).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spec = ["p=IDENTITY"]
    load(df.coalesce(1), t, "incremental", partitions=spec)
    for k in range(3):
        load(df.where(F.col("id") % 3 == k).withColumn("id", -F.col("id") - 1), t, "incremental", partitions=spec)
    size = counts(spark, t).agg(F.max("bytes")).first()[0]
    got = C.compact(spark, t, target_bytes=size).first()
    assert got.loads_after == 2 and got.files_before == 6
    rest = counts(spark, t).collect()
    assert all(r.bytes / r.files >= size / 2 for r in rest) and sum(r.rows for r in rest) == 80_000
    names = tbl.read_version(spark, t).columns
    loaded = df.select(names).union(df.withColumn("id", -F.col("id") - 1).select(names))
    assert tbl.read_version(spark, t).exceptAll(loaded).count() == 0


def test_after_a_merge_its_dead_partitions_stay_dead(spark, scratch):
    t = scratch("merged")
    df = spark.range(100).select("id", (F.col("id") % 4).alias("p"), F.lit(0).alias("v"))
    load(df, t, "full", partitions=["p=IDENTITY"])
    load(df.where("p = 1").withColumn("v", F.lit(1)), t, "merge", key=["id"], partitions=["p=IDENTITY"])
    C.compact(spark, t)
    assert {(r.id, r.v) for r in tbl.read_version(spark, t).collect()} == {(i, int(i % 4 == 1)) for i in range(100)}
    load(df.where("p = 2").withColumn("v", F.lit(2)), t, "merge", key=["id"], partitions=["p=IDENTITY"])
    assert tbl.read_version(spark, t).agg(F.sum("v"), F.count("id")).first() == (75, 100)


def test_an_append_meanwhile_stays(spark, scratch, monkeypatch):
    t = scratch("meanwhile")
    for k in range(3):
        load(spark.range(k * 10, k * 10 + 10), t, "incremental")
    rewrite, began = C._rewrite, []

    def slow(*args):
        out = rewrite(*args)
        if not began:
            began.append(1)
            thread = threading.Thread(target=lambda: load(spark.range(100, 110), t, "incremental"))
            thread.start()
            thread.join()
        return out

    monkeypatch.setattr(C, "_rewrite", slow)
    C.compact(spark, t)
    assert sorted(r.id for r in tbl.read_version(spark, t).collect()) == [*range(30), *range(100, 110)]


def test_rejects_outlive_their_rows(spark, scratch):
    t = scratch("rejects")
    for k in range(3):
        df = spark.createDataFrame([(k * 2, "1"), (k * 2 + 1, "no")], "id long, n string")
        load(df, t, "incremental", targets={"n": "int"}, rejects=["id"])
    v = C.compact(spark, t).first().version
    tbl.remove_versions_before(spark, t, v)
    assert sorted(r.id for r in tbl.read_rejects(spark, t).collect()) == [1, 3, 5]
    assert tbl.read_version(spark, t).count() == 6


def test_reads_by_time_and_added_rows(spark, scratch):
    t = scratch("times")
    for k in range(4):
        load(spark.range(k * 10, k * 10 + 10), t, "incremental")
    times = [tbl.commit_time(spark, t, v) for v in (1, 2, 3, 4)]
    assert times == sorted(set(times))
    assert [tbl.version_at(spark, t, x) for x in (times[0] - 1, times[0], times[2] - 1, times[2], times[3] + 9)] == [None, 1, 2, 3, 4]
    assert tbl.read_as_of(spark, t, times[1]).count() == 20
    with pytest.raises(FileNotFoundError):
        tbl.read_as_of(spark, t, times[0] - 1)
    assert sorted(r.id for r in tbl.read_added(spark, t, 1, 3).collect()) == list(range(10, 30))
    assert tbl.read_added(spark, t, 4).count() == 0
    v = C.compact(spark, t).first().version
    assert sorted(r.id for r in tbl.read_added(spark, t, 2).collect()) == list(range(20, 40))
    load(spark.range(5), t, "full")
    for bad in ((1, None), (v, None), (3, 2)):
        with pytest.raises(ValueError):
            tbl.read_added(spark, t, *bad)


def test_nothing_to_compact(spark, scratch):
    with pytest.raises(FileNotFoundError):
        C.compact(spark, scratch("none"))
    t = scratch("empty")
    for _ in range(3):
        load(spark.range(0), t, "incremental")
    C.compact(spark, t)
    assert tbl.read_version(spark, t).count() == 0
