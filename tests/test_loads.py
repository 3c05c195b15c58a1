"""Loads (FIXTURES C6): full, append and merge semantics, partitioned layout, versions, summary."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeload.sinks.load import load
from lakeload.sinks.table import committed_versions, read_version


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def test_full_is_idempotent_and_keeps_versions(spark, scratch):
    t, o = scratch("full"), _orders(spark)
    s1 = load(o, t, "full").first()
    load(o, t, "full")
    assert _same(read_version(spark, t), o)
    assert committed_versions(spark, t) == [1, 2]
    assert s1["rows_written"] == o.count() and s1["version"] == 1
    load(o.limit(10), t, "full", keep_versions=1)
    assert committed_versions(spark, t) == [3] and read_version(spark, t).count() == 10


def test_incremental_appends(spark, scratch):
    t, o = scratch("incr"), _orders(spark)
    load(o, t, "incremental")
    load(o, t, "incremental")
    assert read_version(spark, t).count() == 2 * o.count()


def test_append_with_missing_and_unknown_columns(spark, scratch):
    t, o = scratch("align"), _orders(spark)
    load(o, t, "incremental")
    load(o.drop("o_orderpriority").limit(5), t, "incremental")
    assert read_version(spark, t).where(F.col("o_orderpriority").isNull()).count() == 5
    with pytest.raises(ValueError):
        load(o.withColumn("extra", F.lit(1)), t, "incremental")


def test_merge_upserts_and_deletes(spark, scratch):
    t, o = scratch("merge"), _orders(spark)
    load(o, t, "full")
    load(o, t, "merge", key=["o_orderkey"])
    assert _same(read_version(spark, t), o)            # same source merged: unchanged
    keys = [r[0] for r in o.orderBy("o_orderkey").select("o_orderkey").limit(3).collect()]
    changes = (o.where(F.col("o_orderkey").isin(keys)).withColumn("o_orderstatus", F.lit("U"))
               .withColumn("deleted", F.col("o_orderkey") == keys[0])
               .unionByName(o.where(F.col("o_orderkey") == keys[0]).withColumn("o_orderkey", F.lit(-1).cast("bigint"))
                            .withColumn("deleted", F.lit(False))))
    load(changes, t, "merge", key=["o_orderkey"], delete_col="deleted")
    out = read_version(spark, t)
    assert out.count() == o.count()                    # one deleted, one inserted
    assert out.where(F.col("o_orderkey") == keys[0]).count() == 0
    assert out.where(F.col("o_orderkey") == -1).count() == 1
    assert {r[0] for r in out.where(F.col("o_orderkey").isin(keys[1:])).select("o_orderstatus").collect()} == {"U"}


def test_merge_rejects_duplicate_source_keys(spark, scratch):
    t, o = scratch("dup"), _orders(spark)
    load(o, t, "full")
    with pytest.raises(ValueError):
        load(o.unionByName(o.limit(1)), t, "merge", key=["o_orderkey"])


def test_partitioned_layout_and_summary(spark, scratch):
    t = scratch("parts")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    s = load(li, t, "full", partitions=["l_shipdate=YEAR", "l_returnflag=IDENTITY", "l_orderkey=BUCKET,4"]).first()
    back = read_version(spark, t)
    assert {"l_shipdate_year", "l_returnflag", "l_orderkey_bucket_4"} <= set(back.columns)
    assert back.count() == li.count() == s["rows_written"]
    assert s["files_written"] >= back.select("l_shipdate_year", "l_returnflag").distinct().count()


def test_file_size_target(spark, scratch):
    t = scratch("files")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    s = load(li, t, "full", target_bytes=16 * 1024).first()
    per_file = read_version(spark, t).groupBy(F.col("_metadata.file_name")).count().collect()
    assert s["files_written"] == len(per_file) > 1


def test_converting_load_counts_rejects(spark, scratch):
    t = scratch("conv")
    df = spark.createDataFrame([(1, 3000000000), (2, 5)], "k int, x bigint")
    s = load(df, t, "full", targets={"x": "int"}).first()
    assert (s["rows_written"], s["rejected_values"]) == (2, 1)
    assert dict(read_version(spark, t).dtypes)["x"] == "int"


def test_prune_by_derived_partitions(spark, scratch):
    from lakeload.functions.transforms import prune_by
    t = scratch("prune")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    spec = ["l_shipdate=YEAR", "l_orderkey=TRUNCATE,1000"]
    load(li, t, "full", partitions=spec)
    back = read_version(spark, t)
    pruned = prune_by(back, "l_shipdate", "1995-01-01 00:00:00", "1995-12-31 23:59:59", spec)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(l_shipdate_year" in plan
    expected = li.where("l_shipdate >= '1995-01-01' AND l_shipdate <= '1995-12-31 23:59:59'").count()
    assert pruned.count() == expected
    by_key = prune_by(back, "l_orderkey", 1500, 2600, spec)
    assert "l_orderkey_trunc_1000" in by_key._jdf.queryExecution().executedPlan().toString()
    assert by_key.count() == li.where("l_orderkey BETWEEN 1500 AND 2600").count()


def test_failed_write_leftovers_are_skipped(spark, scratch):
    from lakeload.sinks.table import version_dir
    t, o = scratch("leftover"), _orders(spark)
    load(o.limit(5), t, "full")
    o.limit(3).write.parquet(version_dir(t, 2) + "/_temporary/0")     # a crashed write: no _SUCCESS
    assert committed_versions(spark, t) == [1]
    s = load(o.limit(7), t, "full").first()
    assert s["version"] == 3 and read_version(spark, t).count() == 7


def test_merge_into_partitioned_table_keeps_layout(spark, scratch):
    t, o = scratch("mpart"), _orders(spark)
    spec = ["o_orderdate=YEAR"]
    load(o, t, "full", partitions=spec)
    with pytest.raises(ValueError):
        load(o.limit(3), t, "merge", key=["o_orderkey"])
    load(o.limit(3).withColumn("o_orderstatus", F.lit("U")), t, "merge", key=["o_orderkey"], partitions=spec)
    back = read_version(spark, t)
    assert "o_orderdate_year" in back.columns and back.count() == o.count()
    assert back.where("o_orderstatus = 'U'").count() == 3


def test_target_names():
    import pytest

    from lakeload.sinks.naming import target_name, target_parts
    assert target_parts("HR.EMP") == ["HR", "EMP"] and target_parts("EMP", namespace="a.b", naming="lower") == ["a", "b", "emp"]
    assert target_name("HR.EMP", "lake", naming="lower") == "lake.hr.emp" and target_name("EMP") == "EMP"
    assert target_name("HR.MY TABLE", table="x y") == "HR.`x y`"
    assert target_name("HR.EMP", "/data/lake/", naming="lower", namespace="") == "/data/lake/emp"
    for bad in (lambda: target_parts("EMP", need_namespace=True), lambda: target_parts("HR."), lambda: target_parts("a", naming="upper")):
        with pytest.raises(ValueError):
            bad()


def test_append_of_values_that_do_not_fit(spark, scratch):
    from lakeload.sinks.load import load
    from lakeload.sinks.table import read_version
    t = scratch("narrow")
    load(spark.createDataFrame([(1, "a")], "k int, v string"), t)
    s = load(spark.createDataFrame([(1 << 40, "b"), (7, "c"), (None, "d")], "k bigint, v string"), t, mode="incremental").first()
    assert (s["rows_written"], s["rejected_values"]) == (3, 1)
    assert sorted((r.v, r.k) for r in read_version(spark, t).collect()) == [("a", 1), ("b", None), ("c", 7), ("d", None)]


def test_converting_load_runs_in_generated_code(spark):
    from lakeload.plans.apply import cast_rejects, convert_counting_rejects
    df = spark.range(6).select("id", (F.col("id") * 1000000000).alias("x"), F.when(F.col("id") != 4, F.col("id")).alias("y"))
    plans = [convert_counting_rejects(df, {"x": "int", "y": "smallint"}, key=["id"]), cast_rejects(df, {"x": "int"}, key=["id"])]
    for p in plans:
        text = p._jdf.queryExecution().executedPlan().toString()
        assert "lambda" not in text and all("*(" in line for line in text.splitlines() if "Project" in line)
    assert [(r["id"], r["x"], r["y"], r["__rejects"]) for r in plans[0].orderBy("id").collect()] == [
        (i, i * 1000000000 if i < 3 else None, None if i == 4 else i, int(i > 2)) for i in range(6)]


def test_rejects_of_a_load_of_good_and_bad_values(spark, scratch):
    from lakeload.sinks.table import read_rejects
    t = scratch("rejects")
    df = spark.createDataFrame([(1, 3000000000, "5"), (2, 5, "x"), (3, 1 << 40, "y"), (4, None, None)], "k int, x bigint, v string")
    s = load(df, t, "full", targets={"x": "int", "v": "int"}, rejects=["k"]).first()
    assert (s["rows_written"], s["rejected_values"]) == (4, 4)
    assert sorted((r.k, r.x, r.v) for r in read_version(spark, t).collect()) == [(1, None, 5), (2, 5, None), (3, None, None), (4, None, None)]
    assert sorted(tuple(r) for r in read_rejects(spark, t).collect()) == [
        (1, "x", "3000000000", "int", "overflow"), (2, "v", "x", "int", "invalid"),
        (3, "v", "y", "int", "invalid"), (3, "x", str(1 << 40), "int", "overflow")]
    t = scratch("no_targets")
    load(df, t, "full", rejects=["k"])
    assert read_version(spark, t).count() == 4 and (read_rejects(spark, t) is None or read_rejects(spark, t).count() == 0)
