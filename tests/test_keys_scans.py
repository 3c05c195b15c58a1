"""Keys, scans (incl. JDBC on an in-process Derby database), samples, report, entry contract."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from lakeload.operators.keys import check_key, describe_columns, key_candidates, key_violations, split_key
from lakeload.sources import scan


def _t(spark, name, sf=SF_SMALL):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_check_key(spark):
    r = check_key(_t(spark, "orders"), ["o_orderkey"]).first()
    assert r["is_key"] and r["duplicate_groups"] == 0
    li = check_key(_t(spark, "lineitem", SF_MID), ["l_orderkey", "l_linenumber"]).first()
    assert not li["is_key"] and li["distinct_keys"] == 45832 and li["total_rows"] == 60000
    nul = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (2, 3)], "a int, b int")
    n = check_key(nul, ["a"]).first()
    assert (n["null_key_rows"], n["duplicate_groups"], n["duplicate_rows"], n["is_key"]) == (1, 1, 2, False)
    v = {(r["a"], r["violation"]) for r in key_violations(nul, ["a"]).collect()}
    assert v == {(1, "duplicate"), (None, "null_key")}


def test_key_candidates_and_split_key(spark):
    o = _t(spark, "orders")
    cands = key_candidates(o, "orders")
    assert [r["key_columns"] for r in cands.collect()] == ["o_orderkey"]
    s = split_key(cands, describe_columns(o, "orders")).first()
    assert (s["split_column"], s["type_class"]) == ("o_orderkey", "BIGINT")
    pairs = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (2, 1, "y")], "a int, b int, c string")
    assert sorted(r["key_columns"] for r in key_candidates(pairs, "p").collect()) == ["a,b", "b,c"]


def test_every_minimal_key(spark):
    keys = lambda df: [r["key_columns"] for r in key_candidates(df, "t", every=True).collect()]
    cube = spark.createDataFrame([(a, b, c, 7, None if a else 1) for a in range(3) for b in range(3) for c in range(3)],
                                 "a int, b int, c int, same int, gap int")
    assert keys(cube) == ["a,b,c"]
    both = spark.createDataFrame([(9 * a + b, a, str(b)) for a in range(9) for b in range(9)], "id long, a int, b string")
    assert keys(both) == ["id", "a,b"]
    assert [r["key_columns"] for r in key_candidates(both, "t").collect()] == ["id"]
    assert keys(cube.union(cube)) == [] and keys(cube.limit(0)) == []


def test_describe_columns(spark):
    d = {r["column_name"]: r for r in describe_columns(_t(spark, "orders"), "orders").collect()}
    assert d["o_orderkey"]["type_class"] == "BIGINT" and d["o_orderkey"]["precision"] == 19
    assert d["o_orderdate"]["type_class"] == "TIMESTAMP" and d["o_orderstatus"]["max_length"] == 1


def test_where_forms_and_pushdown(spark):
    path = f"{SF_SMALL}/orders.parquet"
    a = scan.scan_table(spark, path, where="WHERE o_orderstatus = 'F'")
    b = scan.scan_table(spark, path, where="o_orderstatus = 'F'", columns=["o_orderkey"])
    assert a.count() == b.count() > 0
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_row_key_is_unique_and_stable(spark):
    path = f"{SF_SMALL}/lineitem.parquet"
    a = scan.scan_table(spark, path, row_key="rk", columns=["l_orderkey"])
    assert a.select("rk").distinct().count() == a.count()
    b = scan.scan_table(spark, path, row_key="rk", columns=["l_orderkey"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_key_ranges_cover_and_nulls_go_to_zero(spark):
    o = _t(spark, "orders")
    r = scan.key_ranges(o, "o_orderkey", 4).orderBy("range_id").collect()
    assert [x["range_id"] for x in r] == [0, 1, 2, 3] and sum(x["rows"] for x in r) == o.count()
    assert r[0]["lo"] == o.agg(F.min("o_orderkey")).first()[0] and r[-1]["hi"] == o.agg(F.max("o_orderkey")).first()[0]
    nul = spark.createDataFrame([(None,), (1,), (100,)], "k bigint")
    assert {x["k"]: x["range_id"] for x in scan.with_key_ranges(nul, "k", 4).collect()}[None] == 0


@pytest.mark.parametrize("n", [1, 5, 16])
def test_hash_buckets_disjoint_and_complete(spark, n):
    o = _t(spark, "orders")
    b = scan.hash_buckets(o, ["o_orderkey"], n)
    per = b.groupBy("bucket").agg(F.countDistinct("o_orderkey").alias("k"), F.count(F.lit(1)).alias("r")).collect()
    assert sum(x["r"] for x in per) == o.count() and sum(x["k"] for x in per) == o.count()
    assert all(0 <= x["bucket"] < n for x in per)


def test_sample_exact_size_and_deterministic(spark):
    li = _t(spark, "lineitem", SF_MID)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    a, b = scan.sample_rows(li, keys, 1234), scan.sample_rows(li, keys, 1234)
    assert a.count() == 1234
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert scan.scan_sample(li, keys).count() == 10000           # 5 % is below the floor of 10 000


def test_as_of(spark):
    ev = _t(spark, "events")
    cut = "2024-01-15 00:00:00"
    assert scan.scan_as_of(ev, "ts", cut).count() == ev.where(F.col("ts") <= F.lit(cut).cast("timestamp_ntz")).count()
    assert scan.scan_as_of(ev, "ts").count() == ev.count()


def test_jdbc_sources_on_in_process_derby(spark):
    from lakeload.sources.jdbc import JdbcSource
    url = "jdbc:derby:memory:lakeload_test;create=true"
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    # Derby folds unquoted names to upper case and stores Spark strings as CLOB (not comparable)
    o = _t(spark, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    o = o.toDF(*[c.upper() for c in o.columns])
    (o.write.format("jdbc").option("url", url).option("dbtable", "ORDERS").options(**opts)
     .option("createTableColumnTypes", "O_ORDERSTATUS VARCHAR(8)").mode("overwrite").save())
    src = JdbcSource(url, "ORDERS", options=opts)
    whole = src.read(spark)
    assert whole.count() == o.count()
    filtered = scan.scan_table(spark, src, where="WHERE O_ORDERSTATUS = 'F'")
    assert "PushedFilters" in filtered._jdf.queryExecution().executedPlan().toString()
    assert filtered.count() == o.where("o_orderstatus = 'F'").count()
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    ranged = src.read_ranges(spark, "O_ORDERKEY", lo, hi, 4)
    assert ranged.rdd.getNumPartitions() == 4 and ranged.count() == o.count()
    buckets = src.read_buckets(spark, "O_ORDERKEY", 3)
    assert buckets.rdd.getNumPartitions() == 3 and buckets.count() == o.count()
    q = JdbcSource(url, query="SELECT O_ORDERKEY FROM ORDERS WHERE O_TOTALPRICE > 100000", options=opts).read(spark)
    assert q.count() == o.where("o_totalprice > 100000").count()


def test_report_json(spark):
    from lakeload.operators.report import report_json, report_rows
    o = _t(spark, "orders")
    rows = report_rows({"orders": o}, {"orders": ["o_orderkey"]}, schema="tpch")
    doc = json.loads(report_json(rows, key_candidates(o, "orders")).first()["report"])
    assert doc["table_metadata"] == {"schema": "tpch", "table": "orders", "type": "TABLE", "row_count": o.count()}
    assert doc["constraints"]["primary_key"] == ["o_orderkey"]
    assert doc["constraints"]["unique_indexes"][0]["columns"] == ["o_orderkey"]
    assert doc["columns"]["o_orderkey"]["recommended"] == "integer"
    price = doc["columns"]["o_totalprice"]
    assert price["jdbc_type"] == 8 and price["stats"]["total_values"] == o.count() and len(price["stats"]) == 7
    assert "stats" not in doc["columns"]["o_orderstatus"] and doc["columns"]["o_orderstatus"]["jdbc_type"] == 12


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 8 and "recommended_type" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    from lakeload.queries import QUERIES
    assert set(QUERIES) - set(sql) == {"profile_sample", "scan_sample", "file_layout"}


def test_object_info(spark):
    from lakeload.operators.report import object_info
    spark.range(3).createOrReplaceTempView("lakeload_tmp_view")
    rows = {r["table_name"]: r for r in object_info(spark, ["lakeload_tmp_view", "no_such_table", "/x/y", SF_SMALL]).collect()}
    assert rows["lakeload_tmp_view"]["exists"] and rows["lakeload_tmp_view"]["table_type"] == "VIEW"
    assert not rows["no_such_table"]["exists"] and not rows["/x/y"]["exists"] and rows["/x/y"]["table_type"] is None
    assert rows[SF_SMALL]["exists"] and rows[SF_SMALL]["table_type"] == "TABLE"


def test_bucket_predicates_meet_every_row_once(spark):
    from lakeload.sources.jdbc import bucket_predicates
    rows = spark.createDataFrame([(i,) for i in range(-50, 50)] + [(None,)] * 3, "k int")
    rows.createOrReplaceTempView("lakeload_buckets")
    counts = [spark.sql(f"SELECT * FROM lakeload_buckets WHERE {p}").count() for p in bucket_predicates("k", 7)]
    assert sum(counts) == 103 and min(counts) >= 14


def test_key_ranges_without_keys(spark):
    from lakeload.sources.scan import key_ranges
    assert key_ranges(spark.createDataFrame([], "k int"), "k").count() == 0
    assert [tuple(r) for r in key_ranges(spark.createDataFrame([(None,), (None,)], "k int"), "k").collect()] == [(0, None, None, 2)]


def test_sample_is_the_rows_of_the_smallest_hashes(spark):
    from lakeload.sources.scan import sample_rows
    df = spark.range(5000).withColumn("h", F.xxhash64("id"))
    ids = [r.id for r in df.orderBy("h", "id").collect()]
    for size in (0, 1, 37, 4999, 5000, 9000):
        assert sorted(r.id for r in sample_rows(df, ["id"], size).collect()) == sorted(ids[:size])
    assert sample_rows(df.limit(0), ["id"], 5).count() == 0


def test_minimal_keys_equal_the_search_by_levels(spark, monkeypatch):
    import random

    from lakeload.operators import keys as K
    rnd = random.Random(6)
    by = lambda df, f: sorted(map(tuple, f(df).collect()))
    for rows in (2, 5, 400):  # few rows propose wrong keys, which are then corrected
        monkeypatch.setattr(K, "PROPOSING_ROWS", rows)
        for seed in range(3):
            n = rnd.choice([30, 200])
            data = [(i // 12, i % 12 // 4, i % 4, rnd.randint(0, 5), None if i == 3 else i, rnd.randint(0, 300), "c") for i in range(n)]
            df = spark.createDataFrame(data, "a int, b int, c int, d int, e int, f int, g string")
            assert by(df, lambda x: K.minimal_keys(x, "t")) == by(df, lambda x: K.key_candidates(x, "t", every=True))
    doubled = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    assert K.minimal_keys(doubled, "t").count() == 0 == K.minimal_keys(doubled.limit(0), "t").count()
    assert [r["key_columns"] for r in K.minimal_keys(spark.createDataFrame([(1, 2)], "a int, b int"), "t").collect()] == ["a", "b"]


def test_minimal_keys_of_a_wide_table(spark):
    from lakeload.operators.keys import minimal_keys
    df = spark.range(3000).select(*[(F.floor(F.col("id") / 20 ** k) % 20).cast("int").alias(f"k{k}") for k in range(3)],
                                  *[F.lit(j).alias(f"z{j}") for j in range(60)], *[(F.col("id") % 2 + j).alias(f"p{j}") for j in range(60)])
    assert [r["key_columns"] for r in minimal_keys(df, "wide").collect()] == ["k0,k1,k2"]


def test_hitting_sets():
    from itertools import combinations

    from lakeload.operators.keys import minimal_hitting_sets
    for diffs in ([0b011, 0b110], [0b1, 0b10], [0b111], [], [0b1010, 0b0110, 0b1100, 0b0001]):
        sets = [sum(1 << i for i in c) for n in range(5) for c in combinations(range(4), n)]
        hit = [s for s in sets if all(s & d for d in diffs)]
        assert minimal_hitting_sets(diffs) == {s for s in hit if not any(h != s and h & s == h for h in hit)}


def test_minimal_keys_of_slices_and_of_equal_hashes(spark, monkeypatch):
    from lakeload.operators import keys as K
    data = [(i // 12, i % 12 // 4, i % 4, i % 50 if i != 77 else 76 % 50, None if i == 3 else i, f"x{i % 97}") for i in range(500)]
    df = spark.createDataFrame(data, "a int, b int, c int, d int, e int, f string")
    expected = sorted(r["key_columns"] for r in K.key_candidates(df, "t", every=True).collect())
    assert "a,b,c" in expected and len(expected) > 1
    whole = lambda *_: pytest.fail("values of column sets went through a shuffle")
    monkeypatch.setattr(K, "_set_counts", whole)
    monkeypatch.setattr(K, "PROPOSING_ROWS", 3)
    for rows in (16, 1 << 18):  # many slices of hashes, or one
        monkeypatch.setattr(K, "SLICE_ROWS", rows)
        assert sorted(r["key_columns"] for r in K.minimal_keys(df, "t").collect()) == expected
    assert K._slices(500) == [0, 1] and K._slices(100 << 18) == [0, 1, 8, 64, 100]
    # different values with one hash are no repetition
    monkeypatch.setattr(K, "_hash", lambda c, place: F.pmod(F.xxhash64(K._q(c)), F.lit(16)))
    assert sorted(r["key_columns"] for r in K.minimal_keys(df, "t").collect()) == expected


def test_key_candidates_shuffle_hashes_only(spark, monkeypatch):
    from lakeload.operators import keys as K
    monkeypatch.setattr(K, "_set_counts", lambda *_: pytest.fail("values of column sets went through a shuffle"))
    single = spark.createDataFrame([(i, i // 2, "x" * (i % 5), None if i == 9 else i) for i in range(100)], "id int, a int, b string, c int")
    pair = spark.createDataFrame([(i // 7, i % 7, i % 3, i % 50) for i in range(200)], "a int, b int, c int, d int")
    twice = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a int, b int")
    keys = lambda df: [tuple(r) for r in key_candidates(df, "t").collect()]
    by_hand = sorted(f"{x},{y}" for i, x in enumerate("abcd") for y in "abcd"[i + 1:] if pair.select(x, y).distinct().count() == 200)
    for rows in (16, 1 << 18):
        monkeypatch.setattr(K, "SLICE_ROWS", rows)
        assert keys(single) == [("t", "id", 1, 100, 100)]
        assert sorted(r[1] for r in keys(pair)) == by_hand and "a,b" in by_hand
        assert keys(twice) == keys(single.limit(0)) == []
