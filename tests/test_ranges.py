"""Balanced key ranges against an ordering of all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lakeload.sources import ranges as R


def brute(rows, n, second):
    """The splitters by sorting; rows are (key, second) pairs."""
    first = lambda v: (v is not None, v)
    ordered = sorted(rows, key=lambda r: (first(r[0]), first(r[1])))
    out = []
    for t in (len(rows) * i // n for i in range(1, n)):
        key = ordered[t][0]
        hot = second and sum(r[0] == key for r in rows) * n * R.SHARE > len(rows)
        out.append((key, ordered[t][1] if hot else None))
    return out


def skewed(seed, size):
    rnd = random.Random(seed)
    key = lambda: rnd.choice([7, 7, 7, None, rnd.randrange(-50, 3000), rnd.choice([-(1 << 63), (1 << 63) - 1, rnd.randrange(1 << 60)])])
    return [(key(), rnd.choice([None, rnd.randrange(5), rnd.randrange(1 << 40)])) for _ in range(size)]


@pytest.mark.parametrize("bins", [256, 65_536])
@pytest.mark.parametrize("second", [None, "s"])
def test_splitters_are_those_of_a_sort(spark, monkeypatch, bins, second):
    monkeypatch.setattr(R, "BINS", bins)
    rows = skewed(bins, 600)
    df = spark.createDataFrame(rows, "k long, s long")
    assert R.splitters(df, "k", 6, second) == brute(rows, 6, second)


def test_ranges_are_disjoint_complete_and_even(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, F.lit(40)).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("s"))
    tagged = R.with_balanced_ranges(df, "k", 12, "s")
    sizes = {r.range_id: r["count"] for r in tagged.groupBy("range_id").count().collect()}
    assert sum(sizes.values()) == 50_000 and set(sizes) == set(range(12))
    assert max(sizes.values()) <= 1.1 * 50_000 / 12
    edges = sorted((r.lo, r.hi) for r in tagged.groupBy("range_id").agg(F.min(F.struct("k", "s")).alias("lo"), F.max(F.struct("k", "s")).alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))


def test_edges(spark):
    none = spark.createDataFrame([], "k long, s long")
    assert R.splitters(none, "k", 4) == [] and R.balanced_ranges(none, "k", 4).count() == 0
    nulls = spark.createDataFrame([(None, i) for i in range(100)], "k long, s long")
    assert sorted(r.rows for r in R.balanced_ranges(nulls, "k", 4, "s").collect()) == [25] * 4
    assert [r.rows for r in R.balanced_ranges(nulls, "k", 4).collect()] == [100]
    same = spark.createDataFrame([(5, 1)] * 40, "k long, s long")
    assert [(r.rows, r.lo, r.hi) for r in R.balanced_ranges(same, "k", 4, "s").collect()] == [(40, 5, 5)]
    with pytest.raises(ValueError):
        R.splitters(spark.createDataFrame([("a",)], "k string"), "k", 2)


def test_passes_read_the_key_alone(spark, tmp_path):
    spark.range(1000).select("id", F.lit("x").alias("wide")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    tagged = R.with_balanced_ranges(df, "id", 4)
    plan = tagged.groupBy("range_id").count()._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint>" in plan and plan.count("Exchange") <= 2
