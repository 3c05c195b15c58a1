"""Partition transforms (FIXTURES C5): published bucket vectors, epoch-based transforms, truncation."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeload.functions.transforms import (_decimal_bytes, add_partitions, lake_hash, murmur3_32, parse_spec,
                                           truncate)


def murmur3_reference(data: bytes) -> int:
    """Plain murmur3_x86_32, seed 0 (independent of the vectorised one)."""
    c1, c2, h, n = 0xCC9E2D51, 0x1B873593, 0, len(data)
    rotl = lambda x, r: ((x << r) | (x >> (32 - r))) & 0xFFFFFFFF
    for i in range(0, n - n % 4, 4):
        k = int.from_bytes(data[i:i + 4], "little")
        k = (rotl((k * c1) & 0xFFFFFFFF, 15) * c2) & 0xFFFFFFFF
        h = (rotl(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    tail, k = data[n - n % 4:], 0
    for i, b in enumerate(tail):
        k |= b << (8 * i)
    if tail:
        h ^= (rotl((k * c1) & 0xFFFFFFFF, 15) * c2) & 0xFFFFFFFF
    h ^= n
    h ^= h >> 16
    h = (h * 0x85EBCA6B) & 0xFFFFFFFF
    h ^= h >> 13
    h = (h * 0xC2B2AE35) & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >= 1 << 31 else h


def test_published_vectors_vectorised():
    assert murmur3_32([b"iceberg"])[0] == 1210000089
    assert murmur3_32([bytes([0, 1, 2, 3])])[0] == -188683207
    assert murmur3_32([_decimal_bytes(Decimal("14.20"), 2)])[0] == -500754589


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=20))
def test_vectorised_murmur_matches_reference(batch):
    assert list(murmur3_32(batch)) == [murmur3_reference(b) for b in batch]


def test_bucket_hashes_in_spark(spark):
    df = spark.createDataFrame([(34, "iceberg", Decimal("14.20"), dt.date(2017, 11, 16),
                                 dt.datetime(2017, 11, 16, 22, 31, 8), None)],
                               "l long, s string, d decimal(9,2), dd date, ts timestamp_ntz, n string")
    sch = df.schema
    r = df.select(*[lake_hash(F.col(c), sch[c].dataType).alias(c) for c in df.columns]).first()
    assert (r["l"], r["s"], r["d"], r["dd"], r["ts"], r["n"]) == (2017239379, 1210000089, -500754589, -653330422,
                                                                 -2047944441, None)


def test_time_transforms_and_pre_epoch(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 11, 16, 22, 31, 8),), (dt.datetime(1969, 12, 31, 23, 0, 0),)],
                               "ts timestamp_ntz")
    out, cols = add_partitions(df, ["ts=YEAR", "ts=MONTH", "ts=DAY", "ts=HOUR"])
    rows = [tuple(r) for r in out.select(*cols).collect()]
    assert rows[0] == (47, 574, 17486, 419686)
    assert rows[1] == (-1, -1, -1, -1)
    zoned = spark.createDataFrame([(dt.datetime(2017, 11, 16, 22, 31, 8),)], "ts timestamp")
    z, zc = add_partitions(zoned, ["ts=HOUR", "ts=DAY"])
    assert tuple(z.select(*zc).first()) == (419686, 17486)


def test_truncate(spark):
    df = spark.createDataFrame([(-7, 7, "iceberg", Decimal("10.65"), Decimal("-0.05"))],
                               "a int, b bigint, s string, d decimal(6,2), e decimal(6,2)")
    sch = df.schema
    r = df.select(truncate(F.col("a"), sch["a"].dataType, 10).alias("a"), truncate(F.col("b"), sch["b"].dataType, 10).alias("b"),
                  truncate(F.col("s"), sch["s"].dataType, 3).alias("s"), truncate(F.col("d"), sch["d"].dataType, 50).alias("d"),
                  truncate(F.col("e"), sch["e"].dataType, 10).alias("e")).first()
    assert (r["a"], r["b"], r["s"], r["d"], r["e"]) == (-10, 0, "ice", Decimal("10.50"), Decimal("-0.10"))


def test_spec_parsing():
    assert parse_spec(["a=IDENTITY", "b=bucket,16", ("c", "truncate", 4)]) == [
        ("a", "IDENTITY", None), ("b", "BUCKET", 16), ("c", "TRUNCATE", 4)]
    with pytest.raises(ValueError):
        parse_spec(["a=WEEK"])
    with pytest.raises(ValueError):
        parse_spec(["a=BUCKET"])
    with pytest.raises(ValueError):
        parse_spec(["a=TRUNCATE,0"])
