"""The one-scan profile against the profile by expressions, and its plan."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeload.operators.profile import profile_numbers
from lakeload.operators.profile_scan import profile_one_scan
from lakeload.sources.files import read_table

from conftest import SF_SMALL

SCHEMA = ("b tinyint, i int, l long, d double, f float, c decimal(10,2), w decimal(38,10), h decimal(38,0), z decimal(30,20), s string, other date")
NONE = (None,) * 11


def odd_rows(n=400):
    r = random.Random(2)
    rows = [NONE, (0, 0, 0, 0.0, 0.0, Decimal(0), Decimal(0), Decimal(0), Decimal(0), "0", None),
            (-128, -2147483648, -9223372036854775808, float("nan"), float("nan"), Decimal("-99999999.99"), Decimal("0.0000000001"),
             Decimal("9" * 38), Decimal("-0.00000000000000000001"), "1e5", None),
            (127, 2147483647, 9223372036854775807, float("inf"), float("-inf"), Decimal("10"), Decimal("-9223372036854775808"),
             Decimal("-9223372036854775809"), Decimal("9999999999.99"), " -12.500 ", None),
            (1, 10, 3000000000, 1e300, 3.4e38, Decimal("0.05"), Decimal("9" * 28), Decimal("9223372036854775807"), Decimal("1"), ".5", None),
            (1, 10, 10, -0.1, 0.1, Decimal("0.50"), Decimal("2147483648"), Decimal("-2147483648"), Decimal("0.1"), "5.", None),
            (1, 1, 1, 1e-12, 16777216.0, Decimal("1.10"), Decimal("1.10"), Decimal(1), Decimal("123.456"), "+00123456789012345678901", None),
            (1, 1, 1, 123456.78901234567, 1.5, Decimal("-1"), Decimal(-1), Decimal(-1), Decimal(-1), "nine", None),
            (1, 1, 1, 4.5e15, 2.5e-9, Decimal("-1"), Decimal(-1), Decimal(-1), Decimal(-1), "3000000000.00", None),
            (1, 1, 1, 0.1 + 0.2, 3.0e9, Decimal("-1"), Decimal(-1), Decimal(-1), Decimal(-1), "", None)]
    for _ in range(n):
        x = round(r.uniform(-1e6, 1e6), r.randint(0, 6))
        rows.append((r.randint(-9, 9), r.randint(-10**6, 10**6), r.randint(-10**12, 10**12), x, r.choice([0.5, 2.0, 1.25]), Decimal(r.randint(-10**6, 10**6)) / 100,
                     Decimal(r.randint(-10**15, 10**15)) / 10**5, Decimal(r.randint(0, 10**25)), Decimal(r.randint(0, 10**28)) / 10**18, str(x), None))
    return rows


def result(profile):
    return sorted(map(tuple, profile.collect()))


@pytest.mark.parametrize("floating", [False, True])
def test_equals_the_profile_by_expressions(spark, floating):
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    named = None if floating else df.columns[:-1]
    assert result(profile_one_scan(df, named, "t", floating)) == result(profile_numbers(df, named, table="t", floating=floating))


@pytest.mark.parametrize("row", range(10))
def test_each_odd_row_alone(spark, row):
    df = spark.createDataFrame(odd_rows(0)[row:row + 1], SCHEMA)
    assert result(profile_one_scan(df, df.columns[:-1])) == result(profile_numbers(df, df.columns[:-1]))


def test_no_rows_and_no_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert result(profile_one_scan(df, table="e")) == result(profile_numbers(df, table="e"))
    with pytest.raises(ValueError):
        profile_one_scan(df.select("other"))


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_one_scan_of_wide_text_and_of_a_join(spark, scratch):
    li = read_table(spark, SF_SMALL, "lineitem")
    path = scratch("csv")
    wide = li.select(*[(F.col("l_quantity") * k).alias(f"q{k}") for k in range(1, 13)])
    wide.write.csv(path, header=True)
    text = spark.read.csv(path, header=True, schema=wide.schema)
    assert scans(profile_one_scan(text)) == 1
    assert result(profile_one_scan(text)) == result(profile_numbers(text))
    joined = li.join(read_table(spark, SF_SMALL, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    assert scans(profile_one_scan(joined)) == 2
    assert result(profile_one_scan(joined)) == result(profile_numbers(joined))
