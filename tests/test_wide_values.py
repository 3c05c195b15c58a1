"""Integers of texts with an exponent, and truncation of wide decimals."""

from __future__ import annotations

from decimal import ROUND_DOWN, Context, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.casts import convert
from lakeload.functions.transforms import truncate


EXACT = Context(prec=100)


@pytest.mark.parametrize("kind,limit", [("int", 31), ("bigint", 63)])
def test_exponent_text_truncates(spark, kind, limit):
    texts = ["2.99999999999E0", "-2.99999999999e0", "1e5", "1.5E1", "12345E-2", "-12399e-2", ".5e1", "5.e0", "9.9999999999999999999999E0", "1e-400", "0e5",
             "1E3", "+7.77e2", "99e9", "1e30", "1e400", "2147483647.9e0", "-2147483648.9E0", " 3.7e0 ", "00012.9e1"]
    df = spark.createDataFrame([(t,) for t in [*texts, "e5", "1e", "x1e5", "", None]], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", convert(F.col("t"), T.StringType(), kind).value.alias("v")).collect()}
    for t in texts:
        v = Decimal(t.strip()).to_integral_value(ROUND_DOWN)
        assert got[t] == (int(v) if -(1 << limit) <= v < 1 << limit else None), t
    assert all(got[t] is None for t in ("e5", "1e", "x1e5", "", None))


@pytest.mark.parametrize("dt", [T.DecimalType(38, 10), T.DecimalType(38, 37), T.DecimalType(38, 0), T.DecimalType(30, 20)])
def test_wide_decimals_truncate_exactly(spark, dt):
    most = Decimal(10 ** dt.precision - 1).scaleb(-dt.scale, context=EXACT)
    values = [Decimal(0), Decimal(1).scaleb(-dt.scale), -Decimal(1).scaleb(-dt.scale), Decimal("1"), Decimal("-1"), most, Decimal("0.5") if dt.scale else Decimal(7)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], T.StructType([T.StructField("d", dt)]))
    got = [r["t"] for r in df.select(truncate(F.col("d"), dt, 50).alias("t")).collect()]
    for v, g in zip(values, got):
        u = int(v.scaleb(dt.scale, context=EXACT))
        assert int(g.scaleb(dt.scale, context=EXACT)) == u - u % 50
    assert got[-1] is None
