"""Numeric profiles and recommendations (FIXTURES C3), checked against a brute-force model."""

import math
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakeload.operators.profile import merge_profiles, profile_numbers, recommend_types, storage_estimate
from lakeload.sources.scan import hash_buckets

VALUES = ["0", "5", "-5.00", "0.05", "1000", "2147483647", "2147483648", "-2147483649", "9223372036854775807",
          "9223372036854775808", "12345678.25", "-0.000001", None]


def model(value):
    """(class, precision, scale) of a decimal value the way the profile defines them."""
    if value is None:
        return None
    with localcontext() as ctx:
        ctx.prec = 400
        return _model(Decimal(value).quantize(Decimal("1e-10"), rounding=ROUND_HALF_UP))


def _model(d):
    if abs(d) >= Decimal(10) ** 28:
        return ("decimal", None, None)
    n = d.normalize()
    sign, digits, exp = n.as_tuple()
    scale = max(0, -exp)
    digits = "".join(map(str, digits)).lstrip("0") or "0"
    if exp > 0:
        digits += "0" * exp
    precision = max(1, len(digits.lstrip("0")) if abs(n) < 1 else len(digits))
    if scale == 0:
        if -2 ** 31 <= n <= 2 ** 31 - 1:
            return ("int", precision, scale)
        if -2 ** 63 <= n <= 2 ** 63 - 1:
            return ("long", precision, scale)
    return ("decimal", precision, scale)


def expected_profile(values):
    classes = [model(v) for v in values]
    present = [c for c in classes if c is not None]
    precs = [c[1] for c in present if c[1] is not None]
    scales = [c[2] for c in present if c[2] is not None]
    ints = [c for c in present if c[1] is not None]
    return dict(total_values=len(values), null_values=len(values) - len(present),
                int_values=sum(c[0] == "int" for c in present), long_values=sum(c[0] == "long" for c in present),
                decimal_values=sum(c[0] == "decimal" for c in present), max_precision=max(precs, default=0),
                max_scale=max(scales, default=0),
                max_int_digits=max((max(0, c[1] - c[2]) for c in ints), default=0))


def _row(df):
    r = df.first().asDict()
    return {k: r[k] for k in ("total_values", "null_values", "int_values", "long_values", "decimal_values",
                              "max_precision", "max_scale", "max_int_digits")}


def test_decimal_values(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "x string").select(F.col("x").try_cast("decimal(38,10)").alias("x"))
    got = _row(profile_numbers(df))
    assert got == expected_profile(VALUES)
    assert got["int_values"] == 5 and got["long_values"] == 3 and got["decimal_values"] == 4
    assert got["max_precision"] == 19 and got["max_scale"] == 6


def test_integer_columns(spark):
    vals = [0, 5, -5, 1000, 2147483647, 2147483648, -2147483649, 9223372036854775807, -9223372036854775808, None]
    df = spark.createDataFrame([(v,) for v in vals], "x bigint")
    assert _row(profile_numbers(df)) == expected_profile([None if v is None else str(v) for v in vals])


DOUBLES = [0.0, -0.0, 5.0, -5.0, 0.05, 1000.0, 2147483647.0, 2147483648.0, 12345678.25, -0.000001, 2.5, 0.1 + 0.2,
           1e-11, 4.9999999999e-11, 123456.123456789, 1e19, 1e27, 1e28, 9.007199254740993e15, 3e9, float("nan"),
           float("inf"), float("-inf"), None]


def _double_model(x):
    if x is None:
        return None
    if math.isnan(x) or math.isinf(x):
        return "nan"
    return repr(x)


def _expected_doubles(values):
    vs = [_double_model(v) for v in values]
    # NaN and infinities have no decimal view: counted as decimal values without precision
    exp = expected_profile([None if v is None else ("0" if v == "nan" else v) for v in vs])
    bad = sum(v == "nan" for v in vs)
    if bad:
        exp["decimal_values"] += bad
        exp["int_values"] -= bad
    return exp


def test_double_edge_values(spark):
    df = spark.createDataFrame([(v,) for v in DOUBLES], "x double")
    assert _row(profile_numbers(df)) == _expected_doubles(DOUBLES)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=64),
                          st.decimals(min_value=-10 ** 12, max_value=10 ** 12, places=4).map(float),
                          st.integers(-10 ** 6, 10 ** 6).map(lambda i: i / 100.0)), min_size=1, max_size=30))
def test_doubles_match_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert _row(profile_numbers(df)) == _expected_doubles(values)


def test_recommendation_threshold_is_strict(spark):
    def rec(ints, decs):
        rows = [(float(i),) for i in range(ints)] + [(i + 0.5,) for i in range(decs)]
        return recommend_types(profile_numbers(spark.createDataFrame(rows, "x double"))).first()["recommended_type"]
    assert rec(950, 50) == "decimal(10,2)"      # exactly 95.0 % integers: not integer
    assert rec(951, 49) == "integer"            # 95.1 %
    empty = spark.createDataFrame([(None,)], "x double")
    assert recommend_types(profile_numbers(empty)).first()["recommended_type"] == "decimal(38,10)"


def test_recommendations_and_lossless(spark):
    df = spark.createDataFrame([(v,) for v in ["12345678.25", "0.05", "1.5"]], "x string").select(
        F.col("x").try_cast("decimal(38,10)").alias("x"))
    prof = profile_numbers(df)
    assert recommend_types(prof).first()["recommended_type"] == "decimal(10,2)"
    assert recommend_types(prof, lossless=True).first()["recommended_type"] == "decimal(10,2)"
    wide = spark.createDataFrame([("123456789012.5",), ("0.123",)], "x string").select(
        F.col("x").try_cast("decimal(38,10)").alias("x"))
    # the plain rule takes precision and scale from different values; the lossless one keeps both
    assert recommend_types(profile_numbers(wide)).first()["recommended_type"] == "decimal(13,3)"  # 10 integer digits: too few
    assert recommend_types(profile_numbers(wide), lossless=True).first()["recommended_type"] == "decimal(15,3)"


def test_floating_branch(spark):
    vals = [3.0, 3e9, 1e19, 2.5, float("nan"), float("inf"), None]
    r = _row(profile_numbers(spark.createDataFrame([(v,) for v in vals], "x double"), floating=True))
    assert (r["int_values"], r["long_values"], r["decimal_values"], r["null_values"]) == (1, 1, 4, 1)
    assert (r["max_precision"], r["max_scale"]) == (0, 0)


@pytest.mark.parametrize("buckets", [1, 3, 7])
def test_partials_merge_to_full(spark, buckets):
    from conftest import SF_SMALL
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    full = {r["column_name"]: r.asDict() for r in profile_numbers(li, table="lineitem").collect()}
    parts = profile_numbers(hash_buckets(li, ["l_orderkey", "l_linenumber"], buckets), by=["bucket"], table="lineitem")
    merged = {r["column_name"]: r.asDict() for r in merge_profiles(parts).collect()}
    assert merged == full


def test_wide_table_groups(spark):
    cols = [F.lit(i * 1.25).alias(f"d{i}") for i in range(9)] + [F.lit(i).cast("bigint").alias(f"i{i}") for i in range(9)]
    df = spark.range(50).select(*cols)
    prof = {r["column_name"]: r for r in profile_numbers(df).collect()}
    assert len(prof) == 18 and prof["d3"]["max_scale"] == 2 and prof["i7"]["int_values"] == 50


def test_storage_estimate(spark):
    df = spark.createDataFrame([(1, 1.25), (2, 2.5)], "a bigint, b double")
    est = {r["column_name"]: r for r in storage_estimate(recommend_types(profile_numbers(df))).collect()}
    assert (est["a"]["bytes_before"], est["a"]["bytes_after"]) == (32, 8)
    assert (est["b"]["bytes_before"], est["b"]["bytes_after"]) == (32, 16)


def test_decimal_split_and_text_paths(spark):
    # ten fraction digits, values around the long range, negative fractions, and a scale above 18
    vals = ["0.0000000001", "123.4567890123", "-0.0500000000", "-7.25", "9223372036854775807.5",
            "-9223372036854775808", "92233720368547758070", "1E+27", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string").select(F.col("x").try_cast("decimal(38,10)").alias("x"))
    assert _row(profile_numbers(df)) == expected_profile(vals)
    wide_scale = spark.createDataFrame([("0.1234567890123456789012",), ("5",)], "x string").select(
        F.col("x").try_cast("decimal(30,22)").alias("x"))
    r = _row(profile_numbers(wide_scale))
    assert (r["max_scale"], r["max_precision"], r["int_values"], r["decimal_values"]) == (22, 22, 1, 1)


def text_model(value):
    """(class, precision, scale) of a number given as exact text; None for NULL, decimal without
    precision for text that is not a plain number."""
    import re as _re
    if value is None:
        return None
    t = value.strip()
    if not _re.fullmatch(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)", t):
        return ("decimal", None, None)
    a = t.lstrip("+-")
    whole, _, frac = a.partition(".")
    frac = frac.rstrip("0")
    digits = (whole + frac).lstrip("0")
    precision, scale = max(1, len(digits)), len(frac)
    if scale == 0:
        v = int(t.split(".")[0])
        if -2 ** 31 <= v <= 2 ** 31 - 1:
            return ("int", precision, 0)
        if -2 ** 63 <= v <= 2 ** 63 - 1:
            return ("long", precision, 0)
    return ("decimal", precision, scale)


def test_numbers_as_text(spark):
    vals = VALUES + ["0.123456789012345678", "12345678901234567890123456789012345.5", "abc", " 42 ", "+7.10",
                     "-.5", "00012", "1E5", "99999999999999999999"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = _row(profile_numbers(df, columns=["x"]))
    classes = [text_model(v) for v in vals]
    present = [c for c in classes if c is not None]
    precs = [c[1] for c in present if c[1] is not None]
    scales = [c[2] for c in present if c[2] is not None]
    assert got == dict(total_values=len(vals), null_values=len(vals) - len(present),
                       int_values=sum(c[0] == "int" for c in present), long_values=sum(c[0] == "long" for c in present),
                       decimal_values=sum(c[0] == "decimal" for c in present), max_precision=max(precs),
                       max_scale=max(scales),
                       max_int_digits=max(max(0, c[1] - c[2]) for c in present if c[1] is not None))
    assert got["max_scale"] == 18 and got["max_precision"] == 36
    # string columns are only profiled when named
    assert profile_numbers(df.withColumn("n", F.lit(1)), table="t").count() == 1


def test_lossless_recommendation_keeps_every_value(spark):
    """Values beyond decimal(38,10), floats and texts with exponents: the recommended type gives every value back."""
    from lakeload.operators.profile import recommend_types
    cases = {"wide": ("double", [1e30, 2.5]), "small": ("double", [1e-12, 0.123456789012]), "odd": ("double", [float("nan"), 1.5]),
             "f": ("float", [0.1, 2.5]), "t": ("string", ["1E3", "5", "abc"]), "plain": ("double", [1.25, -300.5]), "text": ("string", ["1.50", "22"])}
    want = {"wide": "string", "small": "string", "odd": "string", "f": "decimal(2,1)", "t": "string", "plain": "decimal(5,2)", "text": "decimal(3,1)"}
    for name, (kind, values) in cases.items():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"{name} {kind}")
        r = recommend_types(profile_numbers(df, columns=[name]), lossless=True).first()
        assert r["recommended_type"] == want[name], (name, r)
        back = df.select(df[name].alias("a"), df[name].cast("string").cast(r["recommended_type"]).cast("string").cast(kind).alias("b")).collect()
        if kind != "string":
            assert all(x.a == x.b or (x.a != x.a and x.b != x.b) for x in back)
