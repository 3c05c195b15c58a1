"""Numeric column profiles and type recommendations.

``profile_numbers`` is one distributed pass per small group of columns: every numeric column is
classified per row with native expressions and folded by ordinary aggregates (Spark splits them into partial and final aggregation,
so only one small row per task crosses the shuffle).  The single wide result row is unpivoted *after*
aggregation; unpivoting first would multiply the rows by the column count.

Columns are aggregated in small groups (see ``GROUP_WEIGHT``) so each group's generated per-row
code stays small enough to be compiled well.  On a columnar source every group reads only its own
columns, so the groups together read each column once, and groups run as parallel tasks.

Profile row (one per column, and per group of ``by`` when given)::

    table_name, column_name, position, total_values, null_values, int_values, long_values,
    decimal_values, max_precision, max_scale, max_int_digits, unclassified_values

``unclassified_values`` counts values that precision and scale do not describe exactly (beyond decimal(38,10), not
finite, or text that is no plain number); while there are any, the lossless recommendation is ``string``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeload.functions.numeric import FLOATING_TYPES, INTEGRAL_TYPES, classification_stages, is_numeric_type, nest_stages

# Recommendation defaults.
DEFAULT_THRESHOLD = 95.0          # percent; strictly greater than this to recommend int / long
ALL_NULL_TYPE = "decimal(38,10)"  # recommendation for a column without values
MIN_REC_PRECISION = 10            # recommended decimals have at least this precision
MIN_REC_SCALE = 2                 # ... and at least this scale
MAX_PRECISION = 38

PROFILE_COLUMNS = ["table_name", "column_name", "position", "total_values", "null_values", "int_values",
                   "long_values", "decimal_values", "max_precision", "max_scale", "max_int_digits", "unclassified_values"]


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[tuple[int, str, T.DataType]]:
    """(position, name, type) of the numeric columns of ``df``, optionally restricted to ``columns``.

    String columns named in ``columns`` are included too: numbers read as text (for example NUMBER
    values wider than decimal(38,10), fetched with a JDBC ``customSchema`` of strings) are classified
    from their exact text.
    """
    wanted = None if columns is None else {c.lower() for c in columns}
    out = []
    for pos, f in enumerate(df.schema.fields, start=1):
        named = wanted is not None and f.name.lower() in wanted
        if (is_numeric_type(f.dataType) and (wanted is None or named)) or (named and isinstance(f.dataType, T.StringType)):
            out.append((pos, f.name, f.dataType))
    return out


# Code weight of one column's classification, and the weight one fused (whole-stage) method may hold.
# The per-row code of a group is compiled into one method; past a few columns it grows too large for
# the JIT to compile well and runs several times slower, so groups stay small.  Each group scans only
# its own columns (columnar source), and separate groups run as parallel tasks.
_WEIGHT_INTEGRAL, _WEIGHT_TEXT = 1, 2
GROUP_WEIGHT = 4


def _column_groups(cols: list[tuple[int, str, T.DataType]], floating: bool) -> list[list]:
    groups, cur, w = [], [], 0
    for c in cols:
        cw = _WEIGHT_INTEGRAL if (floating or isinstance(c[2], INTEGRAL_TYPES)) else _WEIGHT_TEXT
        if cur and w + cw > GROUP_WEIGHT:
            groups.append(cur)
            cur, w = [], 0
        cur.append(c)
        w += cw
    if cur:
        groups.append(cur)
    return groups


def _sql_str(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _group_sql(view: str, cols: list[tuple[int, str, T.DataType]], by: list[str], table: str | None,
               floating: bool) -> str:
    """SQL of one column group's profile rows over the source view."""
    stages, names = classification_stages(cols, floating, carry=by)
    aggs = ["count(1) AS __total"]
    for i in range(len(cols)):
        x, is_int, is_long, p, s, u = names[i]
        aggs += [f"count({x}) AS __n{i}", f"count_if({is_int}) AS __i{i}", f"count_if({is_long}) AS __l{i}",
                 f"max({p}) AS __p{i}", f"max({s}) AS __s{i}", f"max(greatest(0, {p} - {s})) AS __d{i}", f"count_if({u}) AS __u{i}"]
    keys = [f"`{b}`" for b in by]
    group = f" GROUP BY {', '.join(keys)}" if by else ""
    wide = f"(SELECT {', '.join(keys + aggs)} FROM {nest_stages(view, stages)} AS __c{group}) AS __w"
    entries = ", ".join(
        f"named_struct('column_name', {_sql_str(name)}, 'position', {pos}, 'total_values', __total, "
        f"'null_values', __total - __n{i}, 'int_values', __i{i}, 'long_values', __l{i}, "
        f"'decimal_values', __n{i} - __i{i} - __l{i}, 'max_precision', coalesce(__p{i}, 0), "
        f"'max_scale', coalesce(__s{i}, 0), 'max_int_digits', coalesce(__d{i}, 0), 'unclassified_values', __u{i})"
        for i, (pos, name, _) in enumerate(cols))
    return f"SELECT {', '.join([_sql_str(table) + ' AS table_name'] + keys)}, inline(array({entries})) FROM {wide}"


def profile_numbers(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] | None = None,
                    table: str | None = None, floating: bool = False) -> DataFrame:
    """Profile numeric columns: one aggregate per small column group, all groups in one statement.

    ``by`` groups the profile (one partial profile per bucket or load batch); merge partials with
    ``merge_profiles``.  ``floating=True`` profiles float/double columns on the floating branch
    (whole-and-finite test, no precision tracking) instead of reading them as decimal(38,10).

    The whole profile is built as one SQL statement over a temporary view of the source, so the
    driver analyses one plan instead of several per group (which dominates on wide tables).
    """
    by = list(by or [])
    cols = [c for c in numeric_columns(df, columns) if c[1] not in by]
    if floating:
        cols = [c for c in cols if isinstance(c[2], FLOATING_TYPES)]
    if not cols:
        raise ValueError("no numeric columns to profile")
    spark = df.sparkSession
    src = df.select(*[F.col(f"`{c}`") for c in by + [n for _, n, _ in cols]])
    view = f"__lakeload_profile_{uuid.uuid4().hex}"
    src.createOrReplaceTempView(view)
    try:
        sql = "\nUNION ALL\n".join(_group_sql(view, g, by, table, floating) for g in _column_groups(cols, floating))
        out = spark.sql(sql)
    finally:
        spark.catalog.dropTempView(view)
    return out


def merge_profiles(partials: DataFrame) -> DataFrame:
    """Combine partial profiles (per bucket, per load batch): counts add, maxima take the maximum."""
    return (partials.groupBy("table_name", "column_name")
            .agg(F.min("position").alias("position"),
                 F.sum("total_values").cast("bigint").alias("total_values"),
                 F.sum("null_values").cast("bigint").alias("null_values"),
                 F.sum("int_values").cast("bigint").alias("int_values"),
                 F.sum("long_values").cast("bigint").alias("long_values"),
                 F.sum("decimal_values").cast("bigint").alias("decimal_values"),
                 F.max("max_precision").alias("max_precision"),
                 F.max("max_scale").alias("max_scale"),
                 F.max("max_int_digits").alias("max_int_digits"),
                 F.sum("unclassified_values").cast("bigint").alias("unclassified_values"))
            .select(*PROFILE_COLUMNS))


def _share(count: Column, nonnull: Column) -> Column:
    return count.cast("double") * F.lit(100.0) / nonnull.cast("double")


def recommend_expr(total: Column, nulls: Column, ints: Column, longs: Column, max_p: Column, max_s: Column,
                   threshold: float = DEFAULT_THRESHOLD) -> Column:
    """Recommended type name: all NULL → decimal(38,10); > threshold % int → integer;
    > threshold % int+long → long; else decimal(max(10,p), max(2,s)) clamped to 38 with s <= p."""
    nonnull = total - nulls
    p = F.least(F.lit(MAX_PRECISION), F.greatest(F.lit(MIN_REC_PRECISION), max_p))
    s = F.least(p, F.greatest(F.lit(MIN_REC_SCALE), max_s))
    return (F.when(nonnull == 0, F.lit(ALL_NULL_TYPE))
            .when(_share(ints, nonnull) > F.lit(float(threshold)), F.lit("integer"))
            .when(_share(ints + longs, nonnull) > F.lit(float(threshold)), F.lit("long"))
            .otherwise(F.format_string("decimal(%d,%d)", p, s)))


def lossless_expr(total: Column, nulls: Column, ints: Column, longs: Column, decimals: Column,
                  max_int_digits: Column, max_s: Column, unclassified: Column) -> Column:
    """Recommendation that holds every observed value: string while a value is unclassified or integer digits and
    scale together exceed 38; integer / long only if all values are; else decimal(integer digits + scale, scale)."""
    nonnull = total - nulls
    digits = F.least(F.lit(MAX_PRECISION), max_int_digits)
    s = F.greatest(F.lit(0), F.least(max_s, F.lit(MAX_PRECISION) - digits))
    p = F.greatest(F.lit(1), digits + s)
    return (F.when(nonnull == 0, F.lit(ALL_NULL_TYPE))
            .when((unclassified > 0) | (max_int_digits + max_s > MAX_PRECISION), F.lit("string"))
            .when((decimals == 0) & (longs == 0), F.lit("integer"))
            .when(decimals == 0, F.lit("long"))
            .otherwise(F.format_string("decimal(%d,%d)", p, s)))


def recommend_types(profile: DataFrame, threshold: float = DEFAULT_THRESHOLD, lossless: bool = False) -> DataFrame:
    """Add ``recommended_type`` to a profile."""
    c = F.col
    if lossless:
        rec = lossless_expr(c("total_values"), c("null_values"), c("int_values"), c("long_values"),
                            c("decimal_values"), c("max_int_digits"), c("max_scale"), c("unclassified_values"))
    else:
        rec = recommend_expr(c("total_values"), c("null_values"), c("int_values"), c("long_values"),
                             c("max_precision"), c("max_scale"), threshold)
    return profile.withColumn("recommended_type", rec)


def type_width(type_name: Column) -> Column:
    """Bytes per value of a lake type name as stored in Parquet (int 4, long 8, decimal by precision)."""
    p = F.regexp_extract(type_name, r"^decimal\((\d+),", 1)
    prec = F.when(p != "", p.cast("int"))
    return (F.when(type_name.isin("integer", "int", "float"), F.lit(4))
            .when(type_name.isin("long", "bigint", "double"), F.lit(8))
            .when(prec <= 9, F.lit(4))
            .when(prec <= 18, F.lit(8))
            .when(prec.isNotNull() | (type_name == "string"), F.lit(16)))


def storage_estimate(recommended: DataFrame, source_type: str = ALL_NULL_TYPE) -> DataFrame:
    """Bytes of the non-NULL values before (as ``source_type``) and after retyping, per column."""
    values = F.col("total_values") - F.col("null_values")
    return recommended.select(
        "table_name", "column_name", "recommended_type",
        values.alias("stored_values"),
        (values * type_width(F.lit(source_type))).cast("bigint").alias("bytes_before"),
        (values * type_width(F.col("recommended_type"))).cast("bigint").alias("bytes_after"),
    )
