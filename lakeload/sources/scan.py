"""Scans: whole, filtered, SQL, with a row key, split by key range or hash, sampled, as of a point.

A source is a Parquet path (anything containing ``/``), a catalog table name, or a JDBC spec
(``lakeload.sources.jdbc.JdbcSource``).  Every variant returns a lazy DataFrame: filters and column
lists reach the Parquet scan (``PushedFilters`` / ``ReadSchema``) or the JDBC query.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.numeric import is_numeric_type

_WHERE = re.compile(r"^\s*where\s+", re.IGNORECASE)

# Sample sizing (5 % of the rows, at least 10 000 or all rows, at most 100 000).
SAMPLE_PERCENT_DIVISOR = 20
SAMPLE_FLOOR = 10_000
SAMPLE_CEILING = 100_000
# Number of key ranges of a range-split scan.
DEFAULT_RANGES = 4


def read_source(spark: SparkSession, source, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    from lakeload.sources.jdbc import JdbcSource

    if isinstance(source, DataFrame):
        return source
    if isinstance(source, JdbcSource):
        return source.read(spark)
    if isinstance(source, str) and ("/" in source or source.endswith(f".{fmt}")):
        return spark.read.format(fmt).options(**(options or {})).load(source)
    return spark.table(source)


def where_clause(df: DataFrame, clause: str | None) -> DataFrame:
    """Apply filter text given with or without a leading ``WHERE``."""
    if clause is None or not clause.strip():
        return df
    return df.where(_WHERE.sub("", clause, count=1))


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Prepend a stable physical row key ``<file path>:<row index in file>`` (file sources only).

    Must be applied to the scan itself, before other transformations.  The key is stable across
    re-reads of the same files, unlike ``monotonically_increasing_id``.
    """
    key = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    return df.select(key.alias(name), *[F.col(f"`{c}`") for c in df.columns])


def scan_table(spark: SparkSession, source, where: str | None = None, query: str | None = None,
               columns: Sequence[str] | None = None, row_key: str | None = None) -> DataFrame:
    """Scan a table (S1), filtered (S2), or a SELECT (S3), optionally with a row key (S4)."""
    if query is not None:
        if where:
            raise ValueError("a filter applies to a table or view, not to a query")
        df = spark.sql(query)
    else:
        df = read_source(spark, source)
        if row_key:
            df = with_row_key(df, row_key)
        df = where_clause(df, where)
    if columns is not None:
        keep = ([row_key] if row_key else []) + [c for c in columns if c != row_key]
        df = df.select(*[F.col(f"`{c}`") for c in keep])
    return df


def number_columns(df: DataFrame) -> DataFrame:
    """Project to the numeric columns only (S9); pruning reaches the scan."""
    cols = [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]
    return df.select(*[F.col(f"`{c}`") for c in cols])


# ---------------------------------------------------------------- key ranges (S5)

def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Min, max and span (max - min + 1) of a key: one aggregate, partial per task."""
    k = F.col(f"`{key}`")
    return df.agg(F.min(k).alias("min_key"), F.max(k).alias("max_key")).select(
        "min_key", "max_key", (F.col("max_key") - F.col("min_key") + 1).alias("key_span"))


def range_id(key: Column, lo: int, hi: int, n: int = DEFAULT_RANGES) -> Column:
    """Range number of ``key`` among ``n`` equal ranges of [lo, hi]; the last range takes the remainder,
    NULL keys go to range 0."""
    size = max(1, (hi - lo + 1) // n)
    rid = F.least(F.lit(n - 1), F.floor((key - F.lit(lo)) / F.lit(size)).cast("int"))
    return F.when(key.isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), rid))


def with_key_ranges(df: DataFrame, key: str, n: int = DEFAULT_RANGES, name: str = "range_id") -> DataFrame:
    """Tag every row with its key range.  The bounds are one scalar aggregate; the tagging is a
    narrow projection (no shuffle)."""
    b = key_bounds(df, key).first()
    if b is None or b["min_key"] is None:
        return df.withColumn(name, F.lit(0))
    return df.withColumn(name, range_id(F.col(f"`{key}`"), int(b["min_key"]), int(b["max_key"]), n))


def key_ranges(df: DataFrame, key: str, n: int = DEFAULT_RANGES) -> DataFrame:
    """(range_id, lo, hi, rows) of an ``n``-way range split of ``key``."""
    b = key_bounds(df, key).first()
    if b["min_key"] is None:  # no rows, or no row with a key
        return (df.where(F.col(f"`{key}`").isNull()).agg(F.count(F.lit(1)).alias("rows")).where("rows > 0")
                .select(F.lit(0).alias("range_id"), F.lit(None).cast("bigint").alias("lo"), F.lit(None).cast("bigint").alias("hi"), "rows"))
    lo, hi = int(b["min_key"]), int(b["max_key"])
    size = max(1, (hi - lo + 1) // n)
    counts = with_key_ranges(df.select(f"`{key}`"), key, n).groupBy("range_id").agg(F.count(F.lit(1)).alias("rows"))
    r = F.col("range_id")
    return counts.select(
        r,
        (F.lit(lo) + r.cast("bigint") * F.lit(size)).alias("lo"),
        F.when(r == n - 1, F.lit(hi)).otherwise(F.lit(lo) + (r.cast("bigint") + 1) * F.lit(size) - 1).alias("hi"),
        "rows")


# ---------------------------------------------------------------- hash buckets (S6)

def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")


def hash_buckets(df: DataFrame, keys: Sequence[str], n: int, name: str = "bucket") -> DataFrame:
    """Tag rows with one of ``n`` disjoint hash buckets of the key (no shuffle; callers may
    ``repartition(n, name)`` to give each bucket its own task)."""
    return df.withColumn(name, bucket_of(keys, n))


# ---------------------------------------------------------------- samples (S7)

def sample_size_expr(rows: Column) -> Column:
    five = (rows / SAMPLE_PERCENT_DIVISOR).cast("bigint")
    return (F.when(five < SAMPLE_FLOOR, F.least(rows, F.lit(SAMPLE_FLOOR)))
            .when(five > SAMPLE_CEILING, F.lit(SAMPLE_CEILING))
            .otherwise(five)).cast("bigint")


def sample_percent_expr(size: Column, rows: Column) -> Column:
    return F.when(rows > 0, F.least(F.lit(100.0), size.cast("double") / rows.cast("double") * F.lit(100.0)))


def sample_plan(counts: DataFrame) -> DataFrame:
    """Add ``sample_size`` and ``sample_percent`` to a (table_name, row_count) DataFrame."""
    size = sample_size_expr(F.col("row_count"))
    return counts.select("table_name", "row_count", size.alias("sample_size"),
                         sample_percent_expr(size, F.col("row_count")).alias("sample_percent"))


def _sample_key(keys: Sequence[str]) -> Column:
    cols = [F.col(f"`{k}`") for k in keys]
    return F.struct(F.xxhash64(*cols).alias("h"), *[c.alias(f"k{i}") for i, c in enumerate(cols)])


def sample_rows(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Deterministic uniform sample of exactly ``min(size, rows)`` rows (up to duplicate keys): the
    rows whose (hash of key, key) is among the ``size`` smallest.

    Rows are counted by the top 16 bits of the hash (at most 65,536 partial counts reach the driver); the
    counts tell the bin in which the cut lies, and only that bin's tuples are ordered.  The sample itself is a
    filter, so it can be read again by several jobs without recomputing an ordering of whole rows.
    """
    k = _sample_key(keys)
    top = F.shiftright(F.xxhash64(*[F.col(f"`{c}`") for c in keys]), 48)
    counts = sorted(tuple(r) for r in df.select(top.alias("b")).groupBy("b").count().collect())
    left = int(size)
    for cut_bin, n in counts:
        if n >= left:
            break
        left -= n
    else:
        return df
    if left <= 0:
        return df.limit(0)
    cut = df.where(top == cut_bin).select(k.alias("k")).orderBy("k").limit(left).agg(F.max("k").alias("cut")).first()["cut"]
    lit_cut = F.struct(F.lit(cut["h"]).cast("bigint").alias("h"),
                       *[F.lit(cut[f"k{i}"]).alias(f"k{i}") for i in range(len(keys))])
    return df.where((top < cut_bin) | ((top == cut_bin) & (k <= lit_cut)))


def scan_sample(df: DataFrame, keys: Sequence[str], rows: int | None = None, size: int | None = None) -> DataFrame:
    """Sampled scan of ``size`` rows, by default what the sample plan says for ``rows`` (5 %, floor 10 000,
    ceiling 100 000; counted unless given).  A sample is not the table: profile it as such."""
    if size is None:
        rows = df.count() if rows is None else rows
        five = rows // SAMPLE_PERCENT_DIVISOR
        size = min(rows, SAMPLE_FLOOR) if five < SAMPLE_FLOOR else (SAMPLE_CEILING if five > SAMPLE_CEILING else five)
    return sample_rows(df, keys, size)


# ---------------------------------------------------------------- as-of scans (S8)

def scan_as_of(df: DataFrame, ts_col: str, as_of=None) -> DataFrame:
    """Snapshot-consistent scan of an append-only table: rows with ``ts_col <= as_of``.

    ``as_of`` is fixed once per job; when omitted it is the current ``max(ts_col)``, fetched once, so
    every later task of the job sees the same cut.
    """
    if as_of is None:
        as_of = df.agg(F.max(f"`{ts_col}`").alias("m")).first()["m"]
    return df.where(F.col(f"`{ts_col}`") <= F.lit(as_of))
