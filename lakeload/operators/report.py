"""Metadata report: table, columns (with recommendation and profile), constraints; as rows or JSON.

Everything is joined from DataFrames computed as jobs: column listing, row counts, the numeric profile
and its recommendation, declared keys verified in the data, and discovered candidate keys.  Grouping
happens per table over schema-sized rows (one per column), never over data rows.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.types import JDBC_TYPE_CODES, recommended_name
from lakeload.operators import keys as K
from lakeload.operators import profile as P
from lakeload.plans.typeplan import plan_types

# The counters of a column's numeric profile that a report carries (NULL for columns that aren't numeric).
COUNTERS = ("total_values", "null_values", "int_values", "long_values", "decimal_values", "max_precision", "max_scale")


def object_info(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Object check: does each catalog name exist, and is it a TABLE or a VIEW (paths: asked of the
    file system; an existing one is a TABLE)."""
    rows = []
    for n in names:
        if "/" in n:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(n)
            there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
            rows.append((n, bool(there), "TABLE" if there else None))
            continue
        exists = spark.catalog.tableExists(n)
        kind = None
        if exists:
            t = spark.catalog.getTable(n)
            kind = "VIEW" if (t.tableType or "").upper() in ("VIEW", "TEMPORARY") or t.isTemporary else "TABLE"
        rows.append((n, bool(exists), kind))
    return spark.createDataFrame(rows, "table_name string, exists boolean, table_type string")


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def report_rows(tables: Mapping[str, DataFrame], declared_keys: Mapping[str, Sequence[str]] | None = None,
                constraints: bool = True, schema: str | None = None) -> DataFrame:
    """Flattened report: one row per column of every table."""
    declared_keys = declared_keys or {}
    desc = _union([K.describe_columns(df, t) for t, df in tables.items()])
    counts = K.row_counts(tables)
    profiles = []
    for t, df in tables.items():
        if P.numeric_columns(df):
            profiles.append(P.profile_numbers(df, table=t))
    plan = plan_types(desc)
    cols = plan.select("table_name", "column_name", recommended_name(F.col("target_type")).alias("__mapped"))
    out = desc.join(counts, "table_name").join(cols, ["table_name", "column_name"], "left")
    if profiles:
        prof = P.recommend_types(_union(profiles)).select(
            "table_name", "column_name", F.col("recommended_type").alias("__rec"), *COUNTERS)
        out = out.join(prof, ["table_name", "column_name"], "left")
    else:
        out = out.select("*", F.lit(None).cast("string").alias("__rec"), *[F.lit(None).cast("bigint").alias(c) for c in COUNTERS])
    if constraints and declared_keys:
        checks = _union([K.check_key(tables[t], cols_, t) for t, cols_ in declared_keys.items()])
        pk = checks.select("table_name", F.when(F.col("is_key"), F.col("key_columns")).alias("primary_key"))
        out = out.join(pk, "table_name", "left")
    else:
        out = out.withColumn("primary_key", F.lit(None).cast("string"))
    return out.select(
        F.lit(schema).cast("string").alias("schema_name"), "table_name", "row_count", "column_name", "position",
        "data_type", "type_class", "precision", "scale", "nullable",
        F.coalesce(F.col("__rec"), F.col("__mapped")).alias("recommended_type"), *COUNTERS, "primary_key")


def report_json(rows: DataFrame, candidates: DataFrame | None = None, object_types: DataFrame | None = None) -> DataFrame:
    """Nested report per table as JSON text: extraction time, table metadata, columns map (with the type's JDBC code, and the
    counters of numeric columns), constraints."""
    codes = F.create_map(*[F.lit(x) for pair in JDBC_TYPE_CODES.items() for x in pair])
    stats = F.when(F.col("total_values").isNotNull(), F.struct(*COUNTERS))
    col_entry = F.struct(
        F.col("column_name"),
        F.struct(F.col("data_type").alias("source_type"), codes[F.col("type_class")].alias("jdbc_type"), "type_class",
                 "precision", "scale", "nullable", F.col("recommended_type").alias("recommended"),
                 stats.alias("stats")).alias("info"))
    per_table = rows.groupBy("schema_name", "table_name", "row_count", "primary_key").agg(
        F.sort_array(F.collect_list(F.struct("position", col_entry.alias("e")))).alias("cols"))
    if candidates is not None:
        uniq = candidates.groupBy("table_name").agg(F.collect_list(F.struct(
            F.concat(F.lit("candidate_"), F.regexp_replace("key_columns", ",", "_")).alias("name"),
            F.split("key_columns", ",").alias("columns"))).alias("unique_indexes"))
        per_table = per_table.join(uniq, "table_name", "left")
    else:
        per_table = per_table.withColumn("unique_indexes", F.lit(None).cast(
            "array<struct<name:string,columns:array<string>>>"))
    if object_types is not None:
        per_table = per_table.join(object_types.select("table_name", "table_type"), "table_name", "left")
    else:
        per_table = per_table.withColumn("table_type", F.lit("TABLE"))
    report = F.struct(
        F.lit(int(time.time() * 1000)).alias("extraction_timestamp"),
        F.struct(F.col("schema_name").alias("schema"), F.col("table_name").alias("table"),
                 F.coalesce(F.col("table_type"), F.lit("TABLE")).alias("type"), "row_count").alias("table_metadata"),
        F.map_from_entries(F.transform("cols", lambda x: x["e"])).alias("columns"),
        F.struct(F.when(F.col("primary_key").isNotNull(), F.split("primary_key", ",")).alias("primary_key"),
                 F.coalesce(F.col("unique_indexes"), F.array()).alias("unique_indexes")).alias("constraints"))
    return per_table.select("table_name", F.to_json(report).alias("report"))


def write_report(report: DataFrame, path: str) -> None:
    """One JSON document per line, one line per table."""
    report.select("report").write.mode("errorifexists").text(path)
