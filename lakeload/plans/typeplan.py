"""Type planning over a DataFrame of column descriptors.

Input: one row per source column (``table_name, column_name, position, type_class, precision, scale,
nullable``), from every table of a source at once.  Output: one row per column with the chosen rule
and the target type.  Precedence: user exact rule > inferred type > first matching pattern > base
ladder.  Rules reach columns through an equi-join: every numeric column is expanded into its exact
name, prefixes and suffixes (at most twice the name length, which identifiers bound), and joined with
the rules on (kind, text).  No non-equi or cross join is used, so neither side needs to be small;
Spark broadcasts the rules side on its own when its size estimate allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.types import NUMERIC_CLASSES, ladder, parse_default, recommended_name
from lakeload.plans.rules import target_triple

PLAN_COLUMNS = ["table_name", "column_name", "position", "type_class", "precision", "scale", "nullable",
                "rule_source", "rule_text", "target_type", "target_precision", "target_scale", "spark_type"]

# Precedence of rule sources (lower wins).
_EXACT, _INFERRED, _PATTERN = 1, 2, 3


def _match_keys(columns: DataFrame) -> DataFrame:
    """(table_name, column_name, match_kind, match_text) for each numeric column."""
    up = F.upper(F.col("column_name"))
    n = F.length(up)
    lens = F.sequence(F.lit(1), n)
    # prefix of length i: substring(name, 1, i); suffix of length i: substring(name, n - i + 1, i)
    keys = F.concat(
        F.array(F.struct(F.lit("exact").alias("k"), up.alias("t"))),
        F.transform(lens, lambda i: F.struct(F.lit("prefix").alias("k"), F.substring(up, 1, i).alias("t"))),
        F.transform(lens, lambda i: F.struct(F.lit("suffix").alias("k"),
                                             F.substring(up, n - i + 1, i).alias("t"))),
    )
    return (columns.where(F.upper("type_class").isin(*NUMERIC_CLASSES))
            .select("table_name", "column_name", F.inline(keys))
            .select("table_name", "column_name", F.col("k").alias("match_kind"), F.col("t").alias("match_text")))


def _rule_choices(columns: DataFrame, rules: DataFrame | None) -> DataFrame | None:
    if rules is None:
        return None
    valid = rules.where("valid").select(
        "match_kind", "match_text", "rule_pos", "rule_text", "target_class", "target_precision", "target_scale")
    hits = _match_keys(columns).join(valid, ["match_kind", "match_text"])
    prec = F.when(F.col("match_kind") == "exact", F.lit(_EXACT)).otherwise(F.lit(_PATTERN))
    src = F.when(F.col("match_kind") == "exact", F.lit("exact")).otherwise(F.lit("pattern"))
    return hits.select("table_name", "column_name", F.struct(
        prec.alias("prec"), F.col("rule_pos").alias("pos"), src.alias("source"), F.col("rule_text").alias("text"),
        F.col("target_class").alias("c"), F.col("target_precision").alias("p"),
        F.col("target_scale").alias("s")).alias("choice"))


def _inferred_choices(columns: DataFrame, inferred: DataFrame | None) -> DataFrame | None:
    """Inferred types (``table_name, column_name, recommended_type``) as exact overrides of numeric
    columns."""
    if inferred is None:
        return None
    t = target_triple(F.col("recommended_type"))
    num = columns.where(F.upper("type_class").isin(*NUMERIC_CLASSES)).select("table_name", "column_name")
    return (inferred.select("table_name", "column_name", "recommended_type", t.alias("t"))
            .where(F.col("t").isNotNull())
            .join(num, ["table_name", "column_name"])
            .select("table_name", "column_name", F.struct(
                F.lit(_INFERRED).alias("prec"), F.lit(0).alias("pos"), F.lit("inferred").alias("source"),
                F.col("recommended_type").alias("text"), F.col("t.c").alias("c"), F.col("t.p").alias("p"),
                F.col("t.s").alias("s")).alias("choice")))


def plan_types(columns: DataFrame, rules: DataFrame | None = None, inferred: DataFrame | None = None,
               default: str | None = None) -> DataFrame:
    """Target type of every column: exact rule > inferred > first pattern > base ladder."""
    dflt = parse_default(default)
    choices = [c for c in (_rule_choices(columns, rules), _inferred_choices(columns, inferred)) if c is not None]
    base = columns.select("table_name", "column_name", "position", "type_class", "precision", "scale", "nullable")
    if choices:
        allc = choices[0]
        for c in choices[1:]:
            allc = allc.unionByName(c)
        best = allc.groupBy("table_name", "column_name").agg(F.min("choice").alias("choice"))
        base = base.join(best, ["table_name", "column_name"], "left")
    else:
        base = base.withColumn("choice", F.lit(None).cast(
            "struct<prec:int,pos:int,source:string,text:string,c:string,p:int,s:int>"))
    ch = F.col("choice")
    cls = F.coalesce(ch.getField("c"), F.col("type_class"))
    p = F.coalesce(ch.getField("p"), F.col("precision"))
    s = F.coalesce(ch.getField("s"), F.col("scale"))
    t = ladder(cls, p, s, dflt)
    return base.select(
        "table_name", "column_name", "position", "type_class", "precision", "scale", "nullable",
        F.coalesce(ch.getField("source"), F.lit("base")).alias("rule_source"),
        ch.getField("text").alias("rule_text"),
        t.getField("target_type").alias("target_type"), t.getField("target_precision").alias("target_precision"),
        t.getField("target_scale").alias("target_scale"), t.getField("spark_type").alias("spark_type"))


def number_declarations(describe: DataFrame, profile: DataFrame) -> DataFrame:
    """Column descriptors in which every profiled numeric column is declared NUMBER(p,s) with the
    smallest p,s holding its observed values (p = integer digits + scale), as a source dictionary
    would list NUMBER columns.  Columns without values get NUMBER with no precision (0,0)."""
    pr = profile.select("table_name", "column_name", "total_values", "null_values", "max_int_digits", "max_scale")
    j = describe.join(pr, ["table_name", "column_name"], "left")
    has = F.col("max_scale").isNotNull()
    empty = (F.col("total_values") - F.col("null_values")) == 0
    return j.select(
        "table_name", "column_name", "position",
        F.when(has, F.lit("NUMERIC")).otherwise(F.col("type_class")).alias("type_class"),
        F.when(has & empty, F.lit(0)).when(has, F.col("max_int_digits") + F.col("max_scale"))
        .otherwise(F.col("precision")).alias("precision"),
        F.when(has & empty, F.lit(0)).when(has, F.col("max_scale")).otherwise(F.col("scale")).alias("scale"),
        "nullable")


def rule_usage(rules: DataFrame, plan: DataFrame) -> DataFrame:
    """Parsed rules with the number of planned columns each one decided; of valid rules with the same text the first decides."""
    used = (plan.where(F.col("rule_source").isin("exact", "pattern"))
            .groupBy("rule_text").agg(F.count(F.lit(1)).alias("columns_decided")))
    first = rules.where("valid").groupBy("rule_text").agg(F.min("rule_pos").alias("rule_pos"))
    return (rules.join(used.join(first, "rule_text"), ["rule_text", "rule_pos"], "left")
            .withColumn("columns_decided", F.coalesce(F.col("columns_decided"), F.lit(0)).cast("bigint")))


def dictionary_name(type_class: Column, precision: Column, scale: Column, type_name: Column | None = None) -> Column:
    """Recommended type name without a mapper: unspecified precision -> 38, s > p clamps to p, LOB
    types -> binary/string; integer-valued NUMBER narrows to integer/long."""
    cls = F.upper(type_class)
    p0 = F.when(precision > 0, precision).otherwise(F.lit(38))
    s = F.when(scale > 0, scale).otherwise(F.lit(0))
    p = F.least(p0, F.lit(38))
    s2 = F.least(s, p)
    num = (F.when((s == 0) & (p0 < 10), F.lit("integer")).when((s == 0) & (p0 < 19), F.lit("long"))
           .otherwise(F.format_string("decimal(%d,%d)", p, s2)))
    is_date = F.upper(type_name) == "DATE" if type_name is not None else F.lit(False)
    return (F.when(cls.isin("TINYINT", "SMALLINT", "INTEGER"), F.lit("integer"))
            .when(cls == "BIGINT", F.lit("long"))
            .when(cls.isin("NUMERIC", "DECIMAL"), num)
            .when(cls == "FLOAT", F.lit("float")).when(cls == "DOUBLE", F.lit("double"))
            .when(cls == "BOOLEAN", F.lit("boolean"))
            .when(cls.isin("TIMESTAMP", "TIMESTAMP_WITH_TIMEZONE"), F.lit("timestamp"))
            .when(cls == "DATE", F.when(is_date, F.lit("date")).otherwise(F.lit("timestamp")))
            .when(cls.isin("BINARY", "VARBINARY", "LONGVARBINARY", "BLOB"), F.lit("binary"))
            .otherwise(F.lit("string")))


def recommended_names(plan: DataFrame, recommendations: DataFrame | None = None, mode: str = "mapper") -> DataFrame:
    """Name of the recommended type of every column: the profile's recommendation where one exists,
    else the plan's target (``mode='mapper'``) or the dictionary ladder (``mode='dictionary'``)."""
    if mode == "mapper":
        fallback = recommended_name(F.col("target_type"))
    elif mode == "dictionary":
        fallback = dictionary_name(F.col("type_class"), F.col("precision"), F.col("scale"))
    else:
        raise ValueError("mode is 'mapper' or 'dictionary'")
    base = plan
    if recommendations is not None:
        rec = recommendations.select("table_name", "column_name", F.col("recommended_type").alias("__rec"))
        base = plan.join(rec, ["table_name", "column_name"], "left")
    else:
        base = plan.withColumn("__rec", F.lit(None).cast("string"))
    return base.select("table_name", "column_name", "position",
                       F.coalesce(F.col("__rec"), fallback).alias("recommended_type"),
                       F.when(F.col("__rec").isNotNull(), F.lit("profile")).otherwise(F.lit(mode)).alias("basis"))


def type_map(plan: DataFrame) -> DataFrame:
    """One JSON object per table mapping column -> target type, keys in column order."""
    return (plan.groupBy("table_name")
            .agg(F.sort_array(F.collect_list(F.struct("position", "column_name", "target_type"))).alias("e"))
            .select("table_name", F.to_json(F.map_from_entries(
                F.transform("e", lambda x: F.struct(x["column_name"], x["target_type"])))).alias("type_map")))


def read_type_map(maps: DataFrame) -> DataFrame:
    """Explode ``type_map`` JSON back to (table_name, column_name, target_type) rows — the form
    ``plan_types(inferred=...)`` accepts (as ``recommended_type``)."""
    m = F.from_json(F.col("type_map"), "map<string,string>")
    return maps.select("table_name", F.explode(m).alias("column_name", "target_type"))
