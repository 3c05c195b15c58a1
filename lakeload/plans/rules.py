"""Override rules: ``COLUMN:NUMBER=type; %SUFFIX:NUMBER=type; PREFIX%:FLOAT=type; ...``.

Rules are parsed by Spark from a DataFrame of rule texts (one per row, with its position), so a rule
table of any size can be used; ``rules_frame`` builds that DataFrame from the ``;``-separated text
form.  Each rule becomes (kind, match text, target class, precision, scale); bad rules are kept with a
``problem`` and never reach a plan.

Matching is on upper case.  Patterns are a suffix (``%X``) or a prefix (``X%``) only; other uses of
``%`` are invalid.  A rule's source type (NUMBER or FLOAT) only says which columns it may change:
numeric columns.  Among several matching patterns the first in text order wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted rule source types and target spellings -> (type class, precision, scale).
RULE_SOURCES = ("NUMBER", "FLOAT")
TARGET_FIXED = {"LONG": ("BIGINT", 18, 0), "BIGINT": ("BIGINT", 18, 0), "INT": ("INTEGER", 9, 0),
                "INTEGER": ("INTEGER", 9, 0), "DOUBLE": ("DOUBLE", 0, 0), "FLOAT": ("FLOAT", 0, 0)}
DECIMAL_TARGET = r"^(?i)(decimal|numeric|number)\s*\(\s*(-?\d+)\s*,\s*(-?\d+)\s*\)$"

RULE_COLUMNS = ["rule_pos", "rule_text", "match_kind", "match_text", "source_type", "target_class",
                "target_precision", "target_scale", "valid", "problem"]


def rules_frame(spark: SparkSession, text: str | None) -> DataFrame:
    """(rule_pos, rule_text) rows of a ``;``-separated rule list; blank entries are skipped."""
    parts = [] if not text else [p.strip() for p in text.split(";")]
    rows = [(i, p) for i, p in enumerate([p for p in parts if p], start=1)]
    return spark.createDataFrame(rows, "rule_pos int, rule_text string")


def target_triple(target: Column) -> Column:
    """struct(target_class, target_precision, target_scale) of a target spelling, NULL if unknown."""
    t = F.upper(F.trim(target))
    fixed = None
    for k, (cls, p, s) in TARGET_FIXED.items():
        fixed = (F.when if fixed is None else fixed.when)(
            t == k, F.struct(F.lit(cls).alias("c"), F.lit(p).alias("p"), F.lit(s).alias("s")))
    is_dec = F.trim(target).rlike(DECIMAL_TARGET)
    dec = F.struct(F.lit("NUMERIC").alias("c"),
                   F.regexp_extract(F.trim(target), DECIMAL_TARGET, 2).try_cast("int").alias("p"),
                   F.regexp_extract(F.trim(target), DECIMAL_TARGET, 3).try_cast("int").alias("s"))
    return fixed.when(is_dec, dec)


def bad_decimal(triple: Column) -> Column:
    """Whether a decimal target has a precision outside 1..38 or a scale outside 0..precision."""
    p, s = triple["p"], triple["s"]
    fine = (p >= 1) & (p <= 38) & (s >= 0) & (s <= p)
    return (triple["c"] == "NUMERIC") & ~F.coalesce(fine, F.lit(False))


def parse_rules(rules: DataFrame) -> DataFrame:
    """Parse (rule_pos, rule_text) into rule rows with ``valid`` and ``problem``."""
    text = F.trim(F.col("rule_text"))
    has_colon = F.instr(text, ":") > 0
    name = F.trim(F.substring_index(text, ":", 1))
    rest = F.trim(F.expr("substring(trim(rule_text), instr(trim(rule_text), ':') + 1)"))
    src = F.upper(F.trim(F.substring_index(rest, "=", 1)))
    has_eq = F.instr(rest, "=") > 0
    tgt = F.trim(F.expr("substring(rest, instr(rest, '=') + 1)"))
    n_pct = F.length(name) - F.length(F.regexp_replace(name, "%", ""))
    kind = (F.when(n_pct == 0, F.lit("exact"))
            .when((n_pct == 1) & name.startswith("%") & (F.length(name) > 1), F.lit("suffix"))
            .when((n_pct == 1) & name.endswith("%") & (F.length(name) > 1), F.lit("prefix")))
    match = (F.when(kind == "suffix", F.expr("substring(name, 2)"))
             .when(kind == "prefix", F.expr("substring(name, 1, length(name) - 1)"))
             .otherwise(name))
    df = (rules.withColumn("name", name).withColumn("rest", rest)
          .withColumn("triple", F.when(has_colon & has_eq, target_triple(tgt))))
    problem = (F.when(~has_colon | (name == ""), F.lit("no column before ':'"))
               .when(~has_eq, F.lit("no '=' in type mapping"))
               .when(~src.isin(*RULE_SOURCES), F.lit("source type must be NUMBER or FLOAT"))
               .when(kind.isNull(), F.lit("pattern must be %SUFFIX or PREFIX%"))
               .when(F.col("triple").isNull(), F.lit("unknown target type"))
               .when(bad_decimal(F.col("triple")), F.lit("decimal precision or scale out of range")))
    return (df.select(
        "rule_pos", "rule_text",
        kind.alias("match_kind"), F.upper(match).alias("match_text"), src.alias("source_type"),
        F.col("triple.c").alias("target_class"), F.col("triple.p").alias("target_precision"),
        F.col("triple.s").alias("target_scale"), problem.isNull().alias("valid"), problem.alias("problem"))
        .select(*RULE_COLUMNS))


def parse_rule_text(spark: SparkSession, text: str | None) -> DataFrame:
    return parse_rules(rules_frame(spark, text))
