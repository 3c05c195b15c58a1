"""Type ladder and type-name classification as native Column expressions.

``ladder`` turns a source column descriptor (type class, precision, scale) into a lake target type.
It is one CASE expression, so a plan over millions of column descriptors is a narrow projection.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# JDBC type classes (java.sql.Types names and codes, JDBC 4.2).
JDBC_TYPE_CODES = {
    "BIT": -7, "TINYINT": -6, "SMALLINT": 5, "INTEGER": 4, "BIGINT": -5, "FLOAT": 6, "REAL": 7, "DOUBLE": 8,
    "NUMERIC": 2, "DECIMAL": 3, "CHAR": 1, "VARCHAR": 12, "LONGVARCHAR": -1, "DATE": 91, "TIME": 92,
    "TIMESTAMP": 93, "BINARY": -2, "VARBINARY": -3, "LONGVARBINARY": -4, "NULL": 0, "OTHER": 1111,
    "JAVA_OBJECT": 2000, "DISTINCT": 2001, "STRUCT": 2002, "ARRAY": 2003, "BLOB": 2004, "CLOB": 2005,
    "REF": 2006, "DATALINK": 70, "BOOLEAN": 16, "ROWID": -8, "NCHAR": -15, "NVARCHAR": -9,
    "LONGNVARCHAR": -16, "NCLOB": 2011, "SQLXML": 2009, "REF_CURSOR": 2012, "TIME_WITH_TIMEZONE": 2013,
    "TIMESTAMP_WITH_TIMEZONE": 2014,
}

# Source dictionary type names -> type class.  Database names first (a DATE of that
# database carries a time of day, hence TIMESTAMP), then the Spark names of file sources.
TYPE_NAME_CLASSES = {
    "NUMBER": "NUMERIC", "VARCHAR2": "VARCHAR", "VARCHAR": "VARCHAR", "CHAR": "CHAR", "DATE": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMP", "CLOB": "CLOB", "BLOB": "BLOB", "RAW": "VARBINARY",
    "NVARCHAR2": "NVARCHAR", "NCHAR": "NCHAR", "NCLOB": "NCLOB", "FLOAT": "FLOAT", "BINARY_FLOAT": "FLOAT",
    "BINARY_DOUBLE": "DOUBLE", "TIMESTAMP WITH TIME ZONE": "TIMESTAMP_WITH_TIMEZONE",
    "TIMESTAMP WITH LOCAL TIME ZONE": "TIMESTAMP_WITH_TIMEZONE", "ROWID": "ROWID",
    "BIGINT": "BIGINT", "INT": "INTEGER", "INTEGER": "INTEGER", "SMALLINT": "SMALLINT", "TINYINT": "TINYINT",
    "DOUBLE": "DOUBLE", "REAL": "REAL", "DECIMAL": "DECIMAL", "NUMERIC": "NUMERIC", "BOOLEAN": "BOOLEAN",
    "STRING": "VARCHAR", "TIMESTAMP_NTZ": "TIMESTAMP", "TIMESTAMP_LTZ": "TIMESTAMP_WITH_TIMEZONE",
    "BINARY": "BINARY",
}

NUMBER_CLASSES = ("NUMERIC", "DECIMAL")
INT_CLASSES = ("TINYINT", "SMALLINT", "INTEGER")
FLOAT_CLASSES = ("FLOAT", "REAL")
NUMERIC_CLASSES = NUMBER_CLASSES + INT_CLASSES + ("BIGINT", "DOUBLE") + FLOAT_CLASSES

# Largest decimal precision of the lake format and the default for ambiguous NUMBER.
MAX_PRECISION = 38
DEFAULT_NUMBER = (38, 10)

_DEC = re.compile(r"^\s*(?:decimal|numeric|number)\s*\(\s*(-?\d+)\s*,\s*(-?\d+)\s*\)\s*$", re.IGNORECASE)


def parse_default(text: str | None) -> tuple[int, int]:
    """Default precision/scale for ambiguous NUMBER: ``decimal(p,s)`` or ``number=decimal(p,s)``."""
    if text is None or not text.strip():
        return DEFAULT_NUMBER
    t = text.strip()
    if "=" in t:
        src, t = t.split("=", 1)
        if src.strip().upper() not in ("NUMBER", "FLOAT"):
            raise ValueError(f"default must be given for NUMBER: {text!r}")
    m = _DEC.match(t)
    if not m:
        raise ValueError(f"default must be decimal(p,s): {text!r}")
    p, s = int(m.group(1)), int(m.group(2))
    if not (1 <= p <= MAX_PRECISION and 0 <= s <= p):
        raise ValueError(f"default decimal({p},{s}) is outside 1 <= p <= 38, 0 <= s <= p")
    return p, s


def base_name(type_name: Column) -> Column:
    """Upper-cased type name without length/precision arguments: ``TIMESTAMP(6) WITH TIME ZONE`` ->
    ``TIMESTAMP WITH TIME ZONE``, ``decimal(10,2)`` -> ``DECIMAL``."""
    return F.trim(F.regexp_replace(F.upper(type_name), r"\s*\([^)]*\)", ""))


def classify_type_name(type_name: Column) -> Column:
    """Type class of a dictionary or Spark type name; unknown names are OTHER."""
    pairs = [x for k, v in TYPE_NAME_CLASSES.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), base_name(type_name)), F.lit("OTHER"))


def type_code(type_class: Column) -> Column:
    pairs = [x for k, v in JDBC_TYPE_CODES.items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*pairs), type_class)


def ladder(type_class: Column, precision: Column, scale: Column,
           default: tuple[int, int] = DEFAULT_NUMBER) -> Column:
    """Target type of a source column: struct(target_type, target_precision, target_scale, spark_type).

    NUMBER family: unspecified (p=0,s=0, or s<0 with p<1) or p>38 -> default decimal; negative scale
    -> decimal(p-s, 0) capped at 38 through the integer steps; s=0 and p<10 -> int; s=0 and p<19 ->
    long; 0<=s<=p<=38 -> decimal(p,s); anything else -> default.
    """
    dp, ds = default
    cls = F.upper(type_class)
    p0, s0 = precision.cast("int"), scale.cast("int")
    negative = (s0 < 0) & (p0 >= 1) & (p0 <= MAX_PRECISION)
    p = F.when(negative, F.least(F.lit(MAX_PRECISION), p0 - s0)).otherwise(p0)
    s = F.when(negative, F.lit(0)).otherwise(s0)

    def out(name, tp, ts, spark):
        return F.struct(F.lit(name).alias("target_type") if isinstance(name, str) else name.alias("target_type"),
                        (F.lit(tp) if isinstance(tp, int) else tp).cast("int").alias("target_precision"),
                        (F.lit(ts) if isinstance(ts, int) else ts).cast("int").alias("target_scale"),
                        F.lit(spark).alias("spark_type") if isinstance(spark, str) else spark.alias("spark_type"))

    default_dec = out(F.lit(f"decimal({dp},{ds})"), dp, ds, F.lit(f"decimal({dp},{ds})"))
    dec = F.format_string("decimal(%d,%d)", p, s)
    number = (F.when(((p0 == 0) & (s0 == 0)) | ((s0 < 0) & (p0 < 1)) | (p0 > MAX_PRECISION), default_dec)
              .when((s == 0) & (p < 10), out("int", 9, 0, "int"))
              .when((s == 0) & (p < 19), out("long", 18, 0, "bigint"))
              .when((s >= 0) & (s <= p), out(dec, p, s, dec))
              .otherwise(default_dec))
    return (F.when(cls.isin(*NUMBER_CLASSES), number)
            .when(cls == "FLOAT", out("float", 0, 0, "float"))
            .when(cls == "DOUBLE", out("double", 0, 0, "double"))
            .when(cls == "BOOLEAN", out("boolean", 0, 0, "boolean"))
            .when(cls.isin(*INT_CLASSES), out("int", 9, 0, "int"))
            .when(cls == "BIGINT", out("long", 18, 0, "bigint"))
            .when(cls.isin("VARCHAR", "NVARCHAR"), out("string", 0, 0, "string"))
            .when(cls == "TIMESTAMP", out("timestamp", 0, 0, "timestamp_ntz"))
            .when(cls == "TIMESTAMP_WITH_TIMEZONE", out("timestamptz", 0, 0, "timestamp"))
            .when(cls == "DATE", out("date", 0, 0, "date"))
            .when(cls == "TIME", out("time", 0, 0, "string"))
            .when(cls == "BINARY", out("binary", 0, 0, "binary"))
            .otherwise(out("string", 0, 0, "string")))


def recommended_name(target_type: Column) -> Column:
    """Report spelling of a target type (``int`` -> ``integer``, zoned timestamps -> ``timestamp``)."""
    return (F.when(target_type == "int", F.lit("integer"))
            .when(target_type == "timestamptz", F.lit("timestamp"))
            .when(target_type == "time", F.lit("string"))
            .otherwise(target_type))
