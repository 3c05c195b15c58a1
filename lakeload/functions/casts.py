"""Checked conversions to planned target types, as native Column expressions.

Policy (per target column):

* nullable target: a value that cannot be represented becomes NULL and is reported with a reason
  (``overflow``, ``infinite``, ``nan``, ``invalid``) in the reject table;
* required target: such a value, or a NULL, stops the job (``raise_error``), unless the caller routes
  those rows to the reject table instead.

Numbers to int/long truncate toward zero; numbers to decimal(p,s) round HALF_UP to ``s`` and fail when
more than ``p`` digits remain.  All of it is ``try_cast`` plus tests, so it stays in generated code.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reject reasons.
OVERFLOW, INFINITE, NAN, INVALID, NULL_REQUIRED = "overflow", "infinite", "nan", "invalid", "null_in_required"

# Strings are cut at the decimal point before an integer conversion ("2.99999999999" -> 2), those with an exponent after
# moving the point ("2.99999999999E0" -> 2); other texts are read as decimal(38,10).
_TEXT_NUMBER = "decimal(38,10)"
_PLAIN_NUMBER = r"^[+-]?[0-9]+([.][0-9]*)?$"
_PLAIN_FRACTION = r"^([+-]?[0-9]+)[.][0-9]*$"
# Sign, digits before and after the point, exponent.
_EXPONENT_NUMBER = r"^([+-]?)(?=[.]?[0-9])([0-9]*)[.]?([0-9]*)[eE]([+-]?[0-9]{1,3})$"


# Bits of the integer types, without the sign.
_BITS = {"tinyint": 7, "smallint": 15, "int": 31, "integer": 31, "bigint": 63}
_SOURCE_BITS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def try_cast(col: Column, spark_type: str) -> Column:
    return col.try_cast(spark_type)


def _to_integer(col: Column, source: T.DataType, kind: str) -> Column:
    """``try_cast`` to an integer type, of a number only where it is in the type's range: inside Spark each failed try
    throws and catches an exception, which costs far more than the conversion of a good value."""
    value, end = try_cast(col, kind), 1 << _BITS[kind]
    if isinstance(source, T.DecimalType) and source.precision - source.scale >= len(str(end)):
        return F.when((col > F.lit(Decimal(-end - 1))) & (col < F.lit(Decimal(end))), value)
    if _SOURCE_BITS.get(type(source), 0) > _BITS[kind]:
        return F.when(col.between(-end, end - 1), value)
    if isinstance(source, (T.FloatType, T.DoubleType)):  # the ends may pass, the cast decides
        return F.when(col.between(float(-end - 1), float(end)), value)
    return value


def whole_part(text: Column) -> Column:
    """The digits before the point of a number with an exponent, with its sign."""
    part = lambda i: F.regexp_extract(text, _EXPONENT_NUMBER, i)
    shift = F.coalesce(try_cast(part(4), "int"), F.lit(0))
    up = F.concat(part(2), F.substring(F.rpad(part(3), F.greatest(shift, F.length(part(3))), F.lit("0")), F.lit(1), shift))
    down = F.substring(part(2), F.lit(1), F.greatest(F.lit(0), F.length(part(2)) + shift))
    return F.concat(part(1), F.lit("0"), F.when(shift >= 0, up).otherwise(down))


@dataclass(frozen=True)
class Converted:
    value: Column    # converted value (NULL when not representable)
    reason: Column   # NULL when fine, else the reject reason


def convert(col: Column, source: T.DataType, spark_type: str, done: Column | None = None) -> Converted:
    """Convert ``col`` of Spark type ``source`` to ``spark_type`` (a Spark SQL type string); ``done`` is the column that has
    the converted value already."""
    target = spark_type.strip().lower()
    floating = isinstance(source, (T.FloatType, T.DoubleType))
    text = isinstance(source, T.StringType)
    if target in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        kind = "bigint" if target in ("bigint", "long") else target
        value = _to_integer(col, source, kind)
        if text:
            plain = F.trim(col)
            whole = try_cast(F.regexp_replace(plain, _PLAIN_FRACTION, "$1"), "decimal(38,0)")
            value = (F.when(plain.rlike(_PLAIN_NUMBER), try_cast(whole, kind))
                     .when(plain.rlike(_EXPONENT_NUMBER), try_cast(try_cast(F.regexp_replace(whole_part(plain), "^([+-]?)0+([0-9])", "$1$2"), "decimal(38,0)"), kind))
                     .otherwise(try_cast(try_cast(col, _TEXT_NUMBER), kind)))
    elif target.startswith("decimal") or target in ("float", "double", "boolean", "date", "binary",
                                                    "timestamp", "timestamp_ntz", "timestamp_ltz"):
        value = try_cast(col, target)
    elif target == "string":
        value = F.hex(col) if isinstance(source, T.BinaryType) else col.cast("string")
    elif target == "time":
        value = F.date_format(col if not text else try_cast(col, "timestamp_ntz"), "HH:mm:ss")
    else:
        raise ValueError(f"unsupported target type {spark_type!r}")
    value = value if done is None else done
    failed = col.isNotNull() & value.isNull()
    if floating:
        why = (F.when(F.isnan(col), F.lit(NAN))
               .when(F.abs(col) == F.lit(float("inf")), F.lit(INFINITE))
               .otherwise(F.lit(OVERFLOW)))
    elif text:
        number = target not in ("date", "time", "boolean", "binary") and not target.startswith("timestamp")
        why = F.when(try_cast(col, "double").isNull(), F.lit(INVALID)).otherwise(F.lit(OVERFLOW)) if number else F.lit(INVALID)
    else:
        why = F.lit(OVERFLOW)
    return Converted(value=value, reason=F.when(failed, why))


def raw_text(col: Column, source: T.DataType) -> Column:
    """The raw value as text for the reject table (binary as hex)."""
    return F.hex(col) if isinstance(source, T.BinaryType) else col.cast("string")


def required(value: Column, reason: Column, original: Column, name: str) -> Column:
    """Value of a required column: raise on a NULL or on a failed conversion."""
    return (F.when(original.isNull(), F.raise_error(F.lit(f"NULL in required column {name}")))
            .when(reason.isNotNull(), F.raise_error(F.concat(
                F.lit(f"cannot convert column {name} value "), original.cast("string"), F.lit(": "), reason)))
            .otherwise(value))
