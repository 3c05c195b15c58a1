"""Classification of numeric values as native SQL expressions.

A value is classified the way a lake loader needs it: integer-valued and inside the 32-bit range
(``int``), integer-valued and inside the 64-bit range (``long``), or anything else (``decimal``),
together with its precision and scale.  Precision and scale are normalised: trailing fraction zeros are
stripped and the scale is never negative, so ``100`` has precision 3, scale 0 and ``0.05`` precision 1,
scale 2.  Everything here is SQL expression text applied with ``selectExpr``; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The integer ranges of the 32- and 64-bit target types.
INT_MIN, INT_MAX = -2147483648, 2147483647
LONG_MIN, LONG_MAX = -9223372036854775808, 9223372036854775807

# Values that are not decimals already are read as decimal(38,10), as a database driver delivers
# an unconstrained NUMBER.
PROFILE_DECIMAL = "decimal(38,10)"

INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING_TYPES = (T.FloatType, T.DoubleType)
NUMERIC_TYPES = INTEGRAL_TYPES + FLOATING_TYPES + (T.DecimalType,)


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


# Largest magnitude (times 10^k) at which double arithmetic decides a k-digit decimal exactly (< 2^52).
_EXACT_LIMIT = 4.0e15
_MAX_FAST_SCALE = 10
# Plain decimal text (an optional sign, digits, an optional fraction); other text is not classified.
_TEXT_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_INT_RANGE = "BETWEEN -2147483648 AND 2147483647"
_LONG_RANGE = ("BETWEEN CAST('-9223372036854775808' AS DECIMAL(20,0)) "
               "AND CAST('9223372036854775807' AS DECIMAL(20,0))")


def _double_scale_sql(x: str) -> str:
    """Smallest k in 0..10 with rint(|x| * 10^k) / 10^k == |x|, checked only while |x| * 10^k < 2^52
    so the test is exact; -1 when there is none (NaN, infinite, more than 10 fraction digits, too
    large).  The k-digit decimal found is the shortest decimal that reads back as the double, which
    is the value of its decimal(38,10) view.  One flat CASE."""
    whens = " ".join(
        f"WHEN abs({x}) * {10 ** j}.0D < {_EXACT_LIMIT}D AND rint(abs({x}) * {10 ** j}.0D) / {10 ** j}.0D = abs({x}) "
        f"THEN {j}" for j in range(_MAX_FAST_SCALE + 1))
    return f"CASE {whens} ELSE -1 END"


def _text_digits_sql(t: str, r: str, d: str, frac: int) -> tuple[str, str]:
    """(precision, scale) SQL of the plain text ``t`` of |d| with ``frac`` fraction digits."""
    if frac <= 0:
        return f"length({t})", f"IF({d} IS NOT NULL, 0, NULL)"
    scale = f"(length({r}) - (length({t}) - {frac}))"
    small = f"greatest(1, length(TRIM(LEADING '0.' FROM {r})))"
    return f"(CASE WHEN startswith({t}, '0') THEN {small} ELSE length({t}) - {frac + 1} + {scale} END)", scale


def classification_stages(cols, floating: bool = False, carry=()):
    """Per-row classification of ``cols`` [(position, name, type)] as successive SQL select lists.

    Each stage's output feeds the next, so every value is converted once however many aggregates
    read the result (inside one aggregate Spark would recompute shared sub-expressions per aggregate).

    * integers: digits = text length without the sign;
    * doubles: the scale is found by exact double arithmetic (``_double_scale_sql``) and the precision
      is the digit count of rint(|x| * 10^scale); only values this cannot decide take the decimal path;
    * decimals (and undecided doubles): from the plain text ``t`` of |d| at scale s and ``r`` = ``t``
      without trailing zeros, scale = len(r) - (len(t) - s), precision = integer digits + scale, or for
      |d| < 1 the digits of ``r`` after ``0.`` and leading zeros.

    Returns (stages, names): stages is a list of select lists (SQL text), the last one yielding
    names[i] = (value, is_int, is_long, precision, scale, unclassified) per column, plus the ``carry`` columns;
    unclassified: a value that precision and scale do not describe exactly (no decimal(38,10), other text).
    """
    names = {i: (f"__x{i}", f"__i{i}", f"__l{i}", f"__p{i}", f"__s{i}", f"__u{i}") for i in range(len(cols))}
    kinds, frac = {}, {}
    for i, (_, _, dt) in enumerate(cols):
        if isinstance(dt, T.StringType):
            kinds[i] = "text"
        elif floating:
            kinds[i] = "floating"
        elif isinstance(dt, INTEGRAL_TYPES):
            kinds[i] = "integral"
        elif isinstance(dt, T.DoubleType):
            kinds[i] = "double"
        else:
            kinds[i] = "decimal"
        if kinds[i] in ("double", "decimal"):
            frac[i] = dt.scale if isinstance(dt, T.DecimalType) else 10
    keep = [_q(c) for c in carry]

    def carried(extra):
        return keep + [f"__x{i}" for i in kinds] + [c for i in kinds if kinds[i] == "text"
                                                     for c in (f"__a{i}", f"__b{i}")] + extra

    stages = []
    # stage 1: values; scale of doubles by arithmetic; decimal view of other numbers
    s1 = keep + [f"{_q(n)} AS __x{i}" for i, (_, n, _) in enumerate(cols)]
    for i, (_, n, dt) in enumerate(cols):
        if kinds[i] == "double":
            s1.append(f"{_double_scale_sql(_q(n))} AS __k{i}")
        elif kinds[i] == "decimal":
            # a float by its shortest text, not by its binary expansion
            view = _q(n) if isinstance(dt, T.DecimalType) else f"try_cast(CAST({_q(n)} AS STRING) AS {PROFILE_DECIMAL})"
            s1.append(f"{view} AS __d{i}")
        elif kinds[i] == "text":
            s1.append(f"CASE WHEN trim({_q(n)}) RLIKE '{_TEXT_NUMBER}' THEN regexp_replace(trim({_q(n)}), '^[+-]', '') "
                      f"END AS __a{i}")
            s1.append(f"try_cast(regexp_replace(trim({_q(n)}), '[.]0*$', '') AS BIGINT) AS __b{i}")
    stages.append(s1)
    dec = [i for i in kinds if kinds[i] in ("double", "decimal")]
    if dec:
        # stage 2: scaled integer of decided doubles; decimal view of undecided doubles
        s2 = []
        for i in dec:
            if kinds[i] == "double":
                s2 += [f"__k{i}",
                       f"CASE WHEN __k{i} >= 0 THEN CAST(rint(abs(__x{i}) * power(10.0D, __k{i})) AS BIGINT) END AS __m{i}",
                       f"CASE WHEN __x{i} IS NOT NULL AND __k{i} < 0 THEN try_cast(__x{i} AS {PROFILE_DECIMAL}) END "
                       f"AS __d{i}"]
            else:
                s2.append(f"__d{i}")
        stages.append(carried(s2))
        # stage 3: text of |d|
        s3 = [c for i in dec for c in ([f"__k{i}", f"__m{i}"] if kinds[i] == "double" else [])]
        s3 += [f"__d{i}" for i in dec] + [f"CAST(abs(__d{i}) AS STRING) AS __t{i}" for i in dec]
        stages.append(carried(s3))
        # stage 4: text without trailing zeros
        s4 = [c for c in s3 if " AS " not in c] + [f"__t{i}" for i in dec]
        s4 += [(f"TRIM(TRAILING '0' FROM __t{i})" if frac[i] > 0 else f"__t{i}") + f" AS __r{i}" for i in dec]
        stages.append(carried(s4))

    # final stage: classification
    final = list(keep)
    for i in kinds:
        x = f"__x{i}"
        k = kinds[i]
        unknown = "false"
        if k == "integral":
            is_int = f"{x} IS NOT NULL AND {x} {_INT_RANGE}"
            is_long = f"{x} IS NOT NULL AND NOT ({x} {_INT_RANGE})"
            prec = f"length(CAST({x} AS STRING)) - IF({x} < 0, 1, 0)"
            scale = f"IF({x} IS NOT NULL, 0, NULL)"
        elif k == "text":
            a, b = f"__a{i}", f"__b{i}"
            frac_digits = f"TRIM(TRAILING '0' FROM IF(instr({a}, '.') > 0, substring_index({a}, '.', -1), ''))"
            scale = f"length({frac_digits})"
            unknown = f"{x} IS NOT NULL AND {a} IS NULL"
            prec = f"IF({a} IS NOT NULL, greatest(1, length(TRIM(LEADING '0' FROM concat(substring_index({a}, '.', 1), {frac_digits})))), NULL)"
            is_int = f"{a} IS NOT NULL AND {scale} = 0 AND {b} {_INT_RANGE}"
            is_long = f"{a} IS NOT NULL AND {scale} = 0 AND {b} IS NOT NULL AND NOT ({b} {_INT_RANGE})"
        elif k == "floating":
            whole = (f"{x} IS NOT NULL AND NOT isnan({x}) AND abs({x}) != double('Infinity') "
                     f"AND {x} = rint({x})")
            fits_int = f"{x} BETWEEN -2147483648.0D AND 2147483647.0D"
            fits_long = f"{x} >= -9.223372036854775808E18D AND {x} < 9.223372036854775808E18D"
            is_int = f"({whole}) AND {fits_int}"
            is_long = f"({whole}) AND NOT ({fits_int}) AND {fits_long}"
            prec = scale = f"IF({x} IS NOT NULL, 0, NULL)"
        else:
            d, t, r = f"__d{i}", f"__t{i}", f"__r{i}"
            prec, scale = _text_digits_sql(t, r, d, frac[i])
            whole = f"({d} IS NOT NULL AND {scale} = 0)"
            is_int = f"{whole} AND {d} {_INT_RANGE}"
            is_long = f"{whole} AND NOT ({d} {_INT_RANGE}) AND {d} {_LONG_RANGE}"
            number = cols[i][2]
            if isinstance(number, T.FloatType):
                unknown = f"{x} IS NOT NULL AND ({d} IS NULL OR CAST({d} AS FLOAT) != {x})"
            if k == "double":
                unknown = f"{x} IS NOT NULL AND __k{i} < 0 AND ({d} IS NULL OR CAST({d} AS DOUBLE) != {x})"
                kk, m = f"__k{i}", f"__m{i}"
                # decided values are below 2^52, so a whole one fits a long
                fast_int = f"{kk} = 0 AND {x} BETWEEN -2147483648.0D AND 2147483647.0D"
                is_int = f"CASE WHEN {kk} >= 0 THEN {fast_int} ELSE {is_int} END"
                is_long = f"CASE WHEN {kk} >= 0 THEN {kk} = 0 AND NOT ({fast_int}) ELSE {is_long} END"
                prec = f"CASE WHEN {kk} >= 0 THEN length(CAST({m} AS STRING)) ELSE {prec} END"
                scale = f"CASE WHEN {kk} >= 0 THEN {kk} ELSE {scale} END"
            is_int = f"{x} IS NOT NULL AND ({is_int})"
            is_long = f"{x} IS NOT NULL AND ({is_long})"
        final += [x, f"coalesce({is_int}, false) AS __i{i}", f"coalesce({is_long}, false) AS __l{i}",
                  f"CAST({prec} AS INT) AS __p{i}", f"CAST({scale} AS INT) AS __s{i}", f"coalesce({unknown}, false) AS __u{i}"]
    stages.append(final)
    return stages, names


def staged_classification(df, cols, floating: bool = False, carry=()):
    """``classification_stages`` applied to ``df`` (one ``selectExpr`` per stage)."""
    stages, names = classification_stages(cols, floating, carry)
    out = df
    for stage in stages:
        out = out.selectExpr(*stage)
    return out, names


def nest_stages(source: str, stages) -> str:
    """The stages as nested SQL subqueries over ``source`` (a view name)."""
    sql = source
    for n, stage in enumerate(stages):
        sql = f"(SELECT {', '.join(stage)} FROM {sql} AS __s{n})"
    return sql
