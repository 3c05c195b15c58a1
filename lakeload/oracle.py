"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Every string here runs on DuckDB with the test tables registered as views under their own names.
Column names and types follow the Spark side exactly: counts are BIGINT, digit counts INTEGER.
The SQL is generated from the same column lists the Spark queries use, never from Spark results.
"""

from __future__ import annotations

INTEGRAL = {"bigint", "int", "smallint", "tinyint"}


def classify_sql(expr: str, kind: str) -> dict[str, str]:
    """SQL fragments classifying ``expr`` (same rules as lakeload.functions.numeric.classify)."""
    if kind in INTEGRAL:
        return {
            "is_int": f"({expr} IS NOT NULL AND {expr} BETWEEN -2147483648 AND 2147483647)",
            "is_long": f"({expr} IS NOT NULL AND NOT ({expr} BETWEEN -2147483648 AND 2147483647))",
            "precision": f"(length(CAST({expr} AS VARCHAR)) - CASE WHEN {expr} < 0 THEN 1 ELSE 0 END)",
            "scale": f"(CASE WHEN {expr} IS NOT NULL THEN 0 END)",
            "unknown": "false",
        }
    # Doubles become decimals through their shortest text, as Spark converts them (DuckDB's direct
    # cast keeps the binary expansion, e.g. 172799.49 -> 172799.4899999999).
    d = expr if kind.startswith("decimal") else (
        f"TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,10))" if kind in ("double", "float")
        else f"TRY_CAST({expr} AS DECIMAL(38,10))")
    text = f"CAST(abs({d}) AS VARCHAR)"
    frac = f"rtrim(CASE WHEN instr({text}, '.') > 0 THEN split_part({text}, '.', 2) ELSE '' END, '0')"
    whole = f"split_part({text}, '.', 1)"
    scale = f"length({frac})"
    precision = f"greatest(1, length(ltrim({whole} || {frac}, '0')))"
    is_whole = f"({d} IS NOT NULL AND {scale} = 0)"
    fits_int = f"({d} BETWEEN -2147483648 AND 2147483647)"
    fits_long = f"({d} BETWEEN -9223372036854775808 AND 9223372036854775807)"
    return {
        "is_int": f"({is_whole} AND {fits_int})",
        "is_long": f"({is_whole} AND NOT {fits_int} AND {fits_long})",
        "precision": precision,
        "scale": scale,
        "unknown": (f"({expr} IS NOT NULL AND ({d} IS NULL OR CAST({d} AS {kind.upper()}) <> {expr}))" if kind in ("double", "float")
                    else "false"),
    }


def classify_floating_sql(expr: str) -> dict[str, str]:
    finite = f"(NOT isnan({expr}) AND abs({expr}) <> 'inf'::DOUBLE)"
    whole = f"({expr} IS NOT NULL AND {finite} AND {expr} = floor({expr}))"
    fits_int = f"({expr} BETWEEN -2147483648.0 AND 2147483647.0)"
    fits_long = f"({expr} >= -9.223372036854775808e18 AND {expr} < 9.223372036854775808e18)"
    return {
        "is_int": f"({whole} AND {fits_int})",
        "is_long": f"({whole} AND NOT {fits_int} AND {fits_long})",
        "precision": f"(CASE WHEN {expr} IS NOT NULL THEN 0 END)",
        "scale": f"(CASE WHEN {expr} IS NOT NULL THEN 0 END)",
        "unknown": "false",
    }


def profile_sql(source: str, table: str, cols, group_by: str | None = None, floating: bool = False) -> str:
    """Profile rows of ``cols`` [(name, kind, position)] from ``source`` (a view name or subquery)."""
    parts = []
    for name, kind, pos in cols:
        c = classify_floating_sql(name) if floating else classify_sql(name, kind)
        gsel = f"{group_by}, " if group_by else ""
        gby = f" GROUP BY {group_by}" if group_by else ""
        parts.append(
            f"SELECT '{table}' AS table_name, {gsel}'{name}' AS column_name, CAST({pos} AS INTEGER) AS position, "
            f"CAST(count(*) AS BIGINT) AS total_values, "
            f"CAST(count(*) - count({name}) AS BIGINT) AS null_values, "
            f"CAST(count_if({c['is_int']}) AS BIGINT) AS int_values, "
            f"CAST(count_if({c['is_long']}) AS BIGINT) AS long_values, "
            f"CAST(count({name}) - count_if({c['is_int']}) - count_if({c['is_long']}) AS BIGINT) AS decimal_values, "
            f"CAST(coalesce(max({c['precision']}), 0) AS INTEGER) AS max_precision, "
            f"CAST(coalesce(max({c['scale']}), 0) AS INTEGER) AS max_scale, "
            f"CAST(coalesce(max(greatest(0, {c['precision']} - {c['scale']})), 0) AS INTEGER) AS max_int_digits, "
            f"CAST(count_if({c['unknown']}) AS BIGINT) AS unclassified_values "
            f"FROM {source}{gby}")
    return "\nUNION ALL\n".join(parts)


def recommend_sql(alias: str = "", threshold: float = 95.0) -> str:
    a = f"{alias}." if alias else ""
    nonnull = f"({a}total_values - {a}null_values)"
    p = f"least(38, greatest(10, {a}max_precision))"
    s = f"least({p}, greatest(2, {a}max_scale))"
    return (f"CASE WHEN {nonnull} = 0 THEN 'decimal(38,10)' "
            f"WHEN CAST({a}int_values AS DOUBLE) * 100.0 / CAST({nonnull} AS DOUBLE) > {threshold} THEN 'integer' "
            f"WHEN CAST({a}int_values + {a}long_values AS DOUBLE) * 100.0 / CAST({nonnull} AS DOUBLE) > {threshold} "
            f"THEN 'long' "
            f"ELSE 'decimal(' || CAST({p} AS VARCHAR) || ',' || CAST({s} AS VARCHAR) || ')' END")


def lossless_sql(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    nonnull = f"({a}total_values - {a}null_values)"
    digits = f"least(38, {a}max_int_digits)"
    s = f"greatest(0, least({a}max_scale, 38 - {digits}))"
    p = f"greatest(1, {digits} + {s})"
    return (f"CASE WHEN {nonnull} = 0 THEN 'decimal(38,10)' "
            f"WHEN {a}unclassified_values > 0 OR {a}max_int_digits + {a}max_scale > 38 THEN 'string' "
            f"WHEN {a}decimal_values = 0 AND {a}long_values = 0 THEN 'integer' "
            f"WHEN {a}decimal_values = 0 THEN 'long' "
            f"ELSE 'decimal(' || CAST({p} AS VARCHAR) || ',' || CAST({s} AS VARCHAR) || ')' END")


# The driver's test-table schemas as Spark reads them (name, Spark type), in order.
SCHEMAS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}

# Type class and declared precision of each Spark type (mirrors operators.keys).
TYPE_CLASS = {"bigint": ("BIGINT", 19), "int": ("INTEGER", 10), "smallint": ("SMALLINT", 5),
              "tinyint": ("TINYINT", 3), "double": ("DOUBLE", 0), "float": ("FLOAT", 0),
              "boolean": ("BOOLEAN", 0), "string": ("VARCHAR", 0), "timestamp_ntz": ("TIMESTAMP", 0),
              "timestamp": ("TIMESTAMP_WITH_TIMEZONE", 0), "date": ("DATE", 0), "binary": ("BINARY", 0)}


def numeric_cols(table: str):
    """(name, kind, position) of the numeric columns of a test table."""
    num = {"bigint", "int", "smallint", "tinyint", "double", "float"}
    return [(n, t, i) for i, (n, t) in enumerate(SCHEMAS[table], start=1) if t in num or t.startswith("decimal")]


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def ladder_sql(cls: str, p0: str, s0: str, dp: int = 38, ds: int = 10) -> dict[str, str]:
    """SQL CASE expressions of the type ladder (same rules as lakeload.functions.types.ladder)."""
    neg = f"({s0} < 0 AND {p0} >= 1 AND {p0} <= 38)"
    p = f"(CASE WHEN {neg} THEN least(38, {p0} - {s0}) ELSE {p0} END)"
    s = f"(CASE WHEN {neg} THEN 0 ELSE {s0} END)"
    dflt = f"(({p0} = 0 AND {s0} = 0) OR ({s0} < 0 AND {p0} < 1) OR {p0} > 38)"
    dec = f"'decimal(' || CAST({p} AS VARCHAR) || ',' || CAST({s} AS VARCHAR) || ')'"
    d = f"'decimal({dp},{ds})'"
    c = f"upper({cls})"

    def num(v_default, v_int, v_long, v_dec, v_else):
        return (f"CASE WHEN {dflt} THEN {v_default} WHEN {s} = 0 AND {p} < 10 THEN {v_int} "
                f"WHEN {s} = 0 AND {p} < 19 THEN {v_long} WHEN {s} >= 0 AND {s} <= {p} THEN {v_dec} ELSE {v_else} END")

    def full(v_num, fixed):
        whens = " ".join(f"WHEN {cond} THEN {val}" for cond, val in fixed)
        return f"(CASE WHEN {c} IN ('NUMERIC', 'DECIMAL') THEN {num(*v_num)} {whens} END)"

    classes = [("FLOAT", "float", "float"), ("DOUBLE", "double", "double"), ("BOOLEAN", "boolean", "boolean"),
               ("INT", "int", "int"), ("BIGINT", "long", "bigint"), ("STR", "string", "string"),
               ("TIMESTAMP", "timestamp", "timestamp_ntz"), ("TIMESTAMP_WITH_TIMEZONE", "timestamptz", "timestamp"),
               ("DATE", "date", "date"), ("TIME", "time", "string"), ("BINARY", "binary", "binary")]
    conds = {"INT": f"{c} IN ('TINYINT', 'SMALLINT', 'INTEGER')", "STR": f"{c} IN ('VARCHAR', 'NVARCHAR')"}

    def cond(k):
        return conds.get(k, f"{c} = '{k}'")

    tt = [(cond(k), f"'{n}'") for k, n, _ in classes] + [("TRUE", "'string'")]
    st = [(cond(k), f"'{n}'") for k, _, n in classes] + [("TRUE", "'string'")]
    tp = [(cond("INT"), "9"), (cond("BIGINT"), "18"), ("TRUE", "0")]
    ts = [("TRUE", "0")]
    return {
        "target_type": full((d, "'int'", "'long'", dec, d), tt),
        "target_precision": f"CAST({full((str(dp), '9', '18', p, str(dp)), tp)} AS INTEGER)",
        "target_scale": f"CAST({full((str(ds), '0', '0', s, str(ds)), ts)} AS INTEGER)",
        "spark_type": full((d, "'int'", "'bigint'", dec, d), st),
    }


NUMERIC_CLASS_LIST = "('NUMERIC', 'DECIMAL', 'TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'DOUBLE', 'FLOAT', 'REAL')"


def declared_sql(tables) -> str:
    """Column descriptors with numeric columns declared NUMBER(p,s) from their profile."""
    parts = []
    for t in tables:
        num = numeric_cols(t)
        names = {n for n, _, _ in num}
        parts.append(
            f"SELECT table_name, column_name, position, 'NUMERIC' AS type_class, "
            f"CAST(CASE WHEN total_values - null_values = 0 THEN 0 ELSE max_int_digits + max_scale END AS INTEGER) "
            f"AS precision, CAST(CASE WHEN total_values - null_values = 0 THEN 0 ELSE max_scale END AS INTEGER) "
            f"AS scale, true AS nullable FROM ({profile_sql(t, t, num)})")
        for pos, (n, typ) in enumerate(SCHEMAS[t], start=1):
            if n not in names:
                cls, prec = TYPE_CLASS.get(typ, ("OTHER", 0))
                parts.append(f"SELECT '{t}' AS table_name, '{n}' AS column_name, {pos} AS position, "
                             f"'{cls}' AS type_class, {prec} AS precision, 0 AS scale, true AS nullable")
    return union(parts)


def plan_sql(columns_sql: str, rules: list[tuple], inferred_sql: str | None = None, dp: int = 38, ds: int = 10) -> str:
    """Plan rows for descriptors ``columns_sql`` with parsed rules
    [(pos, text, kind, match, class, p, s)] and optional inferred (table_name, column_name, recommended_type)."""
    choices = []
    if rules:
        vals = ", ".join(f"({pos}, '{txt}', '{kind}', '{m}', '{c}', {p}, {s})" for pos, txt, kind, m, c, p, s in rules)
        choices.append(
            "SELECT c.table_name, c.column_name, CASE WHEN r.kind = 'exact' THEN 1 ELSE 3 END AS prec, r.pos, "
            "CASE WHEN r.kind = 'exact' THEN 'exact' ELSE 'pattern' END AS source, r.txt AS text, r.c, r.p, r.s "
            f"FROM cols c JOIN (VALUES {vals}) r(pos, txt, kind, m, c, p, s) ON "
            "((r.kind = 'exact' AND upper(c.column_name) = r.m) OR (r.kind = 'prefix' AND starts_with(upper(c.column_name), r.m)) "
            "OR (r.kind = 'suffix' AND ends_with(upper(c.column_name), r.m))) "
            f"WHERE upper(c.type_class) IN {NUMERIC_CLASS_LIST}")
    if inferred_sql:
        choices.append(
            "SELECT c.table_name, c.column_name, 2 AS prec, 0 AS pos, 'inferred' AS source, i.recommended_type AS text, "
            "CASE WHEN i.recommended_type = 'integer' THEN 'INTEGER' WHEN i.recommended_type = 'long' THEN 'BIGINT' "
            "ELSE 'NUMERIC' END AS c, "
            "CASE WHEN i.recommended_type = 'integer' THEN 9 WHEN i.recommended_type = 'long' THEN 18 "
            "ELSE CAST(regexp_extract(i.recommended_type, 'decimal\\((\\d+),', 1) AS INTEGER) END AS p, "
            "CASE WHEN i.recommended_type IN ('integer', 'long') THEN 0 "
            "ELSE CAST(regexp_extract(i.recommended_type, ',(\\d+)\\)', 1) AS INTEGER) END AS s "
            f"FROM cols c JOIN ({inferred_sql}) i ON c.table_name = i.table_name AND c.column_name = i.column_name "
            f"WHERE upper(c.type_class) IN {NUMERIC_CLASS_LIST}")
    if choices:
        best = (f"SELECT table_name, column_name, arg_min(source, prec * 100000 + pos) AS source, "
                f"arg_min(text, prec * 100000 + pos) AS text, arg_min(c, prec * 100000 + pos) AS rc, "
                f"arg_min(p, prec * 100000 + pos) AS rp, arg_min(s, prec * 100000 + pos) AS rs "
                f"FROM ({union(choices)}) GROUP BY table_name, column_name")
    else:
        best = ("SELECT NULL::VARCHAR AS table_name, NULL::VARCHAR AS column_name, NULL::VARCHAR AS source, "
                "NULL::VARCHAR AS text, NULL::VARCHAR AS rc, NULL::INTEGER AS rp, NULL::INTEGER AS rs WHERE false")
    lad = ladder_sql("coalesce(b.rc, c.type_class)", "coalesce(b.rp, c.precision)", "coalesce(b.rs, c.scale)", dp, ds)
    return (f"WITH cols AS ({columns_sql}), best AS ({best}) "
            f"SELECT c.table_name, c.column_name, c.position, c.type_class, c.precision, c.scale, c.nullable, "
            f"coalesce(b.source, 'base') AS rule_source, b.text AS rule_text, "
            f"{lad['target_type']} AS target_type, {lad['target_precision']} AS target_precision, "
            f"{lad['target_scale']} AS target_scale, {lad['spark_type']} AS spark_type "
            f"FROM cols c LEFT JOIN best b ON c.table_name = b.table_name AND c.column_name = b.column_name")
